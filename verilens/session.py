"""Session helpers.

Library code never creates a session; it only reads settings from the one it
is given.  ``local_session`` is for tests, the bench and the command line.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


class NoSharedFolder(RuntimeError):
    """The session names no folder that driver and executors share."""


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "verilens") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("VERILENS_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders made for local sessions that name none, by application.
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, without a trailing slash.

    A cluster must name it: without the setting ``NoSharedFolder`` is raised,
    because a folder made here would exist on one machine only.  In local mode
    (one JVM, as in tests) a scratch folder is made once per application; the
    setting itself can't be changed while a session runs."""
    current = spark.conf.get(CHECKPOINT_DIR, None)
    if not current:
        context = spark.sparkContext
        if not (context.master == "local" or context.master.startswith("local[")):
            raise NoSharedFolder(f"set {CHECKPOINT_DIR} to a folder shared by driver and executors")
        if context.applicationId not in _LOCAL:
            _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="verilens-shared-")
        current = _LOCAL[context.applicationId]
    return current.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and return it read back.

    This cuts the lineage in a form that survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/verilens/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
