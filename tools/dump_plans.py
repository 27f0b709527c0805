"""Write ``explain("formatted")`` of the three reports over a stored workspace.

Usage: python tools/dump_plans.py <stored workspace dir> [out dir]
(``bench.py`` writes one; ``write_workspace`` makes one from any source.)
"""

import contextlib
import io
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(ws_dir: str, out_dir: str = "docs/plans") -> None:
    from verilens.plans.reports import report
    from verilens.session import local_session
    from verilens.sources.workspace import load_workspace

    spark = local_session(shuffle_partitions=16)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    ws = load_workspace(spark, ws_dir)
    os.makedirs(out_dir, exist_ok=True)
    for name in ("items", "tasks", "conversations"):
        df = report(ws, name)
        df.collect()          # run this DataFrame itself so explain shows the final AQE plan
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue().replace(ws_dir, "<workspace>")
        with open(os.path.join(out_dir, f"{name}.txt"), "w") as fh:
            fh.write(text)


if __name__ == "__main__":
    main(*sys.argv[1:])
