"""Spark-vs-DuckDB comparison helpers shared by the tests."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare_oracle import digest, duck, first_diff  # noqa: E402,F401


def compare(spark_df, con, sql):
    s_cols = list(spark_df.columns)
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols, d_rows = list(rel.columns), rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols), (s_cols, d_cols)
    if digest(s_cols, s_rows) != digest(d_cols, d_rows):
        a, b = first_diff(s_cols, s_rows, d_cols, d_rows)
        raise AssertionError(f"spark-only {a}\nduck-only {b}")
    return len(s_rows)
