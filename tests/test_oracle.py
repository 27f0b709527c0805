"""Registered queries against their DuckDB oracle on the smallest data.

The full set runs with ``python tools/compare_oracle.py <sf_dir>``; here the
reports and a cross-section of operators run at sf0.001 to keep the suite
quick.
"""

import pytest

import __spark_entry__ as E
from sizes import SF_SMALL
from oracle_util import compare, duck
from verilens.plans import catalog

KEYS = ["items", "tasks", "conversations", "rejects", "cte_statuses", "cte_useful_edges",
        "cte_status_changes", "cte_merged_comments", "cte_tag_strings", "cte_users_platform",
        "agg_pivot_fields", "fmt_answer", "yaml_status_vocab", "lookup_status_label",
        "win_first_and_last", "win_rank_ties", "agg_group_concat_sorted", "cast_prefix_int",
        "ts_iso_parse", "typed_projection", "src_workspace", "sink_empty_typed"]


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    """Every query of the catalog; optional queries may be beyond SQL."""
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    compare(df, con, E.oracle_sql()[key])


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "item_id"
