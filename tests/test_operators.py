"""Skew-safe operators equal their textbook window/aggregate forms, also when
one key holds a third of the rows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sizes import SF_ORACLE
from verilens.operators import topk
from verilens.operators.lookup import left_join_skew_safe, resolve_roles
from verilens.operators.spread import with_parts
from verilens.operators.string_agg import ordered_concat


@pytest.fixture(scope="module")
def events(spark):
    e = spark.read.parquet(f"{SF_ORACLE}/events.parquet")
    # a hot key: every third event belongs to user 0
    return e.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))


def _same(a, b):
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.mark.parametrize("descending", [False, True])
def test_row_number_matches_window(events, descending):
    """Few rows make a key heavy here, so that it has many parts."""
    order = F.col("event_id").desc() if descending else F.col("event_id")
    w = Window.partitionBy("user_id")
    want = events.select("user_id", "event_id", F.row_number().over(w.orderBy(order)).alias("rn"),
                         (F.count("*").over(w) + 1 - F.row_number().over(w.orderBy(order))).alias("rest"))
    got = topk.row_number(events.select("user_id", "event_id"), ["user_id"], ["event_id"], descending=descending, from_the_end="rest", heavy_rows=64)
    _same(got.select("user_id", "event_id", "rn", "rest"), want)


def test_numbers_of_sparse_ids_and_null_keys(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 2).alias("k"), (F.col("id") * 10**14).alias("o"))
    want = rows.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o")))
    _same(topk.row_number(rows, ["k"], ["o"], heavy_rows=50).select("k", "o", "rn"), want)


@pytest.mark.parametrize("heavy", [10, 500, 100_000])
@pytest.mark.parametrize("form", ["yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", None])
def test_rank_desc_matches_window(events, form, heavy):
    """Times as texts that share their start, and as timestamps; some are missing."""
    time = F.col("ts") if form is None else F.date_format("ts", form)
    e = events.select("user_id", "event_id", F.when(F.col("event_id") % 7 != 0, time).alias("day"))
    want = e.select("user_id", "event_id", "day",
                    F.rank().over(Window.partitionBy("user_id").orderBy(F.col("day").desc_nulls_last())).alias("rank"))
    _same(topk.rank_desc(e, ["user_id"], "day", heavy_rows=heavy).select("user_id", "event_id", "day", "rank"), want)


def test_a_heavy_key_is_spread(events):
    """One key has a third of the rows and distinct times: no part has many of them, and no window is by the key alone."""
    e = events.select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"))
    sizes = with_parts(e, ["user_id"], "time", 500).where("user_id = 0").groupBy("_part").count().collect()
    assert len(sizes) > 10 and max(r["count"] for r in sizes) <= 500
    plan = topk.rank_desc(e, ["user_id"], "time", heavy_rows=500)._jdf.queryExecution().optimizedPlan().toString()
    specs = [w.split("specifiedwindowframe")[0] for w in plan.split("windowspecdefinition(")[1:]]
    # the window over rows is by key and part; the other adds up the counts of a heavy key's parts
    assert specs and all("_part#" in w or w.startswith("_p0#") for w in specs)


def test_top_rank_ties(events):
    e = events.select("user_id", "event_id", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    want = e.withColumn("r", F.rank().over(Window.partitionBy("user_id").orderBy(F.col("day").desc()))) \
        .filter("r = 1").drop("r")
    _same(topk.top_rank_ties(e, ["user_id"], "day"), want)


def test_first_and_last(events):
    want = events.groupBy("user_id").agg(F.min("event_id").alias("f"), F.max("event_id").alias("l"))
    got = topk.first_and_last(events, ["user_id"], ["event_id"], ["event_id"]) \
        .select("user_id", F.col("first_event_id").alias("f"), F.col("last_event_id").alias("l"))
    _same(got, want)


def test_ordered_concat_in_parts(events):
    e = events.select("user_id", "event_id", "event_type", F.concat(F.lit("a long start "), "event_type", F.col("event_id") % 50).alias("t"))
    for order, value in (("event_id", "event_type"), ("t", "t")):
        _same(ordered_concat(e, ["user_id"], order, value, "|", "s"), ordered_concat(e, ["user_id"], order, value, "|", "s", heavy_rows=20))


def test_ordered_concat_nulls(spark):
    df = spark.createDataFrame([(1, 1, None), (1, 2, "b"), (1, 3, "a"), (2, 1, None), (3, 1, "")],
                               "k int, o int, v string")
    for heavy in (1, 100):
        got = {r.k: r.s for r in ordered_concat(df, ["k"], "o", "v", ", ", "s", heavy_rows=heavy).collect()}
        assert got == {1: "b, a", 2: None, 3: ""}


def test_left_join_with_heavy_keys(events, spark):
    left = spark.createDataFrame([(0, "hot"), (0, "again"), (5, "some"), (-1, "none"), (None, "null")], "k long, x string")
    right = events.select(F.col("user_id").cast("long").alias("r"), "event_id")
    want = left.join(right, left.k == right.r, "left")
    for heavy in (3, 100, 10**6):
        _same(left_join_skew_safe(left, right, "k", "r", heavy_rows=heavy).select("k", "x", "r", "event_id"), want)
    plan = left_join_skew_safe(left, right, "k", "r")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1


def test_resolve_roles(spark):
    df = spark.createDataFrame([(1, "10", "bot", 7), (2, None, "11", 8)],
                               "k int, a string, b string, x int")
    users = spark.createDataFrame([(10, "ten"), (11, "eleven")], "id long, login string")
    got = {r.k: (r.x, r.la, r.lb) for r in
           resolve_roles(df, "k", {"la": "a", "lb": "b"}, users, "id", "login").collect()}
    assert got == {1: (7, "ten", None), 2: (8, None, "eleven")}
