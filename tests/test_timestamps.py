"""ISO-8601 parsing for ``*_at`` columns (decision D8 edge rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from verilens.functions.timestamps import iso_timestamp

D = dt.datetime
CASES = [
    ("2020-10-10 12:00:00", D(2020, 10, 10, 12)),
    ("2024-01-01T00:16:06.738090", D(2024, 1, 1, 0, 16, 6, 738090)),
    ("2020-10-10T12:00:00+03:00", D(2020, 10, 10, 9)),
    ("2020-10-10T12:00:00Z", D(2020, 10, 10, 12)),
    ("2020-10-10T12:00-0130", D(2020, 10, 10, 13, 30)),
    ("20201010", D(2020, 10, 10)),
    ("20201010T120000Z", D(2020, 10, 10, 12)),
    ("2020-284", D(2020, 10, 10)),
    ("2020-W10-1", D(2020, 3, 2)),
    ("2020-10-10T24:00", D(2020, 10, 11)),
    ("2020-10", D(2020, 10, 1)),
    ("2020", D(2020, 1, 1)),
    ("12:00", None),
    ("now", None),
    (" 2020-10-10", None),
    ("2020-10-10 12:00:00 UTC", None),
    ("2020-13-01", None),
    ("2020-02-30 00:00:00", None),
    ("garbage", None),
    (None, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    return {r.i: r.v for r in df.select("i", iso_timestamp(F.col("t")).alias("v")).collect()}


@pytest.mark.parametrize("i", range(len(CASES)))
def test_iso(parsed, i):
    assert parsed[i] == CASES[i][1], CASES[i]


def _random_iso(rnd):
    def d2():
        return f"{rnd.randint(0, 99):02d}"
    y = f"{rnd.randint(1, 2100):04d}"
    date = rnd.choice([
        y, f"{y}-{d2()}", f"{y}{d2()}", f"{y}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 31):02d}",
        f"{y}{rnd.randint(1, 12):02d}{rnd.randint(1, 31):02d}", f"{y}-W{d2()}", f"{y}W{d2()}",
        f"{y}-W{rnd.randint(0, 54):02d}-{rnd.randint(0, 9)}", f"{y}W{d2()}{rnd.randint(0, 9)}",
        f"{y}-{rnd.randint(0, 400):03d}", f"{y}{rnd.randint(0, 400):03d}", f"{y}-{d2()}{d2()}"])
    if rnd.random() < 0.4:
        return date
    h = rnd.choice([f"{rnd.randint(0, 25):02d}", "24", f"{rnd.randint(0, 9)}"])

    def m():
        return f"{rnd.randint(0, 61):02d}"
    t = rnd.choice([h, f"{h}:{m()}", f"{h}{m()}", f"{h}:{m()}:{m()}", f"{h}{m()}{m()}", "24:00",
                    "24:00:01", f"{h}:{m()}:{m()}.{rnd.randint(0, 10 ** rnd.randint(1, 9))}",
                    f"{h}:{m()}:{m()},5", f"{h}:{m()}.5", f"{h}:{m()}{m()}"])
    tz = rnd.choice(["", "Z", "z", f"+{d2()}", f"-{rnd.randint(0, 23):02d}:{rnd.randint(0, 59):02d}",
                     f"+{rnd.randint(0, 23):02d}{rnd.randint(0, 59):02d}", " UTC", "+1"])
    return date + rnd.choice(["T", " ", "x", "t", ":"]) + t + tz


def test_iso_matches_dateutil(spark):
    """Random ISO-like texts parse exactly as the public ``dateutil`` parser
    does (aware results converted to UTC)."""
    import random

    from dateutil.parser import isoparse

    def ref(v):
        try:
            x = isoparse(v)
        except (ValueError, OverflowError):
            return None
        if x.tzinfo is not None:
            x = x.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return x

    rnd = random.Random(11)
    values = [_random_iso(rnd) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = {r.i: r.o for r in df.select("i", iso_timestamp(F.col("v")).alias("o")).collect()}
    bad = [(v, got[i], ref(v)) for i, v in enumerate(values) if got[i] != ref(v)]
    assert not bad, bad[:10]
    assert sum(ref(v) is not None for v in values) > 500
