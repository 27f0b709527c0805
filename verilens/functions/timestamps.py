"""ISO-8601 text -> timestamp (UTC, no zone), NULL for anything else.

Output typing turns every ``*_at`` column into a timestamp.  The accepted
language is strict ISO 8601 as the reports' consumers parse it, which is
narrower than ``CAST(x AS TIMESTAMP)`` (that one accepts ``12:00`` as "today",
``now``, blanks and zone names) and wider in places (basic ``20201010``,
week dates ``2020-W10-1``, ordinal ``2020-284``, ``T24:00``).  One anchored
regular expression decides; the timestamp is then built from the captured
parts with ``try_make_timestamp_ntz`` so impossible dates give NULL.  Zone
offsets are applied, so the result is UTC wall time.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark import SparkContext
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted shapes.
#  date: YYYY | YYYY-MM | YYYY-MM-DD | YYYYMMDD | YYYY-Www[-D] | YYYYWww[D]
#        | YYYY-DDD | YYYYDDD
#  then optionally: one separator character, hh[:mm[:ss[(.|,)fraction]]]
#        (colons optional together), then Z or +hh[[:]mm] / -hh[[:]mm]
ISO_PATTERN = (
    r"^(\d{4})"
    r"(?:-?(?:W(\d{2})(?:-?([1-7]))?|(\d{2})(?:-?(\d{2}))?|(\d{3})))?"
    r"(?:.(\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d+))?)?)?"
    r"(?:([Zz])|([+-])(\d{2})(?::?(\d{2}))?)?)?$"
)

# Fixed value: which shapes are accepted (the pattern above only captures).
# A time may follow only a complete date; dashes and colons are used
# consistently; week dates without a day and YYYY / YYYY-MM take no time.
_TIME = (r"(?:[01]\d|2[0-4])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?|[0-5]\d(?:[0-5]\d(?:[.,]\d+)?)?)?"
         r"(?:[Zz]|[+-]\d{2}(?::?\d{2})?)?")
STRICT_PATTERN = (
    r"^\d{4}(?:-\d{2}|-?W\d{2}"
    rf"|(?:-\d{{2}}-\d{{2}}|\d{{4}}|-W\d{{2}}-[1-7]|W\d{{2}}[1-7]|-?\d{{3}})(?:.{_TIME})?)?$"
)

_GROUPS = ("year", "week", "weekday", "month", "day", "ordinal", "hour", "minute",
           "second", "fraction", "zulu", "sign", "off_h", "off_m")

# The common layout (what databases and Rails write) parses with a plain cast.
FAST_PATTERN = r"^\d{4}-\d{2}-\d{2}(?:[T ](?:[01]\d|2[0-3]):\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?$"


def iso_parts(c: Column) -> Column:
    """All capture groups in one regex pass, as ``array<string>``; NULL for
    texts the fast path handles (or that are not ISO at all).

    ``regexp_replace`` rewrites a matching text to ``g1|g2|...`` which is then
    split (a group cannot hold ``|``; the separator character is not
    captured)."""
    packed = F.regexp_replace(c, ISO_PATTERN, "|".join(f"${i + 1}" for i in range(len(_GROUPS))))
    return F.when(~c.rlike(FAST_PATTERN) & c.rlike(STRICT_PATTERN), F.split(packed, r"\|"))


def _from_parts(parts: Column) -> Column:
    g = {}
    for i, name in enumerate(_GROUPS):
        item = parts.getItem(i)
        g[name] = F.when(item != "", item)
    year = g["year"].cast("int")
    hour = F.coalesce(g["hour"].cast("int"), F.lit(0))
    minute = F.coalesce(g["minute"].cast("int"), F.lit(0))
    frac = F.coalesce(F.rpad(F.substring(g["fraction"], 1, 6), 6, "0"), F.lit("000000"))
    second = F.concat(F.coalesce(g["second"], F.lit("00")), F.lit("."), frac).cast("decimal(8,6)")
    # 24:00[:00[.0]] is midnight of the next day
    is_24 = (hour == 24) & (minute == 0) & (second == 0)
    h = F.when(is_24, F.lit(0)).otherwise(hour)
    week = g["week"].cast("int")
    ordinal = g["ordinal"].cast("int")
    jan4 = F.make_date(year, F.lit(1), F.lit(4))
    # ISO week dates and ordinal dates become a day offset from 1 January
    week_offset = (F.datediff(F.date_sub(jan4, F.weekday(jan4)), F.make_date(year, F.lit(1), F.lit(1)))
                   + (week - 1) * 7 + F.coalesce(g["weekday"].cast("int"), F.lit(1)) - 1)
    year_days = F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))
    day_offset = (F.when(week.between(1, 53), week_offset)
                  .when(ordinal.between(1, year_days), ordinal - 1)
                  .when(week.isNull() & ordinal.isNull(), F.lit(0)))
    calendar = week.isNull() & ordinal.isNull()
    base = F.try_make_timestamp_ntz(
        year, F.when(calendar, F.coalesce(g["month"].cast("int"), F.lit(1))).otherwise(1),
        F.when(calendar, F.coalesce(g["day"].cast("int"), F.lit(1))).otherwise(1),
        h, minute, second)
    off_h = F.coalesce(g["off_h"].cast("int"), F.lit(0))
    off_m = F.coalesce(g["off_m"].cast("int"), F.lit(0))
    sign = F.when(g["sign"] == "-", -1).otherwise(1)
    ts = (base + F.make_dt_interval(day_offset + F.when(is_24, 1).otherwise(0))
          - F.make_dt_interval(F.lit(0), F.lit(0), sign * (off_h * 60 + off_m)))
    valid = ((hour < 24) | is_24) & (minute < 60) & (off_h < 24) & (off_m < 60)
    return F.when(valid, ts)


@lru_cache(maxsize=64)
def _slow_path(name: str, jvm: int) -> Column:
    """The parts of a column of that name, bound once through a lambda variable, and the timestamp they make; it has
    hundreds of nodes, each built by a call into the JVM ``jvm``."""
    parts = F.array(iso_parts(F.col(name)))
    return F.transform(parts, lambda p: F.when(p.isNotNull(), _from_parts(p))).getItem(0)


def iso_timestamp(c: Column, slow: Column | None = None) -> Column:
    """The timestamp of a text.

    The slow path is a function of a lambda variable.  Written out, its hundreds
    of nodes would land in the one method of their stage, which the JVM never
    compiles beyond 8,000 bytes of bytecode; every row of the stage, with all
    joins and aggregates in it, would then be interpreted, also where all texts
    take the fast path."""
    if slow is None:
        slow = F.transform(F.array(iso_parts(c)), lambda p: F.when(p.isNotNull(), _from_parts(p))).getItem(0)
    return (F.when(c.isNull(), None).when(c.rlike(FAST_PATTERN), c.try_cast("timestamp_ntz"))
            .otherwise(slow).cast("timestamp_ntz"))


def with_iso_timestamps(df, columns: dict[str, str]):
    """Replace/add ``out = iso(in)`` for each ``{out: in}`` in one projection."""
    jvm = id(SparkContext._gateway)
    return df.withColumns({out: iso_timestamp(F.col(f"`{src}`"), _slow_path(f"`{src}`", jvm)) for out, src in columns.items()})
