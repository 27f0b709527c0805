"""Text helpers with the loose semantics of the report SQL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (texts the reports search for or strip).
RUBY_HASH_HEADER_LINE = "--- !ruby/hash:ActiveSupport::HashWithIndifferentAccess\n"
MESSAGE_DELIMITER = "\n⁣"    # newline + U+2063 between tipline messages
TAG_NEEDLE = "tag: "
TARGET_NEEDLE = ":target: "


def prefix_int(c: Column) -> Column:
    """``CAST(text AS INT)``: the longest integer prefix (after blanks), 0 when
    there is none, NULL stays NULL.  ``'12\\nx'`` -> 12, ``'abc'`` -> 0."""
    digits = F.regexp_extract(c, r"^\s*([+-]?\d+)", 1)
    # a prefix beyond the 64-bit range saturates, as the SQL cast does
    saturated = F.when(digits.startswith("-"), F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1))
    value = F.when(digits == "", F.lit(0)).otherwise(F.coalesce(digits.try_cast("bigint"), saturated))
    return F.when(c.isNotNull(), value)


def substr_from(c: Column, start: Column) -> Column:
    """``SUBSTR(c, start)``: from a 1-based start to the end."""
    return c.substr(start, F.length(c) + 1)


def tag_id(data: Column) -> Column:
    """Number after ``tag: `` in a tag annotation's YAML text.  When the needle
    is absent the text is read from character 5, as the SQL arithmetic does."""
    return prefix_int(data.substr(F.instr(data, TAG_NEEDLE) + 5, F.length(data) - 1))


def relationship_type(c: Column) -> Column:
    """Text after ``:target: ``, trailing newlines removed."""
    return F.rtrim(substr_from(c, F.instr(c, TARGET_NEEDLE) + len(TARGET_NEEDLE)), F.lit("\n"))


def strip_ruby_header(c: Column) -> Column:
    return F.replace(c, F.lit(RUBY_HASH_HEADER_LINE), F.lit(""))


def last_segment(c: Column, delimiter: str = MESSAGE_DELIMITER) -> Column:
    """Text after the last delimiter (whole text when there is none)."""
    return F.substring_index(c, delimiter, -1)


def null_if_login(c: Column, sentinel: str = "smooch") -> Column:
    """Hide the bot account's login."""
    return F.nullif(c, F.lit(sentinel))


def path_quote(c: Column) -> Column:
    """Percent-encode a path segment (``/`` and ``~`` kept, blank -> %20).

    ``url_encode`` is form encoding; four substitutions turn it into path
    encoding: ``+`` -> %20, ``*`` -> %2A, %7E -> ``~``, %2F -> ``/``.  A literal
    ``+`` is already %2B, so the first substitution is safe."""
    e = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        e = F.replace(e, F.lit(a), F.lit(b))
    return e


def build_item_url(base_url: str, slug: Column, item_id: Column) -> Column:
    """``base || slug || '/media/' || id`` (NULL when any part is NULL)."""
    return F.concat(F.lit(base_url), slug, F.lit("/media/"), item_id.cast("string"))


def contains_line(c: Column, line: str) -> Column:
    """Whole-line test ``c LIKE '%\\n<line>\\n%'``, ASCII case-insensitive."""
    return F.lower(c).contains(f"\n{line.lower()}\n")
