"""Format-preserving pseudonyms for personal data (operator 2).

Validated values (payment cards, IBANs, social security numbers, phone numbers,
dates, IPv4 addresses, e-mail local parts, access keys and other secrets) are
numbered within their format.  A keyed Feistel network permutes those numbers:
two halves modulo a and b, with a * b at least the size of the domain, and a
walk along the cycle back into it.  The pseudonym of x is Q'(Q(x) + s), with a
keyed shift s, so no value keeps itself.  Invalid values on the way (a failing
date or area code) are walked over.  The number doesn't depend on separators or
document, so equal values get equal pseudonyms everywhere; the key and the kind
are all that goes in, and ``restored`` inverts it.

A run of groups that fails its test is tried again without its last groups, and
then from its next group on.  A value found that way gets its usual pseudonym,
unless that would make the longer run valid: then it walks on along its cycle,
so that the text can still be restored.

Only words with a digit, ``@``, ``=`` or ``:`` and their neighbours are searched with
patterns; the rest of the text is copied.

Defined results: null stays null, empty stays empty; values that fail their
test (Luhn, mod 97, calendar) are no personal data and stay; repeated rows are
replaced alike; other columns are kept as they are; an empty table gives no rows.
"""

from __future__ import annotations

import secrets
import re
from collections.abc import Callable
from datetime import date
from functools import lru_cache
from hashlib import blake2b
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from verilens.llm.textbatch import DIGIT, SPACE, Runs, as_strings, by_slice, flat

ROUNDS = 10
#: Characters that are permuted as one number at most.
LONGEST = 256
#: The setting that names the key; without it a session makes its own, and its pseudonyms can't be inverted later.
KEY_SETTING = "spark.verilens.pseudonym.key"
_MADE: dict[str, bytes] = {}

_MARK = DIGIT.copy()
_MARK[[*b"@=:"]] = True
#: Words before and after a marked word that may belong to its value.
BEFORE, AFTER = 2, 1

_PATTERN = re.compile(r"""
    (?P<key>(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9]))
  | (?P<secret>(?:token|password|passwd|secret|api_?key)\s{0,2}[=:]\s{0,2}["']?(?P<value>[A-Za-z0-9]{8,}))
  | (?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))
  | (?P<date>(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}[./]\d{2}[./]\d{4})(?:(?=[Tt]\d{2})|(?!\w|[./-]\d)))
  | (?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]))
  | (?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\w)
            | (?<!\w)\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\w) | (?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))
""", re.X | re.A)

#: An address is found from its @, so that a long run of its characters is read once.
_LOCAL_START = re.compile(r"(?<![\w.+-])[A-Za-z0-9]", re.A)
_DOMAIN = re.compile(r"@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", re.A)

#: Characters of an IBAN by country.
IBAN_LENGTHS = {x[:2]: int(x[2:]) for x in """AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18
    FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MR27 MT31
    MU30 NL18 NO15 PK24 PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20""".split()}


class Feistel:
    """A keyed permutation of 0..size-1 without fixed points, and its inverse."""

    def __init__(self, key: bytes, kind: str, size: int):
        self.size = size
        self.a = max(1, isqrt(max(0, size - 1)) + 1)
        self.b = -(-size // self.a)
        self.seed = blake2b(f"{kind}/{size}".encode(), key=blake2b(key).digest(), digest_size=32).digest()
        self.shift = 1 + self._f(ROUNDS, 0) % max(1, size - 1)

    def _f(self, step: int, half: int) -> int:
        h = blake2b(half.to_bytes(half.bit_length() // 8 + 1, "little") + bytes([step]), key=self.seed, digest_size=64)
        return int.from_bytes(h.digest(), "little")

    def _once(self, x: int, back: bool) -> int:
        left, right = x % self.a, x // self.a
        for step in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if step % 2:
                right = (right + sign * self._f(step, left)) % self.b
            else:
                left = (left + sign * self._f(step, right)) % self.a
        return left + right * self.a

    def _inside(self, x: int, back: bool) -> int:
        x = self._once(x, back)
        while x >= self.size:
            x = self._once(x, back)
        return x

    def moved(self, x: int, back: bool = False) -> int:
        if self.size < 2:
            return x
        by = -self.shift if back else self.shift
        return self._inside((self._inside(x, False) + by) % self.size, True)

    def moved_to(self, x: int, valid: Callable[[int], bool], back: bool = False) -> int:
        """The next valid number on x's cycle."""
        x = self.moved(x, back)
        while not valid(x):
            x = self.moved(x, back)
        return x


def _luhn(digits: str) -> int:
    """The sum that is divisible by 10 for a valid number."""
    return sum(sum(divmod(int(d) * (1 + k % 2), 10)) for k, d in enumerate(reversed(digits)))


def _last_digit(digits: str) -> str:
    return str(-_luhn(digits + "0") % 10)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _refilled(shape: str, values: str) -> str:
    """``shape`` with its letters and digits replaced, in order, by those of ``values``."""
    it = iter(values)
    return "".join(next(it) if c.isalnum() else c for c in shape)


class Pseudonyms:
    """Pseudonyms under one key; ``back`` restores the values instead."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back
        self.networks = lru_cache(maxsize=4096)(lambda kind, size: Feistel(key, kind, size))
        self.cached = lru_cache(maxsize=65536)(self._value)

    def value(self, kind: str, text: str) -> str | None:
        return self.cached(kind, text) if len(text) <= LONGEST else self._value(kind, text)

    def _number(self, kind: str, size: int, x: int, valid: Callable[[int], bool] | None = None) -> int:
        network = self.networks(kind, size)
        return network.moved_to(x, valid, self.back) if valid else network.moved(x, self.back)

    def _digits(self, kind: str, digits: str, valid: Callable[[str], bool] | None = None) -> str:
        n = len(digits)
        if not n:
            return digits
        return str(self._number(kind, 10 ** n, int(digits), valid and (lambda x: valid(str(x).zfill(n))))).zfill(n)

    def _classes(self, kind: str, text: str, hexadecimal: bool = False, valid: Callable[[str], bool] | None = None) -> str:
        """Letters to letters of their case and digits to digits (hexadecimal: any digit), other characters stay."""
        alphabets, hexadecimals = [], "0123456789abcdef" if text.lower() == text else "0123456789ABCDEF"
        for c in text:
            if hexadecimal:
                alphabets.append(hexadecimals)
            elif c.isdigit():
                alphabets.append("0123456789")
            elif c.isascii() and c.isalpha():
                alphabets.append("abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
            else:
                alphabets.append(c)
        out = []
        for at in range(0, len(text), LONGEST):  # longer values are permuted piece by piece
            part = alphabets[at:at + LONGEST]
            size, x = 1, 0
            for c, alphabet in zip(text[at:at + LONGEST], part, strict=True):
                size, x = size * len(alphabet), x * len(alphabet) + alphabet.index(c)

            def spelled(number: int, part: list[str] = part) -> str:
                letters = []
                for alphabet in reversed(part):
                    number, k = divmod(number, len(alphabet))
                    letters.append(alphabet[k])
                return "".join(reversed(letters))

            shape = "".join(a[0] for a in part)
            out.append(spelled(self._number(f"{kind}/{shape}", size, x, valid and (lambda y, spelled=spelled: valid(spelled(y))))))
        return "".join(out)

    def _value(self, kind: str, text: str) -> str | None:
        """The pseudonym, or None for a value that fails its test."""
        digits = "".join(c for c in text if c.isdigit())
        if kind == "email":
            local, _, domain = text.rpartition("@")
            return f"{self._classes('email/' + domain.lower(), local)}@{domain}" if local else None
        if kind == "key":
            return text[:4] + self._classes("key", text[4:])
        if kind == "secret":
            return self._classes("secret", text, bool(re.fullmatch("[0-9a-f]+|[0-9A-F]+", text)))
        if kind == "iban":
            plain = text.replace(" ", "")
            if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
                return None
            account = self._classes("iban/" + plain[:2], plain[4:])
            return _refilled(text, f"{plain[:2]}{98 - _mod97(plain[:2] + '00' + account):02d}{account}")
        if kind == "date":
            return self._date(text)
        if kind == "ip":
            return self._address(text.split("."))
        if kind == "ssn":
            return _refilled(text, self._digits("ssn", digits, _ssn)) if _ssn(digits) else None
        if kind == "card":
            if _luhn(digits) % 10 or len(set(digits)) == 1:
                return None
            body = digits[0] + self._digits("card", digits[1:-1], lambda x: len({digits[0], *x}) > 1)
            return _refilled(text, body + _last_digit(body))
        country = re.match(r"\+(\d{1,3})(?=\D)", text)
        skip = len(country[1]) if country else 0
        if not 8 <= len(digits) <= 15 or len(digits) - skip < 6:
            return None
        return _refilled(text, digits[:skip] + self._digits("phone", digits[skip:]))

    def _address(self, parts: list[str]) -> str | None:
        """An address with octets of as many digits each."""
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        ranges = [((0, 10), (10, 90), (100, 156))[len(p) - 1] for p in parts]  # first octet of that length, and their number
        size, x = 1, 0
        for p, (first, n) in zip(parts, ranges, strict=True):
            size, x = size * n, x * n + int(p) - first
        x = self._number("ip/" + "".join(str(len(p)) for p in parts), size, x)
        out = []
        for first, n in reversed(ranges):
            x, k = divmod(x, n)
            out.append(str(first + k))
        return ".".join(reversed(out))

    def _date(self, text: str) -> str | None:
        fields = re.split(r"[-./]", text)
        year_first = len(fields[0]) == 4
        year = int(fields[0] if year_first else fields[2])
        # day.month.year; with slashes the month may come first
        month_at = 1 if year_first or "." in text or int(fields[1]) <= 12 else 0
        month, day = int(fields[month_at]), int(fields[2] if year_first else fields[1 - month_at])
        try:
            number = date(year, month, day).toordinal()
        except ValueError:
            return None
        first = date(max(1, year // 100 * 100), 1, 1).toordinal()
        last = date(year // 100 * 100 + 99, 12, 31).toordinal()
        day_first = not year_first and month_at == 1
        kind, valid = "date", None
        if "/" in text and not year_first:  # keep which field is read as the month
            valid = (lambda x: True) if day_first else (lambda x: date.fromordinal(first + x).day > 12)
            kind = "date" if day_first else "date/us"
        out = date.fromordinal(first + self._number(f"{kind}/{year // 100}", last - first + 1, number - first, valid))
        y, m, d = f"{out.year:04d}", f"{out.month:02d}", f"{out.day:02d}"
        return _refilled(text, y + m + d if year_first else d + m + y if day_first else m + d + y)

    def _first(self, text: str, at: int) -> tuple[int, int, str, int] | None:
        """(start, end, kind, start of the first match tried) of the first valid value from ``at`` on; the last is -1 if none failed."""
        tried = -1
        while True:
            m, mail = _PATTERN.search(text, at), next_mail(text, at)
            if m is None and mail is None:
                return None
            if mail and (m is None or mail[0] <= m.start()):
                kind, (a, b) = "email", mail
            else:
                kind = m.lastgroup if m.lastgroup != "value" else "secret"
                a, b = m.span("value" if kind == "secret" else 0)
            ends = _ends(text, a, b, kind)
            for end in [b, *ends]:
                if self.value(kind, text[a:end]) is not None:
                    return a, end, kind, tried if end == b else a if tried < 0 else tried
            tried = a if tried < 0 else tried
            # a wrong IBAN of its country's length is one value; other runs may hold one from their next group on
            at = ends[0] if kind == "iban" and ends and text[a:a + 2] in IBAN_LENGTHS else text.find(" ", a, b) + 1 or b
            if kind == "iban" and IBAN_LENGTHS.get(text[a:a + 2]) == len(text[a:b].replace(" ", "")):
                at = b

    def replaced(self, text: str) -> tuple[str, int]:
        """The text with its values replaced, and their number."""
        pieces, n, at = [], 0, 0
        while found := self._first(text, at):
            a, b, kind, tried = found
            new = self.value(kind, text[a:b])
            while tried >= 0 and self._first(text[:a] + new + text[b:], tried) != found:
                new = self.value(kind, new)
            pieces += [text[at:a], new]
            n, at = n + 1, b
        return "".join([*pieces, text[at:]]), n


def next_mail(text: str, at: int) -> tuple[int, int] | None:
    """The span of the first e-mail address from ``at`` on."""
    sign = text.find("@", at)
    while sign >= 0:
        low = sign
        while low > at and (text[low - 1].isalnum() and text[low - 1].isascii() or text[low - 1] in "_.%+-"):
            low -= 1
        if (domain := _DOMAIN.match(text, sign)) and (start := _LOCAL_START.search(text, low, sign)):
            return start.start(), domain.end()
        sign = text.find("@", sign + 1)
    return None


def session_key(spark: SparkSession) -> bytes:
    """The key in the session's ``KEY_SETTING``; without it a random one that lasts as long as the application."""
    found = spark.conf.get(KEY_SETTING, None)
    return found.encode() if found else _MADE.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def _ends(text: str, a: int, b: int, kind: str) -> list[int]:
    """The ends of groups inside text[a:b] that a shorter value may have, last first."""
    if kind not in ("card", "iban"):
        return []
    length = IBAN_LENGTHS.get(text[a:a + 2]) if kind == "iban" else None
    least, most = (length, length) if length else (15, 34) if kind == "iban" else (13, 19)
    return [k for k in range(b - 1, a, -1) if text[k] in " -" and least <= sum(map(str.isalnum, text[a:k])) <= most]


def _ssn(digits: str) -> bool:
    return digits[:3] not in ("000", "666") and digits[0] != "9" and digits[3:5] != "00" and digits[5:] != "0000"


def candidates(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first byte, end) of the stretches of words that may hold a value."""
    runs = Runs(raw, off, ~SPACE[raw])
    marked = np.flatnonzero(_MARK[raw])
    near = np.zeros(len(runs.starts) + 1, np.int64)
    word = np.unique(np.searchsorted(runs.starts, marked, side="right") - 1)
    doc = np.searchsorted(runs.off, word, side="right") - 1
    np.add.at(near, np.maximum(word - BEFORE, runs.off[doc]), 1)
    np.add.at(near, np.minimum(word + AFTER + 1, runs.off[doc + 1]), -1)
    flag = np.cumsum(near[:-1]) > 0
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    edge = runs.off[:-1][runs.off[:-1] < runs.off[1:]]
    first[edge] = flag[edge]
    edge = runs.off[1:][runs.off[:-1] < runs.off[1:]] - 1
    last[edge] = flag[edge]
    a, b = np.flatnonzero(first), np.flatnonzero(last)
    return np.searchsorted(runs.off, a, side="right") - 1, runs.starts[a], runs.ends[b]


@lru_cache(maxsize=8)
def _names(key: bytes, back: bool) -> Pseudonyms:
    return Pseudonyms(key, back)


_KIND = pa.struct([("text", pa.string()), ("n_replaced", pa.int32())])


def _texts(texts: pa.Array, names: Pseudonyms) -> pa.Array:
    raw, off = flat(texts)
    pieces, count, size = [], np.zeros(len(texts), np.int32), np.diff(off)
    at, body = 0, memoryview(raw)
    for doc, a, b in zip(*(x.tolist() for x in candidates(raw, off)), strict=True):
        old = bytes(body[a:b])
        new, n = names.replaced(old.decode())
        if n:
            new = new.encode()
            pieces += [body[at:a], new]
            at = b
            count[doc] += n
            size[doc] += len(new) - len(old)
    pieces.append(body[at:])
    out = pa.Array.from_buffers(pa.string(), len(texts), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(b"".join(pieces))])
    return pa.StructArray.from_arrays([out, pa.array(count)], fields=list(_KIND))


def pseudonymised(text: Column, key: bytes, back: bool = False) -> Column:
    """struct(text, n_replaced) of each whole text; ``back`` inverts it under the same key."""

    @arrow_udf("text string, n_replaced int")
    def replaced(texts: pa.Array) -> pa.Array:
        return by_slice(texts, lambda part: _texts(part, _names(key, back)), _KIND)

    return replaced(text)


def replaced_rows(docs: DataFrame, key: bytes | None = None, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in its text column, and the number of values in ``count_col`` if that is given."""
    mark = "_".join(["pseudonyms", *docs.columns])  # a name that no column has
    found = docs.withColumn(mark, pseudonymised(F.col(text_col), key or session_key(docs.sparkSession)))
    new = F.when(F.col(f"`{text_col}`").isNotNull(), F.col(f"`{mark}`.text")).alias(text_col)
    rows = [new if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    return found.select(*rows, *([F.col(f"`{mark}`.n_replaced").alias(count_col)] if count_col else []))
