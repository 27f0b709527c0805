"""Randomized answers checked against the formatting rules, with Python's
``json`` and ``datetime`` as the oracles."""

import datetime as dt
import json
import random

import pytest

from verilens.functions.answers import with_answer

BASE = "https://assets.test/uploads/dynamic/"


def _words(rnd, n=3):
    alphabet = "abcxyz ÄéΩ,\"\\'-:{}[]"
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(n)]


def _number(rnd):
    f = round(rnd.uniform(-180, 180), rnd.randint(0, 6))
    return int(f) if rnd.random() < 0.2 else f


def _case(rnd):
    kind = rnd.choice(["json_string", "multi", "geo", "datetime"])
    if kind == "json_string":
        v = rnd.choice([rnd.choice(_words(rnd)), rnd.randint(-999, 999), True, False, None])
        value = json.dumps(v)
        return ("any", rnd.choice(["text", "language", "json", "image_path", "id"]), value,
                str(json.loads(value)))
    if kind == "multi":
        selected = _words(rnd, rnd.randint(0, 3))
        other = rnd.choice([None, "", rnd.choice(_words(rnd))])
        inner = json.dumps({"selected": selected, "other": other})
        want = ", ".join(selected + ([f"Other ({other})"] if isinstance(other, str) else []))
        return ("task_response_multiple_choice", "select", json.dumps(inner), want)
    if kind == "geo":
        lat, lng = _number(rnd), _number(rnd)
        name = rnd.choice([None, rnd.choice(_words(rnd)), 7])
        props = {} if name is None else {"name": name}
        inner = json.dumps({"type": "Feature", "geometry": {"type": "Point", "coordinates": [lat, lng]},
                            "properties": props})
        pair = f"({lat}, {lng})"
        return ("any", "geojson", json.dumps(inner), f"{name} {pair}" if isinstance(name, str) else pair)
    y, mo, d = rnd.randint(1900, 2100), rnd.randint(1, 12), rnd.randint(1, 28)
    h, mi, off = rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(-12, 12)
    notime = rnd.random() < 0.3
    off_text = rnd.choice([str(off), f"+{off}" if off >= 0 else str(off)])
    value = (f'"{y:04d}-{mo:02d}-{d:02d} {h}:{mi:02d} {off_text} ZONE '
             f'{"notime" if notime else ""}"')
    if notime:
        want = f"{y:04d}-{mo:02d}-{d:02d}"
    else:
        t = dt.datetime(y, mo, d, h, mi) - dt.timedelta(hours=off)
        want = t.strftime("%Y-%m-%dT%H:%M") + "Z"
    return ("response_datetime", "datetime", value, want)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_answers(spark, seed):
    rnd = random.Random(seed)
    cases = [_case(rnd) for _ in range(400)]
    rows = [(i, 123, a, f, v, None) for i, (a, f, v, _) in enumerate(cases)]
    df = spark.createDataFrame(rows, "i int, annotation_id long, annotation_type string, "
                                     "field_type string, value string, file string")
    got = {r.i: r.answer for r in with_answer(df, "answer", "annotation_id", "annotation_type",
                                               "field_type", "value", "file", BASE).collect()}
    bad = [(cases[i], got[i]) for i in range(len(cases)) if got[i] != cases[i][3]]
    assert not bad, bad[:5]
