"""Windows of unequal length and keys found in documents, against plain Python."""

import collections
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contactloom.operators import profile, windows

START = datetime(2024, 2, 28, 23, 50)


def times(seed, days=3):
    rnd = random.Random(seed)
    out = [START + timedelta(seconds=rnd.randrange(86400 * days)) for _ in range(400)]
    out += [START + timedelta(minutes=7, seconds=rnd.randrange(60)) for _ in range(300)]  # one hot minute
    out += [START + timedelta(hours=30, seconds=rnd.randrange(600)) for _ in range(200)]
    return out + [None] * 20


@pytest.mark.parametrize("cap", [1, 2, 17, 100, 100_000])
def test_windows_hold_at_most_the_cap(spark, cap):
    given = times(cap)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(given)], "id int, ts timestamp").repartition(4)
    got = sorted(tuple(r) for r in windows.adaptive_windows(df, "ts", cap).collect())
    minute = timedelta(minutes=1)
    for (start, end, n), follow in zip(got, [*got[1:], None]):
        assert start < end and n == sum(t is not None and start <= t < end for t in given)
        held = {t.replace(second=0) for t in given if t is not None and start <= t < end}
        assert n <= cap or len(held) == 1
        assert follow is None or follow[0] == end  # gapless
        assert follow is not None or end == max(held) + minute
    assert sum(n for _, _, n in got) == 900
    assert cap < 100_000 or len(got) <= 2
    placed = windows.by_window(df, "ts", cap).select("id", "ts", "window_start").collect()
    starts = [s for s, _, _ in got]
    assert len(placed) == len(given)
    for r in placed:
        assert r["window_start"] == (None if r["ts"] is None else max(s for s in starts if s <= r["ts"]))


def test_windows_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "ts timestamp")
    assert windows.adaptive_windows(df, "ts").isEmpty() and windows.by_window(df, "ts").collect()[0]["window_start"] is None


def walk(value, path=""):
    items = value.items() if isinstance(value, dict) else ((None, v) for v in value) if isinstance(value, list) else ()
    for key, inner in items:
        at = f"{path}[]" if key is None else f"{path}.{key}" if path else key
        yield at, inner
        yield from walk(inner, at)


def test_keys_found_at_any_depth(spark):
    docs = [
        {"a": 1, "b": {"c": None, "d": [1, {"e": "x"}]}}, {"a": None, "b": {"c": "later"}}, {"a": "text", "z": []}, {}, [1, 2], "scalar", None,
        {"b": {"d": [[True]]}, "deep": {"1": {"2": {"3": {"4": 5}}}}},
    ]
    rows = [(i, json.dumps(d)) for i, d in enumerate(docs)] + [(99, None), (98, "not json")]
    df = spark.createDataFrame(rows, "ord long, raw string").select("ord", F.try_parse_json("raw").alias("doc"))
    got = {r["path"]: r for r in profile.discovered_keys(df, "doc").collect()}
    want = collections.defaultdict(lambda: collections.defaultdict(list))
    for i, d in enumerate(docs):
        for path, v in walk(d):
            want[path][i].append(v)
    assert set(got) == set(want)
    for path, by_row in want.items():
        assert got[path]["n"] == len(by_row)
        assert got[path]["nulls"] == sum(all(v is None for v in vs) for vs in by_row.values())
        full = {i: [v for v in vs if v is not None] for i, vs in by_row.items()}
        first = next((full[i] for i in sorted(full) if full[i]), None)
        assert (got[path]["example"] is None) == (first is None)
        assert first is None or json.loads(got[path]["example"]) in first
    assert got["a"]["type"] == "VARIANT" and got["b.c"]["type"] == "STRING" and got["deep.1.2.3.4"]["type"] == "BIGINT"
    assert profile.discovered_keys(df.limit(0), "doc").isEmpty()
