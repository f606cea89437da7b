"""Whitening, line dedup and periodic runs against plain Python, on odd inputs and on SQL."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from contactloom.llm import feast, line_dedup, ntt, periodic_runs, whitening
from llm_helpers import SF, WORD, clashing, odd_docs, odd_texts
from oracle_check import compare, connect

WS = " \t\n\x0b\f\r"


# --- whitening ---------------------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [1, 2, 3, 20, 60])
@pytest.mark.parametrize("kind", ["spread", "close", "repeated", "low rank", "diagonal"])
def test_contour_integration_finds_every_pair(n, kind):
    rng = np.random.default_rng(n)
    q, _ = np.linalg.qr(rng.standard_normal((n, n)))
    e = {
        "spread": rng.random(n) + 0.1, "close": 1 + 1e-6 * rng.random(n), "repeated": np.repeat([3.0, 1.0], [n // 2, n - n // 2]),
        "low rank": np.r_[np.ones(1), np.zeros(n - 1)], "diagonal": np.arange(n) + 1.0,
    }[kind]
    v = np.diag(e) if kind == "diagonal" else (q * e) @ q.T
    v = (v + v.T) / 2
    want = np.linalg.eigvalsh(v)
    for shift in (-1.0, 0.4999, 1.0000005, 2.5, 70.0):
        assert feast.inertia(v, shift) == (want > shift).sum()
    parts = feast.intervals(v, min(8, n))
    pairs = [feast.solve_interval(v, *p) for p in parts]
    assert [len(p[0]) for p in pairs] == [p[2] for p in parts]
    got = np.sort(np.concatenate([p[0] for p in pairs]))[::-1]
    assert len(got) >= min(8, n) and np.allclose(got, want[::-1][: len(got)], rtol=0, atol=1e-12 * max(want[-1], 1))
    for values, vectors in pairs:
        assert np.abs(v @ vectors - vectors * values).max() < 1e-11 * max(want[-1], 1)


def usable_rows(rows):
    fine = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) and abs(np.floor(1024 * c) + 100000) < 2**44 for c in v)]
    sizes = collections.Counter(len(v) for _, v in fine)
    size = min((s for s in sizes), key=lambda s: (-sizes[s], s), default=0)
    return [(i, v) for i, v in fine if len(v) == size]


def check_whitening(spark, rows, top=8):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    df = df.select("*", *[F.lit("clash").alias(c) for c in ("id", "n", "vector", "component", "mean")])
    got = whitening.report(df).collect()
    kept = usable_rows(rows)
    if not kept:
        assert got == []
        return got
    x = np.floor(1024 * np.array([v for _, v in kept])) + 100000
    n, sums = len(x), x.astype(object).sum(axis=0)
    cov = (x - x.mean(axis=0)).T @ (x - x.mean(axis=0)) / n
    values = np.linalg.eigvalsh(cov)[::-1]
    assert len(got) == n * min(top, x.shape[1])
    exact = [(i, sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums))) for (i, _), r in zip(kept, x)]
    want = collections.Counter((i, d if d < 2**63 else None) for i, d in exact)
    assert collections.Counter((r["vec_id"], r["deviation"]) for r in got if r["component"] == 1) == want
    for k in range(1, min(top, x.shape[1]) + 1):
        part = [r for r in got if r["component"] == k]
        share = values[k - 1] / np.trace(cov) if np.trace(cov) > 0 else 0
        assert all(abs(r["explained"] - share) <= 1e-9 and r["n"] == n for r in part)
        if values[k - 1] > 1e-9 * max(np.trace(cov), 1e-9):
            w = np.array([r["whitened"] for r in part])
            assert abs(w.mean()) < 1e-6 and abs(w.var() - 1) < 1e-6 and part[0]["identity_error"] < 1e-4
        elif np.trace(cov) == 0:
            assert all(r["whitened"] is None for r in part)
    return got


def test_whitening_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(12) * np.arange(1, 13)).tolist()) for i in range(300)]
    rows += [(5, rows[5][1])] * 100 + [(None, rows[7][1])]
    got = check_whitening(spark, rows)
    # whitened values against the eigenvectors of a full solver, up to a sign per component
    x = np.floor(1024 * np.array([v for _, v in rows])) + 100000
    cov = np.cov(x.T, bias=True)
    values, vectors = np.linalg.eigh(cov)
    for k in range(1, 9):
        want = dict(zip([i for i, _ in rows], (x - x.mean(axis=0)) @ vectors[:, -k] / np.sqrt(values[-k])))
        mine = {r["vec_id"]: r["whitened"] for r in got if r["component"] == k}
        sign = np.sign(mine[0] * want[0])
        assert all(abs(mine[i] - sign * want[i]) < 1e-7 for i in want)


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(1, None), (2, []), (3, [None, 1.0]), (4, [float("nan")]), (5, [float("inf"), 0.0]), (6, [1e300, 1.0])],
        [(1, [0.5, 0.25])],
        [(i, [0.5, 0.25, -3.0]) for i in range(9)],
        [(i, [float(i), 1.0, float(i * i)]) for i in range(20)] + [(99, [1.0]), (98, [1.0, 2.0]), (97, None), (96, [None, 1.0, 2.0])],
        [(i, [float(i % 7), 1e9 * (i % 5), 3.0]) for i in range(60)],
    ],
)
def test_whitening_of_odd_vectors(spark, rows):
    check_whitening(spark, rows)


def test_moments_join_in_a_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "DRIVER_BYTES", 1)
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(4)
    check_whitening(spark, [(i, rng.standard_normal(5).tolist()) for i in range(50)])


# --- lines -------------------------------------------------------------------------------------------------


def test_lines_query_matches_sql(spark):
    name = "op12_line_dedup"
    ok, _, why = compare(spark, connect(SF), SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, why


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute_lines(docs, at_least):
    seen = collections.Counter(k for _, t in docs for k in {key(x) for x in (t or "").split("\n")} if k)
    out = []
    for d, t in docs:
        ls = (t or "").split("\n")
        kept = [x for x in ls if seen[key(x)] < at_least]
        out.append((d, len(ls), len(ls) - len(kept), "\n".join(kept)))
    return out


def line_docs():
    rng = random.Random(8)
    docs = [(i, t) for i, t in enumerate(odd_texts())]
    pool = [f"Line {i} ÄÖ" for i in range(40)] + ["", "  ", "HOT line", "İstanbul", "\x1c"]
    for i in range(100, 260):
        docs.append((i, "\n".join(rng.choice(["", " ", "\t"]) + rng.choice(pool) + rng.choice(["", "\r"]) for _ in range(rng.randrange(8)))))
    docs += [(i, "hot LINE\nsame copy of all\nhot line") for i in range(300, 380)] + [(300, "hot line")] * 3 + [(None, "HOT LINE\nx"), (None, None)]
    docs.append((900, "\n".join(f"hot line\nown {i}" for i in range(20000))))
    return docs


@pytest.mark.parametrize("fan_in, hot", [(2, 2), (3, 0), (2, 65536)])
def test_lines_match_brute_force_over_many_batches(spark, monkeypatch, fan_in, hot):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    docs = line_docs()
    df = clashing(spark.createDataFrame(docs, "doc_id bigint, text string"))
    runs = line_dedup.LineRuns(spark, 10, 1, fan_in, 3)
    for i in range(7):
        runs.add(df.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(7)) == i))
        assert all(len(level) < fan_in for level in runs.levels) and len(runs.settled) <= fan_in
    got = line_dedup.drop_lines(df, runs.finish()).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(brute_lines(docs, 10))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_settled_lines_are_not_counted_again(spark):
    df = spark.createDataFrame([(i, "often") for i in range(12)], "doc_id bigint, text string")
    runs = line_dedup.LineRuns(spark, 10, 1, 2, 2)
    for _ in range(4):
        runs.add(df)
    assert [r["n"] for r in runs.finish().collect()] == [24]  # two batches until it settled


def test_lines_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.deduplicate([docs], docs).isEmpty() and line_dedup.LineRuns(spark).finish().isEmpty()
    one = spark.createDataFrame([(1, None)], "doc_id bigint, text string")
    assert [tuple(r) for r in line_dedup.deduplicate([], one).collect()] == [(1, 1, 0, "")]


# --- periodic runs -----------------------------------------------------------------------------------------


def brute_runs(ws):
    """Every maximal stretch of each period, shortest period first."""
    n, out = len(ws), {}
    code = {w: i for i, w in enumerate(dict.fromkeys(ws))}
    ids = np.array([code[w] for w in ws], np.int64)
    for q in range(1, n // 4 + 1):
        edge = np.flatnonzero(np.diff(np.r_[0, (ids[q:] == ids[:-q]).astype(np.int8), 0]))
        for s, e in zip(edge[::2].tolist(), (edge[1::2] + q).tolist()):
            if e - s >= max(6, 4 * q):
                out.setdefault((s, e), q)
    return sorted((s, e - s, q) for (s, e), q in out.items())


@pytest.mark.parametrize("width", [1, 2, 8, 32, 64, 512])
def test_transform_gives_exact_inner_products(width):
    rng = np.random.default_rng(width)
    x = rng.integers(0, int(((ntt.PRIME - 1) / width) ** 0.5) + 1, (5, width)).astype(float)
    spectra = ntt.forward(x)
    got = ntt.correlate(spectra[:3], spectra[1:4], spectra[2:5])
    for r in range(3):
        window = np.concatenate([x[r + 1], x[r + 2]])
        want = [int(x[r] @ window[t : t + width]) * 2 * width % ntt.PRIME for t in range(width)]
        assert (got[r] % ntt.PRIME).tolist() == want


@pytest.mark.parametrize("widest", [4, ntt.MAX_ROW])
def test_runs_match_brute_force(monkeypatch, widest):
    monkeypatch.setattr(ntt, "MAX_ROW", widest)
    rng = random.Random(widest)
    for _ in range(120):
        docs = []
        for _ in range(rng.randrange(1, 7)):
            n, k = rng.choice([0, 1, 5, 6, 7, 8, 25, 70, 180]), rng.choice([1, 2, 2, 3, 12])
            d = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                p, a = rng.randrange(1, max(2, n // 4)), rng.randrange(n)
                d = [d[i] if i < a else d[a + (i - a) % p] for i in range(n)]
            docs.append(d)
        got = [[] for _ in docs]
        ids = np.array([w for d in docs for w in d], np.int64)
        for t, s, length, q in periodic_runs.find_runs(ids, np.array([len(d) for d in docs])):
            got[t].append((s, length, q))
        assert got == [brute_runs(d) for d in docs]


def want_report(doc_id, text):
    ws = WORD.findall(text or "")
    n = len(ws)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [w if i < a else ws[a + (i - a) % p] for i, w in enumerate(ws)]
    runs = brute_runs(ws)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    s, length, q = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), s, length, q, None if s is None else 1000 * length // q,
        sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(" ".join(w for i, w in enumerate(ws) if i not in drop)),
    )


def test_periodic_query_matches_brute_force(spark):
    got = sorted(tuple(r) for r in entry.queries()["op13_periodic_runs"](spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert got == sorted(want_report(r["doc_id"], r["text"]) for r in docs)
    assert sum(r[1] > 0 for r in got) > len(got) // 20


def test_runs_of_odd_texts(spark):
    docs = odd_docs(spark)
    more = spark.createDataFrame([(i, "a b c " * i + "tail", "en", "s", 1) for i in range(30, 90)] + [(7000, "w\n" * 30000, "en", "s", 1)], docs.schema)
    docs = docs.unionByName(more)
    text = periodic_runs.planted(F.col("doc_id"), F.col("text"))
    got = periodic_runs.report(periodic_runs.collapse(clashing(docs).withColumn("text", text))).collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter(want_report(r["doc_id"], r["text"]) for r in docs.collect())
    assert periodic_runs.collapse(docs.limit(0)).isEmpty()


def test_long_texts_end_in_time():
    """Constant, two-letter and once-broken texts of 200,000 words, where seeds are many."""
    n = 200_000
    rng = np.random.default_rng(1)
    assert periodic_runs.find_runs(np.zeros(n, np.int64), np.array([n])) == [(0, 0, n, 1)]
    broken = np.where(np.arange(n) % 50_001 == 50_000, 1, 0)
    got = periodic_runs.find_runs(broken, np.array([n]))
    assert [r[1:] for r in got if r[3] == 1] == [(s, min(50_000, n - s), 1) for s in range(0, n, 50_001)]
    letters = rng.integers(0, 2, n)
    assert all((letters[s : s + m - q] == letters[s + q : s + m]).all() for _, s, m, q in periodic_runs.find_runs(letters, np.array([n])))
