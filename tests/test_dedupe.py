"""Pair rules against brute force; merge order against a sequential loop."""

import hashlib
import itertools
import random
from datetime import datetime, timedelta

import pytest

from pyspark.sql import functions as F

from contactloom.operators import dedupe, elimination, merge, segments
from contactloom.operators.upsert import PROPS
from contactloom import rules

SCHEMA = (
    "hs_id string, ord bigint, email string, phone string, firstname string, lastname string, "
    "createdate timestamp, hs_last_activity_date timestamp, company string"
)


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        cur = [i]
        for j, y in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (x != y)))
        prev = cur
    return prev[-1]


def parts(e):
    p = e.split("@")
    return p[0], p[1] if len(p) > 1 else ""


def expected_reason(x, y):
    e1, e2 = (x["email"] or "").strip().lower(), (y["email"] or "").strip().lower()
    p1, p2 = ("".join(ch for ch in (r["phone"] or "") if ch in "0123456789") for r in (x, y))
    phone = p1 == p2 and len(p1) >= 10
    if not e1 or not e2:
        return "same_phone_one_no_email" if phone else None
    if e1 == e2:
        return None
    (l1, d1), (l2, d2) = parts(e1), parts(e2)
    far = distance(e1, e2)
    checks = [
        (l1 == l2 and distance(d1, d2) <= 2, "domain_typo"),
        (d1 == d2 and distance(l1, l2) <= 1, "local_typo"),
        (far <= 2, "email_typo"),
        (phone, "same_phone_different_email"),
        (l1 == l2 and len(l1) >= 4, "same_local_different_domain"),
        (far <= 4, "possible_email_typo"),
    ]
    return next((r for ok, r in checks if ok), None)


def random_records(n, seed, malformed=False):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        local = "".join(rnd.choice("ab") for _ in range(rnd.randint(1, 7)))
        domain = rnd.choice(["b.co", "bb.co", "gmail.com", "ab.com", "a.bco"])
        email = rnd.choice([None, f"{local}@{domain}", f"{local}@{domain}", f" {local.upper()}@{domain}"])
        if malformed and rnd.random() < 0.3:
            email = rnd.choice([local, f"{local}@a@{domain}", f"@{domain}", f"{local}@"])
        phone = rnd.choice([None, "+15550100001", "1 (555) 010-0001", "555", "+15550100002"])
        day = datetime(2020, 1, 1) + timedelta(days=rnd.randint(0, 9))
        out.append({
            "hs_id": f"h{i}", "ord": i, "email": email, "phone": phone, "firstname": rnd.choice(["Ann", " ANN", "ann "]),
            "lastname": rnd.choice(["Lee", "Poe"]), "createdate": day,
            "hs_last_activity_date": rnd.choice([None, day]), "company": rnd.choice([None, f"co{i}"]),
        })
    return out


def expected_pairs(recs):
    def key(r):
        return r["firstname"].strip().lower(), r["lastname"].strip().lower()

    out = set()
    for x, y in itertools.combinations(recs, 2):
        if key(x) == key(y):
            reason = expected_reason(x, y)
            if reason:
                out.add((x["ord"], y["ord"], reason))
    return out


@pytest.mark.parametrize("seed", [7, 31])
@pytest.mark.parametrize("malformed", [False, True])
def test_pairs_match_brute_force(spark, seed, malformed):
    recs = random_records(70, seed + malformed, malformed)
    df = spark.createDataFrame([tuple(r.values()) for r in recs], SCHEMA)
    found = dedupe.duplicate_pairs(df)
    got = [(r["ord_a"], r["ord_b"], r["reason"]) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == expected_pairs(recs)


def edited(rnd, text, edits):
    for _ in range(edits):
        i, kind = rnd.randrange(len(text) + 1), rnd.randrange(3)
        text = text[:i] + (rnd.choice("abcx@.") if kind else "") + text[i + (kind != 2) :]
    return text


@pytest.mark.parametrize("limit", [2, 4])
def test_segments_meet_every_pair_within_the_limit(spark, limit):
    rnd = random.Random(limit)
    texts = {"", "a", "ab@c"}
    for _ in range(60):
        base = "".join(rnd.choice("abcde") for _ in range(rnd.randint(1, 30)))
        texts |= {base} | {edited(rnd, base, rnd.randint(1, limit)) for _ in range(5)}
    df = spark.createDataFrame([(t,) for t in sorted(texts)], "t string")
    rows = df.select("t", segments.stored_keys(F.col("t"), limit, "k").alias("s"), segments.asked_keys(F.col("t"), limit, "k").alias("a")).collect()
    for r in rows:
        assert len(r["s"]) + len(r["a"]) <= 100 and len(set(r["a"])) == len(r["a"])
    for x, y in itertools.combinations(sorted(rows, key=lambda r: len(r["t"])), 2):
        if distance(x["t"], y["t"]) <= limit:
            assert set(x["s"]) & set(y["a"]), (x["t"], y["t"])


def email_variants(rnd, n):
    """E-mails of one name around a few stems: edits anywhere, the @ sign moved, short and long, plain and malformed."""
    out = set()
    while len(out) < n:
        stem = "".join(rnd.choice("abc") for _ in range(rnd.choice([0, 1, 2, 3, 6, 12])))
        e = stem + "@" + rnd.choice(["mail.co", "gmail.co", "hotmail.co", "a.co", "b.a.co", "x"])
        e = edited(rnd, e, rnd.randint(0, 4))
        if rnd.random() < 0.4 and "@" in e:
            i = rnd.randrange(len(e))
            e = e.replace("@", "", 1)
            e = e[:i] + "@" + e[i:]
        if e.strip() == e and e:
            out.add(e)
    return sorted(out)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_email_pairs_match_brute_force(spark, seed):
    given = email_variants(random.Random(seed), 260)
    rows = [(f"h{i}", i, e, None, "Ann", "Lee", None, None, None) for i, e in enumerate(given)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = [(r["e1"], r["e2"]) for r in dedupe.email_pairs(dedupe.profiles(dedupe.records(df))).collect()]
    mails = [{"email": e, "phone": None} for e in given]
    want = {(x["email"], y["email"]) for x, y in itertools.combinations(mails, 2) if expected_reason(x, y)}
    assert len(got) == len(set(got)) and set(got) == want


def test_a_hot_name_at_one_domain_stays_selective(spark):
    """One name and one mail domain: strangers with long local parts hardly meet, and a moved @ sign costs them nothing."""
    rows = [(f"h{i}", i, f"{hashlib.md5(str(i).encode()).hexdigest()[: 20 + i % 10]}@mail.com", None, "Ann", "Lee", None, None, None) for i in range(3000)]
    given = dedupe.emails(dedupe.profiles(dedupe.records(spark.createDataFrame(rows, SCHEMA))))
    size = F.size(segments.stored_keys(F.col("l"), 4, "l")) + F.size(segments.asked_keys(F.col("l"), 4, "l"))
    assert given.agg(F.max(size)).first()[0] <= 100
    a = dedupe._keyed(given, "a", segments.stored_keys(F.col("l"), 4, "l"), F.col("d"))
    b = dedupe._keyed(given, "b", segments.asked_keys(F.col("l"), 4, "l"), F.col("d"))
    assert a.join(b, ["name_key", "d", "k"]).count() < 3000**2 // 200
    assert dedupe.domain_pairs(given).isEmpty()


def test_copies_stay_one_profile(spark):
    recs = [("h%d" % i, i, None, "+15550100001", "Ann", "Lee", None, None, None) for i in range(200)]
    rows = dedupe.duplicate_profiles(spark.createDataFrame(recs, SCHEMA)).collect()
    assert len(rows) == 1 and rows[0]["n_pairs"] == 200 * 199 // 2


def test_survivor_choice(spark):
    day = datetime(2020, 1, 1)
    recs = [
        ("h0", 0, "john@gmsil.com", None, "A", "B", day + timedelta(9), None, None),
        ("h1", 1, "john@gmail.com", None, "A", "B", day, None, None),
        ("h2", 2, "kim@corp.io", None, "C", "D", day, None, None),
        ("h3", 3, "kin@corp.io", None, "C", "D", day, None, None),
        ("h4", 4, "lee@corp.io", None, "E", "F", day, None, None),
        ("h5", 5, "les@corp.io", None, "E", "F", day, day + timedelta(1), None),
    ]
    got = {r["primary"]["hs_id"] for r in dedupe.duplicate_pairs(spark.createDataFrame(recs, SCHEMA)).collect()}
    assert got == {"h1", "h2", "h5"}


def sequential(pairs, records):
    """Apply pairs one after another: the meaning to reproduce."""
    alive = {r["hs_id"]: dict(r) for r in records}
    done = []
    for p, m in pairs:
        ok = p in alive and m in alive
        done.append(ok)
        if ok:
            gone = alive.pop(m)
            for c in ("email", "phone", "firstname", "lastname", "company"):
                if alive[p][c] is None:
                    alive[p][c] = gone[c]
    return done, alive


def test_merge_equals_sequential(spark):
    recs = random_records(60, 3)
    df = spark.createDataFrame([tuple(r.values()) for r in recs], SCHEMA)
    dup = dedupe.duplicate_pairs(df)
    decided = merge.decide_merges(merge.ordered_pairs(dup))
    ordered = sorted(decided.collect(), key=lambda r: tuple(r["pos"]))
    done, alive = sequential([(r["p"], r["m"]) for r in ordered], recs)
    assert [r["merged"] for r in ordered] == done
    merged = {r["hs_id"]: r.asDict() for r in merge.merge_duplicates(df, decided).collect()}
    assert set(merged) == set(alive)
    for k, row in alive.items():
        for c in ("email", "phone", "firstname", "lastname", "company"):
            assert merged[k][c] == row[c], (k, c)
    report = merge.merge_report(decided, dup).first()
    assert report["merged"] == sum(done) and report["failed"] == len(done) - sum(done)


def copies(n, seed, phone="+15550100001"):
    """Records without an e-mail that differ only in their times, many of them equal."""
    rnd = random.Random(seed)
    day = datetime(2020, 1, 1)
    return [(f"h{i}", i * 3, None, phone, "Ann", "Lee", day + timedelta(days=rnd.randint(0, 6)), rnd.choice([None, day + timedelta(days=rnd.randint(0, 9))]), None) for i in range(n)]


def merges_by_sequence(spark, df):
    """Successful merges by the loop over all ordered pairs."""
    pairs = sorted(merge.ordered_pairs(dedupe.duplicate_pairs(df)).collect(), key=lambda r: tuple(r["pos"]))
    gone, out = set(), set()
    for r in pairs:
        if r["p"] not in gone and r["m"] not in gone:
            gone.add(r["m"])
            out.add((r["p"], r["m"], tuple(r["pos"]), r["reason"]))
    return out, pairs


@pytest.mark.parametrize("case", ["mixed", "malformed", "copies", "copies in pieces"])
def test_group_merges_equal_sequence(spark, monkeypatch, case):
    if case == "copies in pieces":
        monkeypatch.setattr(elimination, "PIECE", 7)
    rows = {
        "mixed": lambda: [tuple(r.values()) for r in random_records(80, 11)],
        "malformed": lambda: [tuple(r.values()) for r in random_records(70, 5, True)],
        "copies": lambda: copies(60, 1), "copies in pieces": lambda: copies(60, 2),
    }[case]()
    df = spark.createDataFrame(rows, SCHEMA)
    want, pairs = merges_by_sequence(spark, df)
    got = [(r["p"], r["m"], tuple(r["pos"]), r["reason"]) for r in elimination.merges(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    counts = elimination.merge_counts(df).first()
    assert (counts["merged"], counts["failed"]) == (len(want), len(pairs) - len(want))
    if case == "mixed":
        bad = elimination.failures(df).collect()
        assert {(r["primary_id"], r["duplicate_id"]) for r in bad} == {(r["p"], r["m"]) for r in pairs} - {w[:2] for w in want}
        assert {r["merged"] for r in elimination.outcomes(df).collect()} == {True, False}


def test_no_merges_in_an_empty_target(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert elimination.merges(df).isEmpty() and elimination.merge_counts(df).first()["merged"] == 0


def test_large_groups_are_linear(spark):
    """100,000 copies: one row per merge, whether they stand alone or beside records with e-mails."""
    alone = spark.createDataFrame(copies(100_000, 3), SCHEMA)
    assert elimination.merges(alone).count() == 99_999
    beside = alone.unionByName(spark.createDataFrame([("m1", 50, "ann@corp.io", "+15550100001", "Ann", "Lee", None, None, None)], SCHEMA))
    assert elimination.merges(beside).agg(F.count("m"), F.countDistinct("m")).first()[:] == (100_000, 100_000)


def test_columns_in_rules():
    assert set(rules.IDENTITY_PROPERTIES) <= set(PROPS)
