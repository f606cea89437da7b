"""Plans that must not gather their work in one task or repeat it."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators import dedupe, elimination, segments
from contactloom.operators.clean import clean_contacts, issue_counts
from contactloom.operators.mapping import map_contacts
from contactloom.plans import inputs, jobs
from contactloom.plans.views import view
from contactloom.sources import staging

SF = "/root/testdata/sf0.001"


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_contacts_of_one_row_group_are_dealt_to_tasks(spark):
    assert "RepartitionByExpression [c_custkey" in optimized(view(spark, SF, "contacts_v"))


def test_issue_counts_do_not_clean_twice(spark):
    plan = optimized(issue_counts(clean_contacts(inputs.plain_contacts(spark, SF))))
    assert "Generate explode(issues" in plan and ", true, [code#" in plan


def test_conditions_on_target_records_do_not_repeat_the_cleaning(spark):
    plan = optimized(dedupe.records(inputs.duplicate_source(spark, SF)))
    assert "phone_as_name" not in plan and "regexp_replace(regexp_replace" not in plan and "customer" not in plan


def pairs_of(spark) -> list[tuple[str, str, str]]:
    profs = dedupe.profiles(dedupe.records(inputs.duplicate_source(spark, SF)))
    return sorted(tuple(r) for r in dedupe.email_pairs(profs).collect())


def test_small_and_large_name_blocks_find_the_same_pairs(spark, monkeypatch):
    direct = pairs_of(spark)
    monkeypatch.setattr(dedupe, "SMALL_BLOCK", 6)  # the names have up to twelve records
    mixed = pairs_of(spark)
    monkeypatch.setattr(dedupe, "SMALL_BLOCK", 0)
    assert direct and direct == mixed == pairs_of(spark)


def test_small_name_blocks_need_no_keys(spark, monkeypatch):
    def none(*args):
        raise AssertionError("keys are made for small blocks")

    monkeypatch.setattr(dedupe, "asked_keys", none)
    assert pairs_of(spark)


def test_merge_results_search_once(spark, monkeypatch):
    calls, real = [], dedupe.profile_pairs
    monkeypatch.setattr(dedupe, "profile_pairs", lambda profs: calls.append(1) or real(profs))
    target = inputs.duplicate_source(spark, SF)
    for result in (elimination.merge_counts, elimination.outcomes, elimination.failures):
        calls.clear()
        assert not result(target).isEmpty()
        assert len(calls) == 1


def test_joins_of_large_name_blocks_are_jobs_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "SMALL_BLOCK", 0)
    profs = dedupe.profiles(dedupe.records(inputs.duplicate_source(spark, SF)))
    assert optimized(dedupe.email_pairs(profs)).count("Join ") == 1  # that of the small blocks


def test_custom_fields_are_looked_up_by_number_and_cleaned_once(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    try:
        plan = optimized(jobs.prepare(inputs.contacts(spark, SF)))
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert "map_from_entries" not in plan and plan.count("array_position") >= len(rules.CUSTOM_FIELDS)
    named = [F.xxhash64(F.lit(i)).alias(p) for i, p, _ in rules.CUSTOM_FIELDS]
    assert len(set(spark.range(1).select(*named).first())) == len(named)
    contacts = inputs.contacts(spark, SF)
    one, two = jobs.prepare(contacts), map_contacts(clean_contacts(contacts))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty()


def test_wide_rows_are_staged_with_methods_that_the_jvm_compiles(spark):
    name = staging.METHOD_LIMIT[0]
    with staging.small_methods(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name) == "65535"
    spark.conf.set(name, "20000")
    try:
        with staging.small_methods(spark):
            assert spark.conf.get(name) == "20000"
    finally:
        spark.conf.unset(name)


def shuffled(df) -> int:
    """Rows that the exchanges of a plan moved when it ran."""
    df.collect()

    def below(plan) -> int:
        kind = plan.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return below(plan.executedPlan())
        if kind.endswith("QueryStageExec"):
            return below(plan.plan())
        own = plan.metrics().get("shuffleRecordsWritten").get().value() if kind == "ShuffleExchangeExec" else 0
        return own + sum(below(plan.children().apply(i)) for i in range(plan.children().size()))

    return below(df._jdf.queryExecution().executedPlan())


def one_phone(n: int) -> list[tuple]:
    def mail(i: int) -> str | None:
        return None if i % 7 == 0 else ["", "a@b@c.de", "a@b@x.de"][i % 3] if i % 31 == 1 else f"{hashlib.md5(str(i // 2).encode()).hexdigest()[: 6 + i // 2 % 20]}{'x' * (i % 2)}@mail.com"

    return [(f"h{i}", i, mail(i), "+15550100001", "Ann", "Lee", None, None) for i in range(n)]


RECORDS = "hs_id string, ord bigint, email string, phone string, firstname string, lastname string, createdate timestamp, hs_last_activity_date timestamp"


def test_pairs_of_a_common_phone_do_not_move(spark):
    target = spark.createDataFrame(one_phone(600), RECORDS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dedupe.duplicate_pairs(target).select("ord_a", "ord_b", "reason")
        assert shuffled(found) < 20_000 < found.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_slices_of_a_phone_find_the_pairs_of_profiles(spark, monkeypatch):
    target = spark.createDataFrame(one_phone(90), RECORDS)
    whole = dedupe.duplicate_pairs(target, dedupe.search(target))
    monkeypatch.setattr(dedupe, "PHONE_SLICE", 7)
    cut = dedupe.duplicate_pairs(target)
    assert cut.count() == whole.count() > 90 * 80 // 2 and cut.exceptAll(whole).isEmpty()


def test_domains_that_keep_the_at_sign_need_no_moved_join(spark):
    given = spark.createDataFrame([("Ann Lee", d) for d in ("gmail.com", "ymail.com", "mail.com")], "name_key string, d string")
    moved = {(r["d1"], r["d2"]) for r in dedupe.domain_pairs(given).where("moved").collect()}
    assert moved == {("gmail.com", "mail.com"), ("ymail.com", "mail.com")}


def test_numbers_tell_strangers_and_no_near_texts(spark):
    rnd, rows = random.Random(3), []
    for _ in range(4000):
        letters = rnd.choice(["abc", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyz0123456789._-+@\u00e9 "])
        x = y = "".join(rnd.choices(letters, k=rnd.randint(0, 20)))
        for _ in range(rnd.randint(0, 5)):
            i, kind = rnd.randrange(len(y) + 1), rnd.randrange(3)
            y = y[:i] + (rnd.choice(letters) if kind else "") + y[i + (kind != 2) :]
        rows.append((x, y))
    rows += [tuple("".join(rnd.choices("0123456789abcdef", k=rnd.randint(7, 9))) for _ in "xy") for _ in range(4000)]
    df = spark.createDataFrame(rows, "x string, y string").withColumn("d", F.levenshtein("x", "y"))
    (s1, o1), (s2, o2) = ((segments.signature(F.col(c)), segments.outline(F.col(c))) for c in "xy")
    n1, n2 = F.length("x"), F.length("y")
    for limit in (1, 2, 3, 4):
        far = segments.unlike(s1, n1, s2, n2, limit) | segments.misplaced(o1, n1, o2, n2, limit)
        near, told, strangers = df.agg(F.count_if((F.col("d") <= limit) & far), F.count_if((F.col("d") > limit) & far), F.count_if(F.col("d") > limit)).first()
        assert near == 0 and told > strangers * 0.8
