"""Matching, writes, windows, files and sync."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators import conflict, links, matching, profile, rows, runs, schema_diff, upsert, validate, windows
from contactloom.plans import inputs, jobs
from contactloom.sources import contacts as reader
from contactloom.sources import sinks
from contactloom.sources.staging import stage
from contactloom.streaming.state import SyncState, resolve_window
from contactloom.streaming.sync import RunHeld, planned_writes, run_once, sync_stream

SF = "/root/testdata/sf0.001"


def mapped(spark, *recs):
    """Mapped records from dicts; missing properties are null."""
    names = ["id", "ord", "hs_contact_id", *rules.PROPERTIES]
    kinds = {"ord": "bigint"} | {p: rules.property_type(p) for p in rules.PROPERTIES}
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
    data = [tuple(({"ord": i, "id": f"c{i}"} | r).get(n) for n in names) for i, r in enumerate(recs)]
    return spark.createDataFrame(data, schema)


def target(spark, *recs):
    names = ["hs_id", "ord", *rules.PROPERTIES]
    kinds = {"ord": "bigint"} | {p: rules.property_type(p) for p in rules.PROPERTIES}
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
    data = [tuple(({"ord": i, "hs_id": f"h{i}"} | r).get(n) for n in names) for i, r in enumerate(recs)]
    return spark.createDataFrame(data, schema)


def test_match_chain(spark):
    t = target(spark, {"email": "A@x.co "}, {"phone": "+1"}, {"email": "a@x.co"}, {"engager_contact_id": "c9"})
    m = mapped(
        spark, {"hs_contact_id": "77", "email": "a@x.co"}, {"email": "a@x.co", "phone": "+1"}, {"phone": "+1"},
        {"email": "new@x.co"}, {}, {"id": "c9"},
    )
    got = {r["id"]: (r["action"], r["hs_id"], r["matched_on"]) for r in matching.match_to_target(m, t).collect()}
    assert got["c0"] == ("update", "77", "hubspot_contact_id")
    assert got["c1"] == ("update", "h2", "email")  # of two rows with one key the later counts
    assert got["c2"] == ("update", "h1", "phone")
    assert got["c3"] == ("insert", None, None)
    assert got["c4"][0] == "unresolvable" and got["c9"][0] == "unresolvable"
    by_source = {r["id"]: r["matched_on"] for r in matching.match_to_target(m, t, use_source_id=True).collect()}
    assert by_source["c9"] == "engager_contact_id"


def planned(spark, t, *recs, allow=rules.UPDATE_ALLOWLIST):
    return conflict.plan_writes(matching.match_to_target(mapped(spark, *recs), t), allow)


def test_conflict_filter(spark):
    t = target(spark, {"email": "a@x.co"})
    full = {"email": "a@x.co", "city": "X", "assigned_coach": "C", "lifecyclestage": "customer", "hubspot_owner_id": "o"}
    w = planned(spark, t, full, {"email": "a@x.co", "assigned_coach": "C"}, {"email": "n@x.co", "assigned_coach": "C"}).collect()
    a, b, c = sorted(w, key=lambda r: r["ord"])
    assert (a["email"], a["city"], a["assigned_coach"]) == (None, "X", None)
    assert a["withheld"] == ["assigned_coach", "lifecyclestage", "hubspot_owner_id"] and not a["no_change"]
    assert b["no_change"] and b["withheld"] == ["assigned_coach"]
    assert c["action"] == "insert" and c["assigned_coach"] == "C" and c["email"] == "n@x.co" and c["withheld"] == []


def test_upsert_invariants(spark):
    t = target(spark, {"email": "a@x.co", "city": "Old", "state": "S", "workshop_paid": 1.0})
    w = planned(
        spark, t, {"email": "a@x.co", "state": None, "city": "N1", "zip": "1"}, {"email": "a@x.co", "city": "N2", "workshop_paid": 2.0},
        {"email": "n@x.co", "city": "P", "id": "s1"}, {"email": "n@x.co", "city": None, "state": "Q", "id": "s2"},
        {"phone": "+1", "id": "s3"}, {"email": "m@x.co", "id": "s3", "zip": "9"}, {"hs_contact_id": "gone", "city": "Z"}, {},
        allow=None,
    )
    w = stage(w)
    snap = {r["hs_id"]: r for r in upsert.upsert(t, w).collect()}
    assert snap["h0"]["city"] == "N2" and snap["h0"]["state"] == "S" and snap["h0"]["zip"] is None
    assert snap["h0"]["workshop_paid"] == 2.0 and snap["h0"]["email"] == "a@x.co"
    over = {r["hs_id"]: r for r in upsert.upsert(t, w, mode="overlay").collect()}
    assert over["h0"]["city"] == "N2" and over["h0"]["zip"] == "1"
    assert snap["new:s1"]["city"] == "P" and snap["new:s1"]["state"] == "Q" and snap["new:s1"]["engager_contact_id"] is None
    assert snap["new:s3"]["phone"] == "+1" and snap["new:s3"]["zip"] == "9" and snap["new:s3"]["email"] is None
    assert set(snap) == {"h0", "new:s1", "new:s3"}
    c = upsert.write_counts(t, w).first().asDict()
    assert c == {"input": 8, "updated": 1, "inserted": 2, "failed": 1, "skipped": 1, "withheld": 0, "no_change": 0, "collapsed": 3}
    again = upsert.upsert(t, w)
    assert {r["hs_id"]: r["city"] for r in upsert.apply_updates(again, upsert.collapse_updates(w)).collect()} == {
        k: r["city"] for k, r in snap.items()
    }


def test_catalog_check(spark):
    """Unknown options, one of several members, unreadable numbers and dates; limits of properties not written do nothing."""
    rows = [
        {"city": "X", "state": "S1", "products_purchased": "a;b", "utm_source": "12", "utm_medium": "2024-02-30", "zip": None},
        {"city": "Y", "state": None, "products_purchased": "a;c", "utm_source": "1x", "utm_medium": "2024-02-28", "zip": "1"},
        {"city": "", "products_purchased": ""},
    ]
    w = mapped(spark, *rows).withColumn("action", F.lit("insert"))
    option = "array<struct<value:string,displayOrder:int>>"
    catalog = spark.createDataFrame(
        [("city", "enumeration", "select", [("X", 0), ("X", 1)]), ("products_purchased", "enumeration", "checkbox", [("a", 0), ("b", 1)]), ("state", "enumeration", "select", []),
         ("utm_source", "number", None, None), ("utm_medium", "date", "date", []), ("zip", "string", "text", []), ("no_such_property", "number", "number", [])],
        f"name string, type string, fieldType string, options {option}",
    )
    got = sorted(conflict.check_catalog(w, catalog).collect(), key=lambda r: r["ord"])
    assert [r["invalid_fields"] for r in got] == [["state", "utm_medium"], ["city", "products_purchased", "utm_source"], ["city", "products_purchased"]]
    assert [(r["city"], r["state"], r["products_purchased"], r["utm_source"], r["utm_medium"], r["zip"]) for r in got] == [
        ("X", None, "a;b", "12", None, None), (None, None, None, None, "2024-02-28", "1"), (None, None, None, None, None, None),
    ]
    assert conflict.check_catalog(w, catalog.limit(0)).agg(F.max(F.size("invalid_fields"))).first()[0] == 0
    assert conflict.check_catalog(w.limit(0), catalog).isEmpty()


def test_enum_check(spark):
    m = mapped(spark, {"buyer_tier": "Nope", "city": "X"}, {"buyer_tier": "Registrant"}).withColumn("action", F.lit("insert"))
    a, b = sorted(conflict.check_options(m, conflict.enum_options()).collect(), key=lambda r: r["ord"])
    assert a["buyer_tier"] is None and a["city"] == "X" and a["invalid_fields"] == ["buyer_tier"]
    assert b["buyer_tier"] == "Registrant" and b["invalid_fields"] == []


def test_partition_count_does_not_matter(spark):
    def run():
        return sorted(map(str, matching.match_to_target(jobs.prepare(inputs.contacts(spark, SF)), inputs.target(spark, SF))
                          .select("id", "action", "hs_id", "buyer_tier", "eventtag").collect()))

    eight = run()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert run() == eight
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_number_within(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise("b").alias("k"), F.col("id").alias("ord"))
    got = rows.number_within(df, "k", "ord", "rn", chunk=64).collect()
    for key in ("hot", "b"):
        mine = sorted((r["ord"], r["rn"]) for r in got if r["k"] == key)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))


def test_windows(spark):
    df = spark.createDataFrame([("2020-01-05 10:00:00",), ("2020-01-08 00:00:00",), ("2019-12-31 23:00:00",)], "s string")
    got = [str(r[0]) for r in df.select(windows.week_start(F.col("s").cast("timestamp"))).collect()]
    assert got == ["2020-01-01", "2020-01-08", "2019-12-25"]
    with pytest.raises(ValueError):
        windows.check_bounds("2024-01-02", "2024-01-01")


def test_validation_rules(spark):
    x = mapped(spark, {"email": "a@x.co", "workshop_total": 10.0, "firstname": "ANN"}, {"email": "b@x.co", "utm_source": "s"}, {"email": "c@x.co", "city": "X"}, {"email": "d@x.co"})
    y = target(spark, {"email": "A@x.co", "workshop_total": 10.0, "firstname": "ann "}, {"email": "b@x.co"}, {"email": "c@x.co"})
    props = ["email", "workshop_total", "firstname", "utm_source", "city"]
    got = {r["email"]: (r["status"], r["mismatches"]) for r in validate.validate(x, y, props).collect()}
    assert got == {"a@x.co": ("PASS", []), "b@x.co": ("WARN", ["warn:utm_source"]), "c@x.co": ("FAIL", ["fail:city"]), "d@x.co": ("NOT_FOUND", [])}


def test_schema_catalog(spark):
    d = schema_diff.desired_properties(spark)
    assert d.count() == 53
    assert {r["type"]: r["count"] for r in d.groupBy("type").count().collect()} == {"string": 29, "date": 12, "number": 9, "enumeration": 3}
    assert {r["fieldType"]: r["count"] for r in d.groupBy("fieldType").count().collect()} == {"text": 29, "date": 12, "number": 9, "select": 2, "checkbox": 1}
    have = spark.createDataFrame([("event_type", "Expo", 7), ("eventtag", "New York", 2)], "name string, value string, displayOrder int")
    added = schema_diff.append_options(have, schema_diff.desired_options(spark)).collect()
    assert {(r["name"], r["value"], r["displayOrder"]) for r in added} == {
        ("event_type", "Foundations", 8), ("event_type", "Commercial", 9), ("event_type", "Fly Out", 10),
        ("eventtag", "West Palm Beach", 3), ("eventtag", "Manhasset", 4),
    }
    old = spark.createDataFrame([("p", "a", 3), ("p", "b", 1)], "name string, value string, displayOrder int")
    new = spark.createDataFrame([("p", "a", 0), ("p", "c", 1), ("p", "d", 2)], "name string, value string, ord bigint")
    assert {(r["value"], r["displayOrder"]) for r in schema_diff.append_options(old, new).collect()} == {("c", 4), ("d", 5)}


@pytest.mark.parametrize("failed, total, ok", [(1, 10, True), (2, 10, False), (0, 0, True)])
def test_failure_gate(spark, failed, total, ok):
    m = spark.createDataFrame([(total - failed, 0, failed, 0)], "updated long, inserted long, failed long, skipped long")
    assert runs.judged(m).first()["ok"] is ok


def test_repeated_tags_count(spark):
    df = spark.createDataFrame([(["a", "a", None],), (["b"],), (None,)], "tags array<string>")
    assert {r["tag"]: r["n"] for r in profile.tag_counts(df).collect()} == {"a": 2, "b": 1}


def test_key_presence_counts_null_values(spark):
    docs = [(0, '{"a": null}'), (1, '{"a": 5, "b": {"c": 1}}'), (2, "{}")]
    df = spark.createDataFrame(docs, "ord int, d string").select("ord", F.parse_json("d").alias("d"))
    got = {r["field"]: (r["n"], r["example"]) for r in profile.key_presence(df, "d", ["a", "b", "c"], "ord").collect()}
    assert got["a"] == (2, "5") and got["b"][0] == 1 and got["c"] == (0, None)


def test_guest_edges_skip_existing(spark):
    t = target(spark, {"email": "host@x.co"}, {"engager_contact_id": "c0"}, {"engager_contact_id": "c1"})
    m = mapped(spark, {}, {}).withColumn("guest_group_ref", F.lit(" Host@x.co"))
    have = spark.createDataFrame([("h1", "h0")], "from_id string, to_id string")
    assert [tuple(r) for r in links.guest_edges(m, t, have).collect()] == [("h2", "h0")]


def test_readers(spark, tmp_path):
    objs = [{"id": "a", "tags": ["x"], "customFields": [{"id": "f", "value": 3}]}, {"id": "b"}]
    (tmp_path / "arr.json").write_text(json.dumps(objs))
    assert reader.read_json_array(spark, str(tmp_path / "arr.json")).count() == 2
    lines = "[\n" + json.dumps(objs[0]) + ",\n\n{broken,\n" + json.dumps(objs[1]) + "\n]\n"
    (tmp_path / "lines.json").write_text(lines)
    good, bad = reader.split_corrupt(reader.read_array_lines(spark, str(tmp_path / "lines.json")))
    assert {r["id"] for r in good.collect()} == {"a", "b"} and bad.count() == 1
    (tmp_path / "nd.json").write_text(json.dumps(objs[0]) + "\nnot json\n")
    good, bad = reader.split_corrupt(reader.read_ndjson(spark, str(tmp_path / "nd.json")))
    assert good.count() == 1 and [r["line"] for r in bad.collect()] == ["not json"]
    (tmp_path / "x.csv").write_text("id;name\n a ; Ann \n\nb;\n")
    assert [tuple(r) for r in reader.read_csv_export(spark, str(tmp_path / "x.csv"), ";").collect()] == [("a", "Ann"), ("b", None)]
    assert reader.optional_table(spark, str(tmp_path / "none.json"), "user_id string, owner_id string").count() == 0
    (tmp_path / "map.json").write_text('{\n  "u1": "7",\n  "u2": "8"\n}')
    got = reader.optional_object(spark, str(tmp_path / "map.json"), "user_id", "owner_id")
    assert got.columns == ["user_id", "owner_id"] and {tuple(r) for r in got.collect()} == {("u1", "7"), ("u2", "8")}
    (tmp_path / "odd.json").write_text("[1, 2]")
    assert reader.optional_object(spark, str(tmp_path / "odd.json"), "k", "v").isEmpty()
    assert reader.optional_object(spark, str(tmp_path / "none.json"), "k", "v").isEmpty()
    n = sinks.write_counted(spark.range(7), str(tmp_path / "out"))
    assert n == 7
    df = spark.createDataFrame([("a", datetime(2024, 1, 5)), ("b", datetime(2024, 2, 5))], "id string, dateUpdated timestamp")
    sinks.write_by_month(df, str(tmp_path / "months"))
    assert sorted(p.name for p in (tmp_path / "months").glob("month=*")) == ["month=2024-01", "month=2024-02"]
    feb = reader.read_months(spark, str(tmp_path / "months"), "2024-02-01", "2024-02-28")
    assert [r["id"] for r in feb.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(month" in feb._jdf.queryExecution().executedPlan().toString()


def source(spark, n_bad=0, day=1):
    base = inputs.contacts(spark, SF)
    bad = inputs.FIELD_ID["_hubspot_contact_id"]
    broken = F.array(F.struct(F.lit(bad).alias("id"), F.lit("nowhere").cast("variant").alias("value")))
    return base.withColumn("dateUpdated", F.lit(datetime(2024, 1, day))).withColumn(
        "customFields", F.when(F.col("ord") < n_bad, broken).otherwise(F.array().cast("array<struct<id:string,value:variant>>"))
    )


def test_sync_watermark(spark, tmp_path):
    state = SyncState(spark, str(tmp_path / "state"))
    state.publish_base(inputs.target(spark, SF), datetime(2024, 1, 1))
    assert resolve_window(state, datetime(2024, 1, 2)) == (datetime(2024, 1, 1), "lookback")
    dry = run_once(state, source(spark), datetime(2024, 1, 2), dry_run=True)
    assert dry["changed"] == 150 and state.watermark() is None
    assert state.runs().where("dry_run").isEmpty()
    row = state.dry_runs().first()
    assert row["seq"] == dry["seq"] and row["ok"] and not row["wrote"] and row["advance_to"] is None
    assert dry["updated"] > 0 and dry["inserted"] > 0 and row["updated"] == dry["updated"]
    plan = planned_writes(state, dry["seq"], dry_run=True)
    assert plan.count() == 150 and plan.where("action = 'insert'").count() >= dry["inserted"]
    assert state._changes() is None
    empty = run_once(state, source(spark, day=9), datetime(2024, 1, 2))
    assert empty["ok"] and empty["changed"] == 0 and state.watermark() == datetime(2024, 1, 2)
    before = state.target().count()
    held = run_once(state, source(spark), datetime(2024, 1, 3), since=datetime(2023, 12, 31), max_failure_rate=-1.0)
    assert not held["ok"] and state.watermark() == datetime(2024, 1, 2)
    once = {r["hs_id"]: str(r) for r in state.target().drop("ord").collect()}
    good = run_once(state, source(spark), datetime(2024, 1, 4), since=datetime(2023, 12, 31))
    assert good["ok"] and state.watermark() == datetime(2024, 1, 4)
    again = {r["hs_id"]: str(r) for r in state.target().drop("ord").collect()}
    assert once == again and len(again) > before  # replay changes nothing
    state.compact(datetime(2024, 1, 5))
    assert {r["hs_id"]: str(r) for r in state.target().drop("ord").collect()} == again
    assert state.history().count() == 5 and state.watermark() == datetime(2024, 1, 4)


def test_sync_crash_is_recorded(spark, tmp_path):
    state = SyncState(spark, str(tmp_path / "state"))
    state.publish_base(inputs.target(spark, SF), datetime(2024, 1, 1))
    broken = source(spark).withColumn("tags", F.raise_error(F.lit("boom")).cast("array<string>"))
    with pytest.raises(Exception, match="boom"):
        run_once(state, broken, datetime(2024, 1, 2))
    last = state.history().first()
    assert last["ok"] is False and "boom" in last["error"] and state.watermark() is None


def test_stream_holds_and_replays(spark, tmp_path):
    state = SyncState(spark, str(tmp_path / "state"))
    state.publish_base(inputs.target(spark, SF), datetime(2024, 1, 1))
    rows_ = source(spark, n_bad=3)
    rows_.write.parquet(str(tmp_path / "in"))

    def start(limit):
        stream = spark.readStream.schema(rows_.schema).parquet(str(tmp_path / "in"))
        return sync_stream(state, stream, str(tmp_path / "cp"), max_failure_rate=limit)

    with pytest.raises(Exception, match=RunHeld.__name__):
        start(0.0).awaitTermination()
    assert state.watermark() is None and state.history().first()["ok"] is False
    start(0.1).awaitTermination()
    assert state.watermark() == datetime(2024, 1, 1)
    done = state.history().first()
    assert done["ok"] and done["failed"] == 1 and done["batch_id"] == 0  # three rows, one unknown record
    count = state.runs().count()
    start(0.1).awaitTermination()
    assert state.runs().count() == count


def test_hot_keys(spark):
    """A third of the rows share one e-mail, a third have none; nothing is lost."""
    n = 30_000
    kind = F.col("ord") % 3
    ids = spark.range(n).withColumnRenamed("id", "ord")
    props = {
        "email": F.when(kind == 0, F.lit("hot@x.co")).when(kind == 1, F.concat(F.lit("u"), "ord", F.lit("@x.co"))),
        "phone": F.when(kind == 2, F.concat(F.lit("+"), "ord")),
        "city": F.concat(F.lit("city"), "ord"),
    }
    m = ids.select(
        F.concat(F.lit("c"), "ord").alias("id"), "ord", F.lit(None).cast("string").alias("hs_contact_id"),
        *[props.get(p, F.lit(None)).cast(rules.property_type(p)).alias(p) for p in rules.PROPERTIES],
    )
    t = target(spark, {"email": "hot@x.co", "city": "Old"})
    matched = matching.match_to_target(m, t)
    counts = {(r["action"], r["matched_on"]): r["n"] for r in matching.action_counts(matched).collect()}
    assert counts == {("update", "email"): n // 3, ("insert", "-"): 2 * n // 3}
    w = stage(conflict.plan_writes(matched))
    snap = upsert.upsert(t, w)
    assert snap.count() == 1 + 2 * n // 3
    assert snap.where("hs_id = 'h0'").first()["city"] == f"city{n - 3}"
    inserts = stage(conflict.plan_writes(matching.match_to_target(m, target(spark, {"email": "other@x.co"}))))
    assert upsert.fold_inserts(inserts).count() == 1 + 2 * n // 3
    folded = upsert.fold_inserts(inserts).where("email = 'hot@x.co'").first()
    assert folded["hs_id"] == "new:c0" and folded["city"] == f"city{n - 3}"
