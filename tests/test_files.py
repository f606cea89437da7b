"""Contact files as their source writes them, and values that once went wrong."""

import json

import pytest
from pyspark.sql import functions as F

from contactloom.functions import values as V
from contactloom.operators import merge, upsert
from contactloom.operators.profile import custom_field_population, tag_ranking
from contactloom.plans import jobs
from contactloom.plans.inputs import target as full_target
from contactloom.sources import contacts as reader

SF = "/root/testdata/sf0.001"


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def test_readers_number_rows_in_file_order(spark, tmp_path):
    folder = tmp_path / "lines"
    write(folder, "a.json", [json.dumps({"id": f"a{i}"}) for i in range(5000)])
    write(folder, "b.json", [json.dumps({"id": f"b{i}"}) for i in range(3000)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        got = reader.read_ndjson(spark, str(folder)).select("id", "ord").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    ids = [r["id"] for r in sorted(got, key=lambda r: r["ord"])]
    assert ids == [f"a{i}" for i in range(5000)] + [f"b{i}" for i in range(3000)]
    assert len({r["ord"] for r in got}) == 8000


def test_attribution_object_and_array_brackets(spark, tmp_path):
    one = {"id": "1", "attributionSource": {"utmSource": "u", "medium": "m", "isFirst": False}}
    two = {"id": "2", "attributionSource": [{"isFirst": False, "utmSource": "x"}, {"isFirst": True, "utmSource": "y"}]}
    write(tmp_path / "f", "x.json", ["[" + json.dumps(one) + ",", json.dumps(two) + ",", "", json.dumps({"id": "3"}) + "]"])
    good, bad = reader.split_corrupt(reader.read_array_lines(spark, str(tmp_path / "f")))
    assert bad.isEmpty()
    got = {r["id"]: r["attributionSource"] for r in good.collect()}
    assert got["1"][0]["isFirst"] and got["1"][0]["utmSource"] == "u" and len(got["2"]) == 2 and got["3"] is None
    mapped = {r["id"]: r["utm_source"] for r in jobs.prepare(good).collect()}
    assert mapped == {"1": "u", "2": "y", "3": None}


def test_migration_of_a_file_without_order(spark, tmp_path):
    lines = [
        {"id": "s1", "email": "new@x.co", "city": "A"}, {"id": "s2", "phone": "+15550100001"}, {"id": "s3", "phone": "+15550100002"},
        {"id": "s1", "email": "other@x.co", "city": "B"},
    ]
    write(tmp_path / "m", "x.json", [json.dumps(x) for x in lines])
    good, _ = reader.split_corrupt(reader.read_ndjson(spark, str(tmp_path / "m")))
    snapshot, counts = jobs.migrate(good, full_target(spark, SF).limit(0), None, str(tmp_path / "planned"))
    got = {r["hs_id"]: (r["email"], r["phone"], r["city"]) for r in snapshot.collect()}
    assert got == {"new:s1": ("new@x.co", None, "B"), "new:s2": (None, "+15550100001", None), "new:s3": (None, "+15550100002", None)}
    assert counts.first()["inserted"] == 3 and counts.first()["collapsed"] == 1


def test_null_order_is_refused(spark):
    contacts = spark.createDataFrame([("a", None)], "id string, ord bigint")
    with pytest.raises(ValueError):
        jobs.prepare(contacts.drop("ord"))
    schema = reader.CONTACT_SCHEMA
    empty = spark.createDataFrame([], schema).unionByName(contacts, allowMissingColumns=True)
    with pytest.raises(Exception, match="no ord"):
        jobs.prepare(empty).collect()


def test_csv_values_with_line_breaks(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('id,name\n1,"two\nlines, and a ""quote"""\n2,plain\n')
    got = {r["id"]: r["name"] for r in reader.read_csv_export(spark, str(path)).collect()}
    assert got == {"1": 'two\nlines, and a "quote"', "2": "plain"}


def test_number_and_list_values(spark):
    given = ['1e3', '1500.0', '1.5', '12', '"1000.0"', '1e7', '["0","1","false",0,false,"",null,true,2.0]', '"a, b,,c"', '1e20', '0', '99999999999999999']
    df = spark.createDataFrame([(i, g) for i, g in enumerate(given)], "i int, j string").withColumn("v", F.parse_json("j"))
    df = df.select("i", V.scalar_text("v").alias("t"), V.value_kind("v").alias("k"), V.list_members("v").alias("m"))
    got = {r["i"]: r for r in df.select(
        "i", "t", V.to_integer("t").alias("n"), V.to_iso_date("t", "k").alias("d"), V.to_multi_select("t", "k", "m").alias("s")
    ).collect()}
    assert [got[i]["t"] for i in range(6)] == ["1000", "1500", "1.5", "12", "1000.0", "10000000"]
    assert [got[i]["n"] for i in (0, 1, 5)] == [1000, 1500, 10000000]
    assert got[6]["s"] == "0;1;false;true;2" and got[7]["s"] == "a;b;c"
    assert got[8]["d"] is None and got[10]["d"] is None and got[9]["d"] == "1970-01-01"


def test_ids_of_new_records_do_not_collide(spark):
    props = [f"CAST(NULL AS STRING) AS {p}" for p in upsert.PROPS if p != "email"]
    writes = spark.createDataFrame([("insert", "5", 1, "a@x.co"), ("insert", None, 5, "b@x.co")], "action string, id string, ord bigint, email string")
    ids = {r["hs_id"] for r in upsert.fold_inserts(writes.selectExpr("*", *props)).collect()}
    assert ids == {"new:5", "new#5"}


def test_merge_chain_longer_than_any_round_limit(spark):
    n = 40
    pairs = spark.createDataFrame([(f"r{i + 1}", f"r{i}", i) for i in range(n)], "p string, m string, pos int")
    decided = merge.decide_merges(pairs)
    assert {r["merged"] for r in decided.collect()} == {True} and decided.count() == n
    assert {r["root"] for r in merge.survivors(decided).collect()} == {f"r{n}"}


def test_reports_read_their_input_once(spark):
    df = spark.createDataFrame([(["a", "b", None],), (["a"],), (None,)], "tags array<string>")
    assert [tuple(r) for r in tag_ranking(df).collect()] == [("a", 2, 66.7), ("b", 1, 33.3)]
    one = df.selectExpr("array(named_struct('id', 'f', 'value', parse_json('\"x\"')), named_struct('id', 'g', 'value', parse_json('\"\"'))) AS customFields")
    assert [tuple(r) for r in custom_field_population(one).collect()] == [("f", 3, 100)]
