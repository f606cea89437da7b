"""Repeated change rows in a stream: state, restart, rows that come late."""

from collections import Counter
from datetime import datetime

import pytest

from contactloom.plans import inputs
from contactloom.streaming.repeats import without_repeats
from contactloom.streaming.state import SyncState
from contactloom.streaming.sync import RunHeld, sync_stream
from test_pipeline import SF, source

SCHEMA = "id string, dateUpdated timestamp, _arrived string"


def day(n):
    return datetime(2024, 1, n)


def test_rows_pass_once_over_a_restart(spark, tmp_path):
    waves = [
        [("a", day(9), "x"), ("a", day(9), "x"), ("b", day(9), "x"), (None, day(9), "x"), (None, day(9), "x"), ("c", None, "x")],
        [("a", day(9), "x"), ("a", day(1), "late"), ("b", day(10), "x"), ("", day(9), "x"), ("", day(9), "x"), ("c", None, "x"), (None, day(9), "x")],
        [],
    ]

    def run():
        stream = without_repeats(spark.readStream.schema(SCHEMA).parquet(str(tmp_path / "in")))
        write = lambda batch, i: batch.write.mode("overwrite").parquet(str(tmp_path / f"out/batch={i}"))
        stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        return Counter(tuple(r) for r in spark.read.schema(SCHEMA).parquet(str(tmp_path / "out")).select("id", "dateUpdated", "_arrived").collect())

    seen = set()
    wanted = Counter()
    for wave in waves:
        spark.createDataFrame(wave, SCHEMA).write.mode("append").parquet(str(tmp_path / "in"))
        for row in wave:
            if not row[0] or row[1] is None:
                wanted[row] += 1
            elif row[:2] not in seen:
                seen.add(row[:2])
                wanted[row] += 1
        assert run() == wanted


def test_sync_meets_a_change_once(spark, tmp_path):
    state = SyncState(spark, str(tmp_path / "state"))
    state.publish_base(inputs.target(spark, SF), datetime(2024, 1, 1))
    rows = source(spark, n_bad=3)
    distinct = rows.where("id IS NOT NULL AND id <> ''").select("id", "dateUpdated").distinct().count()

    def start(limit=1.0):
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        sync_stream(state, stream, str(tmp_path / "cp"), max_failure_rate=limit, repeats_within="7 days").awaitTermination()

    rows.unionByName(rows).write.parquet(str(tmp_path / "in"))
    with pytest.raises(Exception, match=RunHeld.__name__):
        start(0.0)  # the batch is held: its keys must not count as seen
    start()
    done = state.runs().where("ok AND changed > 0").select("changed", "updated").collect()
    assert len(done) == 1 and done[0]["changed"] == distinct and done[0]["updated"] > 0
    target = {str(r) for r in state.target().collect()}
    rows.write.mode("append").parquet(str(tmp_path / "in"))
    start()
    assert state.runs().where("ok AND changed > 0").count() == 1 and {str(r) for r in state.target().collect()} == target
