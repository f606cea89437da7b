"""A migration by windows that is killed and started again."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contactloom.operators import windows
from contactloom.plans import inputs, jobs
from contactloom.streaming import manifest
from contactloom.streaming.manifest import WindowedMigration

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("given"))
    rows = inputs.contacts(spark, SF).limit(120)
    undated = F.when(F.col("ord") % 17 == 0, F.lit(None).cast("timestamp")).otherwise(
        F.timestamp_seconds(F.lit(int(datetime(2021, 1, 5).timestamp())) + F.col("ord") * 86400 * 2)
    )
    for name, df in (("c", rows.withColumn("dateAdded", undated)), ("t", inputs.target(spark, SF)), ("o", inputs.owner_map(spark, SF))):
        df.write.parquet(f"{root}/{name}")
    return [spark.read.parquet(f"{root}/{name}") for name in "cto"]


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_killed_between_windows(spark, given, tmp_path, monkeypatch):
    contacts, target, owners = given
    want = content(jobs.migrate(contacts, target, owners, str(tmp_path / "once"))[0])
    root = str(tmp_path / "m")
    job = WindowedMigration(spark, root)
    windows_ = job.open_windows(contacts)
    assert len(windows_) > 4 and windows_[-1] is None

    real, calls = manifest.jobs.plan_updates, []

    def dies(rows, *args, **kw):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(rows, *args, **kw)

    monkeypatch.setattr(manifest.jobs, "plan_updates", dies)
    with pytest.raises(RuntimeError):
        job.run(contacts, target, owners, per_step=3)
    assert len(job.open_windows(contacts)) == len(windows_) - 3

    # died after publishing, before the commit: the folder is there, its windows are still open
    def no_commit(*_):
        raise RuntimeError("lost again")

    monkeypatch.setattr(manifest.Manifest, "commit", no_commit)
    with pytest.raises(RuntimeError):
        job.run(contacts, target, owners, per_step=3)
    monkeypatch.undo()
    assert len(job.open_windows(contacts)) == len(windows_) - 3

    again = WindowedMigration(spark, root)
    assert again.run(contacts, target, owners, per_step=3) and again.open_windows(contacts) == []
    rows = again.manifest._rows().collect()
    assert len(rows) == len({r["window_start"] for r in rows}) == len(windows_)  # no window ran twice
    assert sum(r["rows"] for r in rows) == contacts.count()
    snapshot, counts = again.result(target)
    assert content(snapshot) == want and counts.first()["input"] == contacts.count()
    assert again.run(contacts, target, owners) and len(again.manifest._rows().collect()) == len(windows_)


def test_broken_manifest_starts_afresh(spark, given, tmp_path):
    contacts, target, owners = given
    job = WindowedMigration(spark, str(tmp_path), window=windows.month_start)
    assert not job.run(contacts, target, owners, per_step=2, max_steps=1)
    every = len(job.open_windows(contacts)) + 2
    (tmp_path / "manifest" / "gen=0" / "part-zz.json").write_text('{"window_start": "2021-')
    assert job.manifest.generation() == 1 and len(job.open_windows(contacts)) == every
    assert job.run(contacts, target, owners, per_step=every)
    assert job.manifest.done().count() == every and content(job.result(target)[0]) == content(jobs.migrate(contacts, target, owners, str(tmp_path / "o"))[0])


def test_nothing_to_migrate(spark, given, tmp_path):
    contacts, target, owners = given
    job = WindowedMigration(spark, str(tmp_path / "e"))
    assert job.run(contacts.limit(0), target, owners) and job.manifest.done().isEmpty()
    with pytest.raises(ValueError):
        job.planned()
