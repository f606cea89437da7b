"""Resuming a migration: windows that are done stay done.

A migration plans its writes window by window.  Every step handles the next open windows, publishes their planned writes
in a folder of its own and then appends one row per window to the manifest, which alone commits them.  A run that starts
again leaves out the windows found there; a folder without manifest rows is what a lost run left and is never read.
Planned writes depend on their own contact and on the target as it was, so the snapshot from all windows equals that of
one run.

Layout under ``root``::

    manifest/gen=<g>     appended rows: window, step, rows, finished_at
    planned/step=<id>    planned writes of the windows of one step

A manifest that cannot be read gives a fresh start: the next run begins a new generation.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom.operators import upsert, windows
from contactloom.plans import jobs
from contactloom.sources.staging import exists, stage

_CORRUPT = "_corrupt"
MANIFEST = f"window_start date, step string, rows bigint, finished_at timestamp, {_CORRUPT} string, gen bigint"
COLUMNS = ["window_start", "step", "rows", "finished_at"]


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.path = spark, f"{root.rstrip('/')}/manifest"

    def _rows(self) -> DataFrame:
        if not exists(self.spark, self.path):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).option("columnNameOfCorruptRecord", _CORRUPT).json(self.path)

    def generation(self) -> int:
        """The current generation; a broken or empty-handed row in it starts the next one."""
        rows = self._rows()
        broken = F.col(_CORRUPT).isNotNull() | F.col("step").isNull()
        head = rows.groupBy("gen").agg(F.max(broken).alias("broken")).orderBy(F.desc("gen")).limit(1).collect()
        return 0 if not head else head[0]["gen"] + int(head[0]["broken"])

    def done(self) -> DataFrame:
        """Windows committed in the current generation; a window counts once."""
        rows = self._rows().where(F.col("gen") == self.generation())
        return rows.groupBy("window_start").agg(F.min_by(F.struct("step", "rows", "finished_at"), "finished_at").alias("r")).select("window_start", "r.*")

    def commit(self, counted: DataFrame, step: str) -> None:
        """Append the windows (window_start, rows) of a published step; one file, the last thing a step writes."""
        now = datetime.now(timezone.utc)
        rows = counted.select("window_start", F.lit(step).alias("step"), "rows", F.lit(now).alias("finished_at"))
        rows.coalesce(1).write.mode("append").option("ignoreNullFields", False).json(f"{self.path}/gen={self.generation()}")


class WindowedMigration:
    """A one-time migration that can be stopped and started again between windows."""

    def __init__(self, spark: SparkSession, root: str, ts_col: str = "dateAdded", window=windows.month_start):
        self.spark, self.root, self.ts_col, self.window = spark, root.rstrip("/"), ts_col, window
        self.manifest = Manifest(spark, root)

    def _start(self) -> Column:
        return self.window(F.col(self.ts_col)).cast("date")

    def open_windows(self, contacts: DataFrame) -> list:
        """Starts of the windows not done yet, in order; rows without a time are a window of their own, the last one.

        A list of calendar windows, some hundreds for a source of years, whatever its rows.
        """
        every = contacts.select(self._start().alias("window_start")).distinct()
        done = self.manifest.done().select(F.col("window_start").alias("_done"))
        left = every.join(done, F.col("window_start").eqNullSafe(F.col("_done")), "left_anti").collect()
        return sorted((r["window_start"] for r in left), key=lambda d: (d is None, d))

    def _rows_of(self, contacts: DataFrame, batch: list, after) -> DataFrame:
        """Contacts of these windows; the bounds reach the file scan, the membership is exact."""
        dated = [d for d in batch if d is not None]
        inside = self._start().isin(*dated) if dated else F.lit(False)
        if dated:
            kind = contacts.schema[self.ts_col].dataType
            at = lambda d: windows.instant(datetime(d.year, d.month, d.day), kind)
            inside = inside & (F.col(self.ts_col) >= at(dated[0]))
            inside = inside & (F.col(self.ts_col) < at(after)) if after is not None else inside
        return contacts.where(inside | F.col(self.ts_col).isNull() if None in batch else inside)

    def run(
        self, contacts: DataFrame, target: DataFrame, owner_map: DataFrame | None = None, per_step: int = 16, max_steps: int | None = None,
        **plan,
    ) -> bool:
        """Plan the open windows, ``per_step`` at a time; True when none is left.

        ``max_steps`` ends the run early, to be taken up by the next one.
        """
        todo = self.open_windows(contacts)
        for n, at in enumerate(range(0, len(todo), per_step)):
            if n == max_steps:
                return False
            batch, after = todo[at : at + per_step], next(iter(todo[at + per_step : at + per_step + 1]), None)
            step = uuid.uuid4().hex
            rows = self._rows_of(contacts, batch, after)
            path = f"{self.root}/planned/step={step}"
            stage(jobs.plan_updates(rows, target, owner_map, **plan), path, wide=True)
            counted = rows.groupBy(self._start().alias("window_start")).agg(F.count(F.lit(1)).alias("rows"))
            self.manifest.commit(counted, step)
        return True

    def planned(self) -> DataFrame:
        """Planned writes of all committed steps, each read once."""
        steps = [r["step"] for r in self.manifest.done().select("step").distinct().collect()]
        if not steps:
            raise ValueError("no window is done; run the migration first")
        return self.spark.read.parquet(*[f"{self.root}/planned/step={s}" for s in sorted(steps)])

    def result(self, target: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(new snapshot, counters) of the windows done so far."""
        writes = self.planned()
        return upsert.upsert(target, writes), upsert.write_counts(target, writes)
