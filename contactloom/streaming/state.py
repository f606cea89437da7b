"""Sync state on a shared file system: run history, watermark, target versions.

Layout under ``root``::

    base/version=<v>     full target snapshot
    changes/run=<r>      writes of one run (only what changed)
    runs/                one appended row per run; the last thing a run writes
    dry_runs/            the same for dry runs, which are no part of the history

A reader sees only what a row in ``runs`` has committed.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.operators import runs as R
from contactloom.sources.staging import exists

RUN_SCHEMA = (
    "seq bigint, started_at timestamp, finished_at timestamp, ok boolean, dry_run boolean, "
    "since timestamp, until timestamp, changed bigint, updated bigint, inserted bigint, "
    "failed bigint, skipped bigint, withheld bigint, failure_rate double, error string, "
    "advance_to timestamp, base bigint, wrote boolean, batch_id bigint"
)


def now() -> datetime:
    """Current UTC time without zone, as all times in the state."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def from_micros(us: int | None) -> datetime | None:
    return None if us is None else datetime(1970, 1, 1) + timedelta(microseconds=us)


class SyncState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- runs ---------------------------------------------------------------
    def _rows(self, folder: str) -> DataFrame:
        if not exists(self.spark, f"{self.root}/{folder}"):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(f"{self.root}/{folder}")

    def runs(self) -> DataFrame:
        return self._rows("runs")

    def dry_runs(self) -> DataFrame:
        """What dry runs would have written; ``seq`` is the number the next real run had then."""
        return self._rows("dry_runs")

    def history(self) -> DataFrame:
        """Newest runs first, at most 30."""
        return R.newest(self.runs())

    def head(self) -> dict:
        """Scalars: last sequence number, watermark, current base version."""
        row = self.runs().agg(
            F.coalesce(F.max("seq"), F.lit(0)).alias("seq"),
            F.unix_micros(
                F.max_by("advance_to", F.when(F.col("ok") & F.col("advance_to").isNotNull(), F.col("seq")))
            ).alias("watermark"),
            F.max("base").alias("base"),
            F.max(F.when(F.col("ok"), F.col("batch_id"))).alias("batch_id"),
        ).first()
        return row.asDict() | {"watermark": from_micros(row["watermark"])}

    def watermark(self) -> datetime | None:
        return self.head()["watermark"]

    def record(self, **run) -> None:
        """Append one run row.  ``advance_to`` counts only for an ok run."""
        names = [c.split()[0] for c in RUN_SCHEMA.split(", ")]
        aware = {n: v.replace(tzinfo=timezone.utc) for n, v in run.items() if isinstance(v, datetime)}
        row = {n: None for n in names} | run | aware
        one = self.spark.createDataFrame([tuple(row[n] for n in names)], RUN_SCHEMA)
        folder = "dry_runs" if row["dry_run"] else "runs"
        one.coalesce(1).write.mode("append").parquet(f"{self.root}/{folder}")

    # -- target versions ----------------------------------------------------
    def base_path(self, version: int) -> str:
        return f"{self.root}/base/version={version}"

    def change_path(self, run: int) -> str:
        return f"{self.root}/changes/run={run}"

    def publish_base(self, target: DataFrame, started_at: datetime) -> int:
        """Write a full snapshot as a new version."""
        seq = self.head()["seq"] + 1
        target.write.mode("overwrite").parquet(self.base_path(seq))
        self.record(seq=seq, started_at=started_at, finished_at=started_at, ok=True, base=seq)
        return seq

    def _changes(self) -> DataFrame | None:
        """Committed writes since the newest base, or None."""
        from contactloom.operators.upsert import PROPS

        base = self.head()["base"]
        done = self.runs().where(F.col("wrote") & (F.col("seq") > base)).select(
            F.col("seq").alias("run")
        )
        if done.isEmpty():
            return None
        schema = ", ".join(
            ["hs_id string", "ord bigint", "created boolean"]
            + [f"{p} {rules.property_type(p)}" for p in PROPS]
            + ["run bigint"]
        )
        return self.spark.read.schema(schema).parquet(f"{self.root}/changes").join(done, "run", "left_semi")

    def _with_created(self, snapshot: DataFrame, changes: DataFrame) -> DataFrame:
        """Base plus records inserted since; a replayed insert counts once."""
        columns = [c for c in snapshot.columns if c not in ("hs_id", "createdate", "hs_last_activity_date")]
        created = changes.where("created").groupBy("hs_id").agg(
            F.min_by(F.struct(*columns), F.struct("run", "ord")).alias("r")
        ).select("hs_id", "r.*")
        return snapshot.unionByName(created, allowMissingColumns=True)

    def identities(self) -> DataFrame:
        """``hs_id, ord`` and identity columns of the committed target.

        Updates never write identity columns, so no change has to be overlaid
        and the wide columns of the base are not read.
        """
        snapshot = self.spark.read.parquet(self.base_path(self.head()["base"])).select(
            "hs_id", "ord", *rules.IDENTITY_PROPERTIES
        )
        changes = self._changes()
        return snapshot if changes is None else self._with_created(snapshot, changes)

    def target(self) -> DataFrame:
        """Committed target: newest base overlaid with the changes written since."""
        from contactloom.operators.rows import overlay
        from contactloom.operators.upsert import NON_IDENTITY, apply_updates

        snapshot = self.spark.read.parquet(self.base_path(self.head()["base"]))
        changes = self._changes()
        if changes is None:
            return snapshot
        order = F.struct("run", "ord").alias("ord")
        latest = overlay(changes.select("hs_id", order, *NON_IDENTITY), "hs_id", NON_IDENTITY)
        return apply_updates(self._with_created(snapshot, changes), latest)

    def compact(self, started_at: datetime) -> int:
        """Fold the changes into a new base version."""
        return self.publish_base(self.target(), started_at)


def resolve_window(
    state: SyncState, until: datetime, override: datetime | None = None,
    lookback_hours: int = rules.DEFAULT_LOOKBACK_HOURS,
) -> tuple[datetime, str]:
    """Lower bound of a run: override, else watermark, else a look-back."""
    if override is not None:
        return override, "override"
    last = state.watermark()
    if last is not None:
        return last, "watermark"
    return until - timedelta(hours=max(1, lookback_hours)), "lookback"
