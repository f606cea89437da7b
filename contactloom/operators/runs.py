"""Run metrics, failure rate, history and report rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import text as T
from contactloom.sources.staging import stage

COUNTERS = ["updated", "inserted", "failed", "skipped"]


def batch_rollup(metrics: DataFrame, by: list[str]) -> DataFrame:
    """Sum the counters of many batches."""
    return metrics.groupBy(*by).agg(*[F.sum(c).cast("bigint").alias(c) for c in COUNTERS])


def failure_rate(failed: Column, processed: Column) -> Column:
    """failed / processed; 0 when nothing was processed."""
    return F.coalesce(failed / F.nullif(processed, F.lit(0)), F.lit(0.0))


def judged(metrics: DataFrame, limit: float = rules.MAX_FAILURE_RATE) -> DataFrame:
    """Add ``processed``, ``failure_rate`` (4 digits) and ``ok``."""
    processed = sum((F.col(c) for c in COUNTERS[1:]), F.col(COUNTERS[0]))
    rate = failure_rate(F.col("failed"), processed)
    return metrics.select(
        "*",
        processed.cast("bigint").alias("processed"),
        F.round(rate, 4).alias("failure_rate"),
        (rate <= limit).alias("ok"),
    )


def newest(runs: DataFrame, n: int = rules.RUN_HISTORY) -> DataFrame:
    """Bounded history, newest first (a top-k, not a global sort)."""
    return runs.orderBy(F.col("started_at").desc()).limit(n)


def failed_sample(failed: DataFrame, order: list[str], n: int = 10) -> DataFrame:
    """First ``n`` failed records and how many more there are."""
    failed = stage(failed)  # sorted and counted from one run of its plan
    total = failed.agg(F.count(F.lit(1))).scalar()
    return (
        failed.orderBy(*order)
        .limit(n)
        .select(*failed.columns, F.greatest(total - n, F.lit(0)).cast("bigint").alias("more"))
    )


def sync_summary(judged_runs: DataFrame) -> DataFrame:
    """Summary row per sync run: status text, duration text, rate text."""
    status = F.when(F.col("dry_run"), F.lit("DRY RUN")).when(F.col("ok"), F.lit("OK")).otherwise(
        F.lit("FAILED")
    )
    ms = F.unix_millis("finished_at") - F.unix_millis("started_at")
    return judged_runs.select(
        "run_id",
        status.alias("status"),
        T.duration_ms_text(ms).alias("duration"),
        T.percent_text(F.col("failure_rate"), F.lit(1), 1).alias("rate_text"),
        F.when(status == "FAILED", F.concat(
            F.col("failed").cast("string"), F.lit(" of "), F.col("changed").cast("string"), F.lit(" changed")
        )).alias("alert"),
    )


def migration_summary(runs: DataFrame) -> DataFrame:
    """Migration report row: status, progress, duration and totals."""
    done = F.col("completed_at").isNotNull()
    ms = F.unix_millis("completed_at") - F.unix_millis("started_at")
    return runs.select(
        "tier",
        F.when(done, F.lit("complete")).otherwise(F.lit("in-progress")).alias("status"),
        T.percent_text(F.col("last_batch") + 1, F.col("total_batches"), 1).alias("progress"),
        F.when(done, T.hours_minutes_text(ms)).otherwise(F.lit("-")).alias("duration"),
        (F.col("updated") + F.col("inserted")).alias("succeeded"),
        "updated", "inserted", "failed", "skipped",
        (F.col("updated") + F.col("inserted") + F.col("failed") + F.col("skipped")).alias("processed"),
    )


def reconcile_counts(expected: Column, actual: Column, tolerance: float = rules.COUNT_TOLERANCE) -> Column:
    """True when the counts differ by at most ``tolerance`` of the expected count."""
    return F.abs(actual - expected) <= expected * tolerance
