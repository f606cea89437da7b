"""Calendar and 7-day windows, window statistics, delta scans, resume."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contactloom import rules
from contactloom.functions import tags as G
from contactloom.operators.rows import keep_first
from contactloom.sources.staging import stage


def week_start(ts: Column) -> Column:
    """Start date of the 7-day window, counted from 2020-01-01 UTC.

    Plain date arithmetic: rows before the anchor fall into earlier windows.
    """
    days = F.date_diff(ts.cast("date"), F.lit(rules.WINDOW_ANCHOR).cast("date"))
    return F.date_add(
        F.lit(rules.WINDOW_ANCHOR).cast("date"), (F.floor(days / F.lit(7)) * 7).cast("int")
    )


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "month")


def window_stats(df: DataFrame, window: Column, id_col: str = "id") -> DataFrame:
    """Rows, distinct ids and cap flag per window.

    Distinct ids are pre-grouped by (window, id), so one crowded window is
    counted by many tasks.
    """
    per_id = df.groupBy(window.alias("window_start"), id_col).agg(F.count(F.lit(1)).alias("_n"))
    return per_id.groupBy("window_start").agg(
        F.sum("_n").cast("bigint").alias("total"),
        F.count(id_col).alias("collected"),
        (F.sum("_n") >= rules.WINDOW_CAP).alias("capped"),
    )


def utc_time(value) -> datetime:
    """A time or ISO text as UTC without zone; without a zone it already is UTC."""
    t = value if isinstance(value, datetime) else datetime.fromisoformat(str(value).replace("Z", "+00:00"))
    return t.astimezone(timezone.utc).replace(tzinfo=None) if t.tzinfo else t


def instant(value: datetime, kind: T.DataType) -> Column:
    """A UTC time as a literal of the column's own timestamp type.

    Equal types keep the comparison a plain range that reaches the file scan, and
    the session time zone has no say in it.
    """
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value.replace(tzinfo=timezone.utc))


def check_bounds(since, until) -> tuple[datetime, datetime]:
    lo, hi = utc_time(since), utc_time(until)
    if lo > hi:
        raise ValueError(f"since ({lo}) is after until ({hi})")
    return lo, hi


def changed_rows(df: DataFrame, since, until, ts_col: str = "dateUpdated") -> DataFrame:
    """Rows modified within [since, until]; a plain range filter that reaches the scan."""
    lo, hi = (instant(b, df.schema[ts_col].dataType) for b in check_bounds(since, until))
    return df.where(F.col(ts_col).between(lo, hi))


def changed_since(
    df: DataFrame,
    since,
    until,
    exclude_tags: list[str] = rules.LOOP_GUARD_TAGS,
    ts_col: str = "dateUpdated",
) -> DataFrame:
    """Changed contacts without the loop-guard tags, first row per id."""
    kept = changed_rows(df, since, until, ts_col).where(
        ~G.has_any(F.col("tags"), exclude_tags) & F.col("id").isNotNull() & (F.col("id") != "")
    )
    return keep_first(kept, "id")


def delta_counts(df: DataFrame, since, until, exclude_tags: list[str]) -> DataFrame:
    """scanned / collected / duplicate counts of a delta scan."""
    rows = changed_rows(df, since, until)
    guarded = G.has_any(F.col("tags"), exclude_tags)
    per_id = rows.groupBy("id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~guarded).alias("kept")
    )
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("scanned"),
        F.count_if(F.col("kept") > 0).alias("collected"),
        F.coalesce(F.sum(F.greatest(F.col("kept") - 1, F.lit(0))), F.lit(0)).cast("bigint").alias("duplicates"),
    )


def tagged(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Contacts with any included and none of the excluded tags."""
    out = df
    if exclude:
        out = out.where(~G.has_any(F.col("tags"), exclude))
    if include:
        out = out.where(G.has_any(F.col("tags"), include))
    return out


def minute_counts(df: DataFrame, ts_col: str) -> DataFrame:
    """(minute, n): rows per minute; rows without a time are left out."""
    return df.where(F.col(ts_col).isNotNull()).groupBy(F.date_trunc("minute", F.col(ts_col)).alias("minute")).agg(F.count(F.lit(1)).alias("n"))


def minute_windows(df: DataFrame, ts_col: str, cap: int = rules.WINDOW_CAP) -> DataFrame:
    """(minute, n, window_start): which window each minute with rows belongs to.

    A minute with more than half the cap is a window of its own; the others are cut wherever their running count
    passes a multiple of half the cap.  So a window holds at most ``cap`` rows unless it is one minute long.  Running
    counts are summed inside days and shifted by the days before, a table of one row per day.
    """
    half = max(cap // 2, 1)
    counted = stage(minute_counts(df, ts_col)).select(
        "minute", "n", F.to_date("minute").alias("day"), (F.col("n") > half).cast("bigint").alias("big"),
        F.when(F.col("n") > half, 0).otherwise(F.col("n")).alias("small"),
    )
    earlier = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    days = counted.groupBy("day").agg(F.sum("big").alias("b"), F.sum("small").alias("s")).select(
        "day", F.coalesce(F.sum("b").over(earlier), F.lit(0)).alias("b"), F.coalesce(F.sum("s").over(earlier), F.lit(0)).alias("s")
    )
    before = Window.partitionBy("day").orderBy("minute").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumns({
        "bigs": F.coalesce(F.sum("big").over(before), F.lit(0)), "smalls": F.coalesce(F.sum("small").over(before), F.lit(0)),
    }).join(days, "day")
    # a large minute ends the window before it and begins the next one after it
    part = F.struct(F.col("b") + F.col("bigs"), F.floor((F.col("s") + F.col("smalls")) / half), "big")
    keyed = placed.select("minute", "n", part.alias("part"))
    starts = keyed.groupBy("part").agg(F.min("minute").alias("window_start"))
    return keyed.join(starts, "part").select("minute", "n", "window_start")


def adaptive_windows(df: DataFrame, ts_col: str, cap: int = rules.WINDOW_CAP) -> DataFrame:
    """(window_start, window_end, n): gapless windows of unequal length with at most ``cap`` rows, one minute at least.

    A window ends where the next one with rows begins; the last one after its last minute.
    """
    found = minute_windows(df, ts_col, cap).groupBy("window_start").agg(F.sum("n").alias("n"), F.max("minute").alias("last"))
    found = stage(found.withColumn("day", F.to_date("window_start")))
    later = Window.orderBy("day").rowsBetween(1, Window.unboundedFollowing)
    days = found.groupBy("day").agg(F.min("window_start").alias("first")).select("day", F.min("first").over(later).alias("next_day"))
    inside = F.lead("window_start").over(Window.partitionBy("day").orderBy("window_start"))
    ended = found.withColumn("following", inside).join(days, "day")
    end = F.coalesce("following", "next_day", F.col("last") + F.expr("INTERVAL 1 MINUTE"))
    return ended.select("window_start", end.alias("window_end"), "n")


def by_window(df: DataFrame, ts_col: str, cap: int = rules.WINDOW_CAP, partitions: int | None = None) -> DataFrame:
    """Rows with their ``window_start``, dealt to tasks by time so that a task holds whole neighbouring windows.

    Rows meet their window by the minute, a table of one row per minute; rows without a time come with a null window.
    """
    minutes = minute_windows(df, ts_col, cap).select(F.col("minute").alias("_minute"), "window_start")
    met = df.withColumn("_minute", F.date_trunc("minute", F.col(ts_col))).join(minutes, "_minute", "left").drop("_minute")
    return met.repartitionByRange(partitions, "window_start") if partitions else met.repartitionByRange("window_start")


def pending(df: DataFrame, window: Column, done: DataFrame) -> DataFrame:
    """Rows of windows not yet recorded in ``done(window_start)``."""
    return df.withColumn("window_start", window).join(done, "window_start", "left_anti")


def late_edits(df: DataFrame, since, until) -> DataFrame:
    """Per run window: rows updated inside it, rows created before it, late edits."""
    updated, added = df.schema["dateUpdated"].dataType, df.schema["dateAdded"].dataType
    lo, hi = check_bounds(since, until)
    inside = F.col("dateUpdated").between(instant(lo, updated), instant(hi, updated))
    before = F.col("dateAdded") < instant(lo, added)
    return df.agg(
        F.count_if(inside).alias("updated_in_window"),
        F.count_if(before).alias("created_before_window"),
        F.count_if(inside & before).alias("late_edits"),
    )


def tag_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Tags added and removed per id between two versions; unchanged ids drop out."""
    old = before.select("id", F.col("tags").alias("_old"))
    new = after.select("id", F.col("tags").alias("_new"))
    none = F.array().cast("array<string>")
    o, n = F.coalesce("_old", none), F.coalesce("_new", none)
    return (
        new.join(old, "id", "left")
        .select("id", G.tags_added(o, n).alias("added"), G.tags_removed(o, n).alias("removed"))
        .where((F.size("added") > 0) | (F.size("removed") > 0))
    )
