"""Writers: line JSON, reports, review CSV, partitioned snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from contactloom import rules


def append_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def write_counted(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Write and return the number of rows without a second pass."""
    seen = Observation("written")
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").format(fmt).save(path)
    return seen.get["n"]


def write_review_csv(review: DataFrame, path: str) -> None:
    """Manual-review pairs, fixed columns, quotes escaped."""
    (
        review.select(*rules.REVIEW_COLUMNS)
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def write_report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_object(df: DataFrame, path: str, key: str, value: str) -> None:
    """A small lookup as one JSON object, keys in order."""
    entries = F.array_sort(F.collect_list(F.struct(F.col(key).alias("key"), F.col(value).alias("value"))))
    df.agg(F.to_json(F.map_from_entries(entries)).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_by_month(df: DataFrame, path: str, ts_col: str = "dateUpdated") -> None:
    """Contacts partitioned by modification month, so a delta scan prunes folders.

    Rows are rebalanced by month: adaptive execution splits a busy month by size, so
    it is written by as many tasks as it needs.
    """
    (
        df.withColumn("month", F.date_format(ts_col, "yyyy-MM"))
        .hint("rebalance", "month")
        .write.mode("overwrite")
        .partitionBy("month")
        .parquet(path)
    )
