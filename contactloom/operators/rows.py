"""Ordered row picking: keep-first, keep-last, overlay, numbering.

All of these are grouped aggregates with map-side combine, so a key that holds
a large share of the rows is reduced before the shuffle and never sorted in one
task.  ``ord`` is the input-order column and must be unique per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _pick(df: DataFrame, key: str | list[str], ord_col: str, pick) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(pick(F.struct(*rest), F.col(ord_col)).alias("_row"))
    return best.select(*keys, "_row.*").select(*df.columns)


def keep_first(df: DataFrame, key: str | list[str], ord_col: str = "ord") -> DataFrame:
    """One row per key: the one with the lowest ``ord``."""
    return _pick(df, key, ord_col, F.min_by)


def keep_last(df: DataFrame, key: str | list[str], ord_col: str = "ord") -> DataFrame:
    """One row per key: the one with the highest ``ord``."""
    return _pick(df, key, ord_col, F.max_by)


def last_value(col: str, ord_col: str = "ord") -> Column:
    """Aggregate: latest non-null value of a column."""
    return F.expr(f"max_by({col}, CASE WHEN {col} IS NOT NULL THEN {ord_col} END) AS {col}")


def first_value(col: str, ord_col: str = "ord") -> Column:
    """Aggregate: earliest non-null value of a column."""
    return F.expr(f"min_by({col}, CASE WHEN {col} IS NOT NULL THEN {ord_col} END) AS {col}")


def overlay(df: DataFrame, key: str, cols: list[str], ord_col: str = "ord") -> DataFrame:
    """One row per key; every column takes its latest non-null value."""
    rest = [c for c in df.columns if c not in cols and c != key and c != ord_col]
    return (
        df.groupBy(key)
        .agg(
            F.max(ord_col).alias(ord_col),
            *[last_value(c, ord_col) for c in cols],
            *[F.max_by(c, ord_col).alias(c) for c in rest],
        )
        .select(*df.columns)
    )


def number_within(
    df: DataFrame, key: str, ord_col: str, name: str, chunk: int = 1_000_000
) -> DataFrame:
    """Running number 1, 2, ... per key in ``ord`` order.

    Rows are numbered inside fixed ``ord`` chunks and shifted by the row counts
    of the earlier chunks, so one hot key spreads over many tasks.
    """
    chunked = df.withColumn("_chunk", F.floor(F.col(ord_col) / F.lit(chunk)))
    sizes = chunked.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        key, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy(key, "_chunk").orderBy(ord_col)
    return (
        chunked.join(starts, [key, "_chunk"])
        .withColumn(name, F.row_number().over(inside) + F.col("_start"))
        .select(*df.columns, name)
    )


def first_n(df: DataFrame, n: int, ord_col: str = "ord") -> DataFrame:
    return df.orderBy(ord_col).limit(n)


def spread_nulls(key: Column, row_id: Column) -> Column:
    """Join key whose null rows get a private value, so they do not share one task.

    The private value starts with a NUL character and never equals a real key.
    """
    return F.coalesce(key, F.concat(F.lit("\u0000"), row_id.cast("string")))
