"""Compare expected properties with what the target holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.functions import text as T
from contactloom.operators.rows import keep_last


def values_match(prop: str, expected: Column, actual: Column) -> Column:
    """Numeric classes by value, names without case, everything else trimmed."""
    if prop in rules.NUMERIC_FIELDS:
        return expected.try_cast("double") == actual.try_cast("double")
    e, a = T.trim(expected), T.trim(actual)
    if prop in rules.CASELESS_FIELDS:
        return F.lower(e) == F.lower(a)
    return e == a


def severity(prop: str) -> str:
    return "warn" if prop in rules.WARN_ONLY_FIELDS else "fail"


def validate(expected: DataFrame, actual: DataFrame, props: list[str]) -> DataFrame:
    """Per e-mail: status and the mismatching fields (``fail:x`` / ``warn:x``).

    Both sides keep the last row per e-mail.  Only checked columns are joined.
    """
    checked = [p for p in props if p not in rules.SKIPPED_FIELDS]

    def side(df: DataFrame, prefix: str) -> DataFrame:
        keyed = df.withColumn("_e", T.email_key(F.col("email"))).where(F.col("_e").isNotNull())
        one = keep_last(keyed.select("_e", "ord", *checked), "_e")
        return one.select("_e", *[F.col(p).cast("string").alias(f"{prefix}{p}") for p in checked])

    joined = side(expected, "x_").join(
        side(actual, "y_").withColumn("_found", F.lit(True)), "_e", "left"
    )
    marks = []
    for p in checked:
        x, y = F.col(f"x_{p}"), F.col(f"y_{p}")
        wanted = x.isNotNull() & (x != "")
        blank = y.isNull() | (y == "")
        differs = ~F.coalesce(values_match(p, x, y), F.lit(False))
        marks.append(F.when(wanted & (blank | differs), F.lit(f"{severity(p)}:{p}")))
    found = F.coalesce("_found", F.lit(False))
    mismatches = F.when(found, F.array_compact(F.array(*marks))).otherwise(
        F.array().cast("array<string>")
    )
    result = joined.select(F.col("_e").alias("email"), found.alias("_found"), mismatches.alias("mismatches"))
    failed = F.exists("mismatches", lambda m: F.startswith(m, F.lit("fail:")))
    status = (
        F.when(~F.col("_found"), F.lit("NOT_FOUND"))
        .when(failed, F.lit("FAIL"))
        .when(F.size("mismatches") > 0, F.lit("WARN"))
        .otherwise(F.lit("PASS"))
    )
    return result.select("email", status.alias("status"), "mismatches")


def status_counts(validated: DataFrame) -> DataFrame:
    return validated.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def verdict(validated: DataFrame) -> DataFrame:
    """One row: passed when nothing failed and everything was found."""
    return validated.agg(
        F.count(F.lit(1)).alias("checked"),
        (F.count_if(F.col("status").isin("FAIL", "NOT_FOUND")) == 0).alias("passed"),
    )
