"""Profiling reports over contacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.sources.staging import stage


def tag_counts(df: DataFrame) -> DataFrame:
    """Occurrences per tag; a tag repeated in one row counts each time."""
    return (
        df.select(F.explode("tags").alias("tag"))
        .where(F.col("tag").isNotNull())
        .groupBy("tag")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_tags(df: DataFrame, n: int = 30) -> DataFrame:
    """Most frequent tags; ties by tag (a top-k report)."""
    return tag_counts(df).orderBy(F.col("n").desc(), "tag").limit(n)


def tag_ranking(df: DataFrame) -> DataFrame:
    """Every tag with its share of the scanned contacts in percent, most frequent first."""
    counted = _with_rows(df, F.filter("tags", lambda t: t.isNotNull()), "tag")
    share = F.round(100.0 * F.col("n") / F.col("_rows"), 1).alias("pct")
    return counted.select("tag", "n", share).orderBy(F.col("n").desc(), "tag")


def _with_rows(df: DataFrame, items: Column, name: str) -> DataFrame:
    """(item, n, _rows): occurrences per item and the number of rows, from one scan.

    Every row adds a null item, whose count is the number of rows; the grouped rows
    are staged, so the total is read from them and not from the table again.
    """
    none = F.array().cast("array<string>")
    every = F.concat(F.array(F.lit(None).cast("string")), F.coalesce(items, none))
    counted = stage(df.select(F.explode(every).alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n")))
    rows = counted.where(F.col(name).isNull()).select("n").scalar()
    return counted.where(F.col(name).isNotNull()).select(name, "n", rows.alias("_rows"))


def selected_tag_counts(df: DataFrame, tags: list[str] = rules.CHECKED_TAGS) -> DataFrame:
    """Counts of given tags in the given order, zeros included."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(list(enumerate(tags)), "pos int, tag string")
    return (
        wanted.join(tag_counts(df).where(F.col("tag").isin(tags)), "tag", "left")
        .select("tag", F.coalesce("n", F.lit(0)).alias("n"))
    )


def field_coverage(df: DataFrame, fields: list[str]) -> DataFrame:
    """Filled rows and rounded percentage per field, fullest first: one aggregation, then unpivot."""
    def filled(c: str) -> Column:
        kind = df.schema[c].dataType.simpleString()
        present = F.col(c).isNotNull()
        return present & (F.col(c) != "") if kind == "string" else present

    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count_if(filled(c)).alias(c) for c in fields])
    return (
        one.unpivot("_rows", fields, "field", "filled")
        .select(
            "field",
            "filled",
            F.floor(100.0 * F.col("filled") / F.nullif("_rows", F.lit(0)) + F.lit(0.5)).cast("bigint").alias("pct"),
        )
        .where(F.col("filled") > 0)
        .orderBy(F.desc("filled"), "field")
    )


def key_presence(df: DataFrame, json_col: str, fields: list[str], ord_col: str) -> DataFrame:
    """Rows in which a key exists (even as null) and its first non-null value.

    ``json_col`` is a VARIANT object per row.
    """
    # a missing key is SQL null, a key holding JSON null is not
    keys = [
        F.count_if(F.variant_get(F.col(json_col), f"$.{f}", "variant").isNotNull()).alias(f"n_{f}")
        for f in fields
    ]
    firsts = []
    for f in fields:
        v = F.variant_get(F.col(json_col), f"$.{f}", "string")
        firsts.append(F.min_by(v, F.when(v.isNotNull(), F.col(ord_col))).alias(f"v_{f}"))
    one = df.agg(*keys, *firsts)
    entries = F.array(
        *[
            F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("n"), F.col(f"v_{f}").alias("example"))
            for f in fields
        ]
    )
    return one.select(F.explode(entries).alias("e")).select("e.*")


def discovered_keys(df: DataFrame, variant_col: str, ord_col: str = "ord") -> DataFrame:
    """(path, type, n, nulls, example): every key found in the documents, at any depth; no key is named beforehand.

    ``type`` is the common type of the key's values, ``n`` the rows that have it, ``nulls`` those where it is only JSON null,
    ``example`` the first other value in row order as text.  Elements of arrays share the path ``name[]``.  One round per
    level of nesting, until no value is an object or array; counts are combined before every shuffle.
    """
    level = df.where(F.col(variant_col).isNotNull()).select(F.col(ord_col).alias("ord"), F.lit("").alias("path"), F.col(variant_col).alias("v"))
    found = []
    kind = F.schema_of_variant("v")
    nested = F.startswith(kind, F.lit("OBJECT")) | F.startswith(kind, F.lit("ARRAY"))
    while True:
        inner = level.where(nested).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()).select("key", F.col("value").alias("inner")))
        key = F.when(F.col("key").isNull(), F.concat("path", F.lit("[]"))).otherwise(
            F.concat("path", F.when(F.col("path") == "", F.lit("")).otherwise(F.lit(".")), F.col("key"))
        )
        level = stage(inner.select("ord", key.alias("path"), F.col("inner").alias("v")))
        if level.isEmpty():
            break
        found.append(level)
    if not found:
        return df.sparkSession.createDataFrame([], "path string, type string, n bigint, nulls bigint, example string")
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    is_null = F.is_variant_null("v")
    per_row = whole.groupBy("path", "ord").agg(
        F.min(is_null).alias("empty"), F.min(F.when(~is_null, F.to_json("v"))).alias("text")
    )
    shapes = whole.groupBy("path").agg(F.schema_of_variant_agg("v").alias("type"))
    counts = per_row.groupBy("path").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("empty").alias("nulls"),
        F.min_by("text", F.when(F.col("text").isNotNull(), F.col("ord"))).alias("example"),
    )
    return shapes.join(counts, "path").select("path", "type", "n", "nulls", "example")


def custom_field_population(df: DataFrame) -> DataFrame:
    """Filled values per custom field and percentage of contacts."""
    filled = F.expr("filter(customFields, cf -> coalesce(variant_get(cf.value, '$', 'string'), '') <> '' AND cf.id IS NOT NULL)")
    counted = _with_rows(df, F.transform(filled, lambda cf: cf["id"]), "field_id")
    share = F.floor(100.0 * F.col("n") / F.col("_rows") + F.lit(0.5)).cast("bigint").alias("pct")
    return counted.select("field_id", "n", share)


def sample_rows(df: DataFrame, n: int = 5, ord_col: str = "ord") -> DataFrame:
    """First ``n`` contacts with display name and first five tags (a preview)."""
    from contactloom.functions import text as T

    return (
        df.orderBy(ord_col)
        .limit(n)
        .select("id", T.full_name(F.col("firstName"), F.col("lastName")).alias("name"),
                F.slice(F.coalesce("tags", F.array().cast("array<string>")), 1, 5).alias("tags"))
    )
