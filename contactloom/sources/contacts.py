"""Readers for contact files, with explicit schemas and corrupt-line handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from contactloom import rules
from contactloom.sources.staging import exists

ATTRIBUTION = "struct<isFirst:boolean,utmSource:string,sessionSource:string,medium:string>"

CONTACT_SCHEMA = ", ".join(
    [f"{c} string" for c in rules.CONTACT_STRING_FIELDS]
    + [
        "dateAdded timestamp",
        "dateUpdated timestamp",
        "tags array<string>",
        f"attributionSource array<{ATTRIBUTION}>",
        "customFields array<struct<id:string,value:variant>>",
        "ord bigint",
    ]
)

#: Bits of ``ord`` for the file, the scan task and the row in it.
FILE_BITS, TASK_BITS, ROW_BITS = 20, 17, 26

OPPORTUNITY_SCHEMA = (
    "id string, name string, monetaryValue double, status string, source string, "
    "createdAt timestamp, pipelineId string, contactId string"
)

_CORRUPT = "_corrupt"


def placed(scan: DataFrame) -> DataFrame:
    """A file scan with ``_place``, the place of a row in the input: files by path, then scan task, then row.

    To be applied straight to a file scan, before any shuffle.  Splits of one file are
    scanned in the order of their offsets, so the order within a file is the file's.
    """
    files = sorted(scan.inputFiles())
    if len(files) >= 1 << FILE_BITS:
        raise ValueError(f"more than {1 << FILE_BITS} files")
    task, row = F.shiftright("_seq", 33), F.col("_seq").bitwiseAND(F.lit((1 << 33) - 1))
    fits = (task < 1 << TASK_BITS) & (row < 1 << ROW_BITS)
    number = F.shiftleft("_nth", TASK_BITS + ROW_BITS) + F.shiftleft(task, ROW_BITS) + row
    misfit = F.raise_error(F.lit("a scan task or its rows do not fit ord")).cast("bigint")
    nth = scan.sparkSession.createDataFrame(list(enumerate(files)), "_nth bigint, _file string")
    named = scan.withColumns({"_file": F.input_file_name(), "_seq": F.monotonically_increasing_id()})
    # one row per file, at most 2 ** FILE_BITS
    known = named.join(F.broadcast(nth), "_file").withColumn("_place", F.when(fits, number).otherwise(misfit))
    return known.select(*scan.columns, "_place")


def _loose(schema: str) -> str:
    """The schema with attribution of any shape."""
    return schema.replace(f"attributionSource array<{ATTRIBUTION}>", "attributionSource variant")


def _settled(df: DataFrame) -> DataFrame:
    """Attribution as an array: a single object counts as the first, whatever its flag."""
    if dict(df.dtypes).get("attributionSource") != "variant":
        return df
    one = F.try_variant_get("attributionSource", "$", f"struct<{ATTRIBUTION.removeprefix('struct<')}")
    single = F.array(one.withField("isFirst", F.lit(True)))
    many = F.try_variant_get("attributionSource", "$", f"array<{ATTRIBUTION}>")
    is_object = F.startswith(F.schema_of_variant("attributionSource"), F.lit("OBJECT"))
    return df.withColumn("attributionSource", F.when(is_object, single).otherwise(many))


def _ordered(df: DataFrame, place: str) -> DataFrame:
    """``ord`` of the file if it has one, else the place in the input."""
    own = F.coalesce("ord", place) if "ord" in df.columns else F.col(place)
    return df.withColumn("ord", own).drop(place)


def read_json_array(spark: SparkSession, path: str, schema: str = CONTACT_SCHEMA) -> DataFrame:
    """A file holding one JSON array.

    A multi-line file is one task; use ``read_array_lines`` for large files that
    hold one object per line.
    """
    scan = spark.read.schema(_loose(schema)).option("multiLine", True).json(path)
    return _settled(_ordered(placed(scan), "_place"))


def _parse_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Parse one JSON object per ``line``; unreadable lines are kept in ``_corrupt``.

    The good/corrupt split needs no cached copy this way: both sides re-read text.
    """
    parsed = F.from_json(
        "line", f"{_loose(schema)}, {_CORRUPT} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    rows = lines.select(parsed.alias("r"), "_place").select("r.*", "_place")
    return _settled(_ordered(rows, "_place"))


def _text_lines(spark: SparkSession, path: str, line: Column) -> DataFrame:
    return placed(spark.read.text(path)).select(line.alias("line"), "_place")


def read_ndjson(spark: SparkSession, path: str, schema: str = CONTACT_SCHEMA) -> DataFrame:
    """One object per line; blank lines are skipped."""
    lines = _text_lines(spark, path, F.trim("value"))
    return _parse_lines(lines.where(F.col("line") != ""), schema)


def read_array_lines(spark: SparkSession, path: str, schema: str = CONTACT_SCHEMA) -> DataFrame:
    """A large JSON array with one object per line, read line by line in parallel.

    Blank lines and the bracket lines are skipped, a trailing comma is removed, also a
    bracket that shares a line with the first or last object.
    """
    line = F.regexp_replace(F.trim("value"), r"^\[\s*(?=\{)|(?<=\})\s*,?\s*\]\s*$|,\s*$", "")
    lines = _text_lines(spark, path, line)
    return _parse_lines(lines.where(~F.col("line").isin("", "[", "]")), schema)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable rows, unreadable lines)."""
    good = df.where(F.col(_CORRUPT).isNull()).drop(_CORRUPT)
    return good, df.where(F.col(_CORRUPT).isNotNull()).select(F.col(_CORRUPT).alias("line"))


def read_csv_export(spark: SparkSession, path: str, delimiter: str = ",", multi_line: bool = True) -> DataFrame:
    """CSV export with header: trimmed values, empty lines skipped, all text.

    Quoted values may hold line breaks, which makes every file one task; files known to
    have none are split with ``multi_line=False``.
    """
    df = (
        spark.read.option("header", True)
        .option("sep", delimiter)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    return df.dropna(how="all")


def normalise_attribution(json_col: str):
    """A single attribution object or an array of them -> array of structs."""
    text = F.col(json_col)
    as_array = F.when(F.startswith(F.ltrim(text), F.lit("{")), F.concat(F.lit("["), text, F.lit("]"))).otherwise(text)
    return F.from_json(as_array, f"array<{ATTRIBUTION}>")


def read_months(spark: SparkSession, path: str, since, until) -> DataFrame:
    """Contacts written by ``sinks.write_by_month`` and changed within the bounds.

    The month condition prunes folders, the timestamp condition reaches the files.
    """
    from contactloom.operators.windows import changed_rows, check_bounds

    lo, hi = check_bounds(since, until)
    months = F.col("month").between(lo.strftime("%Y-%m"), hi.strftime("%Y-%m"))
    df = spark.read.option("basePath", path).parquet(path)
    return changed_rows(df.where(months), lo, hi).drop("month")


def optional_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A lookup file, or an empty table of the same schema when it is missing."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def optional_object(spark: SparkSession, path: str, key: str, value: str) -> DataFrame:
    """A lookup file that is one JSON object, as rows (key, value); empty when it is missing.

    Such files are dimensions (one entry per user), read whole.  What is no object gives no rows.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], f"{key} string, {value} string")
    entries = F.from_json("value", "map<string,string>")
    return spark.read.text(path, wholetext=True).select(F.explode(entries).alias(key, value))
