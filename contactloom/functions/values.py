"""Custom-field value transforms.

A custom field value arrives as VARIANT.  ``scalar_text`` turns it into text
once; ``value_kind`` names its type so that, e.g., the number 1650000000000 is
an epoch while the same digits as text are not a date.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom.functions import text as T

# Numeric prefixes and date shapes.
INTEGER_PREFIX = r"^-?[0-9]+"
DECIMAL_PREFIX = r"^-?([0-9]+[.]?[0-9]*|[.][0-9]+)"
ISO_DATE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
ISO_DATETIME = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T"
FIRST_MS, LAST_MS = -62167219200000, 253402300799999  # year 0 to year 9999
US_DATE = r"\A([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})\z"


def _number_text(x: str) -> str:
    """Text of a numeric VARIANT: a whole value has no fraction and no exponent."""
    d = f"variant_get({x}, '$', 'double')"
    return (
        f"CASE WHEN {d} = floor({d}) AND abs({d}) < 1e18 THEN CAST(CAST({d} AS DECIMAL(38, 0)) AS STRING) "
        f"ELSE variant_get({x}, '$', 'string') END"
    )


def _scalar(x: str) -> str:
    return (
        f"CASE WHEN schema_of_variant({x}) RLIKE '^(DOUBLE|FLOAT|DECIMAL)' THEN {_number_text(x)} "
        f"ELSE variant_get({x}, '$', 'string') END"
    )


def scalar_text(x: str) -> Column:
    return F.expr(_scalar(x))


def is_text(x: str) -> Column:
    return F.expr(f"schema_of_variant({x}) = 'STRING'")


def plain_text(x: str) -> Column:
    """A text value as it is; other values as the variant's own cast gives them."""
    return F.expr(f"variant_get({x}, '$', 'string')")


def list_members(x: str) -> Column:
    """Members of a list as text, without nulls, empty text, the number 0 and the boolean false."""
    kept = (
        "CASE WHEN m IS NULL OR schema_of_variant(m) = 'VOID' THEN false "
        "WHEN schema_of_variant(m) = 'STRING' THEN variant_get(m, '$', 'string') <> '' "
        "WHEN schema_of_variant(m) = 'BOOLEAN' THEN variant_get(m, '$', 'boolean') "
        "WHEN schema_of_variant(m) RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)' THEN variant_get(m, '$', 'double') <> 0 "
        "ELSE true END"
    )
    members = f"filter(try_variant_get({x}, '$', 'array<variant>'), m -> {kept})"
    return F.expr(f"transform({members}, m -> {_scalar('m')})")


def value_kind(x: str) -> Column:
    """'string', 'number', 'array' or 'other' for a VARIANT; null when absent."""
    return F.expr(
        f"CASE WHEN schema_of_variant({x}) = 'STRING' THEN 'string' "
        f"WHEN schema_of_variant({x}) RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)' THEN 'number' "
        f"WHEN startswith(schema_of_variant({x}), 'ARRAY') THEN 'array' "
        f"WHEN schema_of_variant({x}) <> 'VOID' THEN 'other' END"
    )


# The transforms below take column names and are written as SQL text: one call
# per field keeps building a 67-column projection cheap.


def _trimmed(x: str) -> str:
    return f"trim(BOTH '{T.SPACE_CHARS}' FROM {x})"


def to_integer(text: str, strict: bool = False) -> Column:
    """Keep digits and '-', then parse the numeric prefix ('3.7' gives 37).

    ``strict=True`` parses a decimal and truncates it instead ('3.7' gives 3).
    """
    if strict:
        return to_decimal(text).cast("bigint")
    kept = f"regexp_replace({text}, '[^0-9-]', '')"
    return F.expr(f"try_cast(nullif(regexp_extract({kept}, r'{INTEGER_PREFIX}', 0), '') AS BIGINT)")


def to_decimal(text: str) -> Column:
    kept = f"regexp_replace({text}, '[^0-9.-]', '')"
    return F.expr(f"try_cast(nullif(regexp_extract({kept}, r'{DECIMAL_PREFIX}', 0), '') AS DOUBLE)")


def to_iso_date(text: str, kind: str) -> Column:
    """``YYYY-MM-DD`` text; calendar validity is not checked (see ``is_calendar_date``).

    A number is epoch milliseconds; the same digits as text are not a date.  A
    number outside the years 0 to 9999 has no date text and gives null.
    """
    s = _trimmed(text)
    ms = f"try_cast({text} AS DOUBLE)"
    days = f"CASE WHEN {ms} BETWEEN {FIRST_MS} AND {LAST_MS} THEN CAST(floor({ms} / 86400000) AS INT) END"

    def part(i: int) -> str:
        return f"regexp_extract({s}, r'{US_DATE}', {i})"

    return F.expr(
        f"CASE WHEN {kind} = 'number' THEN CAST(date_add(DATE '1970-01-01', {days}) AS STRING) "
        f"WHEN {s} RLIKE r'{ISO_DATE}' THEN {s} "
        f"WHEN {s} RLIKE r'{ISO_DATETIME}' THEN substring({s}, 1, 10) "
        f"WHEN {s} RLIKE r'{US_DATE}' THEN "
        f"{part(3)} || '-' || lpad({part(1)}, 2, '0') || '-' || lpad({part(2)}, 2, '0') END"
    )


def is_calendar_date(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd").isNotNull()


def to_multi_select(text: str, kind: str, items: str) -> Column:
    """Semicolon list of the ``list_members`` of an array, or of text split at commas."""
    from_array = f"array_join({items}, ';')"
    from_text = (
        f"array_join(filter(transform(split({text}, ','), x -> {_trimmed('x')}), x -> x <> ''), ';')"
    )
    return F.expr(
        f"nullif(CASE WHEN {kind} = 'array' THEN {from_array} WHEN {kind} = 'string' THEN {from_text} END, '')"
    )


def to_timezone(tz: Column) -> Column:
    known = F.contains(tz, F.lit("/")) | F.lower(tz).isin("utc", "gmt")
    return F.when(known, F.replace(F.lower(tz), F.lit("/"), F.lit("_slash_")))


def to_epoch_ms(text: Column) -> Column:
    """Epoch digits or an ISO timestamp, in milliseconds; null when neither parses."""
    return F.coalesce(
        F.when(F.rlike(text, F.lit(r"\A[0-9]+\z")), text.try_cast("bigint")),
        # a date without a time means midnight UTC
        F.unix_millis(
            F.try_to_timestamp(
                F.when(F.rlike(text, F.lit(ISO_DATE)), F.concat(text, F.lit("T00:00:00Z"))).otherwise(text)
            )
        ),
    )


def alias_market(market: Column, aliases: dict[str, str]) -> Column:
    key = T.trim(F.lower(market))
    out = market
    for alias, name in aliases.items():
        out = F.when(key == alias, F.lit(name)).otherwise(out)
    return out
