"""String cleaning as built-in Column expressions (no Python workers)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space of the source system's text rules.
SPACE_CHARS = "\t\n\x0b\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_SPACE = r"\t-\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

# Cleaning patterns.
PLACEHOLDER = r"\{\{[^}]*\}\}"
HTML_TAG = r"<[^>]+>"
PHONE_LIKE = r"\A[+0-9" + _SPACE + r"\-().]{7,}\z"
EMAIL = r"\A[^" + _SPACE + r"@]+@[^" + _SPACE + r"@]+\.[^" + _SPACE + r"@]+\z"
E164 = r"\A\+[0-9]{7,15}\z"


def trim(c: Column) -> Column:
    """Strip Unicode white space at both ends (Spark's plain trim strips blanks only)."""
    return F.trim(c, F.lit(SPACE_CHARS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def strip_placeholder(c: Column) -> Column:
    """Remove ``{{...}}`` and surrounding white space; '' when nothing is left."""
    bare = F.when(F.contains(c, F.lit("{{")), F.regexp_replace(c, PLACEHOLDER, "")).otherwise(c)
    return trim(bare)


def clean_placeholder(c: Column) -> Column:
    """Changed and empty becomes null; an untouched '' stays ''."""
    s = strip_placeholder(c)
    return F.when(s == c, c).otherwise(blank_to_null(s))


def placeholder_changed(c: Column) -> Column:
    return F.coalesce(strip_placeholder(c) != c, F.lit(False))


def strip_html(c: Column) -> Column:
    bare = F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, HTML_TAG, "")).otherwise(c)
    return blank_to_null(trim(bare))


def looks_like_phone(c: Column) -> Column:
    return F.coalesce(F.rlike(c, F.lit(PHONE_LIKE)), F.lit(False))


def normal_email(c: Column) -> Column:
    return F.lower(trim(c))


def is_email(c: Column) -> Column:
    return F.coalesce(F.rlike(c, F.lit(EMAIL)), F.lit(False))


def is_e164(c: Column) -> Column:
    return F.coalesce(F.rlike(c, F.lit(E164)), F.lit(False))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def salvage_phone(c: Column) -> Column:
    """10 digits or 11 digits with a leading 1 become ``+1...``; anything else null."""
    d = digits(c)
    return F.when(F.length(d) == 10, F.concat(F.lit("+1"), d)).when(
        (F.length(d) == 11) & F.startswith(d, F.lit("1")), F.concat(F.lit("+"), d)
    )


def email_key(c: Column) -> Column:
    return blank_to_null(trim(F.lower(c)))


def phone_key(c: Column) -> Column:
    return blank_to_null(trim(c))


def name_key(first: Column, last: Column) -> Column:
    """``first|last`` in lower case, null when both parts are blank."""
    f = F.lower(trim(F.coalesce(first, F.lit(""))))
    l = F.lower(trim(F.coalesce(last, F.lit(""))))
    return F.when((f != "") | (l != ""), F.concat(f, F.lit("|"), l))


def full_name(first: Column, last: Column) -> Column:
    return trim(
        F.concat(F.coalesce(first, F.lit("")), F.lit(" "), F.coalesce(last, F.lit("")))
    )


def email_local(c: Column) -> Column:
    return F.coalesce(F.split_part(c, F.lit("@"), F.lit(1)), F.lit(""))


def email_domain(c: Column) -> Column:
    return F.coalesce(F.split_part(c, F.lit("@"), F.lit(2)), F.lit(""))


def duration_ms_text(ms: Column) -> Column:
    """``45s`` or ``1m 23s``; ``n/a`` for a missing or negative span."""
    s = F.floor(ms / 1000.0 + F.lit(0.5)).cast("bigint")
    minutes = F.floor(s / F.lit(60)).cast("bigint")
    return (
        F.when(ms.isNull() | (ms < 0), F.lit("n/a"))
        .when(
            s >= 60,
            F.concat(minutes.cast("string"), F.lit("m "), (s % 60).cast("string"), F.lit("s")),
        )
        .otherwise(F.concat(s.cast("string"), F.lit("s")))
    )


def hours_minutes_text(ms: Column) -> Column:
    h = F.floor(ms / F.lit(3600000)).cast("bigint")
    m = F.floor((ms % 3600000) / F.lit(60000)).cast("bigint")
    return F.concat(h.cast("string"), F.lit("h "), m.cast("string"), F.lit("m"))


def percent_text(part: Column, whole: Column, digits_after: int = 0) -> Column:
    """Decimal arithmetic, so that ties are always rounded half up."""
    pct = part.cast("decimal(20,6)") * 100 / whole.cast("decimal(20,6)")
    return F.concat(F.round(pct, digits_after).cast(f"decimal(20,{digits_after})").cast("string"), F.lit("%"))
