"""Attributes derived from a contact's tag array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from contactloom import rules

EVENT_TAG = r"(?i)^[0-9]{8}_([a-z]{2,5})"  # fixed value: date-stamped city tag


def has_any(tags: Column, wanted: list[str]) -> Column:
    """True when any wanted tag is present; null tags count as absent."""
    return F.coalesce(F.arrays_overlap(tags, F.array(*[F.lit(t) for t in wanted])), F.lit(False))


def first_match(tags: Column, table: list[tuple[str, str]]) -> Column:
    """Value of the first table row whose tag is present (table order is priority)."""
    out = None
    for tag, value in table:
        hit = F.array_contains(tags, tag)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def _matching(pattern: str):
    return lambda tag: F.rlike(tag, F.lit(pattern))


def first_pattern(tags: Column, table: list[tuple[str, str]]) -> Column:
    out = None
    for pattern, value in table:
        hit = F.exists(tags, _matching(pattern))
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def buyer_tier(tags: Column) -> Column:
    return first_match(tags, rules.BUYER_TIERS)


def cancellation_status(tags: Column) -> Column:
    return first_match(tags, rules.CANCELLATIONS)


def fulfillment_status(tags: Column) -> Column:
    return first_match(tags, rules.FULFILLMENTS)


def event_type(tags: Column) -> Column:
    return first_pattern(tags, rules.EVENT_TYPES)


def engagement_action(tags: Column) -> Column:
    return first_match(tags, rules.ENGAGEMENT_ACTIONS)


def without_system_tags(tags: Column) -> Column:
    pattern = "|".join(rules.SYSTEM_TAG_PATTERNS)
    return F.filter(tags, lambda t: ~F.rlike(t, F.lit(pattern)))


def city_codes(tags: Column) -> Column:
    """Distinct lower-case city codes in first-seen order."""
    found = F.transform(tags, lambda t: F.lower(F.regexp_extract(t, EVENT_TAG, 1)))
    return F.array_distinct(F.filter(found, lambda c: c.isNotNull() & (c != "")))


def _city_map() -> Column:
    return F.create_map(*[F.lit(x) for pair in rules.CITY_CODES.items() for x in pair])


def known_cities(codes: Column, distinct_city: bool = False) -> Column:
    """``;``-joined city names; de-duplication is by code unless ``distinct_city``."""
    names = F.filter(
        F.transform(codes, lambda c: F.try_element_at(_city_map(), c)), lambda n: n.isNotNull()
    )
    if distinct_city:
        names = F.array_distinct(names)
    return F.nullif(F.array_join(names, ";"), F.lit(""))


def event_cities(tags: Column, distinct_city: bool = False) -> Column:
    return known_cities(city_codes(tags), distinct_city)


def unknown_city_codes(tags: Column) -> Column:
    known = F.array(*[F.lit(c) for c in rules.CITY_CODES])
    return F.array_except(city_codes(tags), known)


def tags_added(before: Column, after: Column) -> Column:
    return F.array_sort(F.array_except(after, before))


def tags_removed(before: Column, after: Column) -> Column:
    return F.array_sort(F.array_except(before, after))
