"""Registered queries against their DuckDB statements at the smallest scale.

CONTACTLOOM_FULL=1 checks all of them; the default is one query per operator family.
"""

import os

import pytest

import __spark_entry__ as entry
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"
CORE = [
    "clean_names_emails_phones", "issue_counts", "decode_custom_fields", "event_cities", "buyer_tier",
    "owner_map_build", "key_index", "match_actions", "conflict_filtered_updates", "conflict_safe_snapshot",
    "enum_domain_violations", "duplicate_pairs", "weekly_windows", "delta_since", "delta_counts", "tag_diff",
    "tag_topk", "field_coverage", "pipeline_counts", "schema_diff_options", "validation_status",
    "failure_rate", "guest_edges", "corrupt_lines", "review_csv", "stream_sync",
]


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(entry.queries()) if os.environ.get("CONTACTLOOM_FULL") else CORE)
def test_query_matches_sql(spark, con, name):
    ok, n, why = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert ok is not False, why


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["action", "matched_on", "n"]
