"""Every catalog query against its DuckDB oracle on the smallest driver tables
(the driver repeats this at sf0.01)."""

import pytest

import __spark_entry__ as entry
from tools.oracle_check import compare

from harborlens.plans.catalog import all_oracles, all_queries

NAMES = sorted(all_queries())


def test_every_query_has_an_oracle():
    missing = set(all_queries()) - set(all_oracles())
    assert not missing, missing


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert set(df.columns) == {"event_type", "deliveries", "distinct_events", "duplicates", "dup_ratio"}


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    from tests.conftest import SF_SMALL
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res["ok"] is True, res
