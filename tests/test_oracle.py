"""Every query with a SQL counterpart, against DuckDB on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, con, name):
    assert differences(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) == []


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry_is_the_feature_table(spark):
    df = entry(spark)
    assert len(df.columns) == 23
    assert df.columns[:2] == ["event_date", "chokepoint"]


def test_expected_counts_of_the_sample(spark):
    """Row counts at sf0.01, worked out beforehand in another engine."""
    d = "/root/testdata/sf0.01"
    assert queries()["dedup_events"](spark, d).count() == 58_757
    funnel = {r.step: r.row_count for r in queries()["preprocessing_funnel"](spark, d).collect()}
    assert funnel["near a box"] == 4_125
    assert funnel["daily panel"] == 3_544
    assert funnel["feature rows"] == 853


def test_fixed_values_are_the_published_ones():
    """Boxes, codes and inputs as plain values: the SQL takes them from the same place as the queries."""
    from straitflow import config

    boxes = {b.name: (b.lat_min, b.lat_max, b.lon_min, b.lon_max) for b in config.CHOKEPOINT_BOXES}
    assert boxes == {
        "hormuz": (25.06, 28.06, 54.75, 57.75),
        "suez": (29.46, 31.46, 31.34, 33.34),
        "red_sea": (11.0, 17.0, 40.0, 46.0),
        "black_sea": (41.6, 47.6, 30.5, 36.5),
        "malacca": (0.5, 4.5, 99.5, 103.5),
        "panama": (8.58, 9.58, -80.18, -79.18),
        "taiwan": (23.0, 26.0, 118.0, 121.0),
        "chile": (-26.5, -20.5, -72.5, -66.5),
    }
    assert tuple(config.SUPPLY_CHAIN_ROOTS) == ("14", "17", "18", "19", "20")
    assert len(config.MODEL_INPUTS) == 15
