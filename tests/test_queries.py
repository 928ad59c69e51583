"""Registered queries against their SQL counterparts on the smallest tables."""

import pytest

import __spark_entry__ as entry
from gapweave.plans.catalog import QUERIES
from tests.compare import check, connect

SLOW = {
    "full_imputation", "full_imputation_report", "single_level_imputation", "strata", "compared_models", "compared_regressions", "feature_importances",
    "iterative_label_fill", "iterative_label_confidence", "feature_relations", "fill_guarantees", "full_imputation_gaps", "run_quality",
}


@pytest.fixture(scope="module")
def database(sf):
    return connect(sf)


def test_entry_has_rows_and_keys_agree(spark):
    assert entry.entry(spark).count() == 1
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - SLOW))
def test_query(spark, database, sf, name):
    status, rows, detail = check(spark, database, name, sf)
    assert status in ("ok", "rows only"), detail
    assert rows > 0
