"""Every named query against its DuckDB statement on the smallest data set."""

from __future__ import annotations

import __spark_entry__ as driver
import pytest
from compare import connect, differences

from tallyline.catalog import CATALOG
from tallyline.operators import ordering

FOLDER = "/root/testdata/sf0.001"
LIBRARY = sorted(CATALOG)


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_entry(spark):
    assert driver.entry(spark).count() == 1


def test_every_query_has_a_statement():
    assert set(LIBRARY) <= set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", LIBRARY)
def test_query(spark, duck, name):
    result = driver.queries()[name](spark, FOLDER)
    assert differences(result, duck, driver.oracle_sql()[name]) is None


@pytest.mark.parametrize(
    "name",
    [
        "V12_product_performance", "V13_country_rankings", "V16_rfm", "C4_spend_statistics",
        "C5_spend_deciles", "X13_customer_headline", "BI5_concentration", "DIM3_customers",
        "DIM6_products_upserted",
    ],
)
def test_distributed_ordering(spark, duck, monkeypatch, name):
    """The same answers when nothing counts as small enough for one task."""
    monkeypatch.setattr(ordering, "ONE_TASK_ROWS", 0)
    result = driver.queries()[name](spark, FOLDER)
    assert differences(result, duck, driver.oracle_sql()[name]) is None
