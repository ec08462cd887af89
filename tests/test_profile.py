from __future__ import annotations

import pytest
from conftest import PROFILE_ROWS, raw_frame, rows_of
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline import pipeline
from tallyline.operators.cleaning import clean
from tallyline.plans import profile, rules
from tallyline.sources import landing


def test_figures(profile_raw):
    row = profile.profile_figures(profile_raw).first()
    assert (row["row_count"], row["missing_Description"], row["missing_CustomerID"]) == (9, 1, 2)
    assert (row["duplicate_rows"], float(row["duplicate_rows_pct"])) == (1, 11.11)
    assert row["distinct"].asDict() == {
        "unique_invoice_count": 7, "unique_customer_count": 4,
        "unique_product_count": 5, "unique_country_count": 3,
    }
    assert (row["quantity_negative_count"], row["quantity_zero_count"]) == (2, 0)
    assert (row["unit_price_zero_count"], row["unit_price_negative_count"]) == (1, 0)
    assert (row["cancellation_count"], row["potential_return_count"]) == (1, 1)
    assert profile.identifier_coverage(profile_raw).first()["customer_id_present_count"] == 7


def test_parts(profile_raw):
    dates = profile.date_range(profile_raw).first()
    assert tuple(dates) == ("2012-09-03T00:00:00", "2012-09-21T00:00:00")
    assert rows_of(profile.top_countries(profile_raw))[0] == {"country": "United Kingdom", "row_count": 5}
    assert profile.shape(profile_raw).count() == 8
    missing = rows_of(profile.missing_values(profile_raw), "column_name")
    assert float(missing["CustomerID"]["missing_pct"]) == 22.22
    close = profile.distinct_counts(profile_raw, approximate=True).first()
    assert close["unique_invoice_count"] == 7


def test_missing_country_has_its_own_bucket(spark):
    rows = [*PROFILE_ROWS, ("1", "2", "x", 1, "2011-01-01", 1.0, 1, None)]
    found = rows_of(profile.country_distribution(raw_frame(spark, rows)), "country")
    assert found["(missing)"]["row_count"] == 1


def test_status_after_cleaning(profile_raw):
    counts = {
        r["transaction_status"]: r["count"]
        for r in clean(profile_raw).groupBy("transaction_status").count().collect()
    }
    assert counts == {"valid_sale": 6, "cancellation": 1, "potential_return": 1, "non_standard": 1}


def test_raw_warnings(profile_raw):
    extra = profile_raw.withColumn("Note", F.lit("x"))
    found = {r["rule"]: (r["row_count"], r["severity"]) for r in rows_of(rules.raw_warnings(extra))}
    assert found == {
        "missing_customer_id": (2, "info"),
        "missing_description": (1, "info"),
        "duplicate_rows": (1, "warning"),
        "negative_quantity": (2, "info"),
        "non_positive_unit_price": (1, "warning"),
        "cancellations": (1, "info"),
        "potential_returns": (1, "warning"),
        "unexpected_columns": (1, "warning"),
    }


def test_schema_faults_come_together(spark, profile_raw):
    landing.validate_schema(profile_raw)
    bad = profile_raw.drop("Country").withColumn("Quantity", F.lit("six")).withColumn(
        "StockCode", F.lit(None).cast("string")
    )
    faults = landing.schema_findings(bad)
    assert len(faults) == 3
    assert any("Country" in f for f in faults) and any("9 null" in f for f in faults)
    with pytest.raises(C.ContractError, match="3 structural"):
        landing.validate_schema(bad)


def test_reports_are_stored(spark, public_tables):
    paths = pipeline.save_reports(public_tables)
    found = spark.read.json(paths["profile"]).first().asDict(recursive=True)
    want = profile.profile_figures(public_tables.raw).first().asDict(recursive=True)
    assert found["row_count"] == want["row_count"] == 6 and found["distinct"] == want["distinct"]
    summary = {(r["section"], r["metric"]): r["value"] for r in spark.read.json(paths["cleaning"]).collect()}
    assert summary["rows", "cleaned"] == 6
    assert spark.read.schema("rule string").json(paths["raw_warnings"]).count() == rules.raw_warnings(public_tables.raw).count()
