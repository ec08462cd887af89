from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from conftest import UK, load, rows_of

from tallyline import contracts as C
from tallyline.plans import cohorts, customers, measures, metrics, products, quality, rules, sales


def test_headline(sales_tables):
    row = sales.headline(sales_tables.star.fact).first()
    assert row["total_orders"] == 5
    assert row["gross_sales_revenue"] == Decimal("89.00")
    assert row["cancellation_value"] == Decimal("-20.00")
    assert row["net_revenue"] == Decimal("69.00")
    assert row["average_order_value"] == Decimal("13.80")


def test_growth(sales_tables):
    months = sales.monthly_growth(sales_tables.star.fact).orderBy("year", "month").collect()
    first, second = months
    assert first["previous_month_net_revenue"] is None
    assert first["month_over_month_growth_pct"] is None
    assert first["net_revenue"] == Decimal("53.00") and second["net_revenue"] == Decimal("16.00")
    assert second["month_over_month_growth_pct"] == Decimal("-69.81")
    assert second["cumulative_net_revenue"] == Decimal("69.00")
    assert (first["is_partial_month"], second["is_partial_month"]) == (False, True)


def test_first_month_that_starts_late_is_partial_and_gaps_stay(spark, tmp_path):
    rows = [
        ("700001", "1", "x", 1, "2011-03-04", 10.0, 1, UK),
        ("700002", "1", "x", 1, "2011-05-31", 30.0, 1, UK),
    ]
    star = load(spark, rows, tmp_path).star
    months = sales.monthly_growth(star.fact).orderBy("year", "month").collect()
    assert [m["is_partial_month"] for m in months] == [True, False]
    assert months[0]["month_start"] == date(2011, 3, 4)
    assert months[1]["previous_month_net_revenue"] == Decimal("10.00")
    assert star.dates.count() == 89


def test_month_without_sales_has_null_gross(spark, tmp_path):
    rows = [
        ("C700001", "1", "x", -1, "2011-03-01", 10.0, 1, UK),
        ("700002", "1", "x", 1, "2011-04-30", 30.0, 1, UK),
    ]
    fact = load(spark, rows, tmp_path).star.fact
    plain = rows_of(sales.monthly_revenue(fact), "month")
    assert plain[3]["gross_sales_revenue"] is None and plain[4]["cancellation_value"] is None
    grown = rows_of(sales.monthly_growth(fact), "month")
    assert grown[3]["gross_sales_revenue"] == 0 and grown[3]["average_order_value"] is None


def test_countries(sales_tables):
    found = rows_of(sales.country_share(sales_tables.star), "country_name")
    assert found["Ireland"]["net_revenue"] == Decimal("63.00") and found["Ireland"]["revenue_rank"] == 1
    assert found["Spain"]["pct_of_total_net_revenue"] == Decimal("8.70")


def test_products(sales_tables):
    star = sales_tables.star
    found = rows_of(products.product_performance(star), "stock_code")
    assert found["51010"]["revenue"] == Decimal("36.00") and found["51010"]["revenue_rank"] == 1
    assert found["51020"]["pct_of_total_revenue"] == Decimal("37.0787")
    assert found["51010"]["order_count"] == 3
    running = products.cumulative_contribution(star).orderBy("revenue_rank").collect()
    assert [r["cumulative_revenue"] for r in running] == [Decimal("36.00"), Decimal("69.00"), Decimal("89.00")]
    cancels = rows_of(products.cancellation_activity(star))
    assert len(cancels) == 1 and cancels[0]["cancellation_rate_pct"] == Decimal("50.00")


def test_equal_products_share_a_rank(spark, tmp_path):
    rows = [
        (f"70000{i}", f"1000{i}", "x", 1, "2011-03-01", p, 1, UK) for i, p in enumerate([5.0, 9.0, 9.0, 1.0])
    ]
    star = load(spark, rows, tmp_path).star
    ranks = rows_of(products.product_performance(star), "stock_code")
    assert [ranks[f"1000{i}"]["revenue_rank"] for i in range(4)] == [3, 1, 1, 4]
    assert products.top_per_country(star, 2).count() == 2
    assert products.country_rankings(star).count() == 4


def test_rfm(sales_tables):
    found = rows_of(customers.rfm(sales_tables.star), "customer_id")
    assert set(found) == {11, 12, 13}
    assert found[12]["frequency"] == 2 and found[12]["monetary"] == Decimal("6.00")
    assert found[11]["recency_days"] == 3
    assert found[11]["recency_score"] == 3 and found[11]["rfm_segment_heuristic"] == C.OCCASIONAL
    assert found[12]["rfm_segment_heuristic"] == C.AT_RISK


def test_customers(sales_tables):
    star = sales_tables.star
    assert tuple(customers.repeat_rate(star).first()) == (3, 2, Decimal("66.67"))
    assert tuple(customers.customer_coverage(star).first()) == (3, 3)
    stats = customers.spend_statistics(star).first()
    assert (stats["median_customer_spend"], stats["p90_customer_spend"]) == (18.0, 39.6)
    headline = customers.customer_headline(star).first()
    assert headline["median_customer_spend"] == 18.0
    assert headline["top_decile_revenue"] == Decimal("45.00")
    assert customers.spend_deciles(star).count() == 3
    histogram = rows_of(customers.frequency_histogram(star), "order_count")
    assert histogram[2]["customer_count"] == 2


def test_cohorts(sales_tables):
    plan = cohorts.cohort_retention(sales_tables.star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(customer_key") == 1
    cells = cohorts.cohort_retention(sales_tables.star)
    june, july = date(2013, 6, 1), date(2013, 7, 1)
    found = {(r["cohort_month"], r["month_index"]): r for r in rows_of(cells)}
    assert set(found) == {(june, 0), (june, 1), (july, 0)}
    assert found[june, 0]["cohort_size"] == found[june, 0]["returning_customers"] == 2
    assert found[june, 1]["returning_customers"] == 1 and found[june, 1]["retention_pct"] == Decimal("50.00")
    assert found[july, 0]["dataset_last_month"] == july
    matrix = rows_of(cohorts.cohort_matrix(cells), "cohort_month")
    assert (matrix[june]["M0"], matrix[june]["M1"]) == (Decimal("100.00"), Decimal("50.00"))
    assert (matrix[july]["M0"], matrix[july]["M1"]) == (Decimal("100.00"), None)
    assert cohorts.cohort_cells(cells).count() == 3
    assert cohorts.retention_curve(cells).count() == 1
    assert cohorts.retention_curve(cells, eligible_only=True).count() == 0


def test_duplicates(sales_tables):
    fact = sales_tables.star.fact
    assert quality.sales_deduplicated(fact).count() == 6
    versions = rows_of(quality.duplicate_sensitivity(fact), "dataset_version")
    assert versions[C.COMPLETE]["order_count"] == versions[C.DEDUPLICATED]["order_count"] == 5
    assert versions[C.COMPLETE]["average_order_value"] == Decimal("17.80")
    delta = quality.sensitivity_delta(quality.duplicate_sensitivity(fact)).first()
    assert delta["revenue_difference"] == Decimal("9.00") and delta["units_sold_difference"] == 6


def test_no_sales_at_all(spark, tmp_path):
    rows = [("C700001", "1", "x", -1, "2011-03-01", 10.0, 1, UK)]
    star = load(spark, rows, tmp_path).star
    versions = rows_of(quality.duplicate_sensitivity(star.fact), "dataset_version")
    assert versions[C.COMPLETE]["revenue"] == 0 and versions[C.COMPLETE]["average_order_value"] is None
    assert sales.headline(star.fact).first()["average_order_value"] is None
    assert customers.rfm(star).count() == 0


def test_measures(sales_tables):
    star = sales_tables.star
    by_country = rows_of(measures.sales(measures.wide(star, "country"), ["country_name"]), "country_name")
    assert by_country["Ireland"]["net_revenue"] == Decimal("63.00")
    assert by_country["Spain"]["average_order_value"] == pytest.approx(3.0)
    june = measures.wide(star, "date").filter("month = 6")
    assert measures.customers(june).first()["repeat_customers"] == 1
    assert measures.concentration(customers.customer_totals(star)).first()["top_revenue"] == Decimal("45.00")
    segments = customers.rfm(star).cache()
    total = measures.sales(measures.wide(star, "segment", segments=segments)).first()
    assert total["net_revenue"] == Decimal("69.00")
    with pytest.raises(C.ContractError):
        measures.with_segment(star.fact, segments.unionByName(segments))
    share = measures.duplicate_share(quality.duplicate_sensitivity(star.fact)).first()
    assert share["duplicate_revenue_sensitivity"] == pytest.approx(9 / 89)
    assert measures.quality(star.fact).first()["total_source_records"] == 8


def test_concentration_counts_ties(spark):
    spend = spark.createDataFrame([(i, 10) for i in range(20)], "customer_id bigint, monetary int")
    assert measures.concentration(spend).first()["top_revenue_share"] == 1.0


@pytest.fixture(scope="module")
def month_rows(spark):
    rows = [
        (date(2011, 1, 1), False, 1000, -100, 10),
        (date(2011, 2, 1), False, 2000, -200, 20),
        (date(2011, 3, 1), True, 500, -50, 5),
    ]
    schema = (
        "month_start date, is_partial_month boolean, gross_sales_revenue int, "
        "cancellation_value int, order_count int"
    )
    return spark.createDataFrame(rows, schema)


def test_month_metrics(month_rows):
    full = metrics.headline_kpis(month_rows).first()
    assert tuple(full)[:5] == (3500, -350, 3150, 35, 90.0)
    assert (full["months_included"], full["has_partial_month"]) == (3, True)
    two = metrics.headline_kpis(metrics.months_between(month_rows, "2011-01-01", "2011-02-28")).first()
    assert (two["net_revenue"], two["has_partial_month"]) == (2700, False)
    none = metrics.headline_kpis(month_rows.limit(0)).first()
    assert none["average_order_value"] is None and none["gross_sales_revenue"] == 0
    assert measures.partial_months(month_rows).first()["warning_text"] == measures.PARTIAL_TEXT


def test_selection_and_search(sales_tables):
    star = sales_tables.star
    trend = products.monthly_trend(star)
    june = rows_of(metrics.top_products(trend, "2013-06-01", "2013-06-30"), "stock_code")
    assert june["51020"]["revenue"] == Decimal("15.00")
    ranked = products.top_per_country(star, 20)
    assert metrics.only_values(ranked, "country_name", []).count() == ranked.count()
    assert metrics.only_values(ranked, "country_name", ["Spain"]).count() == 2
    table = products.product_performance(star).cache()
    assert metrics.search_products(table, "seed t").count() == 1
    assert metrics.search_products(table, "510").count() == 3
    shares = rows_of(metrics.contribution(table, 1), "label")
    assert shares["All other products"]["pct"] == Decimal("59.5506")
    assert metrics.contribution(table, 2).count() == 3
    assert metrics.product_series(trend, "SEED TRAY").count() == 2
    assert metrics.first_row(table).count() == 1
    versions = quality.duplicate_sensitivity(star.fact)
    assert metrics.version_difference(versions, "revenue").first()["difference"] == Decimal("9.00")


def test_reconciliation_passes_and_sees_corruption(sales_tables):
    from pyspark.sql import functions as F

    fact = sales_tables.star.fact
    assert all(r["passed"] for r in rules.reconcile(sales_tables.cleaned, fact).collect())
    wrong = fact.withColumn("line_revenue", F.col("line_revenue") + F.when(F.col("source_row_id") == 0, 1).otherwise(0))
    failed = {r["check_name"] for r in rules.reconcile(sales_tables.cleaned, wrong).collect() if not r["passed"]}
    assert failed == {"gross_sales_revenue", "net_revenue"}
    fewer = rules.reconcile(sales_tables.cleaned, fact.filter("source_row_id > 0"))
    assert "fact_row_count" in {r["check_name"] for r in fewer.filter("NOT passed").collect()}


def test_cohorts_over_many_years(spark, tmp_path):
    """More months than one word of a customer's activity holds."""
    days = ["2001-01-31", "2001-02-01", "2006-03-15", "2006-04-15", "2013-12-31"]
    rows = [(f"90{c}{i:03}", "1", "x", 1, d, 1.0, c, UK) for c in (1, 2, 3) for i, d in enumerate(days) if (c + i) % 3]
    cells = cohorts.cohort_retention(load(spark, rows, tmp_path).star)
    seen = {c: [date.fromisoformat(d).replace(day=1) for i, d in enumerate(days) if (c + i) % 3] for c in (1, 2, 3)}
    want = {}
    for months in seen.values():
        for m in months:
            key = (months[0], m, (m.year - months[0].year) * 12 + m.month - months[0].month)
            want[key] = want.get(key, 0) + 1
    found = {(r["cohort_month"], r["activity_month"], r["month_index"]): r["returning_customers"] for r in cells.collect()}
    assert found == want
