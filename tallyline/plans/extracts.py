"""Published extracts: aggregates without customer identifiers, and the BI model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.contracts import Star
from tallyline.functions import status as S
from tallyline.plans import cohorts, customers, products, quality, sales
from tallyline.session import once

Builder = Callable[[Star], DataFrame]


def product_performance(star: Star) -> DataFrame:
    """X-1."""
    return products.product_performance(star).withColumn(
        "is_non_merchandise", products.non_merchandise()
    )


def anomalous_transactions(star: Star) -> DataFrame:
    """X-10: no row identifier, no customer."""
    return quality.anomalous_invoices(star.fact).drop("source_row_id")


def dataset_metadata(star: Star) -> DataFrame:
    """X-14: ten scalars of the whole fact in one pass."""
    return star.fact.agg(
        F.count("*").alias("total_source_records"),
        F.min("invoice_timestamp").cast("date").alias("date_range_start"),
        F.max("invoice_timestamp").cast("date").alias("date_range_end"),
        *[S.rows_with(s).alias(f"{s}_count") for s in C.STATUSES],
        F.count_if("flag_missing_customer_id").alias("missing_customer_id_count"),
        F.count_if("flag_duplicate_candidate").alias("duplicate_candidate_count"),
        F.count_if("flag_non_standard_invoice_format").alias("anomalous_invoice_format_count"),
    ).select(*C.EXTRACT_SCHEMAS["dataset_metadata"].fieldNames())


PUBLIC: dict[str, Builder] = {
    "product_performance": product_performance,
    "product_monthly_trend": products.monthly_trend,
    "product_cancellation_activity": products.cancellation_activity,
    "country_performance": sales.revenue_by_country,
    "monthly_revenue": lambda star: sales.monthly_growth(star.fact),
    "cohort_retention": cohorts.cohort_retention,
    "duplicate_sensitivity": lambda star: quality.duplicate_sensitivity(star.fact),
    "transaction_quality_summary": lambda star: quality.quality_monitor(star.fact),
    "product_country_performance": lambda star: products.top_per_country(star, 20),
    "anomalous_transactions": anomalous_transactions,
    "customer_segment_summary": lambda star: customers.segment_summary(customers.rfm(star)),
    "customer_spend_deciles": lambda star: customers.spend_deciles(star, "customer_count"),
    "customer_headline_metrics": customers.customer_headline,
    "dataset_metadata": dataset_metadata,
    "dim_product": lambda star: star.products.select("product_key", "stock_code", "description"),
}

def public(star: Star) -> dict[str, Builder]:
    """The builders of :data:`PUBLIC` for one export of all: the three customer extracts read the same totals,
    which the first of them to run stores."""
    totals = once(lambda: customers.stored_totals(star))
    return PUBLIC | {
        "customer_segment_summary": lambda star: customers.segment_summary(customers.rfm(star, totals())),
        "customer_spend_deciles": lambda star: customers.spend_deciles(star, "customer_count", totals()),
        "customer_headline_metrics": lambda star: customers.customer_headline(star, totals()),
    }


BI_MODEL: dict[str, Builder] = {
    "fact_sales": lambda star: star.fact,
    "dim_date": lambda star: star.dates,
    "dim_product": lambda star: star.products,
    "dim_customer": lambda star: star.customers,
    "dim_country": lambda star: star.countries,
    "v_customer_rfm": customers.rfm,
    "v_customer_cohort_retention": cohorts.cohort_retention,
    "v_monthly_revenue_growth": lambda star: sales.monthly_growth(star.fact),
    "v_duplicate_sensitivity": lambda star: quality.duplicate_sensitivity(star.fact),
}
