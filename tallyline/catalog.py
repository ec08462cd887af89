"""Every named query, as a function of the stored tables.

Keys start with the inventory id of the question they answer.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import contracts as C
from tallyline.functions import status as S
from tallyline.operators import cleaning
from tallyline.operators.merge import insert_absent
from tallyline.pipeline import Tables
from tallyline.plans import (
    cohorts, customers, extracts, measures, metrics, products, profile, quality, rules, sales,
)
from tallyline.plans import star as build
from tallyline.session import concurrently, scratch_path, shuffles_removed, stash
from tallyline.sources import files, landing
from tallyline.warehouse import Warehouse

Query = Callable[[Tables], DataFrame]

# Parameters of the interactive questions.
RANGE = ("1996-01-01", "1997-12-31")
FIRST_LOAD_END = "1998-01-01"
OVERLAP_START = "1997-01-01"
COUNTRIES = ["NATION_3", "NATION_7", "NATION_12"]
PATTERN = "BLUE|^000[12]"
PRODUCT = "blue widget"


def _years() -> tuple[int, int]:
    return int(RANGE[0][:4]), int(RANGE[1][:4])


def present(df: DataFrame) -> DataFrame:
    """Plain result types: whole numbers as BIGINT, exact decimals as DOUBLE."""
    shown = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint").alias(field.name)
        shown.append(column)
    return df.select(*shown)


# --- sources and sinks ------------------------------------------------------------------


def _manifest(t: Tables) -> DataFrame:
    """What the manifest says of the stored extract: all its rows are in a fingerprinted file."""
    files_ = landing.file_manifest(t.raw.sparkSession, f"{t.folder}/raw")
    return files_.agg(
        F.sum("rows").alias("row_count"),
        F.count_if(F.col("fingerprint").isNull()).alias("files_without_fingerprint"),
        (F.count("*") - F.count_distinct("file")).alias("repeated_files"),
    )


def _landing(t: Tables) -> DataFrame:
    """Land the extract, offer it again, offer a part of it, then force that part in: the action of
    each attempt and the rows landed after it."""
    spark = t.raw.sparkSession
    target, part = scratch_path(spark, "landing"), scratch_path(spark, "changed")
    t.raw.filter("Quantity > 0").write.parquet(part)
    rows = []
    for attempt, (source, force) in enumerate(
        [(f"{t.folder}/raw", False), (f"{t.folder}/raw", False), (part, False), (part, True)], 1
    ):
        try:
            action = landing.land(spark, source, target, force).action
        except C.ContractError:
            action = "refuse"
        rows.append((attempt, action, landing.landed(spark, target).count()))
    return spark.createDataFrame(rows, "attempt bigint, action string, landed_rows bigint")


def _header_check(t: Tables) -> DataFrame:
    C.require_columns(t.raw, C.RAW_COLUMNS, "raw extract")
    landing.validate_schema(t.raw)
    return profile.missing_values(t.raw).filter(F.col("column_name").isin(C.RAW_REQUIRED)).select(
        "column_name", "missing_count"
    )


def _stored_months(t: Tables) -> DataFrame:
    stored = t.raw.sparkSession.read.parquet(f"{t.folder}/cleaned")
    return stored.groupBy("year", "month").agg(
        F.count("*").alias("row_count"), F.sum("line_revenue").alias("line_revenue")
    )


def _staging(t: Tables) -> DataFrame:
    rules.check_staging(t.cleaned)
    counts = landing.null_counts(t.cleaned, C.CLEANED_COLUMNS)
    return counts.unpivot([], C.CLEANED_COLUMNS, "column_name", "null_count")


def _export(t: Tables, builders: dict[str, extracts.Builder]):
    folder = scratch_path(t.raw.sparkSession, "export")
    with shuffles_removed(t.raw.sparkSession):
        built = concurrently([partial(builder, t.star) for builder in builders.values()])
        tables = dict(zip(builders, built, strict=True))
        return folder, tables, files.export_all(tables, folder)


def _bi_export(t: Tables) -> DataFrame:
    _, _, done = _export(t, extracts.BI_MODEL)
    return files.export_manifest(t.raw.sparkSession, done).select("name", "row_count", "column_count")


def _verified_export(t: Tables) -> DataFrame:
    _, tables, done = _export(t, extracts.BI_MODEL)
    rows = [(r.name, files.verify_export(r, tables[r.name])) for r in done]
    return t.raw.sparkSession.createDataFrame(rows, "name string, verified boolean")


def _public_export(t: Tables) -> DataFrame:
    spark = t.raw.sparkSession
    _, _, done = _export(t, extracts.public(t.star))
    files.assert_no_customer_identifiers(spark, done)
    return files.export_manifest(spark, done).select("name", "row_count", "column_count")


def _read_back(t: Tables) -> DataFrame:
    folder, _, _ = _export(t, {"product_performance": extracts.product_performance})
    return files.read_extract(t.raw.sparkSession, "product_performance", folder)


def _read_all(t: Tables) -> DataFrame:
    spark = t.raw.sparkSession
    folder, _, _ = _export(t, extracts.public(t.star))
    counts = [
        table.agg(F.lit(name).alias("name"), F.count("*").alias("row_count"))
        for name, table in files.read_all_extracts(spark, folder).items()
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def _report(t: Tables) -> DataFrame:
    """Write the cleaning summary as JSON and read it back."""
    spark = t.raw.sparkSession
    path = scratch_path(spark, "report")
    files.save_report(profile.cleaning_summary(t.cleaned), path)
    return spark.read.schema("section string, metric string, value decimal(24,2)").json(path)


# --- cleaning -----------------------------------------------------------------------------


def _classified(t: Tables) -> DataFrame:
    return cleaning.classify(cleaning.normalise(t.raw))


def _status_counts(t: Tables) -> DataFrame:
    return _classified(t).groupBy("transaction_status").agg(
        F.count("*").alias("row_count"), F.sum("line_revenue").alias("line_revenue")
    )


def _flag_counts(t: Tables) -> DataFrame:
    """Row-local flags straight from the raw lines, without ids or a shuffle of lines."""
    flags = [f for f in C.FLAGS if f != "flag_duplicate_candidate"]
    return _classified(t).agg(*[F.count_if(f).alias(f) for f in flags])


def _duplicate_groups(t: Tables) -> DataFrame:
    return cleaning.line_groups(cleaning.normalise(t.raw)).filter("copies > 1")


def _row_counts(t: Tables) -> DataFrame:
    rules.require_row_count(t.raw, t.cleaned)
    return t.raw.agg(F.count("*").alias("raw_rows")).withColumn(
        "cleaned_rows", t.cleaned.agg(F.count("*")).scalar()
    )


# --- incremental loads ----------------------------------------------------------------------


def _before(t: Tables) -> DataFrame:
    return t.cleaned.filter(F.col("invoice_date") < F.lit(FIRST_LOAD_END).cast("timestamp_ntz"))


def _extended(maker, t: Tables) -> DataFrame:
    """A dimension loaded from the earlier lines, then reloaded with all of them."""
    return maker(t.cleaned, stash(maker(_before(t)), "first-load"))


def _merged_fact(t: Tables) -> DataFrame:
    """The earlier part of the fact with blank revenue, then an overlapping second load."""
    at = F.col("invoice_timestamp")
    last, first = int(FIRST_LOAD_END[:4]), int(OVERLAP_START[:4])
    old = t.star.during(0, last).fact
    old = old.filter(at < F.lit(FIRST_LOAD_END).cast("timestamp_ntz")).withColumn(
        "line_revenue", F.lit(0).cast("decimal(14,2)")
    )
    new = t.star.during(first, 9999).fact.filter(at >= F.lit(OVERLAP_START).cast("timestamp_ntz"))
    return (
        build.merge_fact(old, new)
        .groupBy(sales.year_of().alias("year"))
        .agg(F.count("*").alias("row_count"), F.sum("line_revenue").alias("line_revenue"))
    )


def _reloaded(t: Tables) -> DataFrame:
    """The whole load twice into a fresh warehouse; the second must change nothing."""
    warehouse = Warehouse(t.raw.sparkSession, scratch_path(t.raw.sparkSession, "reload"))
    warehouse.load(t.cleaned)
    warehouse.load(t.cleaned)
    return quality.status_distribution(warehouse.star().fact)


def _versions_log(t: Tables) -> DataFrame:
    """The published version of the stored warehouse and its fact rows."""
    warehouse = Warehouse(t.raw.sparkSession, f"{t.folder}/warehouse")
    version = warehouse.current_version()
    return warehouse.star().fact.agg(F.count("*").alias("fact_rows")).withColumn(
        "version", F.lit(version).cast("bigint")
    )


def _fact(t: Tables) -> DataFrame:
    s = t.star
    return build.build_fact(t.cleaned, s.countries, s.customers, s.products)


# --- measures -------------------------------------------------------------------------------


def _months(t: Tables) -> DataFrame:
    return sales.monthly_growth(t.star.fact)


def _versions(t: Tables) -> DataFrame:
    return quality.duplicate_sensitivity(t.star.fact)


def _retention(t: Tables) -> DataFrame:
    return cohorts.cohort_retention(t.star)


def _segment_sales(t: Tables) -> DataFrame:
    segments = stash(customers.rfm(t.star), "segments")
    return measures.sales(
        measures.wide(t.star, "segment", segments=segments), ["rfm_segment_heuristic"]
    )


def _filtered_sales(t: Tables) -> DataFrame:
    frame = measures.wide(t.star, "date", "country", years=(1997, 1997)).filter(
        F.col("country_name").isin(COUNTRIES)
    )
    return measures.sales(frame, ["country_name", "quarter"])


def _filtered_customers(t: Tables) -> DataFrame:
    frame = measures.wide(t.star, "date", "country", years=(1997, 9999))
    return measures.customers(frame, ["country_name"])


CATALOG: dict[str, Query] = {
    # 2.1 sources, landing, sinks
    "SRC1_manifest": _manifest,
    "SRC3_landing": _landing,
    "SRC4_raw_lines": lambda t: t.make_raw(),
    "SRC5_required_columns": _header_check,
    "SRC6_cleaned_by_month": _stored_months,
    "SRC8_staging_nulls": _staging,
    "SNK2_bi_export": _bi_export,
    "SNK3_verified_export": _verified_export,
    "SNK4_public_export": _public_export,
    "SNK7_read_extract": _read_back,
    "SNK8_read_all_extracts": _read_all,
    "SNK9_report_json": _report,
    # 2.2 cleaning
    "CLN2_normalised": lambda t: cleaning.normalise(t.raw),
    "CLN3_status_counts": _status_counts,
    "CLN4_flag_counts": _flag_counts,
    "CLN8_duplicate_groups": _duplicate_groups,
    "CLN13_row_counts": _row_counts,
    "CLN14_cleaned": lambda t: cleaning.clean(t.raw),
    "CLN15_exact_revenue": lambda t: profile.exact_revenue(t.cleaned),
    "CLN16_cleaning_summary": lambda t: profile.cleaning_summary(
        t.cleaned, t.raw.agg(F.count("*")).scalar()
    ),
    # 2.3 profiling and rules
    "PRF1_shape": lambda t: profile.shape(t.raw),
    "PRF2_missing_values": lambda t: profile.missing_values(t.raw),
    "PRF3_duplicate_rows": lambda t: profile.duplicate_rows(t.raw),
    "PRF4_distinct_counts": lambda t: profile.distinct_counts(t.raw),
    "PRF5_date_range": lambda t: profile.date_range(t.raw),
    "PRF6_quantity_range": lambda t: profile.quantity_range(t.raw),
    "PRF7_price_range": lambda t: profile.price_range(t.raw),
    "PRF8_reversal_counts": lambda t: profile.reversal_counts(t.raw),
    "PRF9_top_countries": lambda t: profile.top_countries(t.raw),
    "PRF10_identifier_coverage": lambda t: profile.identifier_coverage(t.raw),
    "DQ1_raw_warnings": lambda t: rules.raw_warnings(t.raw).drop("message"),
    "DQ2_invariants": lambda t: rules.cleaned_invariants(t.raw, t.cleaned),
    "DQ3_cleaning_warnings": lambda t: rules.cleaning_warnings(t.cleaned).drop("message"),
    "DQ4_reconciliation": lambda t: rules.reconcile(t.cleaned, t.star.fact),
    "DQ4_reconciliation_per_line": lambda t: rules.reconcile(t.cleaned, t.star.fact, per_line=True),
    # 2.4 star schema
    "DIM1_dates": lambda t: build.dim_date(t.cleaned),
    "DIM2_countries": lambda t: build.dim_country(t.cleaned),
    "DIM3_customers": lambda t: build.dim_customer(t.cleaned),
    "DIM4_products": lambda t: build.dim_product(t.cleaned),
    "DIM5_dates_extended": lambda t: insert_absent(
        build.dim_date(_before(t)), build.dim_date(t.cleaned), "date_key"
    ),
    "DIM5_customers_extended": lambda t: _extended(build.dim_customer, t),
    "DIM6_products_upserted": lambda t: _extended(build.dim_product, t),
    "FCT1_fact": _fact,
    "FCT2_merged_fact": _merged_fact,
    "FCT3_published_version": _versions_log,
    "FCT4_guards": lambda t: build.broken_references(t.star),
    "FCT5_reloaded": _reloaded,
    # 2.5 views
    "V1_valid_sales": lambda t: quality.with_status(t.star.fact, C.VALID_SALE),
    "V2_cancellations": lambda t: quality.with_status(t.star.fact, C.CANCELLATION),
    "V3_potential_returns": lambda t: quality.with_status(t.star.fact, C.POTENTIAL_RETURN),
    "V4_non_standard": lambda t: quality.with_status(t.star.fact, C.NON_STANDARD),
    "V5_customer_summary": lambda t: customers.customer_summary(t.star),
    "V6_product_summary": lambda t: products.product_summary(t.star),
    "V7_monthly_revenue": lambda t: sales.monthly_revenue(t.star.fact),
    "V8_quality_monitor": lambda t: quality.quality_monitor(t.star.fact),
    "V9_sales_deduplicated": lambda t: quality.sales_deduplicated(t.star.fact),
    "V10_monthly_growth": _months,
    "V11_revenue_by_country": lambda t: sales.revenue_by_country(t.star),
    "V12_product_performance": lambda t: products.product_performance(t.star),
    "V13_country_rankings": lambda t: products.country_rankings(t.star),
    "V14_monthly_trend": lambda t: products.monthly_trend(t.star),
    "V15_cancellation_activity": lambda t: products.cancellation_activity(t.star),
    "V16_rfm": lambda t: customers.rfm(t.star),
    "V17_cohort_retention": _retention,
    "V18_duplicate_sensitivity": _versions,
    "V19_sensitivity_delta": lambda t: quality.sensitivity_delta(_versions(t)),
    # 2.6 statements
    "A1_headline": lambda t: sales.headline(t.star.fact),
    "A2_growth_listing": lambda t: _months(t).orderBy("year", "month"),
    "A3_country_share": lambda t: sales.country_share(t.star),
    "A4_full_months": lambda t: sales.full_months(t.star.fact),
    "B1_top_by_revenue": lambda t: products.top_by_revenue(t.star),
    "B2_top_by_quantity": lambda t: products.top_by_quantity(t.star),
    "B3_largest_lines": lambda t: products.largest_lines(t.star),
    "B4_cumulative_contribution": lambda t: products.cumulative_contribution(t.star),
    "B5_top_per_country": lambda t: products.top_per_country(t.star, 3),
    "B6_trend_of_best": lambda t: products.trend_of_best(t.star),
    "B7_most_cancelled": lambda t: products.most_cancelled(t.star),
    "C1_customer_coverage": lambda t: customers.customer_coverage(t.star),
    "C2_repeat_rate": lambda t: customers.repeat_rate(t.star),
    "C3_frequency_histogram": lambda t: customers.frequency_histogram(t.star),
    "C4_spend_statistics": lambda t: customers.spend_statistics(t.star),
    "C5_spend_deciles": lambda t: customers.spend_deciles(t.star),
    "C6_longest_lifespans": lambda t: customers.longest_lifespans(t.star),
    "C7_highest_value": lambda t: customers.highest_value(t.star),
    "C8_segment_summary": lambda t: customers.segment_summary(customers.rfm(t.star)),
    "D1_status_distribution": lambda t: quality.status_distribution(t.star.fact),
    "D2_reversals": lambda t: quality.reversals(t.star.fact),
    "D3_non_standard_reasons": lambda t: quality.non_standard_reasons(t.star.fact),
    "D4_missing_customers": lambda t: quality.in_status_order(
        quality.flag_rate(t.star.fact, "flag_missing_customer_id")
    ),
    "D5_duplicate_candidates": lambda t: quality.in_status_order(
        quality.flag_rate(t.star.fact, "flag_duplicate_candidate")
    ),
    "D6a_duplicate_sensitivity": _versions,
    "D6b_sensitivity_delta": lambda t: quality.sensitivity_delta(_versions(t)),
    "D7_anomalous_invoices": lambda t: quality.anomalous_invoices(t.star.fact).orderBy(
        "source_row_id"
    ),
    "E1_retention_listing": lambda t: _retention(t).orderBy("cohort_month", "activity_month"),
    "E2_retention_curve": lambda t: cohorts.retention_curve(_retention(t)),
    "E3_cohort_sizes": lambda t: cohorts.cohort_sizes(_retention(t)),
    "R1a_monthly_net": lambda t: sales.monthly_revenue(t.star.fact)
    .select("year", "month", "net_revenue")
    .orderBy("year", "month"),
    "R1b_top_customers": lambda t: customers.top_summary(t.star),
    "R1c_quality_listing": lambda t: quality.in_status_order(quality.quality_monitor(t.star.fact)),
    # 2.7 extracts
    "X1_product_performance": lambda t: extracts.product_performance(t.star),
    "X2_product_monthly_trend": lambda t: extracts.PUBLIC["product_monthly_trend"](t.star),
    "X3_product_cancellations": lambda t: extracts.PUBLIC["product_cancellation_activity"](t.star),
    "X4_country_performance": lambda t: extracts.PUBLIC["country_performance"](t.star),
    "X5_monthly_revenue": lambda t: extracts.PUBLIC["monthly_revenue"](t.star),
    "X6_cohort_retention": lambda t: extracts.PUBLIC["cohort_retention"](t.star),
    "X7_duplicate_sensitivity": lambda t: extracts.PUBLIC["duplicate_sensitivity"](t.star),
    "X8_quality_summary": lambda t: extracts.PUBLIC["transaction_quality_summary"](t.star),
    "X9_top20_per_country": lambda t: products.top_per_country(t.star, 20),
    "X10_anomalous_transactions": lambda t: extracts.anomalous_transactions(t.star),
    "X11_segment_summary": lambda t: extracts.PUBLIC["customer_segment_summary"](t.star),
    "X12_spend_deciles": lambda t: customers.spend_deciles(t.star, "customer_count"),
    "X13_customer_headline": lambda t: customers.customer_headline(t.star),
    "X14_dataset_metadata": lambda t: extracts.dataset_metadata(t.star),
    "X15_dim_product": lambda t: extracts.PUBLIC["dim_product"](t.star),
    # 2.8 interactive figures
    "M2_months_between": lambda t: metrics.months_between(_months(t), *RANGE),
    "M3_headline_kpis": lambda t: metrics.headline_kpis(metrics.months_between(_months(t), *RANGE)),
    "M4_top_products": lambda t: metrics.top_products(products.monthly_trend(t.star.during(*_years())), *RANGE),
    "M5_metadata_row": lambda t: metrics.first_row(extracts.dataset_metadata(t.star)),
    "M6_only_values": lambda t: metrics.only_values(
        products.top_per_country(t.star, 20), "country_name", COUNTRIES
    ),
    "M7_search_products": lambda t: metrics.search_products(
        extracts.product_performance(t.star), PATTERN
    ),
    "M8_merchandise": lambda t: metrics.merchandise(extracts.product_performance(t.star)),
    "M9_contribution": lambda t: metrics.contribution(products.product_performance(t.star)),
    "M10_smallest_ranks": lambda t: metrics.smallest_ranks(
        sales.revenue_by_country(t.star), "revenue_rank", "country_key"
    ),
    "M11_cohort_matrix": lambda t: cohorts.cohort_cells(_retention(t)),
    "M12_status_share": lambda t: quality.status_distribution(t.star.fact),
    "M13_version_difference": lambda t: metrics.version_difference(_versions(t), "units_sold"),
    "M14_product_series": lambda t: metrics.product_series(products.trend_of(t.star, PRODUCT), PRODUCT),
    "M15_cancellation_rates": lambda t: measures.cancellation_rates(t.star.fact),
    # 2.9 measures
    "BI1_sales": lambda t: measures.sales(t.star.fact),
    "BI1_sales_filtered": _filtered_sales,
    "BI2_partial_months": lambda t: measures.partial_months(_months(t)),
    "BI3_customers": lambda t: measures.customers(t.star.fact),
    "BI3_customers_filtered": _filtered_customers,
    "BI4_customer_spend": lambda t: customers.spend_statistics(t.star).select(
        "mean_customer_spend", "median_customer_spend"
    ),
    "BI5_concentration": lambda t: measures.concentration(customers.customer_totals(t.star)),
    "BI6_product_revenue": lambda t: measures.product_revenue(t.star, t.star.fact),
    "BI6_product_revenue_filtered": lambda t: measures.product_revenue(
        t.star, measures.wide(t.star, "date", years=(1997, 1997))
    ),
    "BI7_non_merchandise": lambda t: t.star.products.select(
        "stock_code", products.non_merchandise_listed().alias("is_non_merchandise")
    ),
    "BI8_quality": lambda t: measures.quality(t.star.fact),
    "BI8_quality_by_country": lambda t: measures.quality(
        measures.wide(t.star, "country"), ["country_name"]
    ),
    "BI9_duplicate_share": lambda t: measures.duplicate_share(_versions(t)),
    "BI10_product_country_matrix": lambda t: measures.product_country_matrix(t.star),
    "BI11_segment_sales": _segment_sales,
}
