"""Warnings, fatal invariants and load reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.functions import status as S
from tallyline.functions.money import line_revenue
from tallyline.operators.ordering import distinct_ids
from tallyline.plans.profile import cleaning_figures, exact_value, profile_figures
from tallyline.sources.landing import null_counts

# Rule, severity and the figure it counts; the text is ours.
RAW_RULES = [
    ("missing_customer_id", "info", "missing_CustomerID", "rows without a customer"),
    ("missing_description", "info", "missing_Description", "rows without a description"),
    ("duplicate_rows", "warning", "duplicate_rows", "rows repeat an earlier row"),
    ("negative_quantity", "info", "quantity_negative_count", "rows take units back"),
    ("zero_quantity", "warning", "quantity_zero_count", "rows move no units"),
    ("non_positive_unit_price", "warning", "unit_price_non_positive_count", "rows have no price"),
    ("cancellations", "info", "cancellation_count", "rows belong to cancelled invoices"),
    ("potential_returns", "warning", "potential_return_count", "rows look like returns"),
    ("unexpected_columns", "warning", "unexpected_column_count", "columns are not in the contract"),
]
CLEANING_RULES = [
    ("non_standard_transactions", "warning", "non_standard_rows", "rows are left out of revenue"),
    ("potential_return_zero_value", "info", "potential_return_rows", "rows look like returns"),
    ("cancellation_exceptions", "warning", "cancellation_exceptions", "cancelled rows add units"),
    (
        "non_standard_invoice_format", "warning", "non_standard_invoice_format",
        "rows have an unusual invoice number",
    ),
    ("duplicate_candidates", "warning", "duplicate_candidate", "rows have an exact copy"),
    ("non_standard_stock_code", "info", "non_standard_stock_code", "rows carry a service code"),
]


def _warnings(figures: DataFrame, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    """One row per rule whose figure is above zero."""
    rows = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.col(figure).cast("bigint").alias("row_count"),
            F.lit(severity).alias("severity"),
            F.concat(F.format_number(F.col(figure), 0), F.lit(f" {text}")).alias("message"),
        )
        for rule, severity, figure, text in rules
    ]
    return figures.select(F.inline(F.array(*rows))).filter("row_count > 0")


def raw_warnings(raw: DataFrame) -> DataFrame:
    """DQ-1."""
    figures = profile_figures(raw).withColumn(
        "unit_price_non_positive_count",
        F.col("unit_price_negative_count") + F.col("unit_price_zero_count"),
    )
    return _warnings(figures, RAW_RULES)


def cleaning_warnings(cleaned: DataFrame) -> DataFrame:
    """DQ-3."""
    return _warnings(cleaning_figures(cleaned), CLEANING_RULES)


def cleaned_invariants(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """DQ-2: (invariant, violations) rows; all zero for a sound table.

    Contiguous ids are checked by smallest, largest and distinct count together.
    """
    known = F.coalesce(F.col("transaction_status").isin(C.STATUSES), F.lit(False))
    drift = F.abs(line_revenue(F.col("quantity"), F.col("unit_price")) - F.col("line_revenue"))
    figures = cleaned.agg(
        F.count("*").alias("rows"),
        F.min("source_row_id").alias("low"),
        F.max("source_row_id").alias("high"),
        F.count_if(F.col("transaction_status").isNotNull() & ~known).alias("unknown"),
        F.count_if(F.col("transaction_status").isNull()).alias("absent"),
        F.count_if(known).alias("classified"),
        F.count_if(F.coalesce(drift > F.lit("0.01").cast("decimal(4,2)"), F.lit(False))).alias("drift"),
    ).withColumns({"raw_rows": raw.agg(F.count("*")).scalar(), "ids": distinct_ids(cleaned, "source_row_id").scalar()})
    rows = F.col("rows")
    gaps = (
        F.when(rows == 0, 0)
        .when((F.col("low") == 0) & (F.col("high") == rows - 1) & (F.col("ids") == rows), 0)
        .otherwise(1)
    )
    checks: list[tuple[str, Column]] = [
        ("row_count_preserved", F.abs(rows - F.col("raw_rows"))),
        ("contiguous_source_row_id", gaps),
        ("known_status", F.col("unknown") + F.col("absent")),
        ("status_counts_add_up", rows - F.col("classified")),
        ("line_revenue_consistent", F.col("drift")),
    ]
    listed = [
        F.struct(F.lit(n).alias("invariant"), v.cast("bigint").alias("violations"))
        for n, v in checks
    ]
    return figures.select(F.inline(F.array(*listed)))


def validate_cleaned(raw: DataFrame, cleaned: DataFrame) -> None:
    """Raise with every broken invariant."""
    broken = cleaned_invariants(raw, cleaned).filter("violations > 0").collect()  # at most 5 rows
    if broken:
        raise C.ContractError("; ".join(f"{r['invariant']}: {r['violations']}" for r in broken))


def require_row_count(before: DataFrame, after: DataFrame) -> None:
    """CLN-13: cleaning must return exactly the rows it was given."""
    old, new = before.count(), after.count()
    if old != new:
        raise C.ContractError(f"cleaning changed the row count from {old} to {new}")


def check_staging(cleaned: DataFrame) -> None:
    """SRC-8, SRC-9: contract columns present and nothing null that may not be."""
    C.require_columns(cleaned, C.CLEANED_COLUMNS, "cleaned table")
    nulls = null_counts(cleaned, C.CLEANED_REQUIRED).first()
    broken = [f"{c}: {nulls[c]} null values" for c in C.CLEANED_REQUIRED if nulls[c]]
    if broken:
        raise C.ContractError("; ".join(broken))


def _checks(df: DataFrame, missing: Column, revenue, value: str) -> DataFrame:
    gross, cancel, back = (
        revenue(C.VALID_SALE), revenue(C.CANCELLATION), revenue(C.POTENTIAL_RETURN)
    )
    figures = df.agg(
        F.count("*").alias("fact_row_count"),
        # filled in below: beside a distinct count, every sum would be kept for each id
        F.lit(None).cast("bigint").alias("unique_source_row_ids"),
        *[S.rows_with(s).alias(f"status_count_{s}") for s in C.STATUSES],
        F.count_if(missing).alias("missing_customer_id_count"),
        F.count_if("flag_duplicate_candidate").alias("duplicate_candidate_count"),
        gross.alias("gross_sales_revenue"),
        cancel.alias("cancellation_value"),
        back.alias("potential_return_value"),
        (gross + cancel).alias("net_revenue"),
    ).withColumn("unique_source_row_ids", distinct_ids(df, "source_row_id").scalar())
    exact = figures.select(*[F.col(c).cast("decimal(24,2)").alias(c) for c in figures.columns])
    return exact.unpivot([], exact.columns, "check_name", value)


def _stored_value(status: str) -> Column:
    return F.coalesce(S.revenue_of(status), F.lit(0)).cast("decimal(24,2)")


def _line_value(status: str) -> Column:
    revenue = line_revenue(F.col("quantity"), F.col("unit_price"))
    total = F.sum(F.when(S.has_status(status), revenue))
    return F.coalesce(total, F.lit(0)).cast("decimal(24,2)")


def reconcile(cleaned: DataFrame, fact: DataFrame, per_line: bool = False) -> DataFrame:
    """DQ-4: twelve figures of the source against the loaded fact, one pass over each.

    The source is computed from quantity and price, the fact from its stored revenue, so a
    difference in either is seen. By default the source is rounded once at the end, which
    differs from the fact by pennies where prices have more than two decimals; ``per_line``
    rounds every line first, as the fact does, and must then agree exactly.
    """
    expected = _line_value if per_line else exact_value
    source = _checks(cleaned, F.col("flag_missing_customer_id"), expected, "expected")
    stored = _checks(fact, F.col("customer_key").isNull(), _stored_value, "actual")
    return source.join(stored, "check_name").select(
        "check_name", "expected", "actual", (F.col("expected") == F.col("actual")).alias("passed")
    )
