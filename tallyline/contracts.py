"""Fixed names and schemas that every stage agrees on."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: raw columns, in published order ------------------------------------
RAW_COLUMNS = [
    "InvoiceNo",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "UnitPrice",
    "CustomerID",
    "Country",
]

# --- fixed values: the same columns after cleaning ------------------------------------
LINE_COLUMNS = [
    "invoice_no",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "unit_price",
    "customer_id",
    "country",
]

# --- fixed values: row flags ----------------------------------------------------------
FLAGS = [
    "flag_missing_customer_id",
    "flag_missing_description",
    "flag_non_positive_price",
    "flag_zero_quantity",
    "flag_duplicate_candidate",
    "flag_non_standard_invoice_format",
    "flag_non_standard_stock_code",
]

# --- fixed values: transaction statuses, in warehouse declaration order ----------------
VALID_SALE = "valid_sale"
CANCELLATION = "cancellation"
POTENTIAL_RETURN = "potential_return"
NON_STANDARD = "non_standard"
STATUSES = [VALID_SALE, CANCELLATION, POTENTIAL_RETURN, NON_STANDARD]

# --- fixed values: segment labels ------------------------------------------------------
CHAMPIONS = "Champions"
LOYAL = "Loyal"
AT_RISK = "At risk"
OCCASIONAL = "New / occasional"
OTHER = "Other"

# --- fixed values: non-merchandise stock codes ------------------------------------------
NON_MERCHANDISE_CODES = [
    "POST", "DOT", "M", "D", "S", "C2", "BANK CHARGES", "AMAZONFEE", "CRUK", "PADS", "B",
]

# --- fixed values: names of the two duplicate-handling variants -------------------------
COMPLETE = "complete_dataset"
DEDUPLICATED = "deduplicated"

# --- fixed values: patterns ---------------------------------------------------------------
INVOICE_PATTERN = "^C?[0-9]{6}$"
PRODUCT_CODE_PATTERN = "^[0-9]"

# --- fixed values: columns of the cleaned table, of the fact and of the extracts, in published order
CLEANED_COLUMNS = ["source_row_id", *LINE_COLUMNS, "transaction_status", "line_revenue", *FLAGS]

RAW_SCHEMA = T.StructType(
    [
        T.StructField("InvoiceNo", T.StringType(), False),
        T.StructField("StockCode", T.StringType(), False),
        T.StructField("Description", T.StringType(), True),
        T.StructField("Quantity", T.IntegerType(), False),
        T.StructField("InvoiceDate", T.TimestampNTZType(), False),
        T.StructField("UnitPrice", T.DoubleType(), False),
        T.StructField("CustomerID", T.DoubleType(), True),
        T.StructField("Country", T.StringType(), False),
    ]
)

# Types a raw column may arrive in. Parquet extracts may already carry exact types.
RAW_TYPES: dict[str, tuple[type[T.DataType], ...]] = {
    "InvoiceNo": (T.StringType,),
    "StockCode": (T.StringType,),
    "Description": (T.StringType,),
    "Quantity": (T.IntegerType, T.LongType, T.ShortType),
    "InvoiceDate": (T.TimestampNTZType, T.TimestampType),
    "UnitPrice": (T.DoubleType, T.DecimalType),
    "CustomerID": (T.DoubleType, T.LongType, T.IntegerType),
    "Country": (T.StringType,),
}
RAW_REQUIRED = [f.name for f in RAW_SCHEMA.fields if not f.nullable]

CLEANED_SCHEMA = T.StructType(
    [
        T.StructField("source_row_id", T.LongType(), False),
        T.StructField("invoice_no", T.StringType(), False),
        T.StructField("stock_code", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("quantity", T.IntegerType(), False),
        T.StructField("invoice_date", T.TimestampNTZType(), False),
        T.StructField("unit_price", T.DecimalType(12, 4), False),
        T.StructField("customer_id", T.LongType(), True),
        T.StructField("country", T.StringType(), False),
        T.StructField("transaction_status", T.StringType(), False),
        T.StructField("line_revenue", T.DecimalType(14, 2), False),
        *[T.StructField(name, T.BooleanType(), False) for name in FLAGS],
    ]
)
CLEANED_REQUIRED = [f.name for f in CLEANED_SCHEMA.fields if not f.nullable]

# fixed values
FACT_COLUMNS = [
    "source_row_id",
    "invoice_no",
    "product_key",
    "customer_key",
    "country_key",
    "date_key",
    "invoice_timestamp",
    "quantity",
    "unit_price",
    "line_revenue",
    "transaction_status",
    *FLAGS,
]
FACT_REQUIRED = [c for c in FACT_COLUMNS if c != "customer_key"]

_text, _long, _int, _bool, _date = (
    T.StringType(),
    T.LongType(),
    T.IntegerType(),
    T.BooleanType(),
    T.DateType(),
)
_money, _pct, _price = T.DecimalType(24, 2), T.DecimalType(12, 4), T.DecimalType(12, 4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in columns.items()])


# The fact as stored, with the columns of its month folders.
FACT_BY_MONTH = _schema(
    source_row_id=_long, invoice_no=_text, product_key=_long, customer_key=_long, country_key=_long,
    date_key=_int, invoice_timestamp=T.TimestampNTZType(), quantity=_int, unit_price=_price,
    line_revenue=T.DecimalType(14, 2), transaction_status=_text, **dict.fromkeys(FLAGS, _bool),
    year=_int, month=_int,
)

# One contract per published extract; readers apply it instead of inferring types.
# fixed values
EXTRACT_SCHEMAS: dict[str, T.StructType] = {
    "product_performance": _schema(
        product_key=_long, stock_code=_text, description=_text, units_sold=_long,
        revenue=_money, order_count=_long, revenue_rank=_long, quantity_rank=_long,
        pct_of_total_revenue=_pct, is_non_merchandise=_bool,
    ),
    "product_monthly_trend": _schema(
        stock_code=_text, description=_text, year=_int, month=_int, units_sold=_long,
        revenue=_money,
    ),
    "product_cancellation_activity": _schema(
        stock_code=_text, description=_text, cancellation_count=_long,
        cancellation_value=_money, valid_sale_count=_long, cancellation_rate_pct=_pct,
    ),
    "product_country_performance": _schema(
        country_name=_text, stock_code=_text, description=_text, revenue=_money,
        rank_within_country=_long,
    ),
    "country_performance": _schema(
        country_key=_long, country_name=_text, order_count=_long, gross_sales_revenue=_money,
        cancellation_value=_money, net_revenue=_money, revenue_rank=_long,
    ),
    "monthly_revenue": _schema(
        year=_int, month=_int, month_start=_date, is_partial_month=_bool,
        gross_sales_revenue=_money, cancellation_value=_money, net_revenue=_money,
        order_count=_long, average_order_value=_money, previous_month_net_revenue=_money,
        month_over_month_growth_pct=_money, cumulative_net_revenue=_money,
    ),
    "cohort_retention": _schema(
        cohort_month=_date, activity_month=_date, month_index=_int, cohort_size=_long,
        returning_customers=_long, retention_pct=_pct, dataset_last_month=_date,
    ),
    "duplicate_sensitivity": _schema(
        dataset_version=_text, revenue=_money, order_count=_long, units_sold=_long,
        average_order_value=_money,
    ),
    "transaction_quality_summary": _schema(
        transaction_status=_text, row_count=_long, missing_customer_id_count=_long,
        missing_description_count=_long, non_positive_price_count=_long,
        zero_quantity_count=_long, duplicate_candidate_count=_long,
        non_standard_invoice_format_count=_long, non_standard_stock_code_count=_long,
    ),
    "anomalous_transactions": _schema(
        invoice_no=_text, quantity=_int, unit_price=_price, line_revenue=_money,
        transaction_status=_text,
    ),
    "customer_segment_summary": _schema(
        rfm_segment_heuristic=_text, customer_count=_long, avg_recency_days=_pct,
        avg_frequency=_pct, avg_monetary=_money,
    ),
    "customer_spend_deciles": _schema(
        decile=_int, customer_count=_long, decile_revenue=_money, pct_of_total_revenue=_pct,
    ),
    "customer_headline_metrics": _schema(
        identified_customers=_long, customers_with_qualifying_purchase=_long,
        customers_with_orders=_long, repeat_customers=_long, repeat_customer_rate_pct=_pct,
        mean_customer_spend=_money, median_customer_spend=T.DoubleType(),
        top_decile_revenue=_money, top_decile_revenue_pct=_pct,
    ),
    "dataset_metadata": _schema(
        total_source_records=_long, date_range_start=_date, date_range_end=_date,
        valid_sale_count=_long, cancellation_count=_long, potential_return_count=_long,
        non_standard_count=_long, missing_customer_id_count=_long,
        duplicate_candidate_count=_long, anomalous_invoice_format_count=_long,
    ),
    "dim_product": _schema(product_key=_long, stock_code=_text, description=_text),
}

# Columns that may never appear in a published extract.
# fixed values
CUSTOMER_IDENTIFIERS = ["customer_id", "customer_key"]


class ContractError(Exception):
    """A table does not have the shape or content its contract promises."""


@dataclass(frozen=True)
class Star:
    """The loaded model: one fact and its four dimensions."""

    fact: DataFrame
    dates: DataFrame
    countries: DataFrame
    customers: DataFrame
    products: DataFrame
    #: The fact with its storage columns ``year`` and ``month``, where it is stored by them.
    by_month: DataFrame | None = None

    def during(self, first: int, last: int) -> Star:
        """The model with the fact of these years only. Whole partitions are left out of the scan
        where the fact is stored by month."""
        if self.by_month is None:
            year = F.year("invoice_timestamp")
            return replace(self, fact=self.fact.filter(year.between(first, last)))
        part = self.by_month.filter(F.col("year").between(first, last))
        return replace(self, fact=part.select(*FACT_COLUMNS), by_month=part)

    def tables(self) -> dict[str, DataFrame]:
        return {
            "fact_sales": self.fact,
            "dim_date": self.dates,
            "dim_country": self.countries,
            "dim_customer": self.customers,
            "dim_product": self.products,
        }


def missing_columns(df: DataFrame, wanted: list[str]) -> list[str]:
    return [c for c in wanted if c not in df.columns]


def require_columns(df: DataFrame, wanted: list[str], what: str) -> None:
    absent = missing_columns(df, wanted)
    if absent:
        raise ContractError(f"{what} lacks {absent}; it has {df.columns}")
