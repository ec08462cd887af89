"""Expected result of every query, as one DuckDB statement each."""

from __future__ import annotations

from oracle.base import statement

STATUSES = ["valid_sale", "cancellation", "potential_return", "non_standard"]
ROW_FLAGS = [
    "flag_missing_customer_id", "flag_missing_description", "flag_non_positive_price",
    "flag_zero_quantity", "flag_non_standard_invoice_format", "flag_non_standard_stock_code",
]
RAW = ["InvoiceNo", "StockCode", "Description", "Quantity", "InvoiceDate", "UnitPrice", "CustomerID", "Country"]
CLEANED = [
    "source_row_id", "invoice_no", "stock_code", "description", "quantity", "invoice_date",
    "unit_price", "customer_id", "country", "transaction_status", "line_revenue",
    "flag_missing_customer_id", "flag_missing_description", "flag_non_positive_price",
    "flag_zero_quantity", "flag_duplicate_candidate", "flag_non_standard_invoice_format",
    "flag_non_standard_stock_code",
]
LINES = (
    "invoice_no:s stock_code:s description:s quantity:i invoice_date:t unit_price:d "
    "customer_id:i country:s"
)
FLAGS = (
    "flag_missing_customer_id:b flag_missing_description:b flag_non_positive_price:b "
    "flag_zero_quantity:b flag_duplicate_candidate:b flag_non_standard_invoice_format:b "
    "flag_non_standard_stock_code:b"
)
FACT = (
    "source_row_id:i invoice_no:s product_key:i customer_key:i country_key:i date_key:i "
    "invoice_timestamp:t quantity:i unit_price:d line_revenue:d transaction_status:s " + FLAGS
)
GROWTH = (
    "year:i month:i month_start:D is_partial_month:b gross_sales_revenue:d cancellation_value:d "
    "net_revenue:d order_count:i average_order_value:d previous_month_net_revenue:d "
    "month_over_month_growth_pct:d cumulative_net_revenue:d"
)
COUNTRY = (
    "country_key:i country_name:s order_count:i gross_sales_revenue:d cancellation_value:d "
    "net_revenue:d revenue_rank:i"
)
PRODUCT = (
    "product_key:i stock_code:s description:s units_sold:i revenue:d order_count:i "
    "revenue_rank:i quantity_rank:i pct_of_total_revenue:d"
)
TREND = "stock_code:s description:s year:i month:i units_sold:i revenue:d"
IN_COUNTRY = "country_name:s stock_code:s description:s revenue:d rank_within_country:i"
CANCELS = (
    "stock_code:s description:s cancellation_count:i cancellation_value:d valid_sale_count:i "
    "cancellation_rate_pct:d"
)
COHORT = (
    "cohort_month:D activity_month:D month_index:i cohort_size:i returning_customers:i "
    "retention_pct:d dataset_last_month:D"
)
VERSIONS = "dataset_version:s revenue:d order_count:i units_sold:i average_order_value:d"
DELTA = (
    "revenue_difference:d order_count_difference:i units_sold_difference:i "
    "average_order_value_difference:d"
)
MONITOR = (
    "transaction_status:s row_count:i missing_customer_id_count:i missing_description_count:i "
    "non_positive_price_count:i zero_quantity_count:i duplicate_candidate_count:i "
    "non_standard_invoice_format_count:i non_standard_stock_code_count:i"
)
MONITOR_SQL = """
    SELECT transaction_status, count(*) AS row_count,
           count_if(flag_missing_customer_id) AS missing_customer_id_count,
           count_if(flag_missing_description) AS missing_description_count,
           count_if(flag_non_positive_price) AS non_positive_price_count,
           count_if(flag_zero_quantity) AS zero_quantity_count,
           count_if(flag_duplicate_candidate) AS duplicate_candidate_count,
           count_if(flag_non_standard_invoice_format) AS non_standard_invoice_format_count,
           count_if(flag_non_standard_stock_code) AS non_standard_stock_code_count
    FROM fact GROUP BY ALL"""
SALES = (
    "gross_sales_revenue:d cancellation_value:d net_revenue:d total_orders:i units_sold:i "
    "average_order_value:d"
)
SALES_SQL = """
    sum(gain) AS gross_sales_revenue, sum(loss) AS cancellation_value,
    coalesce(sum(gain), 0) + coalesce(sum(loss), 0) AS net_revenue,
    count(DISTINCT order_no) AS total_orders, sum(quantity) FILTER (sold) AS units_sold,
    CASE WHEN count(DISTINCT order_no) > 0 THEN
        CAST(coalesce(sum(gain), 0) + coalesce(sum(loss), 0) AS DOUBLE) / count(DISTINCT order_no) END
        AS average_order_value"""
REPEAT_SQL = """
    SELECT {keys} count(*) AS active_customers, count_if(n > 1) AS repeat_customers,
           CAST(count_if(n > 1) AS DOUBLE) / count(*) AS repeat_customer_rate
    FROM (SELECT {keys} customer_key, count(DISTINCT invoice_no) AS n FROM {source}
          WHERE sold AND customer_key IS NOT NULL {where} GROUP BY ALL) GROUP BY ALL"""
QUALITY = (
    "total_source_records:i valid_sales_count:i cancellations_count:i potential_returns_count:i "
    "non_standard_count:i anomalous_invoice_format_count:i missing_customer_id_rate:d "
    "duplicate_candidate_count:i"
)
QUALITY_SQL = """
    count(*) AS total_source_records, count_if(sold) AS valid_sales_count,
    count_if(voided) AS cancellations_count,
    count_if(transaction_status = 'potential_return') AS potential_returns_count,
    count_if(transaction_status = 'non_standard') AS non_standard_count,
    count_if(flag_non_standard_invoice_format) AS anomalous_invoice_format_count,
    CAST(count_if(flag_missing_customer_id) AS DOUBLE) / count(*) AS missing_customer_id_rate,
    count_if(flag_duplicate_candidate) AS duplicate_candidate_count"""


def _pct(part: str, whole: str, digits: int = 2) -> str:
    return f"round(CAST(100.0 * CAST({part} AS DOUBLE) / {whole} AS DECIMAL(38,10)), {digits})"


def _mean(total: str, count: str, digits: int) -> str:
    return f"round(CAST(CAST({total} AS DOUBLE) / {count} AS DECIMAL(38,10)), {digits})"


def _stack(source: str, rows: list[tuple[str, ...]], names: list[str]) -> str:
    """One output row per tuple of expressions over a one-row source."""
    listed = ", ".join(
        "{" + ", ".join(f"'{n}': {e}" for n, e in zip(names, row, strict=True)) + "}" for row in rows
    )
    return f"SELECT unnest([{listed}], recursive := true) FROM ({source})"


def _percentile(tenths: int) -> str:
    """Interpolated percentile of spend from the two neighbouring positions, exactly."""
    spot = f"({tenths} * (n - 1))"
    low = f"max(monetary) FILTER (p = {spot} // 10)"
    high = f"max(monetary) FILTER (p = ({spot} + 9) // 10)"
    return f"{low} + ({high} - {low}) * CAST(any_value({spot} % 10) AS DECIMAL(10,1)) * 0.1"


SPEND_ORDERED = (
    "SELECT *, row_number() OVER (ORDER BY monetary, customer_id) - 1 AS p, count(*) OVER () AS n FROM spend"
)
SEGMENTS_SQL = f"""
    SELECT segment AS rfm_segment_heuristic, count(*) AS customer_count,
           {_mean('sum(recency_days)', 'count(*)', 1)} AS avg_recency_days,
           {_mean('sum(frequency)', 'count(*)', 1)} AS avg_frequency,
           {_mean('sum(monetary)', 'count(*)', 2)} AS avg_monetary
    FROM rfm GROUP BY segment"""
SEGMENTS = "rfm_segment_heuristic:s customer_count:i avg_recency_days:d avg_frequency:d avg_monetary:d"


def _deciles(name: str) -> str:
    return f"""
    SELECT decile, count(*) AS {name}, sum(monetary) AS decile_revenue,
           {_pct('sum(monetary)', '(SELECT CAST(sum(monetary) AS DOUBLE) FROM spend)')} AS pct_of_total_revenue
    FROM deciles GROUP BY decile"""


def _status_rate(flag: str) -> str:
    return f"""
    SELECT transaction_status, count(*) AS row_count, count_if(flag_{flag}) AS {flag}_count,
           {_pct(f'count_if(flag_{flag})', 'count(*)')} AS {flag}_pct
    FROM fact GROUP BY transaction_status"""


STATUS_SHARE = f"""
    SELECT transaction_status, count(*) AS row_count,
           {_pct('count(*)', '(SELECT count(*) FROM fact)')} AS pct_of_rows,
           sum(line_revenue) AS total_line_revenue
    FROM fact GROUP BY transaction_status"""
STATUS_SHARE_COLUMNS = "transaction_status:s row_count:i pct_of_rows:d total_line_revenue:d"

RAW_COUNTS = """
    SELECT count(*) AS n, count(*) - count(CustomerID) AS no_customer,
           count(*) - count(Description) AS no_text,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM raw)) AS extra,
           count_if(Quantity < 0) AS negative, count_if(Quantity = 0) AS zero,
           count_if(UnitPrice <= 0) AS free, count_if(InvoiceNo LIKE 'C%') AS voided,
           count_if(Quantity < 0 AND InvoiceNo NOT LIKE 'C%') AS back
    FROM raw"""
RAW_RULES = [
    ("'missing_customer_id'", "no_customer", "'info'"),
    ("'missing_description'", "no_text", "'info'"),
    ("'duplicate_rows'", "extra", "'warning'"),
    ("'negative_quantity'", "negative", "'info'"),
    ("'zero_quantity'", "zero", "'warning'"),
    ("'non_positive_unit_price'", "free", "'warning'"),
    ("'cancellations'", "voided", "'info'"),
    ("'potential_returns'", "back", "'warning'"),
]
CLEAN_COUNTS = """
    SELECT count(*) AS n, count_if(transaction_status = 'valid_sale') AS valid_sale,
           count_if(transaction_status = 'cancellation') AS cancellation,
           count_if(transaction_status = 'potential_return') AS potential_return,
           count_if(transaction_status = 'non_standard') AS non_standard,
           count_if(transaction_status = 'cancellation' AND quantity >= 0) AS odd_cancel,
           count_if(flag_missing_customer_id) AS no_customer,
           count_if(flag_missing_description) AS no_text,
           count_if(flag_non_positive_price) AS free, count_if(flag_zero_quantity) AS zero,
           count_if(flag_duplicate_candidate) AS copies,
           count_if(flag_non_standard_invoice_format) AS odd_invoice,
           count_if(flag_non_standard_stock_code) AS odd_code,
           max(source_row_id) - min(source_row_id) + 1 - count(DISTINCT source_row_id) AS gaps,
           count_if(abs(round(CAST(quantity AS DECIMAL(10,0)) * unit_price, 2) - line_revenue) > 0.01) AS drift
    FROM cleaned"""
COPY_GROUPS = """
    SELECT count(*) AS groups, max(c) AS largest
    FROM (SELECT *, count(*) AS c FROM lines GROUP BY ALL HAVING count(*) > 1)"""
CLEAN_RULES = [
    ("'non_standard_transactions'", "non_standard", "'warning'"),
    ("'potential_return_zero_value'", "potential_return", "'info'"),
    ("'cancellation_exceptions'", "odd_cancel", "'warning'"),
    ("'non_standard_invoice_format'", "odd_invoice", "'warning'"),
    ("'duplicate_candidates'", "copies", "'warning'"),
    ("'non_standard_stock_code'", "odd_code", "'info'"),
]
RULE_COLUMNS = "rule:s row_count:i severity:s"


def _rules(source: str, rules: list[tuple[str, str, str]]) -> str:
    rows = [(r, f"CAST({n} AS BIGINT)", s) for r, n, s in rules]
    return f"SELECT * FROM ({_stack(source, rows, ['rule', 'row_count', 'severity'])}) WHERE row_count > 0"


def _summary() -> str:
    rows = [("'rows'", "'raw'", "n"), ("'rows'", "'cleaned'", "n")]
    rows += [("'status_count'", f"'{s}'", s) for s in STATUSES]
    rows += [("'status_pct'", f"'{s}'", _pct(s, "n")) for s in STATUSES]
    rows += [
        ("'exceptions'", "'cancellation_exceptions'", "odd_cancel"),
        ("'exceptions'", "'invoice_format_exceptions'", "odd_invoice"),
        ("'flags'", "'missing_customer_id'", "no_customer"),
        ("'flags'", "'missing_description'", "no_text"),
        ("'flags'", "'non_positive_price'", "free"),
        ("'flags'", "'zero_quantity'", "zero"),
        ("'flags'", "'duplicate_candidate'", "copies"),
        ("'flags'", "'non_standard_stock_code'", "odd_code"),
        ("'duplicates'", "'candidate_row_count'", "copies"),
        ("'duplicates'", "'distinct_group_count'", "groups"),
        ("'duplicates'", "'largest_group_size'", "largest"),
        ("'revenue'", "'gross_sales_revenue'", "gross"),
        ("'revenue'", "'cancellation_value'", "cancel"),
        ("'revenue'", "'potential_return_value'", "back"),
        ("'revenue'", "'non_standard_value'", "odd"),
        ("'revenue'", "'net_revenue'", "gross + cancel"),
    ]
    typed = [(s, m, f"CAST({v} AS DECIMAL(24,2))") for s, m, v in rows]
    source = f"SELECT * FROM ({CLEAN_COUNTS}) POSITIONAL JOIN ({COPY_GROUPS}) POSITIONAL JOIN exact"
    return _stack(source, typed, ["section", "metric", "value"])


SUMMARY = ("section:s metric:s value:d", "cleaned lines exact", _summary())

RECONCILED = [
    ("fact_row_count", "n"), ("unique_source_row_ids", "n"),
    *[(f"status_count_{s}", s) for s in STATUSES],
    ("missing_customer_id_count", "no_customer"), ("duplicate_candidate_count", "copies"),
    ("gross_sales_revenue", "gross"), ("cancellation_value", "cancel"),
    ("potential_return_value", "back"), ("net_revenue", "gross + cancel"),
]


LINE_TOTALS = """SELECT
        sum(line_revenue) FILTER (transaction_status = 'valid_sale') AS gross,
        sum(line_revenue) FILTER (transaction_status = 'cancellation') AS cancel,
        sum(line_revenue) FILTER (transaction_status = 'potential_return') AS back FROM cleaned"""


def _reconciliation(totals: str = "FROM exact") -> str:
    loaded = """
        SELECT count(*) AS n, count_if(sold) AS valid_sale, count_if(voided) AS cancellation,
               count_if(transaction_status = 'potential_return') AS potential_return,
               count_if(transaction_status = 'non_standard') AS non_standard,
               count(*) - count(customer_key) AS no_customer,
               count_if(flag_duplicate_candidate) AS copies, sum(gain) AS gross, sum(loss) AS cancel,
               sum(line_revenue) FILTER (transaction_status = 'potential_return') AS back FROM money"""
    source = f"SELECT * FROM ({CLEAN_COUNTS}) POSITIONAL JOIN ({totals})"
    cells = [(f"'{name}'", f"CAST({v} AS DECIMAL(24,2))") for name, v in RECONCILED]
    left = _stack(source, cells, ["check_name", "expected"])
    right = _stack(loaded, cells, ["check_name", "actual"])
    return f"""SELECT check_name, expected, actual, expected = actual AS passed
               FROM ({left}) JOIN ({right}) USING (check_name)"""


def _nulls(table: str, columns: list[str], value: str) -> str:
    counts = ", ".join(f"count(*) - count({c}) AS {c}" for c in columns)
    rows = [(f"'{c}'", c) for c in columns]
    return _stack(f"SELECT {counts} FROM {table}", rows, ["column_name", value])


_EXTRACTS = [
    ("product_performance", "products", 10), ("product_monthly_trend", "trend", 6),
    ("product_cancellation_activity", "cancels", 6), ("country_performance", "countries", 7),
    ("monthly_revenue", "growth", 12), ("cohort_retention", "cohorts", 7),
    ("duplicate_sensitivity", "versions", 5),
    ("transaction_quality_summary", "(SELECT DISTINCT transaction_status FROM fact)", 9),
    ("product_country_performance", "(FROM product_countries WHERE rank_within_country <= 20)", 5),
    ("anomalous_transactions", "(FROM fact WHERE flag_non_standard_invoice_format)", 5),
    ("customer_segment_summary", "(SELECT DISTINCT segment FROM rfm)", 5),
    ("customer_spend_deciles", "(SELECT DISTINCT decile FROM deciles)", 4),
    ("customer_headline_metrics", "(SELECT 1)", 9), ("dataset_metadata", "(SELECT 1)", 10),
    ("dim_product", "dim_product", 3),
]
_EXTRACT_READS = (
    "products trend cancels countries growth cohorts versions product_countries rfm deciles fact dim_product"
)
_MODEL = [
    ("fact_sales", "fact", 18), ("dim_date", "dim_date", 10), ("dim_product", "dim_product", 4),
    ("dim_customer", "dim_customer", 2), ("dim_country", "dim_country", 2),
    ("v_customer_rfm", "rfm", 12), ("v_customer_cohort_retention", "cohorts", 7),
    ("v_monthly_revenue_growth", "growth", 12), ("v_duplicate_sensitivity", "versions", 5),
]
_MODEL_READS = "fact dim_date dim_product dim_customer dim_country rfm cohorts growth versions"


def _sizes(listed: list[tuple[str, str, int]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS name, count(*) AS row_count, {width} AS column_count FROM {source}"
        for name, source, width in listed
    )


def _keyed_later(key: str, member: str, extra: str = "", source: str = "") -> str:
    """Keys of members seen before 1998 first, then those of the newcomers."""
    return f"""
    SELECT row_number() OVER (ORDER BY NOT early, {member}) AS {key}, {member} {extra}
    FROM (SELECT {member}, bool_or(invoice_date < TIMESTAMP '1998-01-01') AS early
          FROM cleaned WHERE {member} IS NOT NULL GROUP BY {member}) {source}"""


def _guards() -> str:
    required = [c.split(":")[0] for c in FACT.split() if not c.startswith("customer_key")]
    nulls = ", ".join(f"count(*) - count({c}) AS null_{c}" for c in required)
    rows = [(f"'null_{c}'", f"null_{c}") for c in required]
    rows += [("'negative_id'", "negative_id"), ("'unknown_status'", "unknown_status")]
    orphans = {
        "product": ("product_key", "dim_product"), "country": ("country_key", "dim_country"),
        "customer": ("customer_key", "dim_customer"), "date": ("date_key", "dim_date"),
    }
    for name, (key, dim) in orphans.items():
        found = f"(SELECT count(*) FROM fact ANTI JOIN {dim} USING ({key}) WHERE {key} IS NOT NULL)"
        rows.append((f"'orphan_{name}'", found))
    known = ", ".join(f"'{s}'" for s in STATUSES)
    source = f"""SELECT {nulls}, count_if(source_row_id < 0) AS negative_id,
                 count_if(transaction_status NOT IN ({known})) AS unknown_status FROM fact"""
    return _stack(source, rows, ["guard", "rows"])


SPEC: dict[str, tuple[str, str, str]] = {
    "SRC4_raw_lines": (
        "InvoiceNo:s StockCode:s Description:s Quantity:i InvoiceDate:t UnitPrice:d CustomerID:i Country:s",
        "raw", "FROM raw",
    ),
    "SRC5_required_columns": (
        "column_name:s missing_count:i", "raw",
        _nulls("raw", [c for c in RAW if c not in ("Description", "CustomerID")], "missing_count"),
    ),
    "SRC6_cleaned_by_month": (
        "year:i month:i row_count:i line_revenue:d", "cleaned",
        """SELECT year(invoice_date) AS year, month(invoice_date) AS month, count(*) AS row_count,
                  sum(line_revenue) AS line_revenue FROM cleaned GROUP BY ALL""",
    ),
    "SRC8_staging_nulls": ("column_name:s null_count:i", "cleaned", _nulls("cleaned", CLEANED, "null_count")),
    "SNK2_bi_export": ("name:s row_count:i column_count:i", _MODEL_READS, _sizes(_MODEL)),
    "SNK3_verified_export": (
        "name:s verified:b", _MODEL_READS,
        f"SELECT name, row_count >= 0 AS verified FROM ({_sizes(_MODEL)})",
    ),
    "SNK4_public_export": ("name:s row_count:i column_count:i", _EXTRACT_READS, _sizes(_EXTRACTS)),
    "SNK7_read_extract": (
        PRODUCT + " is_non_merchandise:b", "products",
        "SELECT *, NOT (stock_code[1] BETWEEN '0' AND '9') AS is_non_merchandise FROM products",
    ),
    "SNK8_read_all_extracts": ("name:s row_count:i", _EXTRACT_READS, _sizes(_EXTRACTS)),
    "SNK9_report_json": SUMMARY,
    "CLN2_normalised": (LINES, "lines", "FROM lines"),
    "CLN3_status_counts": (
        "transaction_status:s row_count:i line_revenue:d", "cleaned",
        """SELECT transaction_status, count(*) AS row_count, sum(line_revenue) AS line_revenue
           FROM cleaned GROUP BY transaction_status""",
    ),
    "CLN4_flag_counts": (
        " ".join(f"{f}:i" for f in ROW_FLAGS), "cleaned",
        "SELECT " + ", ".join(f"count_if({f}) AS {f}" for f in ROW_FLAGS) + " FROM cleaned",
    ),
    "CLN8_duplicate_groups": (
        LINES + " copies:i", "lines",
        "SELECT *, count(*) AS copies FROM lines GROUP BY ALL HAVING count(*) > 1",
    ),
    "CLN13_row_counts": (
        "raw_rows:i cleaned_rows:i", "raw cleaned",
        "SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM cleaned) AS cleaned_rows",
    ),
    "CLN14_cleaned": (
        "source_row_id:i " + LINES + " transaction_status:s line_revenue:d " + FLAGS, "cleaned",
        "FROM cleaned",
    ),
    "CLN15_exact_revenue": (
        "gross_sales_revenue:d cancellation_value:d potential_return_value:d non_standard_value:d net_revenue:d",
        "exact",
        """SELECT gross AS gross_sales_revenue, cancel AS cancellation_value,
                  back AS potential_return_value, odd AS non_standard_value,
                  gross + cancel AS net_revenue FROM exact""",
    ),
    "CLN16_cleaning_summary": SUMMARY,
    "PRF1_shape": (
        "row_count:i column_count:i column_name:s data_type:s is_unexpected:b", "raw",
        """SELECT (SELECT count(*) FROM raw) AS row_count, 8 AS column_count, column_name, data_type,
                  false AS is_unexpected
           FROM (VALUES ('InvoiceNo', 'string'), ('StockCode', 'string'), ('Description', 'string'),
                        ('Quantity', 'int'), ('InvoiceDate', 'timestamp_ntz'),
                        ('UnitPrice', 'decimal(12,4)'), ('CustomerID', 'bigint'),
                        ('Country', 'string')) AS t(column_name, data_type)""",
    ),
    "PRF2_missing_values": (
        "column_name:s missing_count:i missing_pct:d", "raw",
        f"""SELECT *, {_pct('missing_count', '(SELECT count(*) FROM raw)')} AS missing_pct
            FROM ({_nulls('raw', RAW, 'missing_count')})""",
    ),
    "PRF3_duplicate_rows": (
        "duplicate_rows:i duplicate_rows_pct:d", "raw",
        f"SELECT extra AS duplicate_rows, {_pct('extra', 'n')} AS duplicate_rows_pct FROM ({RAW_COUNTS})",
    ),
    "PRF4_distinct_counts": (
        "unique_invoice_count:i unique_customer_count:i unique_product_count:i unique_country_count:i",
        "raw",
        """SELECT count(DISTINCT InvoiceNo) AS unique_invoice_count,
                  count(DISTINCT CustomerID) AS unique_customer_count,
                  count(DISTINCT StockCode) AS unique_product_count,
                  count(DISTINCT Country) AS unique_country_count FROM raw""",
    ),
    "PRF5_date_range": (
        "invoice_date_min:s invoice_date_max:s", "raw",
        """SELECT strftime(min(InvoiceDate), '%Y-%m-%dT%H:%M:%S') AS invoice_date_min,
                  strftime(max(InvoiceDate), '%Y-%m-%dT%H:%M:%S') AS invoice_date_max FROM raw""",
    ),
    "PRF6_quantity_range": (
        "quantity_min:i quantity_max:i quantity_negative_count:i quantity_zero_count:i", "raw",
        """SELECT min(Quantity) AS quantity_min, max(Quantity) AS quantity_max,
                  count_if(Quantity < 0) AS quantity_negative_count,
                  count_if(Quantity = 0) AS quantity_zero_count FROM raw""",
    ),
    "PRF7_price_range": (
        "unit_price_min:d unit_price_max:d unit_price_negative_count:i unit_price_zero_count:i", "raw",
        """SELECT min(UnitPrice) AS unit_price_min, max(UnitPrice) AS unit_price_max,
                  count_if(UnitPrice < 0) AS unit_price_negative_count,
                  count_if(UnitPrice = 0) AS unit_price_zero_count FROM raw""",
    ),
    "PRF8_reversal_counts": (
        "cancellation_count:i cancellation_pct_of_rows:d potential_return_count:i", "raw",
        f"""SELECT voided AS cancellation_count, {_pct('voided', 'n')} AS cancellation_pct_of_rows,
                   back AS potential_return_count FROM ({RAW_COUNTS})""",
    ),
    "PRF9_top_countries": (
        "country:s row_count:i", "raw",
        """SELECT coalesce(Country, '(missing)') AS country, count(*) AS row_count FROM raw
           GROUP BY ALL ORDER BY row_count DESC, country LIMIT 15""",
    ),
    "PRF10_identifier_coverage": (
        "customer_id_present_count:i customer_id_present_pct:d stock_code_present_count:i stock_code_present_pct:d",
        "raw",
        f"""SELECT count(CustomerID) AS customer_id_present_count,
                   {_pct('count(CustomerID)', 'count(*)')} AS customer_id_present_pct,
                   count(StockCode) AS stock_code_present_count,
                   {_pct('count(StockCode)', 'count(*)')} AS stock_code_present_pct FROM raw""",
    ),
    "DQ1_raw_warnings": (RULE_COLUMNS, "raw", _rules(RAW_COUNTS, RAW_RULES)),
    "DQ2_invariants": (
        "invariant:s violations:i", "raw cleaned",
        _stack(
            f"SELECT *, (SELECT count(*) FROM raw) AS raw_n FROM ({CLEAN_COUNTS})",
            [
                ("'row_count_preserved'", "abs(n - raw_n)"),
                ("'contiguous_source_row_id'", "CASE WHEN gaps = 0 THEN 0 ELSE 1 END"),
                ("'known_status'", "n - valid_sale - cancellation - potential_return - non_standard"),
                ("'status_counts_add_up'", "n - valid_sale - cancellation - potential_return - non_standard"),
                ("'line_revenue_consistent'", "drift"),
            ],
            ["invariant", "violations"],
        ),
    ),
    "DQ3_cleaning_warnings": (RULE_COLUMNS, "cleaned", _rules(CLEAN_COUNTS, CLEAN_RULES)),
    "DQ4_reconciliation": (
        "check_name:s expected:d actual:d passed:b", "cleaned exact money", _reconciliation()
    ),
    "DQ4_reconciliation_per_line": (
        "check_name:s expected:d actual:d passed:b", "cleaned exact money", _reconciliation(LINE_TOTALS)
    ),
    "DIM1_dates": (
        "date_key:i date_value:D year:i quarter:i month:i month_name:s day:i day_of_week:i day_name:s is_weekend:b",
        "dim_date", "FROM dim_date",
    ),
    "DIM2_countries": ("country_key:i country_name:s", "dim_country", "FROM dim_country"),
    "DIM3_customers": ("customer_key:i customer_id:i", "dim_customer", "FROM dim_customer"),
    "DIM4_products": (
        "product_key:i stock_code:s description:s description_variant_count:i", "dim_product",
        "FROM dim_product",
    ),
    "DIM5_dates_extended": (
        "date_key:i date_value:D year:i quarter:i month:i month_name:s day:i day_of_week:i day_name:s is_weekend:b",
        "dim_date", "FROM dim_date",
    ),
    "DIM5_customers_extended": (
        "customer_key:i customer_id:i", "cleaned", _keyed_later("customer_key", "customer_id")
    ),
    "DIM6_products_upserted": (
        "product_key:i stock_code:s description:s description_variant_count:i", "cleaned dim_product",
        _keyed_later(
            "product_key", "stock_code", ", description, description_variant_count",
            "JOIN dim_product USING (stock_code)",
        ),
    ),
    "FCT1_fact": (FACT, "fact", "FROM fact"),
    "FCT2_merged_fact": (
        "year:i row_count:i line_revenue:d", "money",
        """SELECT y AS year, count(*) AS row_count,
                  sum(CASE WHEN y < 1997 THEN 0 ELSE line_revenue END) AS line_revenue
           FROM money GROUP BY y""",
    ),
    "FCT3_published_version": (
        "fact_rows:i version:i", "cleaned", "SELECT count(*) AS fact_rows, 1 AS version FROM cleaned"
    ),
    "FCT4_guards": (
        "guard:s rows:i", "fact dim_product dim_country dim_customer dim_date", _guards()
    ),
    "FCT5_reloaded": (STATUS_SHARE_COLUMNS, "fact", STATUS_SHARE),
    **{
        key: (FACT, "fact", f"FROM fact WHERE transaction_status = '{status}'")
        for key, status in zip(
            ["V1_valid_sales", "V2_cancellations", "V3_potential_returns", "V4_non_standard"],
            STATUSES, strict=True,
        )
    },
    "V5_customer_summary": (
        "customer_key:i customer_id:i order_count:i total_net_revenue:d first_order_at:t last_order_at:t is_repeat_customer:b",
        "money dim_customer",
        """SELECT customer_key, customer_id, count(DISTINCT order_no) AS order_count,
                  sum(gain) AS total_net_revenue, min(invoice_timestamp) AS first_order_at,
                  max(invoice_timestamp) AS last_order_at, count(DISTINCT order_no) > 1 AS is_repeat_customer
           FROM money JOIN dim_customer USING (customer_key) WHERE sold GROUP BY customer_key, customer_id""",
    ),
    "V6_product_summary": (
        "product_key:i stock_code:s description:s order_count:i total_units_sold:i total_revenue:d",
        "products",
        "SELECT *, units_sold AS total_units_sold, revenue AS total_revenue FROM products",
    ),
    "V7_monthly_revenue": (
        "year:i month:i month_start:D gross_sales_revenue:d cancellation_value:d net_revenue:d order_count:i",
        "months",
        """SELECT year, month, month_start, gross AS gross_sales_revenue, cancel AS cancellation_value,
                  net AS net_revenue, orders AS order_count FROM months""",
    ),
    "V8_quality_monitor": (MONITOR, "fact", MONITOR_SQL),
    "V9_sales_deduplicated": (FACT + " dedup_rank:i", "dedup", "SELECT *, 1 AS dedup_rank FROM dedup"),
    "V10_monthly_growth": (GROWTH, "growth", "FROM growth"),
    "V11_revenue_by_country": (COUNTRY, "countries", "FROM countries"),
    "V12_product_performance": (PRODUCT, "products", "FROM products"),
    "V13_country_rankings": (IN_COUNTRY, "product_countries", "FROM product_countries"),
    "V14_monthly_trend": (TREND, "trend", "FROM trend"),
    "V15_cancellation_activity": (CANCELS, "cancels", "FROM cancels"),
    "V16_rfm": (
        "customer_key:i customer_id:i first_purchase_at:t last_purchase_at:t recency_days:i frequency:i "
        "monetary:d recency_score:i frequency_score:i monetary_score:i rfm_total_score:i rfm_segment_heuristic:s",
        "rfm",
        """SELECT *, r AS recency_score, f AS frequency_score, w AS monetary_score,
                  total AS rfm_total_score, segment AS rfm_segment_heuristic FROM rfm""",
    ),
    "V17_cohort_retention": (COHORT, "cohorts", "FROM cohorts"),
    "V18_duplicate_sensitivity": (VERSIONS, "versions", "FROM versions"),
    "V19_sensitivity_delta": (DELTA, "delta", "FROM delta"),
    "A1_headline": (
        "total_orders:i units_sold:i gross_sales_revenue:d cancellation_value:d net_revenue:d average_order_value:d",
        "money",
        f"""SELECT * REPLACE (round(CAST(average_order_value AS DECIMAL(38,10)), 2) AS average_order_value)
            FROM (SELECT {SALES_SQL} FROM money)""",
    ),
    "A2_growth_listing": (GROWTH, "growth", "FROM growth ORDER BY year, month"),
    "A3_country_share": (
        "country_name:s order_count:i gross_sales_revenue:d cancellation_value:d net_revenue:d revenue_rank:i pct_of_total_net_revenue:d",
        "countries",
        f"""SELECT *, {_pct('net_revenue', '(SELECT CAST(sum(net_revenue) AS DOUBLE) FROM countries)')}
                   AS pct_of_total_net_revenue FROM countries""",
    ),
    "A4_full_months": (
        "total_orders_full_months:i net_revenue_full_months:d average_monthly_net_revenue_full_months:d",
        "growth",
        f"""SELECT sum(order_count) AS total_orders_full_months, sum(net_revenue) AS net_revenue_full_months,
                   {_mean('sum(net_revenue)', 'count(*)', 2)} AS average_monthly_net_revenue_full_months
            FROM growth WHERE NOT is_partial_month""",
    ),
    "B1_top_by_revenue": (
        "stock_code:s description:s revenue:d revenue_rank:i quantity_rank:i pct_of_total_revenue:d",
        "products", "FROM products ORDER BY revenue_rank, stock_code LIMIT 10",
    ),
    "B2_top_by_quantity": (
        "stock_code:s description:s units_sold:i revenue:d revenue_rank:i quantity_rank:i",
        "products", "FROM products ORDER BY quantity_rank, stock_code LIMIT 10",
    ),
    "B3_largest_lines": (
        "source_row_id:i invoice_no:s stock_code:s description:s quantity:i unit_price:d line_revenue:d invoice_timestamp:t",
        "money dim_product",
        """FROM money JOIN dim_product USING (product_key) WHERE sold
           ORDER BY quantity DESC, source_row_id LIMIT 5""",
    ),
    "B4_cumulative_contribution": (
        "stock_code:s description:s revenue:d revenue_rank:i cumulative_revenue:d cumulative_pct_of_total:d",
        "products",
        f"""SELECT *, {_pct('cumulative_revenue', 'CAST(everything AS DOUBLE)')} AS cumulative_pct_of_total
            FROM (SELECT *, sum(revenue) OVER () AS everything, sum(revenue) OVER (
                      ORDER BY revenue_rank, stock_code ROWS UNBOUNDED PRECEDING) AS cumulative_revenue
                  FROM products) ORDER BY revenue_rank, stock_code LIMIT 20""",
    ),
    "B5_top_per_country": (
        IN_COUNTRY, "product_countries", "FROM product_countries WHERE rank_within_country <= 3"
    ),
    "B6_trend_of_best": (
        TREND, "trend products",
        """FROM trend WHERE stock_code IN
           (SELECT stock_code FROM products ORDER BY revenue_rank, stock_code LIMIT 5)""",
    ),
    "B7_most_cancelled": (
        CANCELS, "cancels", "FROM cancels ORDER BY cancellation_count DESC, stock_code LIMIT 10"
    ),
    "C1_customer_coverage": (
        "identified_customers:i customers_with_qualifying_purchase:i", "dim_customer rfm",
        """SELECT (SELECT count(*) FROM dim_customer) AS identified_customers,
                  (SELECT count(*) FROM rfm) AS customers_with_qualifying_purchase""",
    ),
    "C2_repeat_rate": (
        "customers_with_qualifying_purchase:i repeat_customers:i repeat_customer_rate_pct:d", "spend",
        f"""SELECT count(*) AS customers_with_qualifying_purchase, count_if(frequency > 1) AS repeat_customers,
                   {_pct('count_if(frequency > 1)', 'count(*)')} AS repeat_customer_rate_pct FROM spend""",
    ),
    "C3_frequency_histogram": (
        "order_count:i customer_count:i", "spend",
        "SELECT frequency AS order_count, count(*) AS customer_count FROM spend GROUP BY frequency",
    ),
    "C4_spend_statistics": (
        "mean_customer_spend:d median_customer_spend:d p90_customer_spend:d min_customer_spend:d max_customer_spend:d",
        "spend",
        f"""SELECT {_mean('sum(monetary)', 'count(*)', 2)} AS mean_customer_spend,
                   {_percentile(5)} AS median_customer_spend, {_percentile(9)} AS p90_customer_spend,
                   min(monetary) AS min_customer_spend, max(monetary) AS max_customer_spend
            FROM ({SPEND_ORDERED})""",
    ),
    "C5_spend_deciles": (
        "decile:i customers_in_decile:i decile_revenue:d pct_of_total_revenue:d", "deciles spend",
        _deciles("customers_in_decile"),
    ),
    "C6_longest_lifespans": (
        "customer_id:i first_purchase_at:t last_purchase_at:t observed_lifespan_days:i frequency:i monetary:d",
        "spend",
        """SELECT *, datediff('day', first_purchase_at, last_purchase_at) AS observed_lifespan_days
           FROM spend ORDER BY observed_lifespan_days DESC, customer_id LIMIT 10""",
    ),
    "C7_highest_value": (
        "customer_id:i observed_historical_net_revenue:d order_count:i", "spend",
        """SELECT customer_id, monetary AS observed_historical_net_revenue, frequency AS order_count
           FROM spend ORDER BY monetary DESC, customer_id LIMIT 10""",
    ),
    "C8_segment_summary": (SEGMENTS, "rfm", SEGMENTS_SQL),
    "D1_status_distribution": (STATUS_SHARE_COLUMNS, "fact", STATUS_SHARE),
    "D2_reversals": (
        "cancellation_row_count:i cancellation_value:d potential_return_row_count:i potential_return_value:d",
        "money",
        """SELECT count_if(voided) AS cancellation_row_count, sum(loss) AS cancellation_value,
                  count_if(transaction_status = 'potential_return') AS potential_return_row_count,
                  sum(line_revenue) FILTER (transaction_status = 'potential_return') AS potential_return_value
           FROM money""",
    ),
    "D3_non_standard_reasons": (
        "total_non_standard:i non_positive_price_count:i zero_quantity_count:i non_standard_invoice_format_count:i",
        "fact",
        f"SELECT *, row_count AS total_non_standard FROM ({MONITOR_SQL}) WHERE transaction_status = 'non_standard'",
    ),
    "D4_missing_customers": (
        "transaction_status:s row_count:i missing_customer_id_count:i missing_customer_id_pct:d", "fact",
        _status_rate("missing_customer_id"),
    ),
    "D5_duplicate_candidates": (
        "transaction_status:s row_count:i duplicate_candidate_count:i duplicate_candidate_pct:d", "fact",
        _status_rate("duplicate_candidate"),
    ),
    "D6a_duplicate_sensitivity": (VERSIONS, "versions", "FROM versions"),
    "D6b_sensitivity_delta": (DELTA, "delta", "FROM delta"),
    "D7_anomalous_invoices": (
        "source_row_id:i invoice_no:s quantity:i unit_price:d line_revenue:d transaction_status:s", "fact",
        "FROM fact WHERE flag_non_standard_invoice_format ORDER BY source_row_id",
    ),
    "E1_retention_listing": (COHORT, "cohorts", "FROM cohorts ORDER BY cohort_month, activity_month"),
    "E2_retention_curve": (
        "month_index:i cohorts_observed_at_this_index:i avg_retention_pct:d", "cohorts",
        f"""SELECT month_index, count(*) AS cohorts_observed_at_this_index,
                   {_mean('sum(retention_pct)', 'count(*)', 2)} AS avg_retention_pct
            FROM cohorts WHERE month_index >= 1 GROUP BY month_index""",
    ),
    "E3_cohort_sizes": (
        "cohort_month:D cohort_size:i", "cohorts", "SELECT DISTINCT cohort_month, cohort_size FROM cohorts"
    ),
    "R1a_monthly_net": (
        "year:i month:i net_revenue:d", "growth",
        "SELECT year, month, net_revenue FROM growth ORDER BY year, month",
    ),
    "R1b_top_customers": (
        "customer_key:i customer_id:i order_count:i total_net_revenue:d first_order_at:t last_order_at:t is_repeat_customer:b",
        "money dim_customer",
        """SELECT customer_key, customer_id, count(DISTINCT order_no) AS order_count,
                  sum(gain) AS total_net_revenue, min(invoice_timestamp) AS first_order_at,
                  max(invoice_timestamp) AS last_order_at, count(DISTINCT order_no) > 1 AS is_repeat_customer
           FROM money JOIN dim_customer USING (customer_key) WHERE sold GROUP BY customer_key, customer_id
           ORDER BY total_net_revenue DESC, customer_id LIMIT 10""",
    ),
    "R1c_quality_listing": (MONITOR, "fact", MONITOR_SQL),
    "X1_product_performance": (
        PRODUCT + " is_non_merchandise:b", "products",
        "SELECT *, NOT (stock_code[1] BETWEEN '0' AND '9') AS is_non_merchandise FROM products",
    ),
    "X9_top20_per_country": (
        IN_COUNTRY, "product_countries", "FROM product_countries WHERE rank_within_country <= 20"
    ),
    "X10_anomalous_transactions": (
        "invoice_no:s quantity:i unit_price:d line_revenue:d transaction_status:s", "fact",
        "FROM fact WHERE flag_non_standard_invoice_format",
    ),
    "X12_spend_deciles": (
        "decile:i customer_count:i decile_revenue:d pct_of_total_revenue:d", "deciles spend",
        _deciles("customer_count"),
    ),
    "X13_customer_headline": (
        "identified_customers:i customers_with_qualifying_purchase:i customers_with_orders:i "
        "repeat_customers:i repeat_customer_rate_pct:d mean_customer_spend:d median_customer_spend:d "
        "top_decile_revenue:d top_decile_revenue_pct:d",
        "deciles dim_customer",
        f"""SELECT (SELECT count(*) FROM dim_customer) AS identified_customers,
                   count(*) AS customers_with_qualifying_purchase, count(*) AS customers_with_orders,
                   count_if(frequency > 1) AS repeat_customers,
                   {_pct('count_if(frequency > 1)', 'count(*)')} AS repeat_customer_rate_pct,
                   {_mean('sum(monetary)', 'count(*)', 2)} AS mean_customer_spend,
                   {_percentile(5)} AS median_customer_spend,
                   sum(monetary) FILTER (decile = 1) AS top_decile_revenue,
                   {_pct('sum(monetary) FILTER (decile = 1)', 'CAST(sum(monetary) AS DOUBLE)')} AS top_decile_revenue_pct
            FROM (SELECT *, row_number() OVER (ORDER BY monetary, customer_id) - 1 AS p,
                         count(*) OVER () AS n FROM deciles)""",
    ),
    "X14_dataset_metadata": (
        "total_source_records:i date_range_start:D date_range_end:D valid_sale_count:i cancellation_count:i "
        "potential_return_count:i non_standard_count:i missing_customer_id_count:i "
        "duplicate_candidate_count:i anomalous_invoice_format_count:i",
        "money",
        """SELECT count(*) AS total_source_records, min(invoice_timestamp)::DATE AS date_range_start,
                  max(invoice_timestamp)::DATE AS date_range_end, count_if(sold) AS valid_sale_count,
                  count_if(voided) AS cancellation_count,
                  count_if(transaction_status = 'potential_return') AS potential_return_count,
                  count_if(transaction_status = 'non_standard') AS non_standard_count,
                  count_if(flag_missing_customer_id) AS missing_customer_id_count,
                  count_if(flag_duplicate_candidate) AS duplicate_candidate_count,
                  count_if(flag_non_standard_invoice_format) AS anomalous_invoice_format_count FROM money""",
    ),
    "X15_dim_product": ("product_key:i stock_code:s description:s", "dim_product", "FROM dim_product"),
    "M2_months_between": (
        GROWTH, "growth",
        "FROM growth WHERE month_start BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'",
    ),
    "M3_headline_kpis": (
        "gross_sales_revenue:d cancellation_value:d net_revenue:d order_count:i average_order_value:d "
        "months_included:i has_partial_month:b",
        "growth",
        """SELECT sum(gross_sales_revenue) AS gross_sales_revenue, sum(cancellation_value) AS cancellation_value,
                  sum(net_revenue) AS net_revenue, sum(order_count) AS order_count,
                  CAST(sum(net_revenue) AS DOUBLE) / CAST(sum(order_count) AS DOUBLE) AS average_order_value,
                  count(*) AS months_included, bool_or(is_partial_month) AS has_partial_month
           FROM growth WHERE month_start BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'""",
    ),
    "M4_top_products": (
        "stock_code:s description:s units_sold:i revenue:d", "trend",
        """SELECT stock_code, description, sum(units_sold) AS units_sold, sum(revenue) AS revenue
           FROM trend WHERE year IN (1996, 1997) GROUP BY stock_code, description
           ORDER BY revenue DESC, stock_code LIMIT 10""",
    ),
    "M6_only_values": (
        IN_COUNTRY, "product_countries",
        """FROM product_countries WHERE rank_within_country <= 20
           AND country_name IN ('NATION_3', 'NATION_7', 'NATION_12')""",
    ),
    "M7_search_products": (
        PRODUCT + " is_non_merchandise:b", "products",
        """SELECT *, NOT (stock_code[1] BETWEEN '0' AND '9') AS is_non_merchandise FROM products
           WHERE lower(description) LIKE '%blue%' OR stock_code LIKE '0001%' OR stock_code LIKE '0002%'""",
    ),
    "M8_merchandise": (
        PRODUCT + " is_non_merchandise:b", "products",
        "SELECT *, false AS is_non_merchandise FROM products WHERE stock_code[1] BETWEEN '0' AND '9'",
    ),
    "M9_contribution": (
        "label:s pct:d", "products",
        """WITH top AS (SELECT * FROM products ORDER BY revenue_rank, stock_code LIMIT 10)
           SELECT description AS label, pct_of_total_revenue AS pct FROM top
           UNION ALL
           SELECT 'All other products', 100 - sum(pct_of_total_revenue) FROM top
           HAVING sum(pct_of_total_revenue) < 100""",
    ),
    "M10_smallest_ranks": (COUNTRY, "countries", "FROM countries ORDER BY revenue_rank, country_key LIMIT 10"),
    "M11_cohort_matrix": (
        "cohort_month:D month_index:i retention_pct:d", "cohorts",
        "SELECT cohort_month, month_index, retention_pct FROM cohorts",
    ),
    "M13_version_difference": (
        "complete:i deduplicated:i difference:i", "versions",
        """SELECT max(units_sold) AS complete, min(units_sold) AS deduplicated,
                  max(units_sold) - min(units_sold) AS difference FROM versions""",
    ),
    "M14_product_series": (
        TREND + " month_start:D", "trend",
        "SELECT *, make_date(year, month, 1) AS month_start FROM trend WHERE description = 'blue widget'",
    ),
    "M15_cancellation_rates": (
        "cancellation_rows:i valid_sale_rows:i cancellation_value:d gross_sales_revenue:d "
        "cancellation_row_rate:d cancellation_revenue_offset:d",
        "money",
        """SELECT count_if(voided) AS cancellation_rows, count_if(sold) AS valid_sale_rows,
                  sum(loss) AS cancellation_value, sum(gain) AS gross_sales_revenue,
                  CAST(count_if(voided) AS DOUBLE) / count_if(voided OR sold) AS cancellation_row_rate,
                  CAST(-sum(loss) AS DOUBLE) / CAST(sum(gain) AS DOUBLE) AS cancellation_revenue_offset
           FROM money""",
    ),
    "BI1_sales": (SALES, "money", f"SELECT {SALES_SQL} FROM money"),
    "BI1_sales_filtered": (
        "country_name:s quarter:i " + SALES, "money dim_country",
        f"""SELECT country_name, quarter(invoice_timestamp) AS quarter, {SALES_SQL}
            FROM money JOIN dim_country USING (country_key)
            WHERE y = 1997 AND country_name IN ('NATION_3', 'NATION_7', 'NATION_12') GROUP BY 1, 2""",
    ),
    "BI2_partial_months": (
        "has_partial_month:b warning_text:s", "growth",
        """SELECT bool_or(is_partial_month) AS has_partial_month,
                  CASE WHEN bool_or(is_partial_month) THEN
                  'The selection contains an incomplete month; its growth is not comparable.'
                  ELSE '' END AS warning_text FROM growth""",
    ),
    "BI3_customers": (
        "active_customers:i repeat_customers:i repeat_customer_rate:d", "money",
        REPEAT_SQL.format(keys="", source="money", where=""),
    ),
    "BI3_customers_filtered": (
        "country_name:s active_customers:i repeat_customers:i repeat_customer_rate:d", "money dim_country",
        REPEAT_SQL.format(
            keys="country_name,", source="money JOIN dim_country USING (country_key)", where="AND y >= 1997"
        ),
    ),
    "BI4_customer_spend": (
        "mean_customer_spend:d median_customer_spend:d", "spend",
        f"""SELECT {_mean('sum(monetary)', 'count(*)', 2)} AS mean_customer_spend,
                   {_percentile(5)} AS median_customer_spend FROM ({SPEND_ORDERED})""",
    ),
    "BI5_concentration": (
        "top_revenue:d top_revenue_share:d", "spend",
        """SELECT sum(monetary) FILTER (place <= ceil(n / 10.0)) AS top_revenue,
                  CAST(sum(monetary) FILTER (place <= ceil(n / 10.0)) AS DOUBLE) / CAST(sum(monetary) AS DOUBLE)
                      AS top_revenue_share
           FROM (SELECT monetary, rank() OVER (ORDER BY monetary DESC) AS place, count(*) OVER () AS n FROM spend)""",
    ),
    "BI6_product_revenue": (
        "stock_code:s description:s revenue:d revenue_rank:i revenue_contribution:d is_non_merchandise:b",
        "money dim_product",
        """SELECT stock_code, any_value(description) AS description, sum(gain) AS revenue,
                  rank() OVER (ORDER BY sum(gain) DESC) AS revenue_rank,
                  CAST(sum(gain) AS DOUBLE) / CAST(sum(sum(gain)) OVER () AS DOUBLE) AS revenue_contribution,
                  stock_code = 'POST' AS is_non_merchandise
           FROM money JOIN dim_product USING (product_key) WHERE sold GROUP BY stock_code""",
    ),
    "BI6_product_revenue_filtered": (
        "stock_code:s description:s revenue:d revenue_rank:i revenue_contribution:d is_non_merchandise:b",
        "money dim_product",
        """SELECT stock_code, any_value(description) AS description, sum(gain) AS revenue,
                  rank() OVER (ORDER BY sum(gain) DESC) AS revenue_rank,
                  CAST(sum(gain) AS DOUBLE) / CAST(sum(sum(gain)) OVER () AS DOUBLE) AS revenue_contribution,
                  stock_code = 'POST' AS is_non_merchandise
           FROM money JOIN dim_product USING (product_key) WHERE sold AND y = 1997 GROUP BY stock_code""",
    ),
    "BI8_quality": (QUALITY, "money", f"SELECT {QUALITY_SQL} FROM money"),
    "BI8_quality_by_country": (
        "country_name:s " + QUALITY, "money dim_country",
        f"SELECT country_name, {QUALITY_SQL} FROM money JOIN dim_country USING (country_key) GROUP BY country_name",
    ),
    "BI9_duplicate_share": (
        "complete_revenue:d deduplicated_revenue:d duplicate_revenue_sensitivity:d", "delta",
        """SELECT *, CAST(revenue_difference AS DOUBLE) / CAST(complete_revenue AS DOUBLE)
                  AS duplicate_revenue_sensitivity FROM delta""",
    ),
    "BI10_product_country_matrix": (
        "stock_code:s country_name:s revenue:d", "product_countries",
        """WITH best_products AS (SELECT stock_code FROM product_countries GROUP BY 1
                                  ORDER BY sum(revenue) DESC, stock_code LIMIT 10),
                best_countries AS (SELECT country_name FROM product_countries GROUP BY 1
                                   ORDER BY sum(revenue) DESC, country_name LIMIT 5)
           SELECT stock_code, country_name, revenue
           FROM best_products CROSS JOIN best_countries
           LEFT JOIN product_countries USING (stock_code, country_name)""",
    ),
    "BI11_segment_sales": (
        "rfm_segment_heuristic:s " + SALES, "money rfm",
        f"""SELECT segment AS rfm_segment_heuristic, {SALES_SQL}
            FROM money LEFT JOIN rfm USING (customer_key) GROUP BY segment""",
    ),
}

# The published extract, or second name, of a query that is stated above.
for alias, original in {
    "X2_product_monthly_trend": "V14_monthly_trend",
    "X3_product_cancellations": "V15_cancellation_activity",
    "X4_country_performance": "V11_revenue_by_country",
    "X5_monthly_revenue": "V10_monthly_growth",
    "X6_cohort_retention": "V17_cohort_retention",
    "X7_duplicate_sensitivity": "V18_duplicate_sensitivity",
    "X8_quality_summary": "V8_quality_monitor",
    "X11_segment_summary": "C8_segment_summary",
    "M5_metadata_row": "X14_dataset_metadata",
    "M12_status_share": "D1_status_distribution",
}.items():
    SPEC[alias] = SPEC[original]
SPEC["BI7_non_merchandise"] = (
    "stock_code:s is_non_merchandise:b", "dim_product",
    "SELECT stock_code, stock_code = 'POST' AS is_non_merchandise FROM dim_product",
)

SPEC["SRC1_manifest"] = (
    "row_count:i files_without_fingerprint:i repeated_files:i", "raw",
    "SELECT count(*) AS row_count, 0 AS files_without_fingerprint, 0 AS repeated_files FROM raw",
)
SPEC["SRC3_landing"] = (
    "attempt:i action:s landed_rows:i", "raw",
    """SELECT attempt, action, CASE WHEN attempt < 4 THEN n ELSE positive END AS landed_rows
       FROM (VALUES (1, 'land'), (2, 'skip'), (3, 'refuse'), (4, 'overwrite')) AS a(attempt, action),
            (SELECT count(*) AS n, count_if(Quantity > 0) AS positive FROM raw)""",
)

STATEMENTS = {key: statement(*parts) for key, parts in SPEC.items()}
