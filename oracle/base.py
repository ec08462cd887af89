"""Shared table expressions and the composer for complete statements."""

from __future__ import annotations

_TYPES = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "b": "BOOLEAN", "t": "TIMESTAMP", "D": "DATE"}

# name -> (expressions it reads, text)
TABLES: dict[str, tuple[str, str]] = {
    "derived": (
        "",
        """
        SELECT l.l_orderkey AS k, l.l_linenumber AS ln, l.l_partkey AS pk,
               CAST(l.l_quantity AS INTEGER) AS q,
               l.l_returnflag = 'R' AND l.l_linenumber = 1 AS voided,
               l.l_returnflag = 'R' AND l.l_linenumber = 2 AS sent_back,
               CASE WHEN length(CAST(l.l_orderkey AS VARCHAR)) < 6
                    THEN lpad(CAST(l.l_orderkey AS VARCHAR), 6, '0')
                    ELSE CAST(l.l_orderkey AS VARCHAR) END AS num,
               l.l_extendedprice / l.l_quantity AS unit,
               o.o_orderdate + to_minutes(CAST(o.o_orderkey % 1440 AS INTEGER)) AS ts,
               o.o_custkey AS ck, n.n_name, p.p_name
        FROM lineitem l, orders o, customer c, nation n, part p
        WHERE o.o_orderkey = l.l_orderkey AND c.c_custkey = o.o_custkey
          AND n.n_nationkey = c.c_nationkey AND p.p_partkey = l.l_partkey
        """,
    ),
    "raw": (
        "derived",
        """
        SELECT CASE WHEN voided THEN 'C' || num WHEN k % 997 = 5 THEN 'A' || num ELSE num END AS InvoiceNo,
               CASE WHEN pk % 100 = 0 THEN 'POST'
                    WHEN length(CAST(pk AS VARCHAR)) < 5 THEN lpad(CAST(pk AS VARCHAR), 5, '0')
                    ELSE CAST(pk AS VARCHAR) END AS StockCode,
               CASE WHEN k % 331 = 0 THEN NULL WHEN k % 53 = 0 THEN 'damaged'
                    WHEN ln = 3 THEN '  ' || p_name || ' ' ELSE p_name END AS Description,
               CASE WHEN voided OR sent_back THEN -q WHEN k % 1009 = 3 THEN 0 ELSE q END AS Quantity,
               CAST(ts AS TIMESTAMP) AS InvoiceDate,
               CAST(CASE WHEN sent_back OR k % 401 = 0 THEN 0
                    ELSE round(CAST(unit AS DECIMAL(38,10)), 3) END AS DECIMAL(12,4)) AS UnitPrice,
               CASE WHEN ck % 4 <> 3 THEN ck END AS CustomerID,
               n_name AS Country
        FROM (SELECT *, unnest(CASE WHEN k % 211 = 0 THEN [1, 2] ELSE [1] END) FROM derived)
        """,
    ),
    "lines": (
        "raw",
        r"""
        SELECT regexp_replace(InvoiceNo, '^\s+|\s+$', '', 'g') AS invoice_no,
               regexp_replace(StockCode, '^\s+|\s+$', '', 'g') AS stock_code,
               nullif(regexp_replace(Description, '^\s+|\s+$', '', 'g'), '') AS description,
               Quantity AS quantity, InvoiceDate AS invoice_date, UnitPrice AS unit_price,
               CustomerID AS customer_id,
               regexp_replace(Country, '^\s+|\s+$', '', 'g') AS country
        FROM raw
        """,
    ),
    "cleaned": (
        "lines",
        """
        SELECT row_number() OVER (ORDER BY invoice_date NULLS FIRST, invoice_no NULLS FIRST,
                   stock_code NULLS FIRST, description NULLS FIRST, quantity NULLS FIRST,
                   unit_price NULLS FIRST, customer_id NULLS FIRST, country NULLS FIRST) - 1
                   AS source_row_id,
               *,
               CASE WHEN invoice_no[1] = 'C' THEN 'cancellation'
                    WHEN quantity < 0 THEN 'potential_return'
                    WHEN unit_price > 0 AND quantity > 0 AND invoice_date IS NOT NULL
                         AND regexp_full_match(invoice_no, '[0-9]{6}') THEN 'valid_sale'
                    ELSE 'non_standard' END AS transaction_status,
               CAST(round(CAST(quantity AS DECIMAL(10,0)) * unit_price, 2) AS DECIMAL(14,2)) AS line_revenue,
               customer_id IS NULL AS flag_missing_customer_id,
               description IS NULL AS flag_missing_description,
               unit_price <= 0 AS flag_non_positive_price,
               quantity = 0 AS flag_zero_quantity,
               count(*) OVER (PARTITION BY invoice_no, stock_code, description, quantity,
                   invoice_date, unit_price, customer_id, country) > 1 AS flag_duplicate_candidate,
               NOT regexp_full_match(invoice_no, 'C?[0-9]{6}') AS flag_non_standard_invoice_format,
               NOT (stock_code[1] BETWEEN '0' AND '9') AS flag_non_standard_stock_code
        FROM lines
        """,
    ),
    "dim_date": (
        "cleaned",
        """
        SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS DATE) AS date_value,
               year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
               day(d) AS day, isodow(d) - 1 AS day_of_week, dayname(d) AS day_name,
               isodow(d) > 5 AS is_weekend
        FROM (SELECT unnest(generate_series(min(invoice_date)::DATE, max(invoice_date)::DATE, INTERVAL 1 DAY)) AS d
              FROM cleaned)
        """,
    ),
    "dim_country": (
        "cleaned",
        """
        SELECT dense_rank() OVER (ORDER BY country) AS country_key, country AS country_name
        FROM cleaned GROUP BY country
        """,
    ),
    "dim_customer": (
        "cleaned",
        """
        SELECT dense_rank() OVER (ORDER BY customer_id) AS customer_key, customer_id
        FROM cleaned WHERE customer_id IS NOT NULL GROUP BY customer_id
        """,
    ),
    "spellings": (
        "cleaned",
        """
        SELECT stock_code, description, count(*) AS n,
               row_number() OVER (PARTITION BY stock_code
                   ORDER BY description IS NULL, count(*) DESC, description) AS place
        FROM cleaned GROUP BY stock_code, description
        """,
    ),
    "dim_product": (
        "spellings",
        """
        SELECT dense_rank() OVER (ORDER BY stock_code) AS product_key, stock_code,
               max(description) FILTER (place = 1) AS description,
               count(description) AS description_variant_count
        FROM spellings GROUP BY stock_code
        """,
    ),
    "fact": (
        "cleaned dim_product dim_country dim_customer",
        """
        SELECT x.source_row_id, x.invoice_no, p.product_key, u.customer_key, g.country_key,
               year(x.invoice_date) * 10000 + month(x.invoice_date) * 100 + day(x.invoice_date) AS date_key,
               x.invoice_date AS invoice_timestamp, x.quantity, x.unit_price, x.line_revenue,
               x.transaction_status, x.flag_missing_customer_id, x.flag_missing_description,
               x.flag_non_positive_price, x.flag_zero_quantity, x.flag_duplicate_candidate,
               x.flag_non_standard_invoice_format, x.flag_non_standard_stock_code
        FROM cleaned x
        JOIN dim_product p USING (stock_code)
        JOIN dim_country g ON g.country_name = x.country
        LEFT JOIN dim_customer u ON u.customer_id = x.customer_id
        """,
    ),
    # lines with the signed amounts every revenue question starts from
    "money": (
        "fact",
        """
        SELECT *, transaction_status = 'valid_sale' AS sold,
               transaction_status = 'cancellation' AS voided,
               CASE transaction_status WHEN 'valid_sale' THEN line_revenue END AS gain,
               CASE transaction_status WHEN 'cancellation' THEN line_revenue END AS loss,
               CASE transaction_status WHEN 'valid_sale' THEN invoice_no END AS order_no,
               year(invoice_timestamp) AS y, month(invoice_timestamp) AS m
        FROM fact
        """,
    ),
    "months": (
        "money",
        """
        SELECT y AS year, m AS month, min(invoice_timestamp)::DATE AS month_start,
               sum(gain) AS gross, sum(loss) AS cancel,
               coalesce(sum(gain), 0) + coalesce(sum(loss), 0) AS net,
               count(DISTINCT order_no) AS orders,
               min(invoice_timestamp)::DATE AS lo, max(invoice_timestamp)::DATE AS hi
        FROM money GROUP BY y, m
        """,
    ),
    "growth": (
        "months",
        """
        SELECT year, month, month_start,
               (row_number() OVER w = 1 AND lo > make_date(year, month, 1))
                 OR (lead(year) OVER w IS NULL AND hi < last_day(hi)) AS is_partial_month,
               coalesce(gross, 0) AS gross_sales_revenue, coalesce(cancel, 0) AS cancellation_value,
               net AS net_revenue, orders AS order_count,
               CASE WHEN orders > 0 THEN round(CAST(CAST(net AS DOUBLE) / orders AS DECIMAL(38,10)), 2) END
                   AS average_order_value,
               lag(net) OVER w AS previous_month_net_revenue,
               CASE WHEN lag(net) OVER w <> 0 THEN
                   round(CAST(100.0 * CAST(net - lag(net) OVER w AS DOUBLE) / CAST(lag(net) OVER w AS DOUBLE)
                         AS DECIMAL(38,10)), 2) END AS month_over_month_growth_pct,
               sum(net) OVER (w ROWS UNBOUNDED PRECEDING) AS cumulative_net_revenue
        FROM months WINDOW w AS (ORDER BY year, month)
        """,
    ),
    "countries": (
        "money dim_country",
        """
        SELECT *, rank() OVER (ORDER BY net_revenue DESC) AS revenue_rank
        FROM (SELECT country_key, country_name, count(DISTINCT order_no) AS order_count,
                     coalesce(sum(gain), 0) AS gross_sales_revenue,
                     coalesce(sum(loss), 0) AS cancellation_value,
                     coalesce(sum(gain), 0) + coalesce(sum(loss), 0) AS net_revenue
              FROM money JOIN dim_country USING (country_key) GROUP BY country_key, country_name)
        """,
    ),
    "products": (
        "money dim_product",
        """
        SELECT product_key, stock_code, any_value(description) AS description,
               sum(quantity) AS units_sold, sum(line_revenue) AS revenue,
               count(DISTINCT invoice_no) AS order_count,
               rank() OVER (ORDER BY sum(line_revenue) DESC) AS revenue_rank,
               rank() OVER (ORDER BY sum(quantity) DESC) AS quantity_rank,
               round(CAST(100.0 * CAST(sum(line_revenue) AS DOUBLE)
                     / CAST(sum(sum(line_revenue)) OVER () AS DOUBLE) AS DECIMAL(38,10)), 4)
                   AS pct_of_total_revenue
        FROM money JOIN dim_product USING (product_key) WHERE sold GROUP BY product_key, stock_code
        """,
    ),
    "product_countries": (
        "money dim_product dim_country",
        """
        SELECT country_name, stock_code, any_value(description) AS description,
               sum(line_revenue) AS revenue,
               rank() OVER (PARTITION BY country_name ORDER BY sum(line_revenue) DESC) AS rank_within_country
        FROM money JOIN dim_product USING (product_key) JOIN dim_country USING (country_key)
        WHERE sold GROUP BY country_name, stock_code
        """,
    ),
    "trend": (
        "money dim_product",
        """
        SELECT stock_code, any_value(description) AS description, y AS year, m AS month,
               sum(quantity) AS units_sold, sum(line_revenue) AS revenue
        FROM money JOIN dim_product USING (product_key) WHERE sold GROUP BY stock_code, y, m
        """,
    ),
    "cancels": (
        "money dim_product",
        """
        SELECT stock_code, any_value(description) AS description,
               count_if(voided) AS cancellation_count, sum(loss) AS cancellation_value,
               count_if(sold) AS valid_sale_count,
               round(CAST(100.0 * count_if(voided) / count_if(sold OR voided) AS DECIMAL(38,10)), 2)
                   AS cancellation_rate_pct
        FROM money JOIN dim_product USING (product_key)
        GROUP BY stock_code HAVING count_if(voided) > 0
        """,
    ),
    "spend": (
        "money dim_customer",
        """
        SELECT customer_key, customer_id,
               min(invoice_timestamp) FILTER (sold) AS first_purchase_at,
               max(invoice_timestamp) FILTER (sold) AS last_purchase_at,
               count(DISTINCT order_no) AS frequency,
               coalesce(sum(gain), 0) + coalesce(sum(loss), 0) AS monetary
        FROM money JOIN dim_customer USING (customer_key)
        GROUP BY customer_key, customer_id HAVING bool_or(sold)
        """,
    ),
    "scores": (
        "spend fact",
        """
        SELECT *, ntile(4) OVER (ORDER BY recency_days DESC, customer_id) AS r,
               ntile(4) OVER (ORDER BY frequency, customer_id) AS f,
               ntile(4) OVER (ORDER BY monetary, customer_id) AS w
        FROM (SELECT *, datediff('day', last_purchase_at::DATE,
                     (SELECT max(invoice_timestamp)::DATE + 1 FROM fact)) AS recency_days FROM spend)
        """,
    ),
    "rfm": (
        "scores",
        """
        SELECT *, r + f + w AS total,
               CASE WHEN least(r, f, w) = 4 THEN 'Champions'
                    WHEN r > 2 AND f > 2 THEN 'Loyal'
                    WHEN f > 2 THEN 'At risk'
                    WHEN r > 2 THEN 'New / occasional'
                    ELSE 'Other' END AS segment
        FROM scores
        """,
    ),
    "deciles": (
        "spend",
        "SELECT *, ntile(10) OVER (ORDER BY monetary DESC, customer_id) AS decile FROM spend",
    ),
    "visits": (
        "money",
        """
        SELECT DISTINCT customer_key, date_trunc('month', invoice_timestamp)::DATE AS month
        FROM money WHERE sold AND customer_key IS NOT NULL
        """,
    ),
    "cohorts": (
        "visits money",
        """
        WITH firsts AS (SELECT customer_key, min(month) AS cohort FROM visits GROUP BY customer_key),
             sizes AS (SELECT cohort, count(*) AS size FROM firsts GROUP BY cohort),
             cells AS (SELECT cohort, month, count(*) AS n FROM visits JOIN firsts USING (customer_key)
                       GROUP BY cohort, month)
        SELECT cohort AS cohort_month, month AS activity_month,
               datediff('month', cohort, month) AS month_index, size AS cohort_size,
               n AS returning_customers,
               round(CAST(100.0 * n / size AS DECIMAL(38,10)), 2) AS retention_pct,
               (SELECT date_trunc('month', max(invoice_timestamp))::DATE FROM money WHERE sold)
                   AS dataset_last_month
        FROM cells JOIN sizes USING (cohort)
        """,
    ),
    "dedup": (
        "money",
        """
        SELECT * FROM money WHERE sold
        QUALIFY row_number() OVER (PARTITION BY invoice_no, product_key, customer_key, country_key,
            invoice_timestamp, quantity, unit_price ORDER BY source_row_id) = 1
        """,
    ),
    "versions": (
        "money dedup",
        """
        SELECT dataset_version, revenue, order_count, units_sold,
               CASE WHEN order_count > 0 THEN
                   round(CAST(CAST(revenue AS DOUBLE) / order_count AS DECIMAL(38,10)), 2) END
                   AS average_order_value
        FROM (SELECT 'complete_dataset' AS dataset_version, coalesce(sum(line_revenue), 0) AS revenue,
                     count(DISTINCT invoice_no) AS order_count, coalesce(sum(quantity), 0) AS units_sold
              FROM money WHERE sold
              UNION ALL
              SELECT 'deduplicated', coalesce(sum(line_revenue), 0), count(DISTINCT invoice_no),
                     coalesce(sum(quantity), 0) FROM dedup)
        """,
    ),
    "delta": (
        "versions",
        """
        SELECT c.revenue - d.revenue AS revenue_difference,
               c.order_count - d.order_count AS order_count_difference,
               c.units_sold - d.units_sold AS units_sold_difference,
               c.average_order_value - d.average_order_value AS average_order_value_difference,
               c.revenue AS complete_revenue, d.revenue AS deduplicated_revenue
        FROM versions c JOIN versions d
          ON c.dataset_version = 'complete_dataset' AND d.dataset_version = 'deduplicated'
        """,
    ),
    "exact": (
        "cleaned",
        """
        SELECT round(sum(v) FILTER (transaction_status = 'valid_sale'), 2) AS gross,
               round(sum(v) FILTER (transaction_status = 'cancellation'), 2) AS cancel,
               round(sum(v) FILTER (transaction_status = 'potential_return'), 2) AS back,
               round(sum(v) FILTER (transaction_status = 'non_standard'), 2) AS odd
        FROM (SELECT transaction_status, CAST(quantity AS DECIMAL(10,0)) * unit_price AS v FROM cleaned)
        """,
    ),
}


def _needed(names: str, found: list[str]) -> list[str]:
    for name in names.split():
        if name not in found:
            _needed(TABLES[name][0], found)
            found.append(name)
    return found


def statement(columns: str, reads: str, body: str) -> str:
    """A full statement: the table expressions it reads, and typed output columns.

    ``columns`` lists ``name:type`` pairs with one-letter types.
    """
    parts = [f"{name} AS ({TABLES[name][1].strip()})" for name in _needed(reads, [])]
    typed = []
    for pair in columns.split():
        name, kind = pair.split(":")
        typed.append(f'CAST("{name}" AS {_TYPES[kind]}) AS "{name}"')
    prefix = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return f"{prefix}SELECT {', '.join(typed)}\nFROM ({body.strip()}) AS answer"
