from __future__ import annotations

import re
from decimal import Decimal

import pytest
from conftest import CLASS_ROWS, UK, raw_frame, rows_of
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline.operators import cleaning
from tallyline.operators.cleaning import clean, normalise
from tallyline.operators.copies import expand_copies
from tallyline.plans import profile, rules
from tallyline.sources.testdata import raw_lines


@pytest.fixture(scope="module")
def cleaned(class_raw):
    return clean(class_raw).cache()


def test_contract_and_row_count(class_raw, cleaned):
    assert cleaned.columns == C.CLEANED_COLUMNS
    assert cleaned.count() == class_raw.count() == len(CLASS_ROWS)


def test_statuses_and_revenue(cleaned):
    found = {
        (r["invoice_no"], r["stock_code"]): (r["transaction_status"], r["line_revenue"])
        for r in rows_of(cleaned)
    }
    assert found == {
        ("850001", "72001"): ("valid_sale", Decimal("12.00")),
        ("850002", "POST"): ("valid_sale", Decimal("6.50")),
        ("850003", "72002"): ("valid_sale", Decimal("14.50")),
        ("C850004", "72001"): ("cancellation", Decimal("-4.00")),
        ("C850005", "72002"): ("cancellation", Decimal("7.25")),
        ("850006", "72003"): ("potential_return", Decimal("0.00")),
        ("850007", "72004"): ("non_standard", Decimal("0.00")),
        ("X850008", "72005"): ("non_standard", Decimal("33.00")),
        ("850009", "72006"): ("non_standard", Decimal("0.00")),
        ("850010", "72007"): ("non_standard", Decimal("8.50")),
    }


def test_flags(cleaned):
    counts = cleaned.agg(*[F.count_if(f).alias(f) for f in C.FLAGS]).first().asDict()
    assert counts == {
        "flag_missing_customer_id": 4,
        "flag_missing_description": 1,
        "flag_non_positive_price": 2,
        "flag_zero_quantity": 1,
        "flag_duplicate_candidate": 2,
        "flag_non_standard_invoice_format": 1,
        "flag_non_standard_stock_code": 1,
    }
    duplicated = cleaned.filter("flag_duplicate_candidate").select("invoice_no").distinct()
    assert [r[0] for r in duplicated.collect()] == ["850001"]


def test_ids_are_contiguous_and_repeatable(class_raw, cleaned):
    first = sorted(cleaned.collect())
    assert [r["source_row_id"] for r in first] == list(range(len(CLASS_ROWS)))
    assert sorted(clean(class_raw).collect()) == first


def test_text_is_stripped_of_all_white_space(spark):
    rows = [
        ("\t1 ", " A　", " \n ", 1, "2011-01-01", 1.0, 1, " X\x1f"),
        ("2", "B", "café ", 1, "2011-01-01", 1.0, 1, "Éire"),
    ]
    found = rows_of(normalise(raw_frame(spark, rows)), "stock_code")
    assert (found["A"]["invoice_no"], found["A"]["description"], found["A"]["country"]) == ("1", None, "X")
    assert (found["B"]["description"], found["B"]["country"]) == ("café", "Éire")


def test_fractional_customer_is_an_error(spark):
    raw = raw_frame(spark, [("1", "2", "x", 1, "2011-01-01", 1.0, 1.5, UK)])
    with pytest.raises(Exception, match="not whole"):
        normalise(raw).collect()


def test_pennies_round_half_up(spark):
    prices = [1.005, 2.675, 0.005, 1.004]
    rows = [(f"60000{i}", "1", "x", 1, "2011-01-01", p, 1, UK) for i, p in enumerate(prices)]
    got = rows_of(clean(raw_frame(spark, rows)), "invoice_no")
    assert [str(got[f"60000{i}"]["line_revenue"]) for i in range(4)] == ["1.01", "2.68", "0.01", "1.00"]


def test_prices_keep_their_digits_until_the_product(spark):
    rows = [("620001", "1", "x", 1000, "2012-05-01", 0.00005, 1, UK), ("620002", "1", "x", 1, "2012-05-01", 0.00004, 1, UK)]
    got = rows_of(clean(raw_frame(spark, rows)), "invoice_no")
    assert got["620001"]["line_revenue"] == Decimal("0.05")
    assert got["620002"]["transaction_status"] == "valid_sale" and not got["620002"]["flag_non_positive_price"]


def test_exact_sum_of_many_tenths(spark):
    many = spark.range(1000).select(
        F.lit(1).alias("quantity"),
        F.lit("0.1").cast("decimal(12,4)").alias("unit_price"),
        F.lit(C.VALID_SALE).alias("transaction_status"),
    )
    assert profile.exact_revenue(many).first()["gross_sales_revenue"] == Decimal("100.00")


def test_heavily_repeated_lines_are_chunked(spark, tmp_path):
    path = str(tmp_path / "counted")
    spark.createDataFrame([("a", 1), ("b", 25), ("c", 7)], "k string, copies bigint").write.parquet(path)
    counted = spark.read.parquet(path)
    out = expand_copies(counted, "copies", "no", chunk=7)
    got = {k: sorted(r["no"] for r in out.filter(F.col("k") == k).collect()) for k in "abc"}
    assert got == {"a": [1], "b": list(range(1, 26)), "c": list(range(1, 8))}


def test_summary(class_raw, cleaned):
    found = {
        (r["section"], r["metric"]): r["value"] for r in rows_of(profile.cleaning_summary(cleaned))
    }
    expected = {
        ("rows", "raw"): 11, ("rows", "cleaned"): 11,
        ("status_count", "valid_sale"): 4, ("status_count", "cancellation"): 2,
        ("status_count", "potential_return"): 1, ("status_count", "non_standard"): 4,
        ("status_pct", "non_standard"): Decimal("36.36"),
        ("exceptions", "cancellation_exceptions"): 1, ("exceptions", "invoice_format_exceptions"): 1,
        ("duplicates", "candidate_row_count"): 2, ("duplicates", "distinct_group_count"): 1,
        ("duplicates", "largest_group_size"): 2,
        ("revenue", "gross_sales_revenue"): 45, ("revenue", "cancellation_value"): Decimal("3.25"),
        ("revenue", "potential_return_value"): 0, ("revenue", "non_standard_value"): Decimal("41.50"),
        ("revenue", "net_revenue"): Decimal("48.25"),
    }
    assert {k: found[k] for k in expected} == expected


def test_invariants_hold_and_each_break_is_seen(class_raw, cleaned):
    rules.validate_cleaned(class_raw, cleaned)
    rules.require_row_count(class_raw, cleaned)
    shifted = F.when(F.col("source_row_id") == 3, 99).otherwise(F.col("source_row_id"))
    broken = {
        "row_count_preserved": cleaned.filter("source_row_id < 9"),
        "contiguous_source_row_id": cleaned.withColumn("source_row_id", shifted),
        "known_status": cleaned.withColumn("transaction_status", F.lit("other")),
        "line_revenue_consistent": cleaned.withColumn("line_revenue", F.col("line_revenue") + 1),
    }
    for name, table in broken.items():
        with pytest.raises(C.ContractError, match=name):
            rules.validate_cleaned(class_raw, table)
    with pytest.raises(C.ContractError, match="row count"):
        rules.require_row_count(class_raw, broken["row_count_preserved"])


def test_cleaning_warnings(cleaned):
    found = {r["rule"]: (r["row_count"], r["severity"]) for r in rows_of(rules.cleaning_warnings(cleaned))}
    assert found == {
        "non_standard_transactions": (4, "warning"),
        "potential_return_zero_value": (1, "info"),
        "cancellation_exceptions": (1, "warning"),
        "non_standard_invoice_format": (1, "warning"),
        "duplicate_candidates": (2, "warning"),
        "non_standard_stock_code": (1, "info"),
    }


@pytest.mark.parametrize("heavy", [False, True])
def test_numbers_of_lines_with_many_copies(spark, tmp_path, monkeypatch, heavy):
    """A third of all lines are equal, others are equal in all but one column, some columns are null."""
    if heavy:
        monkeypatch.setattr(cleaning, "COPIES_A_TASK", 5)
    rows = [(f"70{i % 40:04}", f"5{i % 7}", None if i % 5 == 0 else f"t{i % 3}", i % 4, None if i % 9 == 0 else f"2012-0{1 + i % 6}-01 10:00", 1.5, None if i % 3 else i % 6, UK) for i in range(600)]
    rows += [("700001", "51", "same", 1, "2012-03-01 10:00", 2.0, 5, UK)] * 300
    raw_frame(spark, rows).repartition(5).write.parquet(str(tmp_path / "raw"))
    lines = normalise(spark.read.parquet(str(tmp_path / "raw")))
    got = cleaning.number_lines(lines)
    order = [F.col(c).asc_nulls_first() for c in cleaning.LINE_ORDER]
    want = lines.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("source_row_id"), *C.LINE_COLUMNS)
    want = want.withColumn("flag_duplicate_candidate", F.count("*").over(Window.partitionBy(*C.LINE_COLUMNS)) > 1)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and ("Union" in plan) == heavy


def test_numbers_of_no_lines(spark):
    assert clean(raw_frame(spark, [])).collect() == []


def test_lines_are_shuffled_once(spark, tmp_path):
    """Lines are numbered after one shuffle by range, unless a range is too large for a task."""
    raw_frame(spark, CLASS_ROWS).write.parquet(str(tmp_path / "raw"))
    plan = clean(spark.read.parquet(str(tmp_path / "raw")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(_range" in plan


def test_comparing_ids_shuffles_words_only(cleaned, class_raw):
    """Neither the invariants nor the reconciliation send every id through a shuffle."""
    for checks in (rules.cleaned_invariants(class_raw, cleaned), rules.reconcile(cleaned, cleaned.withColumn("customer_key", F.col("customer_id")))):
        plan = checks._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(source_row_id" not in plan and "bit_or(" in plan


def test_lines_join_orders_that_know_their_country(spark, tmp_path):
    """Joined without broadcasts, lines meet orders and parts only; the rows are those of the joins one after the other."""
    tables = {
        "lineitem": "SELECT id div 3 AS l_orderkey, id % 5 AS l_partkey, CAST(id % 3 AS INT) AS l_linenumber, 2.0D AS l_quantity, 7.0D * id AS l_extendedprice, IF(id % 4 = 0, 'R', 'N') AS l_returnflag FROM range(60)",
        "orders": "SELECT id div 2 AS o_orderkey, id % 4 AS o_custkey, TIMESTAMP '1996-01-01' AS o_orderdate FROM range(30)",
        "customer": "SELECT id AS c_custkey, CAST(id % 2 AS INT) AS c_nationkey FROM range(3)",
        "nation": "SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name FROM range(2)",
        "part": "SELECT id AS p_partkey, concat('part ', id) AS p_name FROM range(4)",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{name}.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = raw_lines(spark, str(tmp_path))
        plan = lines._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.findall(r"SortMergeJoin \[(\w+)#", plan) == ["l_partkey", "l_orderkey", "c_nationkey", "o_custkey"]
    read = {name: spark.read.parquet(str(tmp_path / f"{name}.parquet")) for name in tables}
    met = read["lineitem"].join(read["orders"], F.expr("l_orderkey = o_orderkey")).join(read["customer"], F.expr("o_custkey = c_custkey"))
    met = met.join(read["nation"], F.expr("c_nationkey = n_nationkey")).join(read["part"], F.expr("l_partkey = p_partkey"))
    want = met.select(F.expr("IF(l_orderkey % 211 = 0, 2, 1)").alias("n"), "n_name").groupBy("n_name").agg(F.sum("n"))
    assert sorted(map(tuple, lines.groupBy("Country").count().collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("shared", [False, True])
def test_times_bound_ranges_unless_many_lines_share_one(spark, tmp_path, shared):
    """Where times differ, one column tells a line's range; ids are those of the whole order either way."""
    rows = [(f"71{i % 40:04}", f"5{i % 7}", None if i % 5 == 0 else f"t{i % 3}", i % 4, None if i % 50 == 0 else f"2012-03-{1 + i % 28:02} 1{i % 10}:{i % 59:02}", 1.5, i % 6, UK) for i in range(2000)]
    rows += [("710001", "51", "same", i % 3, "2012-03-09 10:00", 2.0, 5, UK) for i in range(900 if shared else 3)]
    raw_frame(spark, rows).repartition(5).write.parquet(str(tmp_path / "raw"))
    lines = normalise(spark.read.parquet(str(tmp_path / "raw")))
    wanted = cleaning.LINE_ORDER if shared else ["invoice_date"]
    assert list(cleaning.line_ranges(lines, 16).columns) == wanted
    order = [F.col(c).asc_nulls_first() for c in cleaning.LINE_ORDER]
    want = lines.select((F.row_number().over(Window.orderBy(*order)) - 1).cast("bigint").alias("source_row_id"), *C.LINE_COLUMNS)
    got = cleaning.number_lines(lines).drop("flag_duplicate_candidate")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_times_of_lines_are_made_once_an_order(spark, tmp_path):
    """The time of an invoice is computed before orders meet their lines, of which there are more."""
    tables = {
        "lineitem": "SELECT id div 3 AS l_orderkey, id % 4 AS l_partkey, CAST(id % 3 AS INT) AS l_linenumber, 2.0D AS l_quantity, 7.0D AS l_extendedprice, 'N' AS l_returnflag FROM range(12)",
        "orders": "SELECT id AS o_orderkey, 0L AS o_custkey, TIMESTAMP_NTZ '1996-01-31' AS o_orderdate FROM range(4)",
        "customer": "SELECT 0L AS c_custkey, 0 AS c_nationkey",
        "nation": "SELECT 0 AS n_nationkey, 'N' AS n_name",
        "part": "SELECT id AS p_partkey, concat('part ', id) AS p_name FROM range(4)",
    }
    for name, text in tables.items():
        spark.sql(text).write.parquet(str(tmp_path / f"{name}.parquet"))
    lines = raw_lines(spark, str(tmp_path))
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join Inner, (l_orderkey") < plan.index("make_interval")
    times = {str(r["InvoiceDate"]) for r in lines.collect()}
    assert times == {f"1996-01-31 00:0{i}:00" for i in range(4)}
