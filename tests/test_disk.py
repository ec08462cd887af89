"""What a load leaves on disk, and how much of it at a time."""

from __future__ import annotations

import time

from conftest import CLASS_ROWS, SALES_ROWS, raw_frame, rows_of
from pyspark.sql import functions as F

from tallyline import catalog, pipeline, session, warehouse
from tallyline.operators.cleaning import clean
from tallyline.plans import quality
from tallyline.plans import star as build
from tallyline.warehouse import Warehouse


def test_batches_of_lines_make_the_same_fact(spark, tmp_path, monkeypatch):
    """Where dimensions are joined by shuffle, the fact is built some lines at a time."""
    cleaned = clean(raw_frame(spark, SALES_ROWS + CLASS_ROWS[:-1]))
    whole = Warehouse(spark, str(tmp_path / "whole")).load(cleaned)
    made, sizes = build.build_fact, []
    monkeypatch.setattr(warehouse, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(warehouse, "LINES_A_BATCH", 4)
    monkeypatch.setattr(build, "build_fact", lambda lines, *a, **k: (sizes.append(lines.count()), made(lines, *a, **k))[1])
    parts = Warehouse(spark, str(tmp_path / "parts")).load(cleaned)
    assert max(sizes) <= 4 and sum(sizes) == cleaned.count()
    assert rows_of(parts.star.by_month, "source_row_id") == rows_of(whole.star.by_month, "source_row_id")
    assert parts.rewritten == whole.rewritten
    apart = cleaned.withColumn("source_row_id", F.col("source_row_id") * F.col("source_row_id") * 10**9 - 5)
    found = warehouse._batches(apart, 3)
    ids = [r[0] for part in found for r in part.select("source_row_id").collect()]
    assert sorted(ids) == sorted(r[0] for r in apart.select("source_row_id").collect())
    assert [part.count() for part in warehouse._batches(cleaned.limit(0), 3)] == [0]


def _shuffle_files(spark) -> int:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return manager.getAllFiles().mkString(" ").count("/shuffle_")


def test_shuffle_files_of_a_load_do_not_stay(spark, tmp_path):
    """Without a garbage collection in between; the session's setting is as it was afterwards."""
    before = spark.conf.get(session._CLEANUP)
    kept = _shuffle_files(spark)
    pipeline.run(spark, lambda: raw_frame(spark, SALES_ROWS).repartition(3, "InvoiceNo"), str(tmp_path / "run"))
    until = time.time() + 20
    while _shuffle_files(spark) > kept and time.time() < until:
        time.sleep(0.2)
    assert _shuffle_files(spark) <= kept
    assert spark.conf.get(session._CLEANUP) == before
    for table in ("raw", "cleaned", "warehouse/fact_sales"):
        assert list((tmp_path / "run" / table).rglob("*.zstd.parquet"))


def test_shuffle_files_of_an_export_do_not_stay(spark, sales_tables):
    seen = []
    builders = {"dim_date": lambda star: (seen.append(spark.conf.get(session._CLEANUP)), star.dates)[1]}
    _, _, done = catalog._export(sales_tables, builders)
    assert seen == ["true"] and done[0].row_count == sales_tables.star.dates.count()
    assert spark.conf.get(session._CLEANUP) == "false"


def test_invoices_are_counted_from_lines(sales_tables):
    """Lines of an invoice lie together; groups of repeated lines, once shuffled, do not."""
    found = quality.duplicate_sensitivity(sales_tables.star.fact)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    totals = [line for line in plan.splitlines() if "sum(all_revenue" in line]
    assert totals and not any("distinct" in line for line in totals)
    orders = {r["order_count"] for r in found.collect()}
    sales = quality.with_status(sales_tables.star.fact, "valid_sale")
    assert orders == {sales.select("invoice_no").distinct().count()}
    assert {r["order_count"] for r in quality.duplicate_sensitivity(sales_tables.star.fact.limit(0)).collect()} == {0}
