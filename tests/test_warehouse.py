from __future__ import annotations

from decimal import Decimal
from pathlib import Path

import pytest
from conftest import SALES_ROWS, UK, raw_frame, rows_of
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline import pipeline, store
from tallyline.operators.cleaning import clean
from tallyline.plans import measures
from tallyline.plans import star as build
from tallyline.session import concurrently, path_missing, scratch_root
from tallyline.warehouse import Warehouse


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"))


def _clean(spark, rows):
    return clean(raw_frame(spark, rows))


def test_reload_changes_nothing(spark, warehouse):
    cleaned = _clean(spark, SALES_ROWS)
    first = warehouse.load(cleaned)
    second = warehouse.load(cleaned)
    assert (first.version, second.version) == (1, 2)
    for name, table in first.star.tables().items():
        assert sorted(map(str, table.collect())) == sorted(map(str, second.star.tables()[name].collect()))


def test_missing_customer_keeps_a_null_key(spark, warehouse):
    rows = [*SALES_ROWS, ("810107", "51010", "CLAY POT", 1, "2013-06-20", 3.0, None, UK)]
    star = warehouse.load(_clean(spark, rows)).star
    assert star.fact.filter("customer_key IS NULL").count() == 1
    assert star.customers.count() == 3
    price = star.fact.schema["unit_price"].dataType
    assert (price.precision, price.scale) == (12, 4)


def test_second_load_updates_inserts_and_keeps(spark, warehouse):
    """A changed description, a new product that sorts first, and a vanished line."""
    cleaned = _clean(spark, SALES_ROWS)
    old = warehouse.load(cleaned).star
    changed = (
        cleaned.filter("source_row_id < 7")
        .withColumn("description", F.when(F.col("stock_code") == "51020", "RENAMED").otherwise(F.col("description")))
        .withColumn("stock_code", F.when(F.col("source_row_id") == 5, "10000").otherwise(F.col("stock_code")))
    )
    new = warehouse.load(changed, allow_vanished=True).star
    assert new.fact.count() == 8
    before, after = rows_of(old.products, "stock_code"), rows_of(new.products, "stock_code")
    assert after["51010"]["product_key"] == before["51010"]["product_key"]
    assert after["51020"]["description"] == "RENAMED"
    assert after["10000"]["product_key"] == 4
    assert not all(r["passed"] for r in warehouse.load(changed, allow_vanished=True).reconciliation.collect())


def test_failed_load_leaves_the_published_version(spark, warehouse):
    cleaned = _clean(spark, SALES_ROWS)
    warehouse.load(cleaned)
    undated = cleaned.withColumn("invoice_date", F.lit(None).cast("timestamp_ntz"))
    with pytest.raises(C.ContractError, match="invoice_date"):
        warehouse.load(undated)
    odd = cleaned.withColumn("transaction_status", F.lit("unheard of"))
    with pytest.raises(C.ContractError, match="unknown_status"):
        warehouse.load(odd)
    assert warehouse.current_version() == 1
    assert warehouse.star().fact.count() == 8
    assert warehouse.load(cleaned).version == 3  # number 2 holds the failed load's files


def test_missing_contract_columns(spark, warehouse):
    with pytest.raises(C.ContractError, match="line_revenue"):
        warehouse.load(_clean(spark, SALES_ROWS).drop("line_revenue"))
    with pytest.raises(C.ContractError, match="nothing has been published"):
        warehouse.star()


def test_guards_see_dangling_keys(sales_tables):
    star = sales_tables.star
    assert build.broken_references(star).filter("rows > 0").count() == 0
    cut = C.Star(star.fact, star.dates, star.countries, star.customers.limit(0), star.products)
    for broadcast in (False, True):
        found = rows_of(build.broken_references(cut, broadcast).filter("rows > 0"))
        assert found == [{"guard": "orphan_customer", "rows": 8}]
    every = {b: sorted(map(str, build.broken_references(star, b).collect())) for b in (False, True)}
    assert every[False] == every[True]


def test_most_frequent_description_and_ties(spark):
    texts = {"1": ["b", "b", "a"], "2": ["z", "y"], "3": [None, None, "x"], "4": [None]}
    rows = [
        (f"{i}", code, text, 1, "2011-01-01", 1.0, 1, UK)
        for code, listed in texts.items()
        for i, text in enumerate(listed)
    ]
    found = rows_of(build.product_members(_clean(spark, rows)), "stock_code")
    assert {k: (v["description"], v["description_variant_count"]) for k, v in found.items()} == {
        "1": ("b", 2), "2": ("y", 2), "3": ("x", 1), "4": (None, 0),
    }


def test_join_strategies_agree(spark, public_tables):
    """Broadcast and shuffle joins give the same fact, lines without a customer included."""
    t, s = public_tables, public_tables.star
    small = build.build_fact(t.cleaned, s.countries, s.customers, s.products, broadcast=True)
    wanted = sorted(map(str, small.collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = build.build_fact(t.cleaned, s.countries, s.customers, s.products)
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "hashpartitioning(_match" in plan
        assert sorted(map(str, shuffled.collect())) == wanted
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert small.filter("customer_key IS NULL").count() == 1
    assert small.agg(F.sum("line_revenue")).first()[0] == Decimal("65.50")


def test_each_gate_stops_the_pipeline(spark, tmp_path, monkeypatch):
    """A fault at any stage raises and leaves the version that was published."""
    folder = str(tmp_path / "run")
    published = Warehouse(spark, f"{folder}/warehouse")
    published.load(_clean(spark, SALES_ROWS))

    def runs(change=lambda df: df):
        return pipeline.run(spark, lambda: change(raw_frame(spark, SALES_ROWS)), folder)

    stages = (("raw", "structural"), ("cleaned", "line_revenue_consistent"), ("fact", "does not reconcile"))
    for name, match in stages:
        folder = str(tmp_path / f"run-{name}")
        monkeypatch.setattr(pipeline, "Warehouse", lambda s, _: published)
        with monkeypatch.context() as m, pytest.raises(C.ContractError, match=match):
            if name == "cleaned":
                m.setattr(pipeline, "clean", lambda raw: clean(raw).withColumn("line_revenue", F.lit(7).cast("decimal(14,2)")))
            if name == "fact":
                made = build.build_fact
                m.setattr(build, "build_fact", lambda *a, **k: made(*a, **k).withColumn("line_revenue", F.lit(7).cast("decimal(14,2)")))
            runs((lambda df: df.drop("Country").withColumn("Country", F.lit(3))) if name == "raw" else (lambda df: df))
        assert published.current_version() == 1


def test_years_prune_partitions(spark, sales_tables):
    part = sales_tables.star.during(2013, 2013).fact
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert part.columns == C.FACT_COLUMNS and part.count() == 8
    assert sales_tables.star.during(2014, 2015).fact.count() == 0


def test_lines_without_a_customer_are_spread(spark, sales_tables):
    star = sales_tables.star
    nobody = star.fact.withColumn("customer_key", F.when(F.col("source_row_id") < 0, F.col("customer_key")))
    segments = star.customers.select("customer_key", F.lit("s").alias("rfm_segment_heuristic"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = measures.with_segment(nobody, segments)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        left = plan.split("SortMergeJoin")[1]
        keys = [part.split("#")[0] for part in left.split("hashpartitioning(")[1:]]
        assert keys == ["_meet", "_meet"] and "_meet" in left.splitlines()[0]
        meet = F.coalesce(F.col("customer_key"), -1 - F.col("source_row_id"))
        assert nobody.select(meet).distinct().count() == 8  # a key of its own for every line
        assert joined.filter("rfm_segment_heuristic IS NULL").count() == 8
        assert joined.columns == [*star.fact.columns, "rfm_segment_heuristic"]
        assert measures.with_segment(star.fact, segments).filter("rfm_segment_heuristic = 's'").count() == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_only_missing_paths_are_passed_over(spark, tmp_path):
    with path_missing():
        spark.read.parquet(str(tmp_path / "nothing"))
    with pytest.raises(AnalysisException), path_missing():
        spark.range(1).select("unheard_of")


def _files(warehouse):
    """Data files of the fact and when they were written."""
    return {str(p): p.stat().st_mtime_ns for p in Path(warehouse.root, "fact_sales").rglob("*.parquet")}


def _at(changed, when):
    return changed.withColumn("invoice_date", F.when(when, F.lit("2013-06-30 10:00:00").cast("timestamp_ntz")).otherwise(F.col("invoice_date")))


def test_only_touched_months_are_written(spark, warehouse):
    cleaned = _clean(spark, SALES_ROWS)
    first = warehouse.load(cleaned)
    assert first.rewritten == [(2013, 6), (2013, 7)]
    before = _files(warehouse)
    # Nothing changed: no line is written, the version points to the folders of the one before.
    assert warehouse.load(cleaned).rewritten == []
    assert _files(warehouse) == before and warehouse.months(2) == warehouse.months(1)
    # A changed line in July.
    changed = cleaned.withColumn("quantity", F.when(F.col("source_row_id") == 6, 60).otherwise(F.col("quantity")))
    changed = changed.withColumn("line_revenue", F.when(F.col("source_row_id") == 6, F.lit("180.00").cast("decimal(14,2)")).otherwise(F.col("line_revenue")))
    third = warehouse.load(changed)
    assert third.rewritten == [(2013, 7)]
    after = _files(warehouse)
    assert {f: t for f, t in after.items() if f in before} == before
    assert all("v=3" in f and "month=7" in f for f in after if f not in before)
    assert warehouse.months(3)[2013, 6] == warehouse.months(1)[2013, 6]
    assert rows_of(third.star.fact, "source_row_id")[6]["quantity"] == 60 and third.star.fact.count() == 8
    # A line that moves from July to June touches both.
    fourth = warehouse.load(_at(changed, F.col("source_row_id") == 6))
    assert fourth.rewritten == [(2013, 6), (2013, 7)] and fourth.star.fact.count() == 8
    # A load of June alone leaves July as it is.
    fifth = warehouse.load(changed.filter("source_row_id < 4"), allow_vanished=True)
    assert fifth.rewritten == [] and fifth.star.fact.count() == 8
    everything = sorted(map(str, warehouse.star().fact.collect()))
    gone = warehouse.drop_before(5)
    assert {p.split("/")[-1] for p in gone} >= {"v=1", "v=4", "month=6", "month=7"}
    assert sorted(map(str, warehouse.star().fact.collect())) == everything
    with pytest.raises(AnalysisException):
        warehouse.star(1).fact.count()
    assert warehouse.load(changed).version == 6


def test_a_month_can_become_empty(spark, warehouse):
    cleaned = _clean(spark, SALES_ROWS)
    warehouse.load(cleaned)
    moved = _at(cleaned, F.col("source_row_id") >= 4)
    assert warehouse.load(moved).rewritten == [(2013, 6)]
    assert list(warehouse.months(2)) == [(2013, 6)] and warehouse.star().fact.count() == 8


@pytest.mark.parametrize("loaded", [False, True])
def test_one_of_two_loads_from_one_version_wins(spark, warehouse, monkeypatch, loaded):
    """The second load begins and ends while the first one is checking its lines."""
    cleaned = _clean(spark, SALES_ROWS)
    if loaded:
        warehouse.load(cleaned.filter("source_row_id < 3"))
    guards = build.broken_references
    inner = []

    def meanwhile(*args):
        if not inner:
            inner.append(None)
            inner[0] = warehouse.load(cleaned)
        return guards(*args)

    monkeypatch.setattr(build, "broken_references", meanwhile)
    with pytest.raises(C.ContractError, match="another load"):
        warehouse.load(cleaned)
    assert warehouse.current_version() == inner[0].version and warehouse.star().fact.count() == 8
    assert warehouse.load(cleaned).version > inner[0].version


def test_a_claim_has_one_owner(spark, tmp_path):
    path = f"{tmp_path}/claims/one"
    assert sorted(concurrently([lambda: store.claim(spark, path)] * 12, at_once=12)) == [False] * 11 + [True]
    with pytest.raises(C.ContractError, match="another load"), store.sole_successor(spark, path, lambda: True, "load"):
        pass
    store.remove(spark, path)
    with pytest.raises(RuntimeError), store.sole_successor(spark, path, lambda: True, "load"):
        raise RuntimeError
    assert store.claim(spark, path)  # a failed block gave it back


def test_a_writer_that_died_while_publishing(spark, warehouse):
    cleaned = _clean(spark, SALES_ROWS)
    warehouse.load(cleaned)
    assert store.claim(spark, f"{warehouse.root}/claims/after-1")
    with pytest.raises(C.ContractError, match="another load"):
        warehouse.load(cleaned)
    warehouse.release()
    assert warehouse.load(cleaned).star.fact.count() == 8


def test_no_scratch_is_left(spark, tmp_path):
    def left():
        return set(store.matching(spark, f"{scratch_root(spark)}/*"))

    before = left()
    pipeline.run(spark, lambda: raw_frame(spark, SALES_ROWS), str(tmp_path / "run"))
    assert left() == before
    with pytest.raises(C.ContractError):
        pipeline.run(spark, lambda: raw_frame(spark, SALES_ROWS).withColumn("Country", F.lit(3)), str(tmp_path / "bad"))
    assert left() == before
