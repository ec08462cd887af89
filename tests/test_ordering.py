from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline.operators import ordering
from tallyline.operators.ordering import (
    Ranges, distinct_ids, fits_one_task, number_rows, percentile_at, rank_rows, ranked_values, tile_rows,
)
from tallyline.session import stash


@pytest.fixture(scope="module")
def values(spark):
    """Unique ids, two groups of very different size, and a value a third of the rows share."""
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(500)))
    group = F.when(F.col("id") % 50 == 0, "small").otherwise("big")
    frame = spark.range(6000).select("id", value.cast("int").alias("v"), group.alias("g"))
    # a null group and a null value must keep their place
    odd = spark.createDataFrame([(6000, None, "big"), (6001, 3, None)], "id bigint, v int, g string")
    return stash(frame.unionByName(odd).repartition(7), "values")


def _same(left, right, columns):
    wanted = sorted(map(tuple, right.select(*columns).collect()), key=str)
    assert sorted(map(tuple, left.select(*columns).collect()), key=str) == wanted


@pytest.mark.parametrize("within", [[], ["g"]])
def test_row_numbers(spark, values, within):
    order = [F.col("v").desc_nulls_last(), F.col("id").asc()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several ranges
    got = number_rows(values, "n", order, within=within, total="of")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    window = Window.partitionBy(*within)
    want = values.withColumn("n", F.row_number().over(window.orderBy(*order)).cast("bigint"))
    want = want.withColumn("of", F.count("*").over(window))
    _same(got, want, ["id", "n", "of"])


@pytest.mark.parametrize("within", [[], ["g"]])
@pytest.mark.parametrize("descending", [True, False])
def test_ranks_with_ties_across_ranges(spark, values, within, descending):
    first = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    got = rank_rows(values, "r", "v", ["id"], descending=descending, within=within)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    window = Window.partitionBy(*within).orderBy(first)
    want = values.withColumn("r", F.rank().over(window).cast("bigint"))
    _same(got, want, ["id", "r"])
    _same(rank_rows(values, "r", "v", ["id"], descending, within, single=True), want, ["id", "r"])


@pytest.mark.parametrize("tiles", [4, 7, 10])
@pytest.mark.parametrize("rows", [3, 6002])
def test_tiles(values, tiles, rows):
    frame = values.orderBy("id").limit(rows)
    order = [F.col("v").asc_nulls_first(), F.col("id").asc()]
    want = frame.withColumn("t", F.ntile(tiles).over(Window.orderBy(*order)))
    _same(tile_rows(frame, "t", tiles, order), want, ["id", "t"])


@pytest.mark.parametrize("fraction", ["0.5", "0.9"])
def test_percentile(values, fraction):
    known = values.filter("v IS NOT NULL")
    numbered = number_rows(known, "n", [F.col("v").asc(), F.col("id").asc()], total="of")
    got = numbered.agg(percentile_at("v", F.col("n"), F.col("of"), fraction)).first()[0]
    want = known.agg(F.percentile("v", float(fraction))).first()[0]
    assert got == pytest.approx(want)


def test_size_check_looks_at_groups(values):
    assert fits_one_task(values)
    assert not fits_one_task(values, limit=6001)
    assert fits_one_task(values, ["g"], limit=5900)
    assert not fits_one_task(values, ["g"], limit=5000)


def test_selected_values(spark, monkeypatch):
    """Any position, with a value that a third of the rows share, nulls, negative and far values."""
    monkeypatch.setattr(ordering, "BUCKETS", 7)
    amount = F.when(F.col("id") % 3 == 0, "12.34").otherwise(F.pmod(F.xxhash64("id"), F.lit(90_000)) / 7 - 2_000)
    frame = spark.range(500).select(F.when(F.col("id") % 10 > 0, amount).cast("decimal(24,2)").alias("v"))
    far = spark.createDataFrame([("99999999999.99",), ("-0.01",)], "v string").select(F.col("v").cast("decimal(24,2)").alias("v"))
    values = stash(frame.unionByName(far), "amounts")
    want = sorted(r["v"] for r in values.filter("v IS NOT NULL").collect())
    places = [0, 1, len(want) // 2, len(want) // 2, len(want) - 2, len(want) - 1]
    assert ranked_values(values, "v", places) == {p: want[p] for p in places}
    assert ranked_values(values.filter("v = 12.34"), "v", [3]) == {3: want[want.index(Decimal("12.34"))]}


@pytest.mark.parametrize("crowded", [False, True])
def test_place_of_rows_among_ranges(spark, tmp_path, crowded):
    """A time tells the range of most rows; null times, equal times and times outside the sample compare with all bounds."""
    hours = F.when(F.col("id") % 3 == 0, F.lit(0)) if crowded else F.col("id") % 700
    at = F.lit("1969-12-20 23:59:59.5").cast("timestamp_ntz") + F.make_interval(hours=F.coalesce(hours, F.col("id") % 700).cast("int"))
    frame = spark.range(4000).select(F.when(F.col("id") % 11 != 0, at).alias("at"), F.when(F.col("id") % 7 != 0, F.col("id") * 37 % 1009).alias("n"))
    frame.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    ranges = Ranges.sampled(rows, ["at", "n"], 40)
    assert ranges.cells is not None
    outside = spark.sql("SELECT CAST(t AS TIMESTAMP_NTZ) AS at, 1L AS n FROM VALUES ('1901-01-01'), ('2100-01-01 10:00:00.25') AS v(t)")
    placed = ranges.place(rows.unionByName(outside)).withColumn("want", ranges.number())
    assert placed.filter("NOT _range <=> want").isEmpty()
    assert placed.columns == ["at", "n", "_range", "want"] and placed.select("_range").distinct().count() > 30


@pytest.mark.parametrize("span", [20, 900, 86400])
def test_ranges_of_whole_cells(spark, tmp_path, span):
    """Where bounds lie apart, a time's cell tells its range: ranges ascend with the time, nulls first, and no lookup
    among the bounds is left in the plan. Bounds that share a cell stay exact."""
    at = F.lit("1969-12-20 13:59:59.5").cast("timestamp_ntz") + F.make_interval(secs=F.col("id") * span)
    spark.range(4000).select(F.when(F.col("id") % 11 != 0, at).alias("at")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    ranges = Ranges.sampled(rows, ["at"], 40).on_cells()
    assert ranges.whole_cells
    outside = spark.sql("SELECT CAST(t AS TIMESTAMP_NTZ) AS at FROM VALUES ('1901-01-01'), ('1969-12-19 23:00:00'), ('2100-01-01 10:00:00.25') AS v(t)")
    placed = ranges.place(rows.unionByName(outside))
    assert "namedlambda" not in placed._jdf.queryExecution().executedPlan().toString()
    found = [r["_range"] for r in placed.orderBy(F.col("at").asc_nulls_first()).collect()]
    assert found == sorted(found) and set(found) <= set(range(ranges.size + 1)) and len(set(found)) > 30
    assert max(found.count(r) for r in set(found)) < 3 * 4000 / 40 + 4000 / 11
    burst = spark.sql("SELECT explode(array(at, at, at)) AS at FROM (SELECT CAST('2012-01-01' AS TIMESTAMP_NTZ) + make_interval(0, 0, 0, 0, 0, id) AS at FROM range(900))")
    both = stash(rows.unionByName(burst), "burst")
    crowded = Ranges.sampled(both, ["at"], 40).on_cells()
    assert not crowded.whole_cells
    assert crowded.place(both).filter(~F.col("_range").eqNullSafe(crowded.number())).isEmpty()


def test_distinct_ids_travel_as_words(spark):
    odd = [None, None, -1, -1, -64, -65, 0, 63, 64, 2**62, -(2**62), 2**63 - 1, -(2**63)]
    ids = spark.createDataFrame([(i,) for i in odd], "id bigint").unionByName(spark.range(100, 1000)).unionByName(spark.range(500, 700))
    found = distinct_ids(ids, "id")
    assert found.collect() == ids.agg(F.count_distinct("id").alias("ids")).collect()
    assert distinct_ids(ids.filter("id > 5 AND id < 0"), "id").first()["ids"] == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bit_or(" in plan and "hashpartitioning(id" not in plan
