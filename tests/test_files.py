from __future__ import annotations

from functools import partial

import pytest
from conftest import UK, PROFILE_ROWS, raw_frame, rows_of
from pyspark.sql import functions as F

from tallyline import contracts as C
from tallyline import store
from tallyline.plans import customers, extracts
from tallyline.session import concurrently
from tallyline.sources import files, landing


@pytest.fixture(scope="module")
def published(spark, public_tables, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("extracts"))
    tables = {name: make(public_tables.star) for name, make in extracts.PUBLIC.items()}
    return folder, tables, files.export_all(tables, folder)


def test_public_extracts(spark, published):
    folder, tables, done = published
    assert {r.name for r in done} == set(C.EXTRACT_SCHEMAS) and len(done) == 15
    files.assert_no_customer_identifiers(spark, done)
    assert all(files.verify_export(r, tables[r.name]) for r in done)
    for name, table in files.read_all_extracts(spark, folder).items():
        assert table.columns == C.EXTRACT_SCHEMAS[name].fieldNames()
        assert sorted(map(str, table.collect())) == sorted(
            str(r) for r in tables[name].select(
                *[F.col(f.name).cast(f.dataType) for f in C.EXTRACT_SCHEMAS[name].fields]
            ).collect()
        )
    manifest = files.export_manifest(spark, done)
    assert manifest.filter("exported_at IS NOT NULL").count() == 15


def test_customer_extracts_share_their_totals(published, public_tables, monkeypatch):
    """One export of all public extracts sums customers once; its extracts equal those built one by one."""
    made = []
    plain = customers.customer_totals
    monkeypatch.setattr(customers, "customer_totals", lambda star: made.append(star) or plain(star))
    star = public_tables.star
    builders = extracts.public(star)
    built = dict(zip(builders, concurrently([partial(b, star) for b in builders.values()]), strict=True))
    assert len(made) == 1 and list(built) == list(extracts.PUBLIC)
    for name, table in built.items():
        assert sorted(map(str, table.collect())) == sorted(map(str, published[1][name].collect()))


def test_anomalous_extract(published):
    rows = rows_of(published[1]["anomalous_transactions"])
    assert [r["invoice_no"] for r in rows] == ["B830506"]
    assert not {"customer_id", "customer_key", "source_row_id"} & set(rows[0])
    flags = rows_of(published[1]["product_performance"], "stock_code")
    assert flags["POST"]["is_non_merchandise"] and not flags["62001"]["is_non_merchandise"]


def test_leak_and_stale_file_are_caught(spark, tmp_path):
    leaky = spark.createDataFrame([(1, 2)], "customer_id int, n int")
    done = files.export_table("leaky", leaky, str(tmp_path))
    with pytest.raises(C.ContractError, match="leaky.customer_id"):
        files.assert_no_customer_identifiers(spark, [done])
    assert files.verify_export(done, leaky)
    assert not files.verify_export(done, leaky.unionByName(leaky))


def test_bi_model(spark, public_tables, tmp_path):
    tables = {name: make(public_tables.star) for name, make in extracts.BI_MODEL.items()}
    done = {r.name: r for r in files.export_all(tables, str(tmp_path))}
    assert len(done) == 9
    assert (done["fact_sales"].row_count, done["fact_sales"].column_count) == (6, 18)


def test_extract_contracts(spark, tmp_path):
    files.export_table("dim_product", spark.createDataFrame([(1, "x")], "product_key int, stock_code string"), str(tmp_path))
    with pytest.raises(C.ContractError, match="description"):
        files.read_extract(spark, "dim_product", str(tmp_path))
    with pytest.raises(C.ContractError, match="cannot be read"):
        files.read_extract(spark, "monthly_revenue", str(tmp_path))
    files.check_extract("unlisted", spark.range(1))


def test_quotes_and_line_breaks_survive_csv(spark, tmp_path):
    text = 'say "hi", \\ then\nleave'
    table = spark.createDataFrame([(1, "c", text), (2, "d", None)], "product_key bigint, stock_code string, description string")
    files.export_table("dim_product", table, str(tmp_path))
    back = rows_of(files.read_extract(spark, "dim_product", str(tmp_path)), "stock_code")
    assert back["c"]["description"] == text and back["d"]["description"] is None


def _lines(n, start=0):
    return [(f"61{i:04d}", f"{30_000 + i % 3}", f"ARTICLE {i % 3}", i % 5 + 1, f"2012-05-{i % 28 + 1:02d}", 1.5 + i, 70 + i, UK) for i in range(start, n)]


def test_landing(spark, tmp_path):
    source, other, target = (str(tmp_path / n) for n in ("source", "other", "landing"))
    raw_frame(spark, _lines(9)).coalesce(1).write.parquet(source)
    assert landing.land(spark, source, target).action == "land"
    assert landing.land(spark, f"file:{source}/", target).action == "skip"
    assert landing.landed(spark, target).count() == 9
    first = landing.land(spark, source, target).folder
    assert landing.land(spark, first, target).action == "verified_in_place"
    raw_frame(spark, _lines(9)).drop("Country").write.parquet(other)
    with pytest.raises(C.ContractError, match="Country"):
        landing.land(spark, other, target)


def test_landing_refuses_a_rewritten_source(spark, tmp_path):
    source, part, target = (str(tmp_path / n) for n in ("source", "part", "landing"))
    raw_frame(spark, _lines(9)).write.parquet(source)
    landing.land(spark, source, target)
    raw_frame(spark, _lines(4)).write.parquet(part)
    with pytest.raises(C.ContractError, match="content differs"):
        landing.land(spark, part, target)
    assert landing.landed(spark, target).count() == 9
    assert landing.land(spark, part, target, force=True).action == "overwrite"
    assert landing.landed(spark, target).count() == 4


def test_landing_notices_damaged_and_vanished_data(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "landing")
    raw_frame(spark, _lines(9)).repartition(3).write.parquet(source)
    folder = landing.land(spark, source, target).folder
    raw_frame(spark, _lines(8)).write.mode("overwrite").parquet(folder)
    with pytest.raises(C.ContractError, match="landed data changed"):
        landing.land(spark, source, target)
    assert landing.land(spark, source, target, force=True).action == "overwrite"
    next(p for p in (tmp_path / "source").glob("*.parquet")).unlink()
    with pytest.raises(C.ContractError, match="content differs"):
        landing.land(spark, source, target)


def test_partitioned_extract_lands_once(spark, tmp_path):
    source, target = str(tmp_path / "source"), str(tmp_path / "landing")
    for i in range(3):
        raw_frame(spark, _lines(3 * i + 3, 3 * i)).coalesce(1).write.parquet(f"{source}/day={i}")
    files_ = rows_of(landing.file_manifest(spark, source))
    assert len(files_) == 3 and {f["file"].split("/")[0] for f in files_} == {"day=0", "day=1", "day=2"}
    assert sum(f["rows"] for f in files_) == 9
    assert [landing.land(spark, source, target).action for _ in range(2)] == ["land", "skip"]


def test_one_rule_for_files_of_any_order_and_format(spark, tmp_path):
    a, b, c = (str(tmp_path / n) for n in "abc")
    frame = raw_frame(spark, _lines(9))
    frame.coalesce(1).write.parquet(a)
    frame.orderBy(F.col("InvoiceNo").desc()).repartition(4).write.parquet(b)
    frame.write.option("header", "true").csv(c)
    prints = [landing.extract_fingerprint(landing.read_raw(spark, p, f)) for p, f in ((a, "parquet"), (b, "parquet"), (c, "csv"))]
    assert prints[0] == prints[1] == prints[2] and prints[0][0] == 9
    target = str(tmp_path / "landing")
    assert landing.land(spark, c, target, fmt="csv").action == "land"
    assert landing.land(spark, a, target).action == "skip"
    assert rows_of(landing.file_manifest(spark, c, "csv"))[0]["file"].endswith(".csv")


def test_raw_csv_with_quotes_breaks_and_bad_numbers(spark, tmp_path):
    head = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    good = tmp_path / "good.csv"
    good.write_text(head + '610001,30001,"SAY ""HI"", NOW",2,2012-05-01 10:00:00,2.5,71,France\n610002,30002,"TWO\nLINES",3,2012-05-01 10:00:00,1.5,72,Spain\n')
    found = rows_of(landing.read_raw(spark, str(good), "csv"), "InvoiceNo")
    assert found["610001"]["Description"] == 'SAY "HI", NOW' and found["610001"]["Quantity"] == 2
    assert found["610002"]["Description"] == "TWO\nLINES" and found["610002"]["Country"] == "Spain"
    bad = tmp_path / "bad.csv"
    bad.write_text(head + "610001,30001,A,many,2012-05-01 10:00:00,2.5,71,France\n")
    with pytest.raises(Exception, match="MALFORMED|many"):
        landing.read_raw(spark, str(bad), "csv").collect()


def test_export_has_a_time(spark, tmp_path):
    done = [files.export_table("t", spark.range(2), str(tmp_path))]
    row = files.export_manifest(spark, done).first()
    assert row["exported_at"] is not None and (row["row_count"], row["column_count"]) == (2, 1)


def test_csv_source(spark, tmp_path):
    path = str(tmp_path / "csv")
    raw_frame(spark, PROFILE_ROWS).write.option("header", "true").csv(path)
    raw = landing.read_raw(spark, path, "csv")
    landing.validate_schema(raw)
    assert raw.schema["Quantity"].dataType.simpleString() == "int" and raw.count() == 9


def test_one_of_two_landings_from_one_state_wins(spark, tmp_path, monkeypatch):
    """A second landing begins and ends while the first one is copying."""
    one, two, target = (str(tmp_path / n) for n in ("one", "two", "landing"))
    raw_frame(spark, _lines(3)).write.parquet(one)
    raw_frame(spark, _lines(5)).write.parquet(two)
    claimed, inner = store.claim, []

    def meanwhile(*args):
        if not inner:
            inner.append(None)
            inner[0] = landing.land(spark, two, target)
        return claimed(*args)

    monkeypatch.setattr(store, "claim", meanwhile)
    with pytest.raises(C.ContractError, match="another landing"):
        landing.land(spark, one, target)
    assert landing.landed(spark, target).count() == 5
    assert len(list((tmp_path / "landing").glob("data-*"))) == 1  # the loser's copy is gone
    assert landing.land(spark, one, target, force=True).action == "overwrite"
    assert landing.landed(spark, target).count() == 3


def test_only_new_files_are_fingerprinted(spark, tmp_path, monkeypatch):
    source, target = str(tmp_path / "extract +1"), str(tmp_path / "landing")
    for i in range(2):
        raw_frame(spark, _lines(3 * i + 3, 3 * i)).coalesce(1).write.parquet(f"{source}/day={i}")
    read, whole = [], landing.read_raw

    def spied(session, path, fmt="parquet", only=None, **more):
        if only is not None:
            read.append(sorted(f.split("day=")[1][0] if "day=" in f else "landed" for f in only))
        return whole(session, path, fmt, only, **more)

    monkeypatch.setattr(landing, "read_raw", spied)
    assert landing.land(spark, source, target).action == "land" and read == [["0", "1"]]
    assert landing.known_fingerprint(spark, source, target) == landing.extract_fingerprint(whole(spark, source))
    del read[:]
    assert landing.land(spark, source, target).action == "skip" and {f for files_ in read for f in files_} == {"landed"}
    del read[:]
    raw_frame(spark, _lines(9, 6)).coalesce(1).write.parquet(f"{source}/day=2")
    with pytest.raises(C.ContractError, match="content differs"):
        landing.land(spark, source, target)
    assert read == [["2"]]  # the new file alone
    assert landing.known_fingerprint(spark, source, target) == landing.extract_fingerprint(whole(spark, source))
    assert landing.land(spark, source, target, force=True).rows == 9 and landing.landed(spark, target).count() == 9


def test_exported_text_is_read_by_several_tasks(spark, tmp_path):
    texts = ["plain", "two\nlines", "a\\nb", "back\\slash\r\n", 'say "hi", now', "\\s", None, "\\"]
    table = spark.range(40_000).select(F.col("id").alias("product_key"), F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("id") % 8 + 1).cast("int")).alias("stock_code"), F.lit("x" * 50).alias("description"))
    done = files.export_table("dim_product", table.coalesce(1), str(tmp_path))
    assert files.verify_export(done, table)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512k")
    try:
        back = files.read_extract(spark, "dim_product", str(tmp_path))
        assert back.rdd.getNumPartitions() > 3
        assert back.exceptAll(table).count() == 0 and back.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
