"""Merkle manifest, ranked search and quality scores against brute force."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, differences
from llm_rows import DOCS, document, edge_rows, edges, nothing, prose  # noqa: F401
from pyspark.sql import functions as F

from tallyline.llm import common, merkle, quality, search
from tallyline.llm.queries import QUERIES, STATEMENTS

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_statement(spark, name):
    assert differences(QUERIES[name](spark, SMALL), connect(SMALL), STATEMENTS[name]) is None


# --- merkle ---------------------------------------------------------------------------------


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc_id, text, lang, source, n_chars):
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return _h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def _up(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return levels


def _path(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at % 2, level[at ^ 1] if at ^ 1 < len(level) else ""))
        at //= 2
    return out


def brute_manifest(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    grown = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(*r)))
        grown[lang] = _up([_leaf(*r) for r in trees[lang]])
    top = _up([grown[lang][-1][0] for lang in order])
    root, out = top[-1][0], []
    for place, lang in enumerate(order):
        for at, (doc_id, text, _, source, n_chars) in enumerate(trees[lang]):
            path = _path(grown[lang], at) + _path(top, place)
            changed = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0 and n_chars is not None
            folded = _leaf(doc_id, text, lang, source, n_chars + changed if n_chars is not None else None)
            for after, other in path:
                folded = _h(other, folded) if after else _h(folded, other)
            leaf = _leaf(doc_id, text, lang, source, n_chars)
            out.append((doc_id, leaf, grown[lang][-1][0], root, _h(*[o for _, o in path]), folded, folded == root))
    return sorted(out, key=str)


MANY = [(i // 2 * 3, f"text {i % 4}", ["en", "de", "en", None, "", "zz", "en"][i % 7], [None, "s"][i % 2], [None, i, 2**63 - 1][i % 3]) for i in range(150)]


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_of_many_levels(spark, levels):
    """Superblocks of two and four nodes take several rounds up and down; their size changes nothing."""
    rows = [*MANY, *MANY[:9], (None, "no id", "en", "s", 3), (None, "no id", "en", "s", 3), (2**62, "far", "de", None, 1)]
    docs = spark.createDataFrame(rows, DOCS).repartition(3).withColumns({"tree": F.lit(1), "leaf": F.lit("x"), "position": F.lit(2)})
    found = merkle.manifest(docs, levels)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted(map(tuple, found.collect()), key=str)
    assert got == brute_manifest(rows)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


def test_manifest_of_edges(spark, edges, edge_rows, nothing):
    assert sorted(map(tuple, merkle.manifest(edges).collect()), key=str) == brute_manifest(edge_rows)
    assert merkle.manifest(nothing).collect() == []
    one = [(7, None, None, None, None)]
    assert sorted(map(tuple, merkle.manifest(spark.createDataFrame(one, DOCS)).collect())) == brute_manifest(one)


# --- search ---------------------------------------------------------------------------------


def brute_search(docs, items, best=10):
    def terms(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)

    counts = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counts = [(doc_id, c) for doc_id, c in counts if c]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        found = []
        for doc_id, c in counts:
            m = 10 + (90 * sum(c.values()) * total) // length
            score = sum(math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if t in c)
            found.append((score, doc_id))
        found = sorted((f for f in found if f[0] > 0), key=lambda f: (-f[0], f[1] is None, f[1] or 0))[:best]
        out += [(item, rank, doc_id, score) for rank, (score, doc_id) in enumerate(found, 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize(("most_items", "most_pairs"), [(4_096, 2_000_000), (2, 2_000_000), (4_096, 8)])
def test_search_against_brute_force(spark, monkeypatch, most_items, most_pairs):
    """Ties by the hundred, rows that repeat or share an id, null ids, items on several rows; blocks change nothing."""
    monkeypatch.setattr(search, "_CELLS", 50)
    docs = [(i, prose(i % 60, 5 + i % 23, 40)) for i in range(240)]
    docs += [(i % 5, "Copy of ONE text, naïve ÉTÉ 42") for i in range(300)] + [(None, prose(3, 12, 40)), (None, "été naïve"), (900, None), (901, " -- "), (902, "")]
    items = [(1, prose(5, 9, 40)), (2, "one copy"), (2, "42 copy, one"), (3, None), (4, "??"), (None, "naïve Été"), (5, "unheard-of"), (6, prose(9, 30, 40)), (7, "the of and")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(7).withColumns({"score": F.lit("x"), "n": F.lit(1)})
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1))
    got = search.search(frame, asked, 10, most_items, most_pairs)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert sorted(map(tuple, got.collect()), key=str) == brute_search(docs, items)
    if most_items == 2:
        assert sorted(map(tuple, search.search(frame, asked, 3, most_items).collect()), key=str) == brute_search(docs, items, 3)


def test_search_of_edges(spark, edges, edge_rows, nothing):
    items = [(1, edge_rows[0][1]), (2, "x" * 5_000 + " é"), (3, "the")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, search.search(edges, asked).collect()), key=str) == brute_search([r[:2] for r in edge_rows], items)
    assert search.search(nothing, asked).collect() == [] and search.search(edges, asked.limit(0)).collect() == []


def test_items_are_cut_into_blocks(spark):
    pairs = spark.createDataFrame([(i % 40, i) for i in range(400)] + [(99, i) for i in range(500)], "item_id long, term long")
    from tallyline.session import stash

    parts = [{r["item_id"] for r in b.collect()} for b in search.blocks(stash(pairs, "pairs"), 4_096, 60)]
    assert sorted(i for p in parts for i in p) == [*range(40), 99]
    assert all(len(p) <= 6 or p == {99} for p in parts)


@pytest.mark.parametrize(("each", "files"), [(None, {1}), (1, {2, 3, 4})])
def test_search_stores_few_files_for_few_items(spark, monkeypatch, each, files):
    """What grows with the items alone makes a file for each share of them, not one for every shuffle partition."""
    from tallyline.session import stash

    docs = [(i, prose(i, 5 + i % 23, 40)) for i in range(60)]
    items = [(i, prose(i, 9, 40)) for i in range(20)]
    made = {}
    monkeypatch.setattr(search, "stash", lambda df, label: made.setdefault(label, stash(df, label)))
    if each:
        monkeypatch.setattr(search, "_TASK_BYTES", each)
        monkeypatch.setattr(search, "_TASK_ROWS", each)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
        rows, parts = got.collect(), got.rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {len(made[label].inputFiles()) for label in ("search-pairs", "search-items")} | {parts} <= files
    assert sorted(map(tuple, rows), key=str) == brute_search(docs, items)


def test_words_in_windows(monkeypatch):
    texts = pa.array(["one two", None, "", "a" * 50 + "é b", " x ", "yy"])
    for separator in (common.SPACE, common.PUNCTUATION):
        whole = common.words(texts, separator)
        for size in (1, 3, 7):
            monkeypatch.setattr(common, "_SPLIT_BYTES", size)
            cut = common.words(texts, separator)
            monkeypatch.undo()
            assert all((getattr(cut, n) == getattr(whole, n)).all() for n in ("hashes", "owner", "sizes"))


# --- quality --------------------------------------------------------------------------------


def test_quality_features(monkeypatch):
    texts = ["Ab, cd. ab", "", None, "X1!\nX1!\n\n| é |", "one two one two three"]
    found = {n: quality.features(pa.array(texts))[:, i] for i, n in enumerate(quality.FEATURES)}
    assert found["log_bytes"].tolist() == [math.log1p(len((t or "").encode())) for t in texts]
    assert found["share_upper"][0] == 1 / 10 and found["upper_of_letters"][0] == 1 / 6 and found["share_digit"][3] == 2 / 15
    assert found["distinct_words"].tolist() == [1.0, 0.0, 0.0, 3 / 5, 3 / 5]
    assert found["distinct_lines"][3] == 2 / 3 and found["line_words"][3] == 5 / 3 and found["top_word"][4] == 2 / 5
    assert found["repeated_pairs"].tolist() == [0.0, 0.0, 0.0, 0.0, 2 / 5]
    assert all(found[n][1] == found[n][2] == 0 for n in found)
    monkeypatch.setattr(quality, "_WINDOW", 3)
    monkeypatch.setattr(common, "_SPLIT_BYTES", 3)
    assert (quality.features(pa.array(texts)) == np.column_stack(list(found.values()))).all()


def test_tables_and_grids():
    """A step in one feature, and a pair whose effect neither feature has by itself."""
    draw = np.random.default_rng(5)
    x = draw.random((3_000, 4))
    y = (((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)) | (x[:, 2] > 0.9)).astype(int)
    model = quality.fit_tables(x, y, np.ones(len(y)))
    odds = model.log_odds(x)
    assert ((odds > 0) == y).mean() > 0.98 and (0, 1) in model.grids
    i = 17
    by_hand = model.intercept + sum(t[sum(e <= x[i, f] for e in model.edges[f])] for f, t in enumerate(model.tables))
    by_hand += sum(g[sum(e <= x[i, a] for e in model.coarse[a]), sum(e <= x[i, b] for e in model.coarse[b])] for (a, b), g in model.grids.items())
    assert math.isclose(by_hand, odds[i], rel_tol=1e-9)
    weighed = quality.fit_tables(x, y, np.where(y == 1, 9.0, 1.0))
    assert weighed.intercept > model.intercept


def test_best_cut_against_all_cuts():
    draw = np.random.default_rng(2)
    for _ in range(20):
        g, h = draw.normal(size=9), draw.random(9) * 3
        gains = {}
        for c in range(1, 9):
            sides = [(g[:c].sum(), h[:c].sum()), (g[c:].sum(), h[c:].sum())]
            if all(w >= quality._LEAST for _, w in sides):
                gains[c] = sum(a * a / (w + quality._RIDGE) for a, w in sides) - g.sum() ** 2 / (h.sum() + quality._RIDGE)
        best = max(gains, key=gains.get, default=0)
        assert quality._cut(g, h)[0] == (best if best and gains[best] > 0 else 0)


def test_quality_of_held_out_documents(spark):
    labels = spark.read.parquet(f"{MIDDLE}/labels.parquet")
    rows = QUERIES["op13_quality"](spark, MIDDLE).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 50 and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in rows)


def test_quality_of_edges(spark, edges, edge_rows, nothing):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, 1), (2, None), (None, 1), (8, 1), (9, 0), (12, 0), (77, 1)], "doc_id long, quality int")
    model = quality.fit(edges, labels)
    out = quality.score(edges.withColumns({"Quality_Score": F.lit("mine"), "x": F.lit(1)}), model)
    assert out.columns == [*edges.columns, "Quality_Score", "x", "quality_score_"]
    got = out.collect()
    assert len(got) == len(edge_rows) and all(0 <= r["quality_score_"] <= 1 and r["Quality_Score"] == "mine" and r["score"] == "mine" for r in got)
    empty = {r["quality_score_"] for r in got if not r["text"]}
    assert len(empty) == 1
    for learned, share in ((labels.where("quality = 1"), 6 / 7), (labels.limit(0), 0.5)):
        constant = quality.fit(edges, learned)
        assert np.allclose([r["quality_score"] for r in quality.score(edges, constant).collect()], share, atol=0.08)
    assert quality.score(nothing, model).count() == 0 and quality.fit(nothing, labels).tables == []
