"""Near-duplicate operators against brute force."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
import xxhash
from llm_rows import DOCS, document, edge_rows, edges, nothing, prose  # noqa: F401
from pyspark.sql import functions as F

from tallyline.llm import components as C
from tallyline.llm import embeddings as E
from tallyline.llm import simhash as H
from tallyline.llm import spots as S
from tallyline.llm.common import Lookup, words


def roots(nodes, links):
    top = {n: n for n in nodes}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        top[b] = a
    return {n: find(n) for n in nodes}


def test_lookup_and_words():
    import pyarrow as pa

    keys = np.random.default_rng(1).integers(0, 2**63, 5_000).astype(np.uint64)
    table = Lookup(keys, np.arange(5_000.0), -1.0)
    assert (table.get(keys) == np.arange(5_000)).all() and table.get(np.array([7], np.uint64))[0] == -1
    assert Lookup(keys[:0], np.zeros(0)).get(keys).sum() == 0
    found = words(pa.array(["Ab c", None, "", "ab\tÉ", "x" * 3_000]).slice(1))
    assert found.sizes.tolist() == [0, 0, 2, 1]
    assert found.hashes[0] == words(pa.array(["AB"])).hashes[0]


@pytest.mark.parametrize("kind", ["chain", "random", "star"])
def test_components(spark, kind):
    draw, n = random.Random(3), 300
    order = draw.sample(range(n), n)
    links = {
        "chain": list(zip(order, order[1:])),
        "random": [(draw.randrange(n), draw.randrange(n)) for _ in range(200)],
        "star": [(0, i) for i in range(1, n)] * 2,
    }[kind]
    found = C.components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()
    nodes = {x for link in links for x in link if link[0] != link[1]}
    want = roots(nodes, links)
    got = {r["node"]: r["root"] for r in found}
    assert set(got) == nodes
    assert {frozenset(n for n in nodes if got[n] == r) for r in got.values()} == {frozenset(n for n in nodes if want[n] == r) for r in want.values()}


def test_components_of_nothing(spark):
    assert C.components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text):
    parts = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ")
    for c in "\n\r\x0b\x0c":
        parts = parts.replace(c, " ")
    parts = [p for p in parts.split(" ") if p]
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + 3]) for i in range(len(parts) - 2)] or [" ".join(parts)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << b for b in range(64) if ones[b] * 2 > len(shingles))


def test_fingerprint_by_hand():
    for text in ["", " ", "One", "one TWO", "a b c", prose(9, 120), "É é a\tb\nc É é a", "a b c a b c a b c"]:
        assert H.fingerprint(text) == plain_fingerprint(text)


def test_simhash_links_are_complete(spark):
    """Every pair within three bits, over fingerprints that crowd around few centres."""
    draw = random.Random(5)
    centres = [draw.getrandbits(64) for _ in range(4)]
    values = {0}
    for _ in range(600):
        v = draw.choice(centres)
        for _ in range(draw.randrange(5)):
            v ^= 1 << draw.randrange(64)
        values.add(v)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "bits long")
    for distance in (0, 1, 3):
        got = {frozenset((r["a"], r["b"])) for r in H.links(frame, distance).collect()}
        want = {frozenset((a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= distance}
        assert got == want
    with pytest.raises(ValueError):
        H.links(frame, 4)


def test_simhash_lookups_are_shuffled(spark, tmp_path):
    """Each fingerprint asks for some 33 values, which Spark takes for no more bytes than the fingerprints have."""
    few = spark.range(1000).select(F.xxhash64("id").alias("bits"))
    few.write.parquet(str(tmp_path / "few"))
    found = H.links(spark.read.parquet(str(tmp_path / "few")))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_simhash_groups_of_edge_rows(edges, edge_rows, nothing):
    found = H.groups(edges).collect()
    assert len(found) == len(edge_rows)
    prints = {i: plain_fingerprint(r[1] or "") for i, r in enumerate(edge_rows)}
    near = [(a, b) for a in prints for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3]
    top = roots(prints, near)
    ids = {t: min((edge_rows[i][0] for i in prints if top[i] == t and edge_rows[i][0] is not None), default=None) for t in top.values()}
    want = sorted(((edge_rows[i][0], prints[i], ids[top[i]]) for i in prints), key=str)
    got = sorted(((r["doc_id"], r["bits"] & (1 << 64) - 1, r["component_id"]) for r in found), key=str)
    assert got == want
    assert H.groups(nothing).count() == 0
    kept = H.deduplicate(edges)
    assert kept.columns == edges.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == sorted({i for i in ids.values() if i is not None})
    assert kept.where("doc_id is null").count() == 1


def vectors(seed=2, size=24, n=160):
    draw = np.random.default_rng(seed)
    base = draw.standard_normal((n // 4, size))
    near = base[draw.integers(0, len(base), n // 2)] + 0.12 * draw.standard_normal((n // 2, size))
    return [*base, *near, *base[:5], *(3 * base[:5])]


def test_embedding_links_against_brute_force(spark):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors())]
    odd = [(900, None), (901, [0.0] * 24), (902, [1.0, None]), (903, [float("nan")] * 24), (904, [float("inf")] + [0.0] * 23), (905, []), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    rows += [*odd, rows[3]]
    got = E.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)).collect()
    assert len(got) == len(rows)
    fine = [(i, np.array(v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = [
        (a, b) for a in range(len(fine)) for b in range(a)
        if len(fine[a][1]) == len(fine[b][1]) and fine[a][1] @ fine[b][1] >= 0.95 * np.linalg.norm(fine[a][1]) * np.linalg.norm(fine[b][1])
    ]
    count = dict.fromkeys(range(len(fine)), 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    found = sum(r["n_links"] for r in got)
    assert found <= 2 * len(links) and found >= 0.9 * 2 * len(links)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    for r in got:
        if r["vec_id"] in (900, 901, 902, 903, 904, 905):
            assert (r["n_links"], r["component_id"]) == (0, r["vec_id"])
    assert {r["component_id"] for r in got if r["vec_id"] in (906, 907)} == {906}
    if found == 2 * len(links):
        top = roots(range(len(fine)), links)
        least = {t: min(fine[i][0] for i in top if top[i] == t) for t in top.values()}
        assert {r["vec_id"]: r["component_id"] for r in got if r["vec_id"] < 900} == {fine[i][0]: least[top[i]] for i in top if fine[i][0] < 900}


def test_embedding_edge_tables(spark):
    assert E.groups(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    one = E.groups(spark.createDataFrame([(5, [1.0, 0.0])] * 3, "vec_id long, embedding array<float>")).collect()
    assert [(r["n_links"], r["component_id"], r["kept"]) for r in one] == [(2, 5, True)] * 3


def test_embedding_plan_grows_with_the_table():
    small, large = E.plan(1_000), E.plan(10**9)
    assert (small.width, large.width) == (10, 30) and large.segments > small.segments


@pytest.mark.parametrize("shared", [0.0, 0.5, 0.8, 0.9])
def test_recall_when_vectors_share_a_direction(shared):
    """Pairs just above the threshold among vectors whose mean cosine is ``shared``: how many meet in a segment and
    are near enough as whole codes."""
    draw = np.random.default_rng(7)
    size, count = 64, 4_000
    x = draw.standard_normal((count, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x = math.sqrt(1 - shared) * x + math.sqrt(shared) * np.eye(size)[0]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turn = draw.standard_normal((count, size))
    turn -= (turn * x).sum(axis=1, keepdims=True) * x
    turn /= np.linalg.norm(turn, axis=1, keepdims=True)
    y = 0.9505 * x + math.sqrt(1 - 0.9505**2) * turn
    cut = E.plan(2 * count, E.centred_cosine(np.concatenate([x, y]), 0.95))
    codes = E.quantise(np.concatenate([x, y]), cut)
    a, b = codes.of(list(x)), codes.of(list(y))
    found, apart = np.zeros(count, dtype=bool), np.zeros(count, dtype=int)
    for j in range(cut.segments):
        shift, mask = cut.width * (j % cut.per_word), (1 << cut.width) - 1
        differ = np.bitwise_count((a[:, j // cut.per_word] >> shift & mask) ^ (b[:, j // cut.per_word] >> shift & mask))
        found |= differ <= E.RADIUS
        apart += differ
    assert (found & (apart <= cut.distance)).mean() >= 0.95


def test_lengths_have_their_own_codes(spark):
    """Vectors that differ only beyond the most frequent length, and links among the rarer lengths."""
    draw = np.random.default_rng(3)
    rows = [(i, draw.standard_normal(8).tolist()) for i in range(120)]
    long = [draw.standard_normal(20) for _ in range(30)]
    rows += [(200 + 2 * i + k, (v * (1 + k) + 0.02 * k).tolist()) for i, v in enumerate(long) for k in (0, 1)]
    rows += [(400 + i, [*long[0][:8].tolist(), *draw.standard_normal(12).tolist()]) for i in range(10)]
    got = {r["vec_id"]: r["n_links"] for r in E.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows}
    want = {i: sum(j != i and len(unit[j]) == len(unit[i]) and unit[i] @ unit[j] >= 0.95 for j in unit) for i in unit}
    assert got == want and sum(want.values()) >= 60


def test_quantisation_balances_bits():
    draw = np.random.default_rng(0)
    cut = E.plan(5_000)
    sample = draw.standard_normal((2_000, 32)) * np.linspace(3, 0.2, 32)
    codes = E.quantise(sample, cut)
    turned = (sample / np.linalg.norm(sample, axis=1, keepdims=True) - codes.mean) @ codes.projection
    assert (np.abs((turned > 0).mean(axis=0) - 0.5) < 0.1).all()


def test_spot_signatures():
    import pyarrow as pa

    a, b, c, d, e, f = S.signatures(pa.array(["The cat sat down and ran", "the CAT, sat down! and ran", "the cat", "", None, "cat the"]))
    assert len(a) == 1 and a.tolist() == b.tolist()
    assert len(c) == len(f) == 1 and c.tolist() != f.tolist() and len(d) == len(e) == 0
    assert S.likeness(d, e) == 1.0 and S.likeness(a, d) == 0.0 and S.likeness(a, b) == 1.0
    x, y = np.arange(10, dtype=np.uint32), np.arange(5, 15, dtype=np.uint32)
    assert S.likeness(x, y) == 5 / 15 and S.likeness(x, y[:2], least=0.8) == 0.0


def test_edited_texts_against_brute_force(edges, edge_rows, nothing):
    import hashlib

    import pyarrow as pa

    ordered = sorted(((r[0], r[1] or "") for r in edge_rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for i, (doc_id, text) in enumerate(ordered):
        following = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, other, after = S.signatures(pa.array([text, edited, following]))
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), S.printed(own), S.printed(other), S.likeness(own, other), S.likeness(own, after)))
    got = [tuple(r)[:7] for r in S.edited(edges).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert S.edited(nothing).count() == 0


def test_spot_groups_against_brute_force(spark):
    import pyarrow as pa

    rows = []
    for seed in range(6):
        base = prose(seed, 150).split(" ")
        for k in range(4):
            changed = base[:]
            for i in range(k * 3):
                changed[7 + 31 * i % len(changed)] = f"new{k}{i}"
            rows.append(document(len(rows), " ".join(changed)))
    rows += [document(90, ""), document(91, None), document(92, rows[0][1])]
    got = {r["doc_id"]: (r["component_id"], r["n_links"]) for r in S.groups(spark.createDataFrame(rows, DOCS)).collect()}
    sets = {r[0]: S.signatures(pa.array([r[1]]))[0] for r in rows}
    links = [(a, b) for a in sets for b in sets if a < b and S.likeness(sets[a], sets[b]) >= 0.8]
    top = roots(sets, links)
    assert {i: c for i, (c, _) in got.items()} == top
    for i in sets:
        kinds = {sets[b].tobytes() for a, b in [*links, *[(b, a) for a, b in links]] if a == i} - {sets[i].tobytes()}
        assert got[i][1] == len(kinds)


def test_texts_that_share_an_id_stay(spark):
    rows = [document(1, prose(1, 200)), document(1, prose(2, 200)), document(1, prose(2, 200)), document(2, prose(1, 200)), document(3, prose(3, 200)), document(3, prose(2, 200)), document(4, prose(4, 90))]
    out = H.deduplicate(spark.createDataFrame(rows, DOCS).repartition(3))
    want = [(1, prose(1, 200)), (1, prose(2, 200)), (3, prose(3, 200)), (4, prose(4, 90))]
    assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == sorted(want)
