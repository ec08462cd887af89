"""SpotSigs document fingerprints: chains of content words that follow common words."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.common import PUNCTUATION, hash_of, map_arrow, pair_hash, passes, ship, table, words
from tallyline.llm.components import components
from tallyline.session import stash

#: Common words of four languages, the anchors; fixed values.
COMMON = (
    "a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their there they this to was were which with you "
    "aber als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich ihr im ist mit nach nicht noch sich sie sind so um und von vor war wie wir zu zum zur "
    "au aux avec ce ces cette dans de des du elle en est et eux il ils je la le les leur lui mais ne nous on ou par pas pour qu que qui sa se ses son sont sur un une vous y "
    "al con cual de del desde donde el ella en entre era es esta este esto ha hay la las le les lo los más me mi muy no nos o para pero por porque que se sin sobre son su sus también un una uno y ya"
).split()
#: Content words in a chain.
CHAIN = 3
SIMILARITY = 0.8
_WHOLE = np.uint64(0x5EED_0F_A11_0000)
_anchors = np.sort(np.array([hash_of(w) for w in dict.fromkeys(COMMON)], dtype=np.uint64))


def signatures(column: pa.Array, chain: int = CHAIN) -> list[np.ndarray]:
    """Per text, its sorted distinct spot signatures, 32 bits each.

    Words are lower-cased (A-Z) runs of letters and digits. Every common word is an anchor; with the
    next ``chain`` words that are not common it makes a signature. A text with words but no
    complete chain has one signature, of all its words in order; a text without words has none."""
    found = words(column, PUNCTUATION)
    h, owner, count = found.hashes, found.owner, len(found.sizes)
    at = np.minimum(np.searchsorted(_anchors, h), len(_anchors) - 1)
    anchor = _anchors[at] == h
    content = np.flatnonzero(~anchor)
    spot = np.flatnonzero(anchor)
    following = np.cumsum(~anchor)[spot]
    complete = following + chain <= len(content)
    spot, following = spot[complete], following[complete]
    if len(spot):
        whole = owner[content[following + chain - 1]] == owner[spot]
        spot, following = spot[whole], following[whole]
    sig = h[spot]
    for i in range(chain):
        sig = pair_hash(sig, h[content[following + i]])
    by = owner[spot]
    none = np.flatnonzero((np.bincount(by, minlength=count) == 0) & (found.sizes > 0))
    if len(none):
        first = found.first
        place = pair_hash(np.arange(len(h), dtype=np.uint64) - np.repeat(first[:-1], found.sizes).astype(np.uint64), h)
        sums = np.add.reduceat(place, first[:-1][found.sizes > 0])
        index = np.cumsum(found.sizes > 0)[none] - 1
        sig = np.concatenate([sig, pair_hash(np.full(len(none), _WHOLE), sums[index])])
        by = np.concatenate([by, none])
    keys = np.unique(by.astype(np.uint64) << np.uint64(32) | sig >> np.uint64(32))
    bounds = np.searchsorted(keys, np.arange(count + 1, dtype=np.uint64) << np.uint64(32))
    short = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    return [short[bounds[i] : bounds[i + 1]] for i in range(count)]


def printed(signature: np.ndarray) -> str:
    """The fingerprint as text: eight hex digits a signature, in ascending order."""
    return signature.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets; zero, without comparing them, if their sizes alone keep
    it below ``least``. Two sets without signatures are alike, one of them is unlike any other."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return 0.0
    if len(a) == len(b) and np.array_equal(a, b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def _printed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in passes(whole):
            found = [s.astype(np.int64) for s in signatures(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(pa.int64()))], names=["doc_id", "spots"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, spots)``: the signatures of every row's text, null texts as empty ones."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(narrow, _printed, "doc_id long, spots array<long>")


def groups(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``(doc_id, component_id, n_links)`` of every row: texts whose fingerprints have a Jaccard
    similarity of ``similarity`` or more are linked; component_id is the smallest doc_id
    reachable, n_links the number of different fingerprints linked directly.

    Equal fingerprints are one row from the start. Sets are partitioned by length: class k holds lengths
    between powers of 1/similarity, so a set can only be like one of its own class or of a neighbouring one, and
    each is sent to its own and to the class above. In a partition, sets meet if they share one of their
    rarest signatures, as many as a similar set cannot miss all of; the exact likeness is then computed
    where the lengths allow it. Null texts count as empty; texts without words are one group."""
    if not 0 < similarity <= 1:
        raise ValueError("similarity must be above 0 and at most 1")
    rows = stash(fingerprints(docs).withColumn("print", F.sha2(F.concat_ws(",", F.col("spots").cast("array<string>")), 256)), "spots")
    unique = stash(rows.groupBy("print").agg(F.min("doc_id").alias("least"), F.first("spots").alias("spots")), "spots-distinct")
    unique = unique.withColumn("node", F.xxhash64("print")).withColumn("size", F.size("spots"))
    each = unique.select("node", "size", F.explode("spots").alias("spot"))
    often = each.groupBy("spot").agg(F.count("*").alias("often"))
    ranked = each.join(often, "spot").groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("often", "spot"))).alias("by"))
    need = F.col("size") - F.ceil(F.col("size") * F.lit(similarity) - 1e-9) + 1
    step = math.log(1 / similarity) if similarity < 1 else 1.0
    level = F.floor(F.log(F.col("size").cast("double")) / F.lit(step) + 1e-9).cast("int") if similarity < 1 else F.col("size")
    rare = ranked.select("node", "size", level.alias("level"), F.explode(F.slice("by", F.lit(1), need.cast("int"))).alias("s")).select("node", "size", "level", F.col("s.spot").alias("spot"))
    stored = rare.toDF("a", "a_size", "level", "spot")
    asked = rare.select("node", "size", F.explode(F.array("level", F.col("level") + 1)).alias("level"), "spot").toDF("b", "b_size", "level", "spot")
    fits = (F.least("a_size", "b_size") >= F.greatest("a_size", "b_size") * F.lit(similarity) - 1e-9) & (F.col("a") != F.col("b"))
    pairs = stored.join(asked, ["level", "spot"]).where(fits).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sets = unique.select("node", "spots")
    compared = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b")
    both = F.size(F.array_intersect("left", "right"))
    links = stash(compared.where(both >= (F.size("left") + F.size("right") - both) * F.lit(similarity) - 1e-9).select("a", "b"), "spots-links")
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").count()
    rooted = unique.select("node", "print", "least").join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(named, "root").join(degree, "node", "left").select("print", "component_id", F.coalesce("count", F.lit(0)).alias("n_links"))
    return rows.join(by_print, "print").select("doc_id", "component_id", "n_links")


def with_next(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, next_text)``: each document beside the next by ascending doc_id, the last beside
    the first; null texts as empty ones, null ids first, equal ids by text.

    The ids, without texts, give bounds that cut them into ranges. Each range then is one window
    partition, so texts move once; the document at a bound is sent to the range before as well, where it
    is only looked at."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    ranges = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    ends = narrow.select(key.alias("key")).agg(F.min("key").alias("least"), F.percentile_approx("key", shares, 10_000).alias("bounds")).first()
    least = -(2**63) if ends["least"] is None else ends["least"]
    bounds = np.unique(np.array([b for b in ends["bounds"] or [] if b > least], dtype=np.int64))

    ship(docs.sparkSession)

    @F.pandas_udf("array<int>")
    def homes(keys: pd.Series) -> pd.Series:
        k = keys.to_numpy()
        own = np.searchsorted(bounds, k, side="right")
        first = (np.concatenate([[least], bounds])[own] == k) if len(bounds) else k == least
        before = np.where(own > 0, own - 1, len(bounds))
        return pd.Series([[a, b] if f else [a] for a, b, f in zip(own.tolist(), before.tolist(), first.tolist(), strict=True)])

    placed = narrow.withColumn("key", key).select("*", F.posexplode(homes("key")).alias("guest", "range"))
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    return placed.withColumn("next_text", F.lead("text").over(order)).where("guest = 0").select("doc_id", "text", "next_text")


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_signatures"]
    for whole in batches:
        for batch in passes(whole, limit=PASS):
            own, edited = signatures(batch.column("text")), signatures(batch.column("edited"))
            texts_, following = batch.column("text"), batch.column("next_text")
            last = len(own) - 1
            same = [i < last and following[i].equals(texts_[i + 1]) for i in range(len(own))]
            odd = [i for i, s in enumerate(same) if not s]
            extra = dict(zip(odd, signatures(following.take(pa.array(odd))), strict=True))
            after = [own[i + 1] if s else extra[i] for i, s in enumerate(same)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), batch.column("n_chars"), batch.column("edited_sha256"),
                    pa.array(map(printed, own)), pa.array(map(printed, edited)),
                    pa.array(map(likeness, own, edited), pa.float64()), pa.array(map(likeness, own, after), pa.float64()),
                    pa.array([len(s) for s in own], pa.int64()),
                ],
                names=names,
            )


PASS = 2 << 20


def edited(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint beside that of its edited text, whose last half (rounded down, in code
    points) is replaced by the first as many of the next document, and their likeness. The
    likenesses are exact. Empty texts have an empty fingerprint."""
    pairs = with_next(docs).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    own = pairs.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)))
    own = own.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "text", "edited", "next_text")
    return map_arrow(
        own, _compare, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_signatures long"
    )


def query(spark: SparkSession, folder: str) -> DataFrame:
    return edited(table(spark, folder, "documents").select("doc_id", "text"))
