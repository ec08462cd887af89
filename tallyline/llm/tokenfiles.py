"""Token ids in binary files: one zstandard frame a document, with a dictionary for all of them."""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import accumulate
from uuid import uuid4

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyline.llm.common import map_arrow, pair_hash, passes, table, texts
from tallyline.session import scratch_path, stash

TOKENIZER = "byte_bpe_50k.json"
END = 0
#: Documents whose ids train the dictionary, about; and the dictionary's bytes at most.
SAMPLE_DOCS, DICTIONARY_BYTES = 1_000, 1 << 16
LEVEL = 3
#: Pieces whose ids a Python worker keeps, the first it meets, some 40 bytes each; others are encoded anew.
KEPT_WORDS = 2_000_000
#: Text bytes whose pieces are hashed at once; temporaries take some forty times as much.
HASH_BYTES = 1 << 20
#: New pieces in a running text.
CHUNK = 4_096
#: Text bytes that are encoded at once, and bytes that a reader holds at once, about.
ENCODE_BYTES, READ_BYTES = 4 << 20, 8 << 20

MAGIC = b"TOKFILE1"
#: Magic, sha256 of the dictionary (zeros without one), bytes of an id, documents, where the index begins.
_HEADER = "<8s32sBxxxxxxxqq"
_HEADER_SIZE = struct.calcsize(_HEADER)
#: Of each document: doc_id, whether it is null, ids with the end id, and where its frame begins.
_ENTRY = np.dtype([("doc_id", "<i8"), ("no_id", "<i8"), ("n_tokens", "<i8"), ("offset", "<i8")])


#: ASCII characters that count as white space, and the first bytes of the other ones: fixed values.
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
_WIDE_SPACES = re.compile(rb"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: ASCII letters, digits, and punctuation but for the apostrophe, which may belong to the letters around it.
_CLASS = np.zeros(256, dtype=np.uint8)
for _i in range(33, 127):
    _CLASS[_i] = 1 if chr(_i).isalpha() else 2 if chr(_i).isdigit() else 3 * (_i != 39)
_HASHED = np.random.default_rng(20_240_611).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x5851F42D4C957F2D)


class Encoder:
    """A tokenizer with the ids of pieces of text it has met; gives ids serialised, without the end id.

    Byte-level tokenizers split a text, before any merge, at every space that a character other than
    white space precedes or follows, on both sides of a line break that stands alone, and between letters, digits and
    punctuation. A text can be cut there, and a piece's ids do not depend on the rest. Texts in which
    a space stands between white space, or with white space beyond ASCII, go to the tokenizer whole, as all do if it
    splits in another way. Pieces are found, hashed (64 bits, their length included) and looked up with array operations; only
    pieces that are new go to the tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        self.cuttable = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not spec.get("normalizer")
        #: By the character in front of a piece: whether an id begins with it.
        self.leads = {front: np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, dtype=bool) for front in (32, 10)}
        for front, mark in ((32, "\u0120"), (10, "\u010a")):
            self.leads[front][[i for token, i in self.tokenizer.get_vocab().items() if token.startswith(mark)]] = True
        #: Hashes of known pieces, in order; where the ids of each begin in ``ids``, and how many there are.
        self.known, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.kind)

    def _encoded(self, parts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        return [np.array(e.ids, dtype=self.kind) for e in found]

    def _new(self, pieces: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of new pieces, in some order, where those of each piece begin, and how many there are. ``plain`` tells pieces whose
        only white space is a space or line break in front: they are encoded as running text, and the ids that begin with that
        character tell where each piece begins. The others are encoded one by one."""
        begin, count = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        out, total, alone = [self.ids[:0]], 0, np.ones(len(pieces), dtype=bool)
        front = np.array([p[0] for p in pieces])
        for first, leads in self.leads.items():
            these = np.flatnonzero(plain & (front == first))
            chunks = [these[i : i + CHUNK] for i in range(0, len(these), CHUNK)]
            for chunk, ids in zip(chunks, self._encoded([b"".join([pieces[i] for i in c.tolist()]).decode() for c in chunks]), strict=True):
                begins = np.flatnonzero(leads[ids])
                if len(begins) == len(chunk) and begins[0] == 0:
                    begin[chunk], count[chunk], alone[chunk] = total + begins, np.diff(begins, append=len(ids)), False
                    out.append(ids)
                    total += len(ids)
        rest = np.flatnonzero(alone)
        single = self._encoded([pieces[i].decode() for i in rest.tolist()])
        count[rest] = np.fromiter(map(len, single), np.int64, len(single))
        begin[rest] = total + np.cumsum(count[rest]) - count[rest]
        return np.concatenate([*out, *single]), begin, count

    def _looked_up(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces that begin at ``starts``, one after the other, and how many each has."""
        low = int(starts[0])
        raw = data[low : int(starts[-1] + sizes[-1])]
        first = starts - low
        # Bytes between pieces belong to texts that are encoded whole; they are added to no piece.
        within = np.arange(len(raw)) - np.repeat(first, np.diff(first, append=len(raw)))
        powers = np.full(int(sizes.max()) + 1, _STEP, dtype=np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        values = _HASHED[raw] * powers[np.minimum(within, len(powers) - 1)]
        values[within >= np.repeat(sizes, np.diff(first, append=len(raw)))] = 0
        hashes = pair_hash(np.add.reduceat(values, first), sizes.astype(np.uint64))
        distinct, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.known, distinct)
        fresh = np.flatnonzero(self.known[np.minimum(place, max(len(self.known) - 1, 0))] != distinct) if len(self.known) else np.arange(len(distinct))
        ids, known, at, count = self.ids, self.known, self.at, self.count
        if len(fresh):
            ends = starts[index[fresh]] + sizes[index[fresh]]
            begins = starts[index[fresh]]
            blanks = np.concatenate([[0], np.cumsum(_SPACES[raw])])
            plain = (ends - begins > 1) & (blanks[ends - low] == blanks[begins - low + 1])
            more, offsets, counts = self._new([data[i:j].tobytes() for i, j in zip(begins.tolist(), ends.tolist(), strict=True)], plain)
            begin = len(ids) + offsets
            ids, known = np.concatenate([ids, more]), np.insert(known, place[fresh], distinct[fresh])
            at, count = np.insert(at, place[fresh], begin), np.insert(count, place[fresh], counts)
            place = np.searchsorted(known, distinct)
            if len(known) <= KEPT_WORDS:
                self.ids, self.known, self.at, self.count = ids, known, at, count
        begins, counts = at[place][inverse], count[place][inverse]
        ends = np.cumsum(counts)
        return ids[np.arange(int(ends[-1])) + np.repeat(begins - (ends - counts), counts)], counts

    def __call__(self, batch: pa.Array) -> list[bytes]:
        column = texts(batch)
        edges = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1, offset=column.offset * 8)
        low, high = int(edges[0]), int(edges[-1])
        if low == high:
            return [b""] * len(column)
        data, edges = np.frombuffer(column.buffers()[2], dtype=np.uint8, count=high - low, offset=low), edges - low
        blank = _SPACES[data]
        owner_of = lambda places: np.searchsorted(edges[1:], places, side="right")
        double = np.flatnonzero(blank[1:] & blank[:-1])
        double = double[owner_of(double) == owner_of(double + 1)]
        gaps, whole = np.zeros(len(column), dtype=bool), np.full(len(column), not self.cuttable)
        gaps[owner_of(double)] = True
        triple = double[:-1][(np.diff(double) == 1) & (data[double[1:]] == 32)] if len(double) else double
        whole[owner_of(triple[owner_of(triple) == owner_of(triple + 2)])] = True
        wide = np.array([m.start() for m in _WIDE_SPACES.finditer(data)], dtype=np.int64)
        whole[owner_of(wide)] = True
        breaks = np.flatnonzero((data == 32) | (data == 10))
        breaks = breaks[(data[breaks] == 32) | ~gaps[owner_of(breaks)]]
        border = np.zeros(len(data) + 1, dtype=bool)
        border[breaks] = True
        border[edges] = True
        kind = _CLASS[data]
        border[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        starts = np.flatnonzero(border[:-1])
        sizes = np.diff(starts, append=len(data))
        owner = owner_of(starts)
        used = ~whole[owner]
        starts, sizes, owner = starts[used], sizes[used], owner[used]
        out: list[list[bytes]] = [[] for _ in range(len(column))]
        at = 0
        while at < len(starts):
            stop = max(at + 1, int(np.searchsorted(starts, starts[at] + HASH_BYTES)))
            ids, counts = self._looked_up(data, starts[at:stop], sizes[at:stop])
            own = owner[at:stop]
            change = np.flatnonzero(np.diff(own, prepend=-1))
            ends = np.concatenate([[0], np.cumsum(counts)])
            for text, begin, end in zip(own[change].tolist(), ends[change].tolist(), ends[[*change[1:], len(own)]].tolist(), strict=True):
                out[text].append(ids[begin:end].tobytes())
            at = stop
        entire = np.flatnonzero(whole)
        for text, ids in zip(entire.tolist(), self._encoded([column[i].as_py() for i in entire.tolist()]), strict=True):
            out[text].append(ids.tobytes())
        return [b"".join(parts) for parts in out]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _open(path: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(path)


def _place(path: str, content: bytes) -> None:
    """Write a file under another name and move it to its own, so that a reader sees all of it or nothing,
    and a task that runs again replaces it by the same."""
    fs, place = _open(path)
    fs.create_dir(place.rpartition("/")[0])
    draft = f"{place}.{uuid4().hex}"
    with fs.open_output_stream(draft) as out:
        out.write(content)
    fs.move(draft, place)


def train_dictionary(docs: DataFrame, tokenizer: str, sample_docs: int = SAMPLE_DOCS) -> bytes:
    """A dictionary from the serialised ids of about ``sample_docs`` documents, chosen by hash: a
    bounded sample, as the result is a table of frequent byte strings that no further document
    would change much. Empty if there are too few documents to train on."""
    rows = docs.count()
    share = min(1.0, sample_docs / max(rows, 1))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))).select("text")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([i + END.to_bytes(encode.width, "little") for i in encode(batch.column(0))], pa.binary())], names=["ids"])

    samples = sorted(r["ids"] for r in map_arrow(chosen, encoded, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def write(docs: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write token files below ``folder``, a place that all executors
    reach: ``dictionary.zstd`` and one file for each range of ids. Returns ``(shard, path, docs, ids)``, a row a file.

    Documents are in ascending order of doc_id, nulls first, equal ids by text, in each file and from file
    to file. A null text counts as empty, and has the end id only. A file has a header with the
    dictionary's hash, one zstandard frame a document, and an index of doc_id, ids and offset, so one
    document is read without the others (``read_document``). Texts move once, as texts, and are
    encoded where they are written. A task holds the compressed frames of one range."""
    tokenizer = tokenizer or public_tokenizers.path(TOKENIZER)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dictionary = train_dictionary(narrow, tokenizer)
    _place(f"{folder}/dictionary.zstd", dictionary)
    shared = narrow.sparkSession.sparkContext.broadcast(dictionary)
    digest = sha256(dictionary).digest() if dictionary else bytes(32)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, press = encoder(tokenizer), _compressor(shared.value)
        end = END.to_bytes(encode.width, "little")
        shard = TaskContext.get().partitionId()
        frames, entries, at, ids = [], [], _HEADER_SIZE, 0
        for whole in batches:
            for batch in passes(whole, limit=ENCODE_BYTES):
                keys = batch.column("doc_id").to_pylist()
                for key, found in zip(keys, encode(batch.column("text")), strict=True):
                    frame = press.compress(found + end)
                    count = len(found) // encode.width + 1
                    entries.append((key or 0, key is None, count, at))
                    frames.append(frame)
                    at += len(frame)
                    ids += count
        if not entries:
            return
        index = np.array(entries, dtype=_ENTRY).tobytes()
        path = f"{folder}/ids-{shard:06d}.tok"
        _place(path, b"".join([struct.pack(_HEADER, MAGIC, digest, encode.width, len(entries), at), *frames, index]))
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([path]), pa.array([len(entries)], pa.int64()), pa.array([ids], pa.int64())], names=["shard", "path", "docs", "ids"])

    ordered = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stash(map_arrow(ordered, written, "shard long, path string, docs long, ids long"), "token-files")


class TokenFile:
    """One token file, opened for reading; only its index is read at first."""

    def __init__(self, path: str):
        self.fs, self.place = _open(path)
        self.file = self.fs.open_input_file(self.place)
        magic, digest, self.width, count, self.index_at = struct.unpack(_HEADER, self.file.read_at(_HEADER_SIZE, 0))
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        dictionary = b""
        if digest != bytes(32):
            with self.fs.open_input_file(f"{self.place.rpartition('/')[0]}/dictionary.zstd") as f:
                dictionary = f.read()
            if sha256(dictionary).digest() != digest:
                raise ValueError(f"{path} was written with another dictionary")
        self.index = np.frombuffer(self.file.read_at(count * _ENTRY.itemsize, self.index_at), dtype=_ENTRY)
        self.press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def _ids(self, frame: bytes, entry: np.void) -> np.ndarray:
        ids = np.frombuffer(self.press.decompress(frame), dtype=f"<u{self.width}")
        if len(ids) != entry["n_tokens"]:
            raise ValueError("a frame does not have the ids that the index says")
        return ids

    def document(self, position: int) -> np.ndarray:
        """The ids of one document, by its place in the file: reads its frame only."""
        start = int(self.index["offset"][position])
        end = int(self.index["offset"][position + 1]) if position + 1 < len(self.index) else self.index_at
        return self._ids(self.file.read_at(end - start, start), self.index[position])

    def __iter__(self) -> Iterator[tuple[np.void, np.ndarray]]:
        """Index entry and ids of every document, reading a bounded block of frames at a time."""
        ends = [*self.index["offset"][1:].tolist(), self.index_at]
        starts = self.index["offset"].tolist()
        at = 0
        while at < len(starts):
            stop = at + 1
            while stop < len(starts) and ends[stop] - starts[at] <= READ_BYTES:
                stop += 1
            block = self.file.read_at(ends[stop - 1] - starts[at], starts[at])
            for i in range(at, stop):
                yield self.index[i], self._ids(block[starts[i] - starts[at] : ends[i] - starts[at]], self.index[i])
            at = stop


def read_document(files: DataFrame, doc_id: int) -> np.ndarray | None:
    """The ids of one document, from the file whose range holds it; None if there is none. The
    manifest ``files`` is a row a file."""
    for row in files.orderBy("shard").toLocalIterator():
        opened = TokenFile(row["path"])
        hit = np.flatnonzero((opened.index["doc_id"] == doc_id) & (opened.index["no_id"] == 0))
        if len(hit):
            return opened.document(int(hit[0]))
    return None


def read(files: DataFrame) -> DataFrame:
    """``(shard, doc_id, start, n_tokens, ids_crc32)`` of every document in token files, read back a
    task a file. ``start`` counts the ids of all documents before; ``ids_crc32`` is the unsigned crc32 of
    the ids, with the end id, as little-endian unsigned 32-bit integers."""
    totals = files.select("shard", "ids").orderBy("shard").collect()  # a row a file
    bases = dict(zip([r["shard"] for r in totals], [0, *accumulate(r["ids"] for r in totals)], strict=False))

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                source = TokenFile(path)
                sums = [zlib.crc32(ids.astype("<u4").tobytes()) for _, ids in source]
                n = source.index["n_tokens"]
                keys = pa.array(source.index["doc_id"], mask=source.index["no_id"] == 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(n), shard)), keys, pa.array(bases[shard] + np.cumsum(n) - n), pa.array(n.astype(np.int64)), pa.array(sums, pa.int64())],
                    names=["shard", "doc_id", "start", "n_tokens", "ids_crc32"],
                )

    spread = files.select("shard", "path").repartition(max(1, len(totals)), "shard")
    return map_arrow(spread, opened, "shard long, doc_id long, start long, n_tokens long, ids_crc32 long")


def query(spark: SparkSession, folder: str) -> DataFrame:
    files = write(table(spark, folder, "documents").select("doc_id", "text"), scratch_path(spark, "token-files"))
    return read(files).select("doc_id", "start", "n_tokens", "ids_crc32")
