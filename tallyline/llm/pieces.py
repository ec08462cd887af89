"""SentencePiece encoding and decoding as a shortest path through a weighted transducer."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, passes, table, texts

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: Field numbers of the model's published protocol buffer; fixed values.
_NORMALIZER, _TRAINER = 3, 2
_CHARSMAP, _DUMMY_PREFIX, _EXTRA_SPACES, _ESCAPE = 2, 3, 4, 5
_MODEL_TYPE, _UNIGRAM, _BPE = 3, 1, 2
#: Words whose paths a Python worker keeps, the first it meets, and pairs of pieces; others are found anew.
KEPT_WORDS, KEPT_PAIRS = 600_000, 600_000
_NEVER = float("inf")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Number and value of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 0x7F) << shift
            if byte < 0x80:
                return value
            shift += 7

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = varint() if tag & 7 == 2 else 8 if tag & 7 == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size


class Transducer:
    """The composition of a model's normaliser, its pieces and its byte fallback.

    Three transducers are compiled. The normaliser rewrites each white space as a mark and puts one
    in front. The lexicon has a path for every piece, over its characters, to the piece's id; its
    weight is minus the piece's score for a unigram model. Characters that no piece covers take a path to
    the ids of their UTF-8 bytes, or to the unknown id. For a merge model a third one, over ids, allows a piece
    to follow another only if merging the two together ends at just these two; every other arc weighs infinity.
    A sequence of pieces is what merging produces exactly if each neighbouring pair is, so
    the one path of finite weight is the encoding.

    Composed with a text, the states are positions, with the piece that ends there. In the tropical
    semiring the best way to a position is the least sum, so one state for each position is enough. The
    text is cut at the marks before words, and at characters that occur in no piece of several: no arc crosses
    them, so the shortest path of a text is the chain of the shortest paths of its parts."""

    def __init__(self, path: str, rules: dict[str, str] | None = None):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        with open(path, "rb") as f:
            outer = dict(x for x in _fields(f.read()) if x[0] in (_NORMALIZER, _TRAINER))
        normal, trainer = (dict(_fields(outer.get(k, b""))) for k in (_NORMALIZER, _TRAINER))
        if normal.get(_CHARSMAP):
            raise ValueError("the model's character map is compiled; give its rules as rules=")
        self.kind = trainer.get(_MODEL_TYPE, _UNIGRAM)
        if self.kind not in (_UNIGRAM, _BPE):
            raise ValueError("only unigram and merge models have a lexicon of weighted pieces")
        self.prefix, self.squeeze = bool(normal.get(_DUMMY_PREFIX, 1)), bool(normal.get(_EXTRA_SPACES, 1))
        if not normal.get(_ESCAPE, 1):
            raise ValueError("models that do not escape white space are not supported")
        self.rules = rules or {}
        self.rule = re.compile("|".join(map(re.escape, sorted(self.rules, key=len, reverse=True)))) if self.rules else None
        size = model.get_piece_size()
        self.unknown = model.unk_id()
        self.ids: dict[str, int] = {}
        self.cost: dict[int, float] = {}
        self.bytes_of: dict[int, int] = {}
        self.texts: list[bytes] = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes_of[int(piece[3:5], 16)] = i
                self.texts.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unused(i):
                self.texts.append(b"")
            elif model.is_unknown(i):
                self.texts.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.cost[i] = -model.get_score(i)
                self.texts.append(piece.replace(SPACE, " ").encode())
        self.pieces = {i: p for p, i in self.ids.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.unknown_cost = max(self.cost.values(), default=0.0) + 10.0
        self.cut = self._cuts()
        self.spines: dict[int, tuple[list, list] | None] = {}
        self.pairs: dict[int, bool] = {}
        self.words: dict[str, tuple[int, ...]] = {}

    def _cuts(self) -> re.Pattern:
        """Parts of a text that no piece crosses: before white space, and between characters of
        different sets, where two characters are in one set if they meet in some piece."""
        long = [p.lstrip(SPACE) for p in self.ids if len(p) > 1]
        if any(SPACE in p for p in long):
            return re.compile(r"(?s).+")
        parent: dict[str, str] = {}

        def root(c: str) -> str:
            while (up := parent.setdefault(c, c)) != c:
                c = up
            return c

        for piece in long:
            for a, b in zip(piece, piece[1:], strict=False):
                parent[root(a)] = root(b)
        sets: dict[str, list[str]] = {}
        for c in {*parent, *map(chr, range(128))} - {" "}:
            sets.setdefault(root(c), []).append(c)
        largest = max(sets.values(), key=len)
        small = [re.escape("".join(sorted(s))) for s in sets.values() if s is not largest and any(c < "\x80" for c in s)]
        small.sort()
        runs = [f" *[^ {''.join(small)}]+", *(f" *[{s}]+" for s in small), " +"]
        return re.compile("|".join(runs))

    def normalise(self, text: str) -> str:
        """The text as the lexicon reads it, with plain spaces for the marks."""
        if self.rule:
            text = self.rule.sub(lambda m: self.rules[m[0]], text)
        text = text.replace(SPACE, " ")
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        return f" {text}" if self.prefix and text else text

    def _spines(self, piece: int) -> tuple[list, list] | None:
        """Merge a piece's own characters, lowest cost first, leftmost of equals. Gives the symbols
        that stood at its left and right end on the way, each with the cost at which it came and
        at which it went; None if the characters don't merge to the piece."""
        if piece in self.spines:
            return self.spines[piece]
        parts = list(self.pieces[piece])
        ends = ([(parts[0], -_NEVER)], [(parts[-1], -_NEVER)])
        while len(parts) > 1:
            costs = [self.cost[i] if (i := self.ids.get(a + b)) is not None else _NEVER for a, b in zip(parts, parts[1:], strict=False)]
            least = min(costs)
            if least == _NEVER:
                break
            at = costs.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            for side, symbol in zip(ends, (parts[0], parts[-1]), strict=True):
                if side[-1][0] != symbol:
                    side.append((symbol, max(least, side[-1][1])))
        whole = None
        if len(parts) == 1:
            whole = tuple([(t, came, side[i + 1][1] if i + 1 < len(side) else _NEVER) for i, (t, came) in enumerate(side)] for side in ends)
        self.spines[piece] = whole
        return whole

    def follows(self, left: int, right: int) -> bool:
        """Whether the acceptor over ids has an arc from one piece to the next: no symbol at the right
        end of the first and symbol at the left end of the second, there at the same time, merge before
        either goes into its own piece."""
        if self.kind == _UNIGRAM or left < 0:
            return True
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = True
            for a, a_came, a_goes in self._spines(left)[1]:
                for b, b_came, b_goes in self._spines(right)[0]:
                    if a_came <= b_goes and b_came < a_goes and (i := self.ids.get(a + b)) is not None:
                        cost = self.cost[i]
                        if cost < a_goes and cost <= b_goes:
                            known = False
            self.pairs[key] = known
        return known

    def alone(self, piece: int) -> bool:
        """Whether a piece can be reached at all: merging its own characters gives it."""
        return self.kind == _UNIGRAM or self._spines(piece) is not None

    def fallback(self, char: str) -> tuple[int, ...]:
        if len(self.bytes_of) == 256:
            return tuple(self.bytes_of[b] for b in char.encode())
        return (self.unknown,)

    def path(self, word: str) -> tuple[int, ...]:
        """Ids along the shortest path of one part of a text (marks already written)."""
        whole = self.ids.get(word)
        if whole is not None and self.kind == _BPE and self.alone(whole):
            return (whole,)
        n, ids, longest = len(word), self.ids, self.longest
        weight, back, last = [0.0] + [_NEVER] * n, [0] * (n + 1), [-1] * (n + 1)
        for end in range(1, n + 1):
            for start in range(max(0, end - longest), end):
                piece = ids.get(word[start:end])
                if piece is None or weight[start] == _NEVER:
                    continue
                if self.kind == _BPE:
                    if weight[end] == _NEVER and self.alone(piece) and self.follows(last[start], piece):
                        weight[end], back[end], last[end] = weight[start], start, piece
                        break
                elif weight[start] + self.cost[piece] < weight[end]:
                    weight[end], back[end], last[end] = weight[start] + self.cost[piece], start, piece
            if weight[end] == _NEVER and weight[end - 1] < _NEVER and word[end - 1] not in ids:
                weight[end], back[end], last[end] = weight[end - 1] + self.unknown_cost, end - 1, -1
        if weight[n] == _NEVER:
            raise ValueError(f"no path through {word!r}")
        out: list[tuple[int, ...]] = []
        end = n
        while end:
            start = back[end]
            out.append((last[end],) if last[end] >= 0 else self.fallback(word[start:end]))
            end = start
        return tuple(chain.from_iterable(reversed(out)))

    def encode(self, text: str) -> list[int]:
        parts = self.cut.findall(self.normalise(text))
        known = self.words
        try:
            return list(chain.from_iterable(map(known.__getitem__, parts)))
        except KeyError:
            pass
        fresh = {p: known.get(p) or self.path(p.replace(" ", SPACE)) for p in set(parts)}
        if len(known) < KEPT_WORDS:
            known.update((p, ids) for p, ids in fresh.items() if len(p) <= 64)
        return list(chain.from_iterable(map(fresh.__getitem__, parts)))

    def decode(self, ids: list[int]) -> str:
        """The inverse transducer: texts of the pieces, bytes joined, the mark in front removed."""
        text = b"".join(map(self.texts.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text[:1] == " " else text


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    return Transducer(path)


def model_path(name: str = MODEL) -> str:
    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs`` with ``ids array<int>`` and ``decoded string``: the encoding of ``text`` by the model at
    ``path`` (a file that every executor has, such as an installed package's), and what the ids decode to.

    A null text counts as empty and has no ids. Texts are whole, whatever their length; nothing is shuffled;
    columns named ``ids`` or ``decoded`` are replaced; repeated rows and other columns stay."""
    path = path or model_path()
    rest = [c for c in docs.columns if c.lower() not in ("ids", "decoded")]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*rest).schema.fields)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(path)
        for whole in batches:
            for batch in passes(whole):
                ids = [machine.encode(t) for t in texts(batch.column("text")).to_pylist()]
                sizes = np.cumsum([0, *map(len, ids)])
                flat = np.fromiter(chain.from_iterable(ids), np.int32, int(sizes[-1]))
                lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat))
                decoded = pa.array(list(map(machine.decode, ids)), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, lists, decoded], names=[*rest, "ids", "decoded"])

    return map_arrow(docs.select(*rest), encoded, f"{fields}, ids array<int>, decoded string")


def query(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", F.col("text").cast("string").alias("text"))
    out = encode(docs)
    return out.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("lossless"),
    )
