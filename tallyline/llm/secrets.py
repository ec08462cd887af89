"""Secrets: fixed patterns, and assignments lexed from source and configuration text."""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import map_arrow, passes, table, texts

KINDS = ("assign", "access", "hex", "literal")
#: The base patterns; fixed values.
_ASSIGN = re.compile(
    r"""(?=[pstaPSTA])(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_ASSIGN_LEAST, _ACCESS_LEAST = 6, 20

#: What a word in a target's name says about its value; fixed values.
SENSITIVE = {
    "password": 3.0, "passwd": 3.0, "pwd": 3.0, "passphrase": 3.0, "pass": 2.0, "secret": 3.0,
    "token": 2.5, "apikey": 3.0, "credential": 2.5, "credentials": 2.5, "bearer": 2.5, "auth": 1.5,
    "authorization": 2.0, "signature": 1.5, "key": 1.0, "api": 1.0, "access": 0.5, "private": 1.5,
    "client": 0.5, "encryption": 1.0, "signing": 1.0, "session": 0.5, "dsn": 1.0, "salt": 1.0,
}
#: Words that make a value a stand-in; fixed values.
STAND_INS = re.compile(r"(?i)example|sample|changeme|change_me|placeholder|your[_-]|dummy|redacted|\[secret\]|xxx|\*\*\*|<[^>]*>|\$\{|\{\{|%\(|%s|null$|none$|true$|false$")
#: Names of types and functions that stand for values read elsewhere; fixed values.
_READS = re.compile(r"(?i)(getenv|environ|input|prompt|getpass|read|load|fetch|request)")
THRESHOLD = 5.0
#: Text bytes that are strings at a time, one text at least.
_PASS = 1 << 20

_SEPARATOR = re.compile(r"=>|:=|[=:]")
#: Marks that are part of an address or of a match operator.
_NO_VALUE = re.compile(r":(?=//)|[=:]~(?=[\s/]|$)")
#: A target's name and perhaps its type, up to the separator; read backwards from there.
_NAME_BACKWARDS = re.compile(r"""[\x20\t]*(?:[\w.<>\[\],|\x20]*?[A-Za-z_][\x20\t]*:)?[\x20\t]*\]?["'`]?([\w$.\-]*[A-Za-z_$@])""")
_QUOTED = re.compile(r"""[rbfuRBFU]{0,2}(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)'|`([^`\n]*)`)""")
_REFERENCE = re.compile(r"[A-Za-z_$][\w$]*(?:\.[A-Za-z_$][\w$]*)*")
_BARE = re.compile(r"""[^\s"'`,;#<>(){}\[\]]+""")
_JOIN = re.compile(r"[\x20\t]*(?:\+|\.(?=[\x20\t]*[\"'$])|(?=[\"']))[\x20\t]*(?:\\?\n[\x20\t]*)?")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
#: A call whose only or first argument is a literal, and an element whose content is one.
_CALL = re.compile(r"""\([\x20\t]*(?:"((?:[^"\\\n]|\\.)*)"|'((?:[^'\\\n]|\\.)*)')[\x20\t]*[,)]""")
_ELEMENT = re.compile(r"<([A-Za-z_][\w.\-]*)>([^<>\n]+)</")
_OPENING = re.compile(r"[\x20\t]*(?:\([\x20\t\n]*)*")


@dataclass
class Literal:
    text: str
    start: int
    end: int


@dataclass
class Assignment:
    """A target's name and the parts of its value: literals, and names of other targets."""

    name: str
    parts: list[Literal | str] = field(default_factory=list)
    quoted: bool = True


def _value(text: str, at: int) -> Assignment | None:
    """The value that begins at ``at``: literals and names joined by concatenation, else one bare word."""
    found = Assignment("")
    while True:
        if quoted := _QUOTED.match(text, at):
            group = quoted.lastindex or 1
            found.parts.append(Literal(quoted[group], quoted.start(group), quoted.end(group)))
        elif found.parts:
            name = _REFERENCE.match(text, at)
            if not name:
                return found
            found.parts.append(name[0])
            quoted = name
        else:
            bare = _BARE.match(text, at)
            if not bare:
                return None
            name = _REFERENCE.fullmatch(bare[0])
            if name and text[bare.end() : bare.end() + 1] not in ("(", "["):
                found.parts.append(name[0])
            joined = _JOIN.match(text, bare.end())
            if not (name and joined and joined[0].strip().startswith("+")):
                found.quoted = False
                found.parts.append(Literal(bare[0], bare.start(), bare.end()))
                return found
            quoted = bare
        joined = _JOIN.match(text, quoted.end())
        if not joined or joined.end() >= len(text) or not (joined[0].strip() or text[joined.end()] in "\"'"):
            return found
        at = joined.end()


def assignments(text: str) -> list[Assignment]:
    """Name and value of everything in ``text`` that reads as an assignment, in order: ``=``, ``:=``, ``:`` and
    ``=>`` in source, keyword arguments, JSON, YAML, INI and environment files, values in parentheses,
    calls with a literal as their first argument, and the content of elements. A name is looked for between its
    separator and the last but one before it, since a type may stand between them; so the work
    grows with the text."""
    out: list[tuple[int, Assignment]] = []
    end = last = before_last = 0
    for mark in _SEPARATOR.finditer(text):
        low, last, before_last = before_last, mark.end(), last
        before, after = text[mark.start() - 1 : mark.start()], text[mark.end() : mark.end() + 1]
        if mark.start() < end or before in ("=", "!", "<", ">", ":") or after in ("=", ":") or _NO_VALUE.match(text, mark.start()):
            continue
        line = text.rfind("\n", low, mark.start())
        name = _NAME_BACKWARDS.match(text[max(low, line + 1) : mark.start()][::-1])
        if not name:
            continue
        if found := _value(text, _OPENING.match(text, mark.end()).end()):
            found.name = name[1][::-1]
            end = max((p.end for p in found.parts if isinstance(p, Literal) and found.quoted), default=0)
            out.append((mark.start(), found))
    for call in _CALL.finditer(text):
        start = call.start()
        while start and (text[start - 1].isalnum() or text[start - 1] in "_$."):
            start -= 1
        name = text[start : call.start()].strip(".")
        if name and not name[0].isdigit() and not _READS.search(name):
            group = call.lastindex
            out.append((start, Assignment(name, [Literal(call[group], call.start(group), call.end(group))])))
    for element in _ELEMENT.finditer(text):
        if text.startswith(f"{element[1]}>", element.end()):
            out.append((element.start(), Assignment(element[1], [Literal(element[2], element.start(2), element.end(2))])))
    return [a for _, a in sorted(out, key=lambda p: p[0])]


@dataclass
class Names:
    """Dotted names by their parts, last part first: the definitions of a name, and the longer names that end in it."""

    own: list[int] = field(default_factory=list)
    longer: dict[str, Names] = field(default_factory=dict)
    #: How many names are defined here or below, and one of those below.
    count: int = 0
    one: Names | None = None

    def only(self) -> Names:
        """The one name defined here or below, if there is one only; else this node."""
        return self.one if self.count == 1 and not self.own else self


class Definitions:
    """What names stand for where a text uses them.

    A reference means the nearest definition of the same dotted name before it; then it is part of one value with what it
    is joined to. If the name is only defined later, or under several longer or shorter dotted names, or
    under other names with the same last part, it may mean each of their definitions; then each of these is a
    value by itself. Certain references lead backwards, so their values are made in order, and possible ones
    share the nodes of :class:`Names`: all in all the work grows with the definitions and references."""

    def __init__(self, found: list[Assignment]):
        self.root = Names()
        self.parts: list[list[Literal | str]] = []
        for i, a in enumerate(found):
            parts = a.parts if a.quoted else [p for p in a.parts if isinstance(p, str)]
            self.parts.append(parts)
            if a.quoted or parts:
                self._define(a.name, i)

    def _define(self, name: str, i: int) -> None:
        path = [self.root]
        for part in reversed(name.split(".")):
            path.append(path[-1].longer.setdefault(part, Names()))
        if not path[-1].own:
            for node in path:
                node.count += 1
                if node is not path[-1]:
                    node.one = path[-1]
        path[-1].own.append(i)

    def __contains__(self, name: str) -> bool:
        return name.rpartition(".")[2] in self.root.longer

    def meant(self, name: str, at: int) -> tuple[int | None, list[Names | list[int]]]:
        """The one definition that ``name`` means in assignment ``at``; or else none, and where those are that it may mean."""
        node, shorter, whole = self.root, [], True
        for part in reversed(name.split(".")):
            if part not in node.longer:
                whole = False
                break
            node = node.longer[part]
            if node.own:
                shorter.append(node)
        if whole and node.own:
            names = [node]
        else:
            names = [*shorter, *([node.only()] if whole else [])]
            if not names:
                last = self.root.longer.get(name.rpartition(".")[2])
                names = [] if last is None else [last.only()]
        sure = len(names) == 1 and names[0].own and (names[0].count == 1 or any(names[0] is n for n in shorter))
        if sure:
            before = bisect_left(names[0].own, at)
            return (names[0].own[before - 1], []) if before else (None, [names[0].own])
        return None, [n if n is node or not n.own else n.own for n in names]


@dataclass(frozen=True)
class Shape:
    """What the score of a value depends on; shapes of joined values are made from those of their parts."""

    size: int
    kinds: frozenset[int]
    counts: Counter
    stand_in: bool
    words: bool
    space: bool
    address: bool
    path: bool
    in_path: bool

    @classmethod
    def of(cls, value: str) -> Shape:
        return cls(
            len(value),
            frozenset(i for i, c in enumerate((r"[a-z]", r"[A-Z]", r"[0-9]", r"[^A-Za-z0-9\s]")) if re.search(c, value)),
            Counter(value),
            bool(STAND_INS.search(value)),
            bool(re.fullmatch(r"[A-Za-z]+(?:[\s.,_-]+[A-Za-z]+)*[.,]?", value)),
            bool(re.search(r"\s", value)),
            bool(re.match(r"https?://[^:@/]+(/|$)", value)),
            bool(re.fullmatch(r"[./~][\w./-]+", value)),
            bool(re.fullmatch(r"[\w./-]*", value)),
        )

    def joined(self, other: Shape) -> Shape:
        return Shape(
            self.size + other.size, self.kinds | other.kinds, self.counts + other.counts, self.stand_in or other.stand_in,
            self.words and other.words, self.space or other.space, self.address, self.path and other.in_path, self.in_path and other.in_path,
        )

    def score(self) -> float:
        """How much a value looks like a secret: length, mixed characters, entropy; stand-ins and plain
        words speak against it."""
        if self.size < 6 or self.stand_in:
            return -10.0
        entropy = -sum(n / self.size * math.log2(n / self.size) for n in self.counts.values())
        score = 1.0 * (self.size >= 8) + 1.0 * (len(self.kinds) >= 2) + 1.0 * (len(self.kinds) >= 3) + 1.0 * (entropy >= 3.0)
        score += 1.0 * (self.size >= 20 and entropy >= 3.5)
        return score - 3.0 * self.words - 1.0 * self.space - 3.0 * (self.address or self.path)


def sensitivity(name: str) -> float:
    words = [w.lower() for w in _PART.findall(name)]
    best = sum(sorted((SENSITIVE.get(w, 0.0) for w in {*words, "".join(words)}), reverse=True)[:2])
    return best


def literal_score(value: str) -> float:
    """How much a literal looks like a secret."""
    return Shape.of(value).score()


def method_spans(text: str) -> list[tuple[int, int]]:
    """Literals that reach a sensitive name, directly or through constants, and score enough.

    What is certainly joined is scored as one value; what a name only may mean, each value by itself. Targets
    are taken from the most sensitive name down: a definition that was looked at for one of them
    need not be looked at again for a less sensitive one. A constant that is joined to itself counts once more for its
    length, its literals are listed once."""
    found = assignments(text)
    named = [sensitivity(a.name) for a in found]
    if max(named, default=0.0) < 2.0:
        return []
    constants = Definitions(found)
    shapes: list[Shape | None] = []
    certain: list[list[Literal | int]] = []
    possible: list[list[Names | list[int]]] = []
    for i, target in enumerate(found):
        own, shape, maybe = [], None, []
        for part in _used(target, constants):
            if isinstance(part, Literal):
                own.append(part)
                more = Shape.of(part.text)
            else:
                one, others = constants.meant(part, i)
                maybe += others
                if one is None:
                    continue
                own.append(one)
                # A bare word is a value only where it stands; as a constant it is a name.
                more = shapes[one] if found[one].quoted or not isinstance(next(iter(certain[one]), 0), Literal) else None
            shape = more if shape is None else shape if more is None else shape.joined(more)
        shapes.append(shape)
        certain.append(own)
        possible.append(maybe)
    out: set[tuple[int, int]] = set()
    taken, looked, seen, passed = set(), set(), set(), set()

    def take(i: int) -> None:
        """List the literals that a value certainly consists of."""
        stack = [i]
        while stack:
            d = stack.pop()
            if d not in taken:
                taken.add(d)
                out.update((p.start, p.end) for p in certain[d] if isinstance(p, Literal) and p.end > p.start)
                stack += [p for p in certain[d] if isinstance(p, int)]

    def look(i: int, weight: float) -> None:
        """Score a value, and by itself each value that its parts may mean."""
        stack: list[tuple[str, int | Names]] = [("value", i)]
        while stack:
            kind, at = stack.pop()
            if kind == "names":
                if id(at) in passed:
                    continue
                passed.add(id(at))
                stack += [("value", d) for d in at.own] + [("names", n) for n in at.longer.values()]
                continue
            if kind == "value" and at not in looked:
                looked.add(at)
                if shapes[at] is not None and weight + shapes[at].score() >= THRESHOLD:
                    take(at)
            if at not in seen:
                seen.add(at)
                stack += [("part", p) for p in certain[at] if isinstance(p, int)]
                for places in possible[at]:
                    if isinstance(places, Names):
                        stack.append(("names", places))
                    elif id(places) not in passed:
                        passed.add(id(places))
                        stack += [("value", d) for d in places]

    bare = [not a.quoted and not any(isinstance(p, str) and p in constants for p in a.parts) for a in found]
    for i in sorted(range(len(found)), key=lambda i: -named[i]):
        if named[i] < 2.0:
            break
        if bare[i] and any(_READS.search(p.text) for p in found[i].parts if isinstance(p, Literal)):
            continue
        look(i, named[i])
    return sorted(out)


def _used(target: Assignment, constants: Definitions) -> list[Literal | str]:
    """The parts of a value: a bare word is a name if it is defined in this text, else the literal itself."""
    if target.quoted:
        return target.parts
    known = [p for p in target.parts if isinstance(p, str) and p in constants]
    return known or [p for p in target.parts if isinstance(p, Literal)]


def find(text: str) -> list[tuple[str, int, int, int]]:
    """``(kind, start, end, value_start)`` of every span, by start and then kind; positions in code
    points. Base patterns are leftmost and non-overlapping per kind; literals found by lexing are
    added where no base span covers them."""
    out = [("assign", m.start(), m.end(), m.start(1)) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= _ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", m.start(), m.end(), m.start()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= _ACCESS_LEAST]
    out += [("hex", m.start(), m.end(), m.start()) for m in _HEX.finditer(text)]
    base = sorted((a, b) for _, a, b, _ in out)
    furthest = [0, *accumulate((b for _, b in base), max)]  # end of what begins at or before a span
    starts = [a for a, _ in base]
    for start, end in method_spans(text):
        if end > furthest[bisect_right(starts, start)]:
            out.append(("literal", start, end, start))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def redacted(text: str, mark: str = "[secret]") -> str:
    """``text`` with every found value replaced by ``mark``; the names stay."""
    out, done = [], 0
    for start, end in sorted((value, end) for _, _, end, value in find(text)):
        if end <= done:
            continue
        if start >= done:
            out += [text[done:start], mark]
        done = end
    return "".join([*out, text[done:]])


_SPANS = "array<struct<kind: string, start: int, end: int, value_start: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_start", pa.int32())]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` of every row of ``docs`` (doc_id, text), also of texts without secrets and of
    null texts (no spans). Work and memory are per text; nothing is shuffled, repeated rows
    come out as often as they came in, an empty table gives an empty result."""

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = ("kind", "start", "end", "value_start")
        for batch in (b for whole in batches for b in passes(whole, limit=_PASS)):
            found = [[dict(zip(keys, s, strict=True)) for s in find(t)] for t in texts(batch.column(1)).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, _SPAN_TYPE)], names=["doc_id", "spans"])

    return map_arrow(docs.select("doc_id", F.col("text").cast("string").alias("text")), scanned, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, spans {_SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in ``text`` replaced, and ``n_chars``, where there is one, as the new
    texts have it; other columns, null texts and texts without secrets stay as they are."""

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for whole in batches for b in passes(whole, limit=_PASS)):
            at = batch.schema.get_field_index("text")
            texts_ = [None if t is None else redacted(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts_, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    out = map_arrow(docs, cleaned, docs.schema)
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("text").contains("[secret]"), size).otherwise(F.col("n_chars")))
    return out


def query(spark: SparkSession, folder: str) -> DataFrame:
    spans = scan(table(spark, folder, "documents").select("doc_id", "text"))

    def joined(found):
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return spans.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"] != "literal")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"), count("literal").alias("n_literal"),
    )
