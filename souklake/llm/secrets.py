"""Secret scan by assignment-aware lexing.

Fixed patterns find assigned credentials, access keys and long hexadecimal runs. Beyond them, source
and configuration syntax is read as a sequence of assignments: `name = value` (also `:`, `:=`, `=>`, `+=`,
`name: type = value`, `table["name"] = value`), `<name>value</name>` and pairs `name: NAME, value: value`.
A value is an expression of
- literals in quotes, with escapes and prefixes, also long ones and such within quoted JSON; the text beside
  placeholders of formatted ones;
- names, whose constants are carried on and folded with what is added to them; unknown names are skipped;
- lists of literals (brackets, or dashes in the lines below), each judged by itself, indented blocks after
  `|` or `>`, and bare words up to white space. What a call returns is no literal.
A value is scored by its target names and its own look; names are cut into parts at case changes and separators.

Spans are [start, end) in code points of the text, without quotes. Nulls are empty texts without spans. Empty tables
give no rows, other columns are not read, repeated rows are scanned each. The time is linear in the text's
length. Nothing is shuffled.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "literal")
#: A literal from this score on is a secret.
LEAST_SCORE = 1.0
#: Least look of an item of a list written in lines, which may be prose.
LIST_SCORE = 0.3


class Span(NamedTuple):
    kind: str
    start: int
    end: int


_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_RUN = re.compile(r"[0-9a-f]{24}")

# A name begins where its run of name characters does (but for leading digits, dots and dashes), and
# what has been read is not read again, so that a text costs one pass however long its runs are.
_TARGET = re.compile(
    r"""(?<![A-Za-z0-9_.-])[0-9.-]*+(?P<name>[A-Za-z_][A-Za-z0-9_.-]*+)\\?+["'`]?+\]?+[\x20\t]*+(?P<sign>=>|:=|\+=|[:=](?![:=]))"""
    r"""|<(?P<tag>[A-Za-z_][\w.-]*+)(?P<marks>\s[^<>]*+)?+>(?P<inner>[^<>]++)</(?P=tag)>""",
    re.ASCII,
)
_STRING = re.compile(
    r"""(?P<prefix>[rRbBfFuUL@$]{0,2})(?:(?P<mark>\"{3}|'{3})(?P<long>(?:[^"'\\]++|\\.|(?!(?P=mark))["'])*+)(?P=mark)"""
    r"""|"(?P<double>(?:[^"\\\n]++|\\.)*+)"|'(?P<single>(?:[^'\\\n]++|\\.)*+)'|`(?P<back>(?:[^`\\\n]++|\\.)*+)`|\\"(?P<nested>[^"\\\n]*+)\\")""",
    re.DOTALL,
)
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_.-]*+", re.ASCII)
_BARE = re.compile(r"""[^\s"'`,;(){}\[\]]*[^\s"'`,;(){}\[\].:=!?]""")
_TYPE = re.compile(r"[\x20\t]*+([A-Za-z_][\w.]*+)(?:\[[\w., |]*+\])?+\??+[\x20\t]++=[\x20\t]++")
_BEFORE = re.compile(r"""[\x20\t]*+(?:\\?\r?\n[\x20\t]*+(?=[rRbBfFuU]?["'`]))?+""")
_JOIN = re.compile(r"[\x20\t]*+(\+|\.\.?|~|&)?+[\x20\t]*+")
_JOIN_LINES = re.compile(r"\s*+(\+|\.\.?|~|&)?+\s*+")
_ADDED = re.compile(r"""[\x20\t]*+\+[\x20\t]*+(?=[rRbBfFuU]?["'`])""")
_BLOCK = re.compile(r"[|>][+-]?\d?[\x20\t]*+\r?\n")
_LINE = re.compile(r"([\x20\t]*+)([^\n]*+)(?:\n|\Z)")
_ITEM = re.compile(r"[\x20\t]*+\r?\n[\x20\t]*+-[\x20\t]++")
_LIST_GAP = re.compile(r"[\s,]*+")
_HOLE = re.compile(r"\$\{([^{}\n]*+)\}")
_FORMAT_HOLE = re.compile(r"\{([^{}\n]*+)\}")
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")

#: Weight of a part of a name for what is assigned to it.
NAME_WEIGHTS = {
    "password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "pass": 0.8, "secret": 1.0, "token": 0.8, "apikey": 1.0,
    "credential": 0.8, "credentials": 0.8, "auth": 0.5, "key": 0.4, "api": 0.4, "private": 0.4, "access": 0.3, "bearer": 0.8,
    "signature": 0.5, "passwords": 1.0, "secrets": 0.8, "tokens": 0.8, "dsn": 0.5, "session": 0.3, "client": 0.1,
}
#: Names whose value names the next assignment, and names of such an assignment.
_NAMING = frozenset(("key", "name", "id"))
_PAIRED = frozenset(("value", "val", "content", "default"))
_SIGN = re.compile(r"[:=]")
#: Values that only stand for a secret.
_PLACEHOLDER = re.compile(r"(?:x+|\*+|\.+|none|null|true|false|changeme|example|placeholder|todo|your[_-].*|<.*>|\$\{.*|\{\{.*)", re.IGNORECASE)


def name_score(name: str) -> float:
    return min(1.5, sum(NAME_WEIGHTS.get(part.lower(), 0.0) for part in _WORDS.findall(name)))


def entropy(counts: Counter[str], length: int) -> float:
    """Bits a character."""
    return -sum(count / length * math.log2(count / length) for count in counts.values()) if length else 0.0


class Value:
    """A literal or what literals and constants are folded to: known by the counts of its characters and its parts."""

    __slots__ = ("text", "place", "parts", "reported", "_counts")

    def __init__(self, text: str | None, place: tuple[int, int] | None, parts: list[Value] = []):
        self.text, self.place, self.parts, self.reported = text, place, parts, False
        self._counts: tuple[Counter[str], int] | None = None
        if parts:
            counts: Counter[str] = Counter()
            for part in parts:
                counts.update(part.counts()[0])
            self._counts = counts, sum(part.counts()[1] for part in parts)

    def counts(self) -> tuple[Counter[str], int]:
        if self._counts is None:
            self._counts = Counter(self.text), len(self.text or "")
        return self._counts

    def score(self) -> float:
        """From -1 (no secret) to 1 by length, mixture of character classes and entropy."""
        counts, length = self.counts()
        if length < 6 or (self.text is not None and _PLACEHOLDER.fullmatch(self.text)):
            return -1.0
        mixed = sum(any(map(test, counts)) for test in (str.islower, str.isupper, str.isdigit)) + any(not char.isalnum() for char in counts)
        return min(1.0, 0.2 * (mixed - 1) + 0.15 * max(0.0, entropy(counts, length) - 2.5) + 0.1 * (length >= 16))

    def places(self) -> Iterator[tuple[int, int]]:
        """Places of all literals in it that have not been given before."""
        left = [self]
        while left:
            value = left.pop()
            if not value.reported:
                value.reported = True
                left += value.parts
                if value.place:
                    yield value.place


def folded(parts: list[Value]) -> Value:
    return parts[0] if len(parts) == 1 else Value(None, None, parts)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, leftmost and not overlapping within a kind."""
    found = []
    if "=" in text or ":" in text:
        found += [Span("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [Span("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    at = 0
    while run := _HEX_RUN.search(text, at):  # a run of 24 begins its whole run
        whole = _HEX.match(text, run.start())
        found.append(Span("hex", whole.start(), whole.end()))
        at = whole.end()
    return found


def _literal(m: re.Match, text: str, constants: dict[str, Value]) -> list[Value]:
    """The parts of a quoted literal: one, or those beside its placeholders and the constants in them."""
    group = next(name for name in ("long", "double", "single", "back", "nested") if m[name] is not None)
    start, end = m.span(group)
    raw = "r" in m["prefix"].lower() or "@" in m["prefix"]
    hole = _FORMAT_HOLE if set(m["prefix"]) & set("fF$") else _HOLE
    if "{" not in m[group] or not hole.search(text, start, end):
        return [Value(m[group] if raw else _ESCAPE.sub(r"\1", m[group]), (start, end))]
    parts, at = [], start
    for gap in [*hole.finditer(text, start, end), None]:
        stop = gap.start() if gap else end
        if stop > at:
            parts.append(Value(text[at:stop], (at, stop)))
        if gap:
            if gap[1] in constants:
                parts.append(constants[gap[1]])
            at = gap.end()
    return parts or [Value("", (start, end))]


def _lines(text: str, at: int, indent: int) -> tuple[list[Value], int]:
    """The lines from a place that are indented deeper."""
    parts = []
    while at < len(text):
        line = _LINE.match(text, at)
        content = line[2].rstrip()
        if content and len(line[1]) <= indent:
            break
        if content:
            parts.append(Value(content, (line.start(2), line.start(2) + len(content))))
        at = line.end()
    return parts, at


def _value(text: str, at: int, target: re.Match, constants: dict[str, Value]) -> tuple[list[Value], int]:
    """The values assigned to a target (several of a list), and where to read on."""
    at = _BEFORE.match(text, at).end()
    if target["sign"] == ":" and (block := _BLOCK.match(text, at)):
        begin = text.rfind("\n", 0, target.start()) + 1
        indent = _LINE.match(text, begin)[1] if begin + 400 > target.start() else ""
        parts, end = _lines(text, block.end(), len(indent))
        return [folded(parts)] if parts else [], end
    values = []
    if target["sign"] == ":":
        end = at
        while item := _ITEM.match(text, end):
            m = _STRING.match(text, item.end()) or _BARE.match(text, item.end())
            if not m or text[m.end() : m.end() + 1] not in ("", "\r", "\n"):
                break
            values.append(folded(_literal(m, text, constants)) if m.re is _STRING else Value(m[0], m.span()))
            end = m.end()
        if values:
            return [value for value in values if value.score() >= LIST_SCORE], end
    if text.startswith("[", at):
        at = _LIST_GAP.match(text, at + 1).end()
        while m := _STRING.match(text, at):
            values.append(folded(_literal(m, text, constants)))
            at = _LIST_GAP.match(text, m.end()).end()
        return values, at
    join = _JOIN
    if text.startswith("(", at):
        join = _JOIN_LINES
        at = _LIST_GAP.match(text, at + 1).end()
    parts: list[Value] = []
    first, added, end = True, False, at
    while True:
        m = _STRING.match(text, at)
        if m:
            parts += _literal(m, text, constants)
            end = m.end()
        elif (first or added) and (m := _NAME.match(text, at)):
            plus = _ADDED.match(text, m.end())
            bare = _BARE.match(text, at)
            alone = plus or bare.end() <= m.end() or text.startswith("+", m.end())
            if m[0] in constants and alone and text[m.end() : m.end() + 1] not in ("(", "["):
                parts.append(constants[m[0]])
            elif not plus:
                break
            end = m.end()
        else:
            break
        joint = join.match(text, end)
        first, added, at = False, bool(joint[1]), joint.end()
    if first and (bare := _BARE.match(text, at)):
        end = bare.end()
        if text[end : end + 1] not in ("(", "["):
            parts.append(Value(bare[0], bare.span()))
    return [folded(parts)] if parts else [], end


def literals(text: str) -> Iterator[tuple[str, Value]]:
    """(name, value) of each assignment, constants carried on."""
    constants: dict[str, Value] = {}
    at, paired = 0, None
    while target := _TARGET.search(text, at):
        if target["tag"]:
            inner = target["inner"].strip()
            start = target.start("inner") + len(target["inner"]) - len(target["inner"].lstrip())
            value = Value(inner, (start, start + len(inner)))
            yield target["tag"], value
            for mark in _TARGET.finditer(target["marks"] or ""):
                if mark["name"] in _NAMING and (m := _STRING.match(target["marks"], mark.end())):
                    yield m["double"] or m["single"] or "", value
            at = target.end("tag")
            continue
        name = target["name"]
        # `name: other = value` is a typed name or one within prose; both names stand for the value.
        typed = _TYPE.match(text, target.end()) if target["sign"] == ":" else None
        values, at = _value(text, typed.end() if typed else target.end(), target, constants)
        for value in values:
            yield name, value
            if typed:
                yield typed[1], value
            if paired and name.lower() in _PAIRED:
                yield paired, value
        # Quoted text may hold assignments of its own, such as a connection string.
        first = values[0].place if values else None
        if first and first[0] > target.end() and text[first[0] - 1] in "\"'`" and _SIGN.search(text, *first):
            at = first[0]
        paired = values[0].text if len(values) == 1 and name.lower() in _NAMING else None
        if len(values) == 1:
            before = constants.get(name) if target["sign"] == "+=" else None
            constants[name] = folded([before, values[0]]) if before else values[0]
            if typed:
                constants[typed[1]] = values[0]


def scan_text(text: str) -> list[Span]:
    """All spans of a text by start, then kind; literals inside other spans are not listed again."""
    base = base_spans(text)
    found = set(base)
    if "=" in text or ":" in text or "</" in text:
        ordered = sorted(base, key=lambda span: span.start)
        starts, reach = [span.start for span in ordered], list(accumulate((span.end for span in ordered), max))
        for name, value in literals(text):
            weight = name_score(name)
            # The name must speak for a secret; the look of the value alone never does.
            if weight >= 0.7 and weight + value.score() >= LEAST_SCORE:
                for start, end in value.places():
                    before = bisect_right(starts, start)
                    if end > start and not (before and reach[before - 1] >= end):
                        found.add(Span("literal", start, end))
    return sorted(found, key=lambda span: (span.start, KINDS.index(span.kind), span.end))


def redact_text(text: str, spans: list[Span], mark: str = "[SECRET]") -> str:
    """The text with each maximal run of overlapping spans replaced by the mark."""
    parts, at = [], 0
    for span in sorted(spans, key=lambda span: span.start):
        if span.start >= at:
            parts += [text[at : span.start], mark]
        at = max(at, span.end)
    return "".join([*parts, text[at:]])


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", redact: bool = False) -> DataFrame:
    """Id column and `spans` (kind, start, end) of each text; with `redact`, also `redacted`."""
    docs = docs.select(id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    struct = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            spans = [scan_text(text or "") for text in texts]
            columns = [batch.column(0), pa.array([[span._asdict() for span in row] for row in spans], struct)]
            names = [id_column, "spans"]
            if redact:
                columns.append(pa.array([text and redact_text(text, row) for text, row in zip(texts, spans)], pa.string()))
                names.append("redacted")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"`{id_column}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.mapInArrow(task, schema + (", redacted string" if redact else ""))


def redacted(docs: DataFrame, text_column: str = "text", length_column: str | None = None, mark: str = "[SECRET]") -> DataFrame:
    """All rows and columns, with the mark in place of secrets and the length column set to the code points left."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_column)
            texts = [text and redact_text(text, scan_text(text), mark) for text in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if length_column:
                place = batch.schema.get_field_index(length_column)
                lengths = [old if text is None else len(text) for text, old in zip(texts, batch.column(place).to_pylist())]
                columns[place] = pa.array(lengths, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(task, docs.schema)
