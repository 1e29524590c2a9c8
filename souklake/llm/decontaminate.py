"""Benchmark decontamination with an Aho-Corasick automaton over normalised benchmark texts.

Normalising lower-cases A-Z and takes as words the runs of letters a-z, digits and non-ASCII bytes.
A pattern is a window of consecutive words of one item (the whole item where it has fewer words).
Each document is normalised and scanned once per automaton; hits are mapped back to byte offsets of
the original text. Documents are not shuffled.

Patterns are collected to the driver in groups of items of at most `AUTOMATON_BYTES` of pattern
text, a bound on what one automaton holds; with a benchmark beyond it, a task takes the automata one
after the other for each batch of rows and unites their hits row by row, so that repeated and null
ids are rows like others. Null or wordless texts have no words and no patterns; items without an id
are no items. Repeated items count once. Other columns are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import filtered, to_bytes

WINDOW = 13
AUTOMATON_BYTES = 64 << 20

# A-Z to a-z; other ASCII than letters and digits to a space; bytes of non-ASCII characters stay.
_NORMAL = bytes(
    byte + 32 if 0x41 <= byte <= 0x5A else byte if byte >= 0x80 or 0x61 <= byte <= 0x7A or 0x30 <= byte <= 0x39 else 0x20
    for byte in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def windows(item: bytes, width: int = WINDOW) -> set[bytes]:
    """Patterns of an item: words joined by one space, with a space on either side."""
    parts = words(item)
    if not parts:
        return set()
    return {b" " + b" ".join(parts[i : i + width]) + b" " for i in range(max(1, len(parts) - width + 1))}


@functools.lru_cache(maxsize=2)
def _automaton(key: str, packed: tuple[tuple[bytes, tuple], ...]):
    found = ahocorasick.Automaton()
    for pattern, items in packed:
        found.add_word(pattern.decode("latin-1"), (len(pattern), pattern.count(b" ") - 1, items))
    if len(found):
        found.make_automaton()
    return found


def find(text: bytes, automaton) -> tuple[int, np.ndarray, np.ndarray, set]:
    """Number of words, mask of the hit ones, byte offsets of word starts in the text, items found."""
    normal = text.translate(_NORMAL)
    parts = normal.split()
    hit = np.zeros(len(parts) + 1, np.int32)
    items: set = set()
    if parts and len(automaton):
        starts = None
        line = b" " + b" ".join(parts) + b" "
        for end, (length, count, ids) in automaton.iter(line.decode("latin-1")):
            if starts is None:
                starts = np.cumsum([1] + [len(part) + 1 for part in parts[:-1]])
            first = int(np.searchsorted(starts, end - length + 2))
            hit[first] += 1
            hit[first + count] -= 1
            items.update(ids)
    return len(parts), np.cumsum(hit[:-1]) > 0, normal, items


def word_offsets(normal: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte offsets, in the original text, of the words of its normalised bytes."""
    blank = np.ones(len(normal) + 2, dtype=bool)
    blank[1:-1] = np.frombuffer(normal, np.uint8) == 0x20
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    return edges[0::2], edges[1::2]


def _groups(benchmark: DataFrame, id_column: str, text_column: str, width: int, limit: int) -> Iterator[list[tuple[bytes, tuple]]]:
    """Patterns with their item ids, in groups of about `limit` bytes."""
    items = benchmark.select(id_column, text_column).where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull())
    held: dict[bytes, set] = {}
    size = 0
    for item in items.toLocalIterator():
        for pattern in windows(item[1].encode(), width):
            ids = held.get(pattern)
            if ids is None:
                ids = held[pattern] = set()
                size += len(pattern)
            ids.add(item[0])
        if size >= limit:
            yield [(pattern, tuple(ids)) for pattern, ids in held.items()]
            held, size = {}, 0
    yield [(pattern, tuple(ids)) for pattern, ids in held.items()]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_id_column: str = "item_id",
    item_text_column: str = "text",
    width: int = WINDOW,
    limit: int = AUTOMATON_BYTES,
) -> DataFrame:
    """Per document: id column, `n_words`, `n_hit`, `items` (sorted as strings) and `spans`.

    `spans` are the [start, end) byte offsets, in the original text, of the maximal runs of hit words.
    """
    docs = docs.select(id_column, text_column)
    kind = docs.schema[id_column].dataType.simpleString()
    context = docs.sparkSession.sparkContext

    groups = list(_groups(benchmark, item_id_column, item_text_column, width, limit))
    shared = [(_key(group), context.broadcast(tuple(group))) for group in groups]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = to_bytes(batch.column(1))
            hits: list[np.ndarray] = [np.zeros(0, bool)] * len(texts)
            items: list[set] = [set() for _ in texts]
            for number, (key, patterns) in enumerate(shared):  # rows are united by their place, never by id
                automaton = _automaton(key, patterns.value)
                for i, text in enumerate(texts):
                    _, hit, _, found = find(text, automaton)
                    hits[i] = hits[i] | hit if number else hit
                    items[i] |= set(map(str, found))
            runs = []
            for text, hit in zip(texts, hits):
                edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
                starts, ends = word_offsets(text.translate(_NORMAL)) if len(edges) else ([], [])
                runs.append([{"start": int(starts[a]), "end": int(ends[b - 1])} for a, b in zip(edges[0::2], edges[1::2])])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(hit) for hit in hits], pa.int64()),
                    pa.array([int(hit.sum()) for hit in hits], pa.int64()),
                    pa.array([sorted(names) for names in items], pa.list_(pa.string())),
                    pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=[id_column, "n_words", "n_hit", "items", "spans"],
            )

    return docs.mapInArrow(
        task, f"`{id_column}` {kind}, n_words long, n_hit long, items array<string>, spans array<struct<start:bigint,end:bigint>>"
    )


def contaminated(n_words: int, n_hit: int) -> bool:
    """At least one word in twenty is hit."""
    return n_hit > 0 and 20 * n_hit >= n_words


def clean(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_id_column: str = "item_id", item_text_column: str = "text", width: int = WINDOW, limit: int = AUTOMATON_BYTES) -> DataFrame:
    """The rows, with all their columns, that are not contaminated.

    With several automata, the hit words of a row are united before it is judged: one automaton after
    the other within a task, each built from its group of patterns.
    """
    groups = list(_groups(benchmark, item_id_column, item_text_column, width, limit))
    shared = [(_key(group), docs.sparkSession.sparkContext.broadcast(tuple(group))) for group in groups]

    def judge():
        def passes(texts: list[bytes]) -> list[bool]:
            hits: list[np.ndarray] = [np.zeros(0, bool)] * len(texts)
            for number, (key, patterns) in enumerate(shared):
                automaton = _automaton(key, patterns.value)
                for i, text in enumerate(texts):
                    hit = find(text, automaton)[1]
                    hits[i] = hits[i] | hit if number else hit
            return [not contaminated(len(hit), int(hit.sum())) for hit in hits]

        return passes

    return filtered(docs, text_column, judge)


def _key(patterns: list[tuple[bytes, tuple]]) -> str:
    return hashlib.sha256(repr(sorted(patterns, key=lambda x: x[0])).encode()).hexdigest()
