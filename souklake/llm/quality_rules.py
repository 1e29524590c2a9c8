"""Quality rules as a short-circuit cascade.

Each rule reads measures of a text and may reject it. On a sample, every rule is timed and its
rejections counted; the rules then run in order of rejections per second among the texts that the
rules before leave, and a text leaves at its first rejection. The order changes the work only: a text
is kept if no rule rejects it.

The sample is one text of each of the `SAMPLE_ROWS` ids with the smallest hashes, whatever the input's
size; tasks try the rules on it and it only orders them. Null texts are texts without words, null ids
are judged but not sampled, very long texts are measured whole in linear time. Empty tables give no rows, other
columns are not read, repeated rows are judged alike.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import WHITE, covered, least_hashed, to_bytes, window_hashes, word_hashes, word_spans

SAMPLE_ROWS = 256

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[97:123] = True


class Measures:
    """Measures of one text; each is computed when a rule first asks for it."""

    def __init__(self, text: bytes):
        self.text = text
        self.bytes = np.frombuffer(text, np.uint8)

    @cached_property
    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        return word_spans(self.text)

    @property
    def n_words(self) -> int:
        return len(self.spans[0])

    @cached_property
    def word_chars(self) -> int:
        return int(((self.bytes & 0xC0 != 0x80) & ~WHITE[self.bytes]).sum())

    @cached_property
    def n_symbols(self) -> int:
        return int(_SYMBOL[self.bytes].sum())

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.text.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        hashes = window_hashes(word_hashes(self.text), 3)
        _, inverse, counts = np.unique(hashes, return_inverse=True, return_counts=True)
        return int(covered(self.n_words, np.flatnonzero(counts[inverse] > 1), 3).sum())

    @cached_property
    def case(self) -> tuple[int, int]:
        return int(_UPPER[self.bytes].sum()), int(_LOWER[self.bytes].sum())

    @cached_property
    def alphabetic_words(self) -> int:
        starts, ends = self.spans
        letters = np.zeros(len(self.bytes) + 1, np.int64)
        np.cumsum(_UPPER[self.bytes] | _LOWER[self.bytes] | (self.bytes >= 0x80), out=letters[1:])
        return int((letters[ends] > letters[starts]).sum())

    def ending(self, marks: tuple[bytes, ...]) -> int:
        return sum(line.rstrip().endswith(marks) for line in self.lines)

    def starting(self, marks: tuple[bytes, ...]) -> int:
        return sum(line.lstrip().startswith(marks) for line in self.lines)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


#: Thresholds of common web-text filters.
RULES = (
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 12 * m.n_words),
    Rule("repeated_lines", lambda m: 10 * m.n_dup_lines > 3 * len(m.lines)),
    Rule("no_letters", lambda m: 10 * m.alphabetic_words < 7 * m.n_words),
    Rule("shouting", lambda m: m.case[0] > 2 * m.case[1] and m.case[0] > m.word_chars // 2),
    Rule("ellipsis_lines", lambda m: 10 * m.ending((b"...", "…".encode())) > 3 * len(m.lines)),
    Rule("bullet_lines", lambda m: 10 * m.starting((b"-", b"*", "•".encode())) > 9 * len(m.lines)),
)


def base_failed(m: Measures) -> bool:
    return m.n_words < 50 or 100 * m.n_repeat_words > 50 * m.n_words


def trial(text: bytes, rules: tuple[Rule, ...] = RULES) -> tuple[bool, list[float], list[bool]]:
    """Base verdict of a text, and the seconds and verdict of each rule where the base measures are there."""
    m = Measures(text)
    failed = base_failed(m)
    m.word_chars, m.n_symbols, m.n_dup_lines  # noqa: B018  every text's base measures are returned anyway
    seconds, rejected = [], []
    for rule in rules:
        started = time.perf_counter()
        rejected.append(bool(rule.rejects(m)))
        seconds.append(time.perf_counter() - started)
    return failed, seconds, rejected


def order(trials: list[tuple[bool, list[float], list[bool]]], rules: tuple[Rule, ...] = RULES) -> list[tuple[Rule, float, float]]:
    """Rules with cost (seconds a text) and share of rejections, in the order in which they should run.

    Only texts that pass the base rules reach the cascade, and a rule only those that the rules before
    it leave: the next rule is always the one with most rejections per second among the texts left.
    """
    left = [(seconds, rejected) for failed, seconds, rejected in trials if not failed]
    waiting, found = list(range(len(rules))), []
    while waiting:
        costs = {r: max(1e-9, sum(seconds[r] for seconds, _ in left)) / max(1, len(left)) for r in waiting}
        shares = {r: (sum(rejected[r] for _, rejected in left) + 1) / (len(left) + 2) for r in waiting}
        best = max(waiting, key=lambda r: shares[r] / costs[r])
        found.append((rules[best], costs[best], shares[best]))
        waiting.remove(best)
        left = [x for x in left if not x[1][best]]
    return found


def trials(docs: DataFrame, id_column: str, text_column: str, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[tuple[bool, list[float], list[bool]]]:
    """Trials of the sampled texts, made by tasks: only numbers, of at most `rows` texts, reach the driver."""
    chosen = least_hashed(docs.select(id_column), id_column, rows)
    # The chosen ids are at most `rows` values: a bounded broadcast. A repeated id is tried with one of its texts.
    one = docs.select(id_column, text_column).join(F.broadcast(chosen), id_column).groupBy(id_column).agg(F.first(text_column).alias(text_column))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            failed, seconds, rejected = zip(*(trial(text, rules) for text in to_bytes(batch.column(0)))) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(failed, pa.bool_()), pa.array(seconds, pa.list_(pa.float64())), pa.array(rejected, pa.list_(pa.bool_()))],
                names=["failed", "seconds", "rejected"],
            )

    found = one.select(text_column).mapInArrow(task, "failed boolean, seconds array<double>, rejected array<boolean>")
    return [(row.failed, row.seconds, row.rejected) for row in found.collect()]


def judge(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    rules: tuple[Rule, ...] = RULES,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per document: id, base measures, `base_failed`, `kept`, `rules_run` and `rejected_by`.

    `rejected_by` names the first rule in the estimated order that rejects the text ("base" for the
    base rules), so it may differ between runs; `kept` does not.
    """
    ordered = tuple(rule for rule, _, _ in order(trials(docs, id_column, text_column, rules, sample_rows), rules))
    docs = docs.select(id_column, text_column)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in to_bytes(batch.column(1)):
                m = Measures(text)
                failed = base_failed(m)
                by, run = ("base" if failed else None), 0
                if not failed:
                    for rule in ordered:
                        run += 1
                        if rule.rejects(m):
                            by = rule.name
                            break
                rows.append((m.n_words, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words, failed, by is None, run, by))
            columns = list(zip(*rows)) or [[]] * 9
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(column, kind) for column, kind in zip(columns, kinds))],
                names=[id_column, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rules_run", "rejected_by"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.mapInArrow(
        task,
        f"`{id_column}` {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, rules_run int, rejected_by string",
    )
