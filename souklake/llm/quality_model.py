"""Quality classifier: a second-order factorisation machine.

A text becomes a sparse vector of hashed words (log counts, scaled by the text's norm), hashed pairs
of word shapes, and dense columns of structure statistics and metadata (sizes). The machine adds to
a linear model one interaction per pair of features, of low rank, scored in linear time by
sum_{i<j} <v_i, v_j> x_i x_j = (|sum_i v_i x_i|^2 - sum_i |v_i|^2 x_i^2) / 2.

It is fitted on at most `SAMPLE_ROWS` labelled rows, those with the smallest hash of their id; the
bound keeps the driver's share fixed. Every row is scored. Labels, language, source and id are never
features. Null and empty texts are scored by their structure statistics alone. Labels that are null
or that name no document are left out; an id with several labels gives an example for each, with several
rows only one.
Without any label every score is 0.5.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import WHITE, filtered, least_hashed, mix, to_bytes, window_hashes, word_hashes, word_spans

SAMPLE_ROWS = 8_000
WORD_BITS = 14
RANK = 8

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>{}[]\\^~_=+@")] = True
_KIND = np.zeros(256, np.uint8)  # 0 other, 1 upper, 2 lower, 3 digit, 4 punctuation, 5 symbol, 6 non-ASCII
_KIND[65:91], _KIND[97:123], _KIND[48:58], _KIND[128:] = 1, 2, 3, 6
_KIND[list(b".,;:!?'\"()-/")] = 4
_KIND[_SYMBOL] = 5

STATISTICS = (
    "one", "log_words", "log_chars", "few_words", "word_length", "long_words", "upper", "digits", "marks", "symbols", "other",
    "distinct_words", "repeated_windows", "repeated_lines", "line_length", "exclamations",
)
SHAPE_BITS = 9
SIZE = len(STATISTICS) + (1 << SHAPE_BITS) + (1 << WORD_BITS)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    data = np.frombuffer(text, np.uint8)
    starts, ends = word_spans(text)
    count = len(starts)
    kinds = np.bincount(_KIND[data[~WHITE[data]]], minlength=7) if len(data) else np.zeros(7, int)
    size = max(1, int(kinds.sum()))
    lengths = ends - starts
    hashes = word_hashes(text)
    lines = [line for line in text.split(b"\n") if line.strip()]
    windows = window_hashes(hashes, 3)
    words, counts = np.unique(hashes, return_counts=True)
    dense = np.array(
        [
            1.0,
            np.log1p(count) / 10,
            np.log1p(len(data)) / 12,
            1.0 / (1 + count / 20),
            min(4.0, size / max(1, count) / 8),
            float((lengths > 25).sum()) / max(1, count),
            kinds[1] / size,
            kinds[3] / size,
            kinds[4] / size,
            min(1.0, 4 * kinds[5] / size),
            kinds[0] / size,
            len(words) / max(1, count),
            1.0 - len(np.unique(windows)) / max(1, len(windows)) if len(windows) else 0.0,
            1.0 - len(set(lines)) / max(1, len(lines)) if lines else 0.0,
            min(2.0, np.log1p(count / max(1, len(lines))) / 5),
            min(1.0, 5 * text.count(b"!") / max(1, count)),
        ],
        np.float32,
    )
    if not count:
        return np.arange(len(STATISTICS), dtype=np.int64), dense
    bucket = (mix(words, 1) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    value = np.log1p(counts).astype(np.float32)
    # Shape of a word: kinds of its first and last byte, and its length up to seven.
    shape = (_KIND[data[starts]].astype(np.int64) * 8 + _KIND[data[ends - 1]]) * 8 + np.minimum(lengths, 7)
    shapes, often = np.unique(shape, return_counts=True)
    often = often.astype(np.float32) / count
    offset = len(STATISTICS)
    return (
        np.concatenate((np.arange(offset), offset + shapes, offset + (1 << SHAPE_BITS) + bucket)),
        np.concatenate((dense, often, value / np.sqrt((value**2).sum()))),
    )


class Machine:
    """Bias, linear weights and factors; `fit` and `scores` take lists of (indices, values)."""

    def __init__(self, rank: int = RANK, seed: int = 7):
        self.bias = np.float32(0)
        self.weights = np.zeros(SIZE, np.float32)
        self.factors = np.random.default_rng(seed).normal(0, 0.05, (SIZE, rank)).astype(np.float32)

    def margins(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        if not rows:
            return np.zeros(0, np.float32)
        at, x, starts = _joined(rows)
        scaled = self.factors[at] * x[:, None]
        sums = np.add.reduceat(scaled, starts)
        squares = np.add.reduceat((scaled**2).sum(1), starts)
        return self.bias + np.add.reduceat(self.weights[at] * x, starts) + 0.5 * ((sums**2).sum(1) - squares)

    def scores(self, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(rows).astype(np.float64), -30, 30)))

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.05, decay: float = 2e-5) -> Machine:
        """Logistic loss by AdaGrad over shuffled batches; the same rows give the same machine."""
        if not len(labels):
            return self
        share = np.clip(labels.mean(), 0.01, 0.99)
        self.bias = np.float32(np.log(share / (1 - share)))
        turns = np.random.default_rng(11)
        seen_w, seen_v = np.full(SIZE, 1e-4, np.float32), np.full(self.factors.shape, 1e-4, np.float32)
        for _ in range(epochs):
            order = turns.permutation(len(rows))
            for begin in range(0, len(order), batch):
                part = order[begin : begin + batch]
                at, x, starts = _joined([rows[i] for i in part])
                owner = np.repeat(np.arange(len(part)), np.diff(np.append(starts, len(at))))
                scaled = self.factors[at] * x[:, None]
                sums = np.add.reduceat(scaled, starts)
                margin = self.bias + np.add.reduceat(self.weights[at] * x, starts) + 0.5 * ((sums**2).sum(1) - np.add.reduceat((scaled**2).sum(1), starts))
                error = ((1 / (1 + np.exp(-np.clip(margin, -30, 30)))) - labels[part]).astype(np.float32) / len(part)
                self.bias -= np.float32(rate * error.sum())
                push = error[owner] * x
                touched, inverse = np.unique(at, return_inverse=True)
                step = np.bincount(inverse, push, len(touched)).astype(np.float32) + decay * self.weights[touched]
                seen_w[touched] += step**2
                self.weights[touched] -= rate * step / np.sqrt(seen_w[touched])
                pull = push[:, None] * (sums[owner] - scaled)
                step = np.empty((len(touched), self.factors.shape[1]), np.float32)
                for column in range(step.shape[1]):
                    step[:, column] = np.bincount(inverse, pull[:, column], len(touched))
                step += decay * self.factors[touched]
                seen_v[touched] += step**2
                self.factors[touched] -= rate * step / np.sqrt(seen_v[touched])
        return self

    def packed(self) -> bytes:
        return np.concatenate(([self.bias], self.weights, self.factors.ravel())).astype("<f4").tobytes()

    @staticmethod
    def unpacked(data: bytes) -> Machine:
        machine, numbers = Machine.__new__(Machine), np.frombuffer(data, "<f4")
        machine.bias, machine.weights, machine.factors = numbers[0], numbers[1 : SIZE + 1], numbers[SIZE + 1 :].reshape(SIZE, -1)
        return machine


def _joined(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = [len(row[0]) for row in rows]
    return np.concatenate([row[0] for row in rows]), np.concatenate([row[1] for row in rows]), np.cumsum([0, *sizes[:-1]])


@functools.lru_cache(maxsize=2)
def _unpacked(data: bytes) -> Machine:
    return Machine.unpacked(data)


def fold(id_column: str = "doc_id", folds: int = 4) -> Column:
    """Fold of a row by the CRC-32 of its id as text; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds, F.lit(0))


def examples(docs: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int, id_column: str, text_column: str) -> DataFrame:
    """Features and label of the sampled rows; texts leave the executors as features only."""
    ids = docs.select(id_column).distinct()  # labels of no document take no place in the sample
    named = labels.where(usable & F.col(label).isNotNull()).select(id_column, F.col(label).cast("float").alias("_label"))
    chosen = least_hashed(named.join(ids, id_column, "left_semi"), id_column, rows)
    # The chosen ids are at most `rows` rows: a bounded broadcast.
    joined = docs.select(id_column, text_column).join(F.broadcast(chosen), id_column).select(id_column, "_label", text_column)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(text) for text in to_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([at.astype("<i4").tobytes() for at, _ in found], pa.binary()),
                    pa.array([x.astype("<f4").tobytes() for _, x in found], pa.binary()),
                ],
                names=[id_column, "label", "at", "x"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    found = joined.mapInArrow(task, f"`{id_column}` {kind}, label float, at binary, x binary")
    # One example of each id and label, however often their rows are repeated: at most `rows`.
    one = found.groupBy(id_column, "label").agg(F.min(F.struct("at", "x")).alias("features"))
    return one.select(id_column, "label", "features.at", "features.x")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", usable: Column | None = None, rows: int = SAMPLE_ROWS, id_column: str = "doc_id", text_column: str = "text") -> Machine:
    usable = F.lit(True) if usable is None else usable
    found = [
        (row[0], bytes(row[2]), bytes(row[3]), row[1]) for row in examples(docs, labels, label, usable, rows, id_column, text_column).toLocalIterator()
    ]
    found.sort()
    data = [(np.frombuffer(at, "<i4").astype(np.int64), np.frombuffer(x, "<f4")) for _, at, x, _ in found]
    return Machine().fit(data, np.array([y for *_, y in found], np.float32))


def score(docs: DataFrame, machine: Machine, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id column and `score` of each row. The machine has a fixed size and is broadcast."""
    docs = docs.select(id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(machine.packed())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _unpacked(shared.value)
        for batch in batches:
            texts = to_bytes(batch.column(1))
            scores = [held.scores([features(text) for text in texts[i : i + 32]]) for i in range(0, len(texts), 32)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0), *scores]), pa.float64())], names=[id_column, "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.mapInArrow(task, f"`{id_column}` {kind}, score double")


def accepted(docs: DataFrame, machine: Machine, least: float = 0.7, text_column: str = "text") -> DataFrame:
    """The rows, with all their columns, that score `least` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(machine.packed())

    def judge():
        held = _unpacked(shared.value)
        return lambda texts: [bool(x >= least) for i in range(0, len(texts), 32) for x in held.scores([features(text) for text in texts[i : i + 32]])]

    return filtered(docs, text_column, judge)
