"""Removal of repeated word windows: a count-min sketch first, exact groups second.

Pass 1: each block of documents counts its windows in a sketch of `DEPTH` rows; block sketches are
merged by adding counts, one range of cells per task. Counts are of documents and never too small.
Pass 2: only windows whose every cell counts two or more documents, which are the windows estimated
repeated and some more, are grouped exactly, by a 128-bit BLAKE2b digest of the window's words. A
block sends each such window once, with the smallest id it has, and hears whether another block has
a smaller one.

The sketch has about 8 cells per window of the corpus in each row, whatever its size, and is never
brought together: a task holds one range of it, a block the overfull cells of its own windows.

A word is removed if a window that covers it also starts in a document with a smaller id; windows are
judged on the input. Null texts have no words. Documents with one id (repeated rows, or
different texts of an id, which must be an integer) do not remove each other's words. Rows without id neither remove nor lose words. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .text import covered, mix, window_hashes, word_hashes

WIDTH = 50
DEPTH = 2
CELLS_PER_WINDOW = 8


class Plan:
    """Sizes of the sketch and of the exact pass, and what blocks and shards do in each."""

    def __init__(self, size: int, width: int):
        windows = max(1, size // 6)
        self.width = width
        self.bits = min(56, B.width_bits(windows * CELLS_PER_WINDOW))
        self.shard_bits = B.width_bits(windows / B.SHARD_KEYS, 0)

    def cells(self, hashes: np.ndarray, row: int) -> np.ndarray:
        return mix(hashes, row + 1) >> np.uint64(64 - self.bits)

    def sketch(self, block: B.Block, told: dict) -> list[tuple[int, bytes]]:
        found = [np.unique(window_hashes(word_hashes(block.texts[i]), self.width)) for i in block.open]
        hashes = np.concatenate([np.zeros(0, np.uint64), *found])
        return [part for row in range(DEPTH) for part in B.send_cells(self.cells(hashes, row), self.bits, self.shard_bits, row << self.shard_bits)]

    def candidates(self, block: B.Block, told: dict) -> Candidates:
        """Windows of the block estimated repeated, with their exact keys."""
        full = [B.full_cells(told, "sketch", self.bits, self.shard_bits, row << self.shard_bits) for row in range(DEPTH)]
        owner, place, keys = [], [], []
        for i in block.open:
            hashes = window_hashes(word_hashes(block.texts[i]), self.width)
            hit = np.flatnonzero(np.logical_and.reduce([full[row](self.cells(hashes, row)) for row in range(DEPTH)]))
            if len(hit):
                words = block.texts[i].split()
                line = b" ".join(words)
                starts = np.cumsum([0] + [len(word) + 1 for word in words]).tolist()
                for at in hit.tolist():
                    keys.append(hashlib.blake2b(line[starts[at] : starts[at + self.width] - 1], digest_size=16).digest())
                owner.append(np.full(len(hit), i))
                place.append(hit)
        return Candidates(owner, place, keys, block, self.shard_bits)

    def request(self, block: B.Block, told: dict) -> list[tuple[int, bytes]]:
        found = self.candidates(block, told)
        high, low, least = found.high, found.low, found.least
        return [
            (shard, B.bundle([B.pack(high[a:b]), B.pack(low[a:b]), B.pack(least[a:b])])) for shard, a, b in found.shards() if b > a
        ]

    def result(self, block: B.Block, told: dict) -> pa.Table:
        found = self.candidates(block, told)
        smaller = np.zeros(len(found.high), bool)
        for shard, a, b in found.shards():
            if ("exact", shard) in told:
                smaller[a:b] = np.unpackbits(np.frombuffer(told["exact", shard], np.uint8), count=b - a).astype(bool)
        gone = smaller[found.entry] | (block.ids[found.owner] > found.least[found.entry])
        owner, place = found.owner[gone], found.place[gone]
        cuts = np.searchsorted(owner, np.arange(len(block.ids) + 1))
        rows = []
        for i, text in enumerate(block.texts):
            words = text.split()
            if block.copy[i]:
                mask = np.full(len(words), len(words) >= self.width)
            else:
                mask = covered(len(words), place[cuts[i] : cuts[i + 1]], self.width)
            kept = b" ".join([word for word, out in zip(words, mask.tolist()) if not out]) if mask.any() else b" ".join(words)
            rows.append((None if block.ids[i] == B.NO_ID else int(block.ids[i]), len(words), int(mask.sum()), hashlib.sha256(kept).hexdigest(), kept))
        ids, n_words, n_removed, digests, kept = zip(*rows)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()),
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_sha256": pa.array(digests, pa.string()),
                "kept": pa.array([x.decode() for x in kept], pa.string()),
            }
        )


class Candidates:
    """Occurrences (owner, place, entry) in document order, and one sorted entry per key."""

    def __init__(self, owner: list[np.ndarray], place: list[np.ndarray], keys: list[bytes], block: B.Block, shard_bits: int):
        self.owner = np.concatenate([np.zeros(0, np.int64), *owner])
        self.place = np.concatenate([np.zeros(0, np.int64), *place])
        pairs = np.frombuffer(b"".join(keys), ">u8").astype(np.uint64).reshape(-1, 2)
        order = np.lexsort((pairs[:, 1], pairs[:, 0]))  # stable: the smallest document of a key comes first
        high, low = pairs[order, 0], pairs[order, 1]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.entry = np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.high, self.low, self.least = high[new], low[new], block.ids[self.owner[order[new]]]
        self.shard_bits = shard_bits

    def shards(self) -> list[tuple[int, int, int]]:
        first = np.arange(1, 1 << self.shard_bits, dtype=np.uint64) << np.uint64(64 - self.shard_bits) if self.shard_bits else np.zeros(0, np.uint64)
        cuts = [0, *np.searchsorted(self.high, first).tolist(), len(self.high)]
        return [(shard, a, b) for shard, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def exact(data: list[bytes]) -> list[bytes | None]:
    """Per block, a bit for each of its keys: does another block have it with a smaller id?"""
    parts = [B.unbundle(x) for x in data]
    high, low = (np.concatenate([B.unpack(part[i], np.uint64) for part in parts]) for i in (0, 1))
    ids = [B.unpack(part[2], np.int64) for part in parts]
    least = np.concatenate(ids)
    order = np.lexsort((low, high))
    new = np.ones(len(order), bool)
    new[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
    smallest = np.minimum.reduceat(least[order], np.flatnonzero(new))
    smaller = np.empty(len(order), bool)
    smaller[order] = smallest[np.cumsum(new) - 1] < least[order]
    cuts = np.cumsum([len(x) for x in ids])[:-1]
    return [np.packbits(bits).tobytes() if bits.any() else None for bits in np.split(smaller, cuts)]


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """(id column, n_words, n_removed, kept_sha256, kept) of each row; `kept` is the remaining text."""
    size, count = B.sized(docs, text_column, block_bytes)
    plan = Plan(size, width)
    texts, copies = B.blocked(docs, id_column, text_column, count)
    told = copies.union(B.answer(B.ask(texts, copies, plan.sketch), "sketch", B.merge_cells))
    told = told.union(B.answer(B.ask(texts, told, plan.request), "exact", exact))
    found = B.finish(texts, told, plan.result, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return found.withColumnRenamed("doc_id", id_column)
