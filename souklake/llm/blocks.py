"""Blockwise exchange between documents and keys found in them, shared by the exact-repeat operators.

Documents are dealt to blocks by a hash of their id, so that every block holds about `block_bytes` of
text. A block tells key shards, in packed arrays, what it holds (one row per block and shard); a shard
sees all blocks' rows for its range of keys and answers each block. Keys of a block are folded before
they are sent, so that a key found in a third of all documents costs at most one entry per block.

    texts, copies = blocked(docs)                   one shuffle of the texts, reused by every pass
    asked  = ask(texts, copies, function)           block -> rows (shard, block, payload)
    told   = answer(asked, kind, function)          shard -> rows (block, kind, shard, payload)
    result = finish(texts, copies + told, ...)      block -> result rows

Functions get numpy arrays and bytes and are run by Spark per block or shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import to_bytes

#: Bytes of text per block and keys per shard: both bound the memory of a task.
BLOCK_BYTES = 6 << 20
SHARD_KEYS = 2 << 20

TOLD = "block int, kind string, shard int, data binary"
NO_ID = np.iinfo(np.int64).max


def pack(values: np.ndarray) -> bytes:
    """Values of any dtype, byte planes apart and compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize) if len(values) else np.zeros((0, 1), np.uint8)
    return zstandard.ZstdCompressor(level=1).compress(raw.T.tobytes())


def unpack(data: bytes, kind: type | np.dtype) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel() if len(raw) else np.zeros(0, kind)


def pack_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned values as packed differences, 16 bits wide where they fit."""
    steps = np.diff(values, prepend=values.dtype.type(0)) if len(values) else values
    wide = len(steps) and int(steps.max()) > 0xFFFF
    return (b"\x04" if wide else b"\x02") + pack(steps.astype(np.uint32 if wide else np.uint16))


def unpack_sorted(data: bytes) -> np.ndarray:
    steps = unpack(data[1:], np.uint32 if data[:1] == b"\x04" else np.uint16)
    return np.cumsum(steps, dtype=np.uint64)


def bundle(parts: list[bytes]) -> bytes:
    return np.array([len(parts), *map(len, parts)], "<u4").tobytes() + b"".join(parts)


def unbundle(data: bytes) -> list[bytes]:
    count = int(np.frombuffer(data, "<u4", 1)[0])
    ends = 4 * (count + 1) + np.cumsum([0, *np.frombuffer(data, "<u4", count, 4).tolist()])
    return [data[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def width_bits(number: float, least: int = 16) -> int:
    """Bits of the smallest power of two that is not below a number."""
    return max(least, int(np.ceil(np.log2(max(1.0, number)))))


def text_key(text: bytes) -> int:
    """The first half of the key by which whole copies are found, as a signed integer."""
    return int.from_bytes(hashlib.sha256(text).digest()[:8], "big", signed=True)


class Block:
    """Documents of one block, in order of their id and text; documents without id come last."""

    def __init__(self, table: pa.Table, told: dict):
        ids = [NO_ID if x is None else x for x in table.column("id").to_pylist()]
        texts = to_bytes(table.column("text"))
        order = sorted(range(len(ids)), key=lambda i: (ids[i], texts[i]))
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        #: Documents whose whole text is in a document with a smaller id; other texts of their ids are not.
        copies = {pair for (kind, _), data in told.items() if kind == "copy" for pair in zip(*(unpack(part, np.int64).tolist() for part in unbundle(data)))}
        named = {x for x, _ in copies}
        self.copy = np.array([x in named and (x, text_key(text)) in copies for x, text in zip(self.ids.tolist(), self.texts)], bool)
        #: Documents whose repeats are looked for.
        self.open = [i for i, x in enumerate(self.ids) if x != NO_ID and not self.copy[i]]
        self.number = table.column("block")[0].as_py()


def sized(docs: DataFrame, text_column: str, block_bytes: int = BLOCK_BYTES) -> tuple[int, int]:
    """Bytes of all texts and number of blocks."""
    size = docs.agg(F.sum(F.octet_length(text_column))).first()[0] or 0
    return size, int(size // block_bytes) + 1


def blocked(docs: DataFrame, id_column: str, text_column: str, blocks: int) -> tuple[DataFrame, DataFrame]:
    """(block, id, text) of the documents, and per block the ids and text keys of whole copies.

    Copies are found by the SHA-256 of the text: hashes are folded before their shuffle, and the join
    back splits hot hashes. The smallest id of equal texts stands for them all.
    """
    named = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    texts = named.select(F.pmod(F.xxhash64(F.coalesce("id", -F.octet_length("text"))), F.lit(blocks)).cast("int").alias("block"), "id", "text")
    hashed = texts.where("id is not null and text is not null").select("block", "id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("hash"))
    first = hashed.groupBy("hash").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").select("hash", "first")

    def packed(key: tuple, table: pa.Table) -> pa.Table:
        ids = np.array(table.column("id").to_pylist(), np.int64)
        keys = np.array([int.from_bytes(x[:8], "big", signed=True) for x in table.column("hash").to_pylist()], np.int64)
        return _answers(key[0].as_py(), "copy", [0], [bundle([pack(ids), pack(keys)])])

    copies = hashed.join(first, "hash").where("id > first").select("block", "id", "hash").groupBy("block").applyInArrow(packed, TOLD)
    return texts, copies


def _answers(block: int | list[int], kind: str, shards: list[int], data: list[bytes]) -> pa.Table:
    blocks = block if isinstance(block, list) else [block] * len(data)
    return pa.table(
        {
            "block": pa.array(blocks, pa.int32()),
            "kind": pa.array([kind] * len(data), pa.string()),
            "shard": pa.array(shards, pa.int32()),
            "data": pa.array(data, pa.binary()),
        }
    )


def _rows(found: list[tuple[int, int, bytes]], names: tuple[str, str]) -> pa.Table:
    one, other, data = zip(*found) if found else ((), (), ())
    return pa.table({names[0]: pa.array(one, pa.int32()), names[1]: pa.array(other, pa.int32()), "data": pa.array(data, pa.binary())})


def _told(table: pa.Table) -> dict[tuple[str, int], bytes]:
    return {(kind, shard): data for kind, shard, data in zip(*(table.column(name).to_pylist() for name in ("kind", "shard", "data")))}


def ask(texts: DataFrame, told: DataFrame, function: Callable[[Block, dict], list[tuple[int, bytes]]]) -> DataFrame:
    """(shard, block, data): what each block sends to the shards, from its texts and what it was told."""

    def one(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table):
            return _rows([], ("shard", "block"))
        heard = _told(answers)
        block = Block(table, heard)
        return _rows([(shard, block.number, data) for shard, data in function(block, heard)], ("shard", "block"))

    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(one, "shard int, block int, data binary")


def note(block: int) -> int:
    """Shard of what a block keeps for itself: it comes back as it is with the answers."""
    return -1 - block


def answer(asked: DataFrame, kind: str, function: Callable[[list[bytes]], list[bytes | None]]) -> DataFrame:
    """(block, kind, shard, data): per shard, an answer to each block (None: nothing to tell)."""

    def one(key: tuple, table: pa.Table) -> pa.Table:
        blocks, data = table.column("block").to_pylist(), table.column("data").to_pylist()
        answers = data if key[0].as_py() < 0 else function(data)
        kept = [(block, x) for block, x in zip(blocks, answers) if x is not None]
        return _answers([x[0] for x in kept], kind, [key[0].as_py()] * len(kept), [x[1] for x in kept])

    return asked.groupBy("shard").applyInArrow(one, TOLD)


def finish(texts: DataFrame, told: DataFrame, function: Callable[[Block, dict], pa.Table], schema: str) -> DataFrame:
    """Result rows of each block from its texts and all answers."""

    def one(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        heard = _told(answers)
        return function(Block(table, heard), heard)

    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(one, schema)


# Repeated fingerprints: shared by both operators, which choose what a fingerprint is.


def send_cells(cells: np.ndarray, bits: int, shard_bits: int, offset: int = 0) -> list[tuple[int, bytes]]:
    """Cells (one per document and key) as sorted shards; more than two of a cell tell nothing more."""
    cells = np.sort(cells)
    extra = np.zeros(len(cells), bool)
    extra[2:] = cells[2:] == cells[:-2]
    cells = cells[~extra]
    each = np.uint64(bits - shard_bits)
    cuts = np.searchsorted(cells, np.arange((1 << shard_bits) + 1, dtype=np.uint64) << each)
    low = cells & np.uint64((1 << int(each)) - 1)
    return [(offset + i, pack_sorted(low[a:b])) for i, (a, b) in enumerate(zip(cuts.tolist(), cuts[1:].tolist())) if b > a]


def distinct(values: np.ndarray) -> np.ndarray:
    """Distinct values of a sorted array."""
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return values[new]


class Members:
    """Membership in sorted values: a table of low bits first, a search for what passes it."""

    BITS = 22

    def __init__(self, values: np.ndarray):
        self.values = values
        self.low = np.zeros(1 << self.BITS, bool)
        self.low[(values & np.uint64((1 << self.BITS) - 1)).astype(np.int64)] = True

    def __call__(self, asked: np.ndarray) -> np.ndarray:
        found = self.low[(asked & np.uint64((1 << self.BITS) - 1)).astype(np.int64)]
        at = np.flatnonzero(found)
        if len(at):
            some = asked[at]
            found[at] = self.values[np.minimum(np.searchsorted(self.values, some), len(self.values) - 1)] == some
        return found


def merge_cells(data: list[bytes]) -> list[bytes | None]:
    """Adds the blocks' counts of a shard and tells each block which of its cells count two or more."""
    blocks = [unpack_sorted(x) for x in data]
    cells = np.sort(np.concatenate(blocks))
    full = distinct(cells[1:][cells[1:] == cells[:-1]])
    member = Members(full)
    found = []
    for own in blocks:
        hit = distinct(own[member(own)])
        found.append(pack_sorted(hit) if len(hit) else None)
    return found


def full_cells(told: dict, kind: str, bits: int, shard_bits: int, offset: int = 0) -> Members:
    """Cells of a block that count two or more."""
    each = np.uint64(bits - shard_bits)
    parts = [
        unpack_sorted(told[kind, offset + shard]) + (np.uint64(shard) << each) for shard in range(1 << shard_bits) if (kind, offset + shard) in told
    ]
    return Members(np.concatenate(parts) if parts else np.zeros(0, np.uint64))
