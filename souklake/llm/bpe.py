"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task takes its texts in blocks of bounded bytes. The distinct words (matches of the split pattern)
of a block that are not ranks themselves form one corpus. An inverted index maps the rank a pair of
neighbouring tokens would merge into to the positions of such pairs; merges are applied corpus-wide
in rank order, and only the two pairs beside a merged one are looked up again. Nothing is shuffled:
a word's tokens do not depend on other words, so blocks are independent and a lost task is rerun
alone.

Nulls are empty texts (no tokens). Empty tables give no rows; other columns of the input are not
read and cannot clash. Repeated rows are encoded each.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .text import slices, to_bytes

#: Chunks kept with their ids in a worker process before it starts anew.
KEPT_CHUNKS = 400_000
#: Bytes of text whose new words are merged together.
BLOCK_BYTES = 6 << 20


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks by token of a tiktoken file."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Vocabulary:
    """Ranks of a tiktoken file and the pairs of tokens that merge.

    The split pattern never matches across a space before a character that is no white space: such a
    space starts a match. So texts are cut at spaces first, and a chunk met before is not split again.
    """

    def __init__(self, lines: bytes, pattern: str):
        ranks = read_ranks(lines)
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        size = max(ranks.values()) + 2
        self.byte = np.array([ranks[bytes([value])] for value in range(256)], np.int32)
        pairs = np.array(
            [
                (ranks[token[:cut]], ranks[token[cut:]], rank)
                for token, rank in ranks.items()
                for cut in range(1, len(token))
                if token[:cut] in ranks and token[cut:] in ranks
            ],
            np.int32,
        ).reshape(-1, 3)
        self.by_left = self._sorted(pairs[:, 0], pairs[:, 1], pairs[:, 2], size)
        self.by_right = self._sorted(pairs[:, 1], pairs[:, 0], pairs[:, 2], size)
        self.byte_pairs = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int32)
        self.known: dict[str, bytes | None] = {}

    @staticmethod
    def _sorted(fixed: np.ndarray, others: np.ndarray, ranks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Others and ranks by fixed token, with the start of each fixed token's entries."""
        by = np.lexsort((others, fixed))
        return np.searchsorted(fixed[by], np.arange(size)), others[by], ranks[by]

    def _lookup(self, table: tuple[np.ndarray, np.ndarray, np.ndarray], fixed: int, others: np.ndarray) -> np.ndarray:
        """Ranks of the pairs of one fixed token with others, -1 where they do not merge."""
        starts, tokens, ranks = table
        low, high = starts[fixed], starts[fixed + 1]
        if low == high:
            return np.full(len(others), -1, np.int32)
        at = np.minimum(np.searchsorted(tokens[low:high], others) + low, high - 1)
        return np.where(tokens[at] == others, ranks[at], -1).astype(np.int32)

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, by all merges over all words in rank order.

        `token` holds the tokens of all words with a separator (-1) behind each word; merged-away
        places hold -2. `rank_at` is the rank that the pair starting at a place merges into. The
        index takes a rank to the places where such a pair arose; stale places fail the comparison
        with `rank_at`. A step merges the leftmost pair of each word, so that a lower rank that
        arises beside it comes before the word's next pair of the same rank.
        """
        if not words:
            return []
        sizes = np.array([len(word) + 1 for word in words])
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum(sizes) - 1
        token = self.byte[raw]
        token[ends] = -1
        size = len(token)
        word_at = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        following = np.arange(1, size + 1, dtype=np.int64)
        previous = np.arange(-1, size - 1, dtype=np.int64)
        rank_at = np.full(size, -1, np.int32)
        both = (token[:-1] >= 0) & (token[1:] >= 0)
        rank_at[:-1][both] = self.byte_pairs[raw[:-1][both], raw[1:][both]]

        index: dict[int, list[np.ndarray]] = {}
        order: list[int] = []

        def enter(places: np.ndarray, ranks: np.ndarray) -> None:
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(ranks):
                return
            by = np.argsort(ranks, kind="stable")
            places, ranks = places[by], ranks[by]
            cuts = np.flatnonzero(np.diff(ranks)) + 1
            for rank, part in zip(ranks[np.concatenate(([0], cuts))].tolist(), np.split(places, cuts)):
                if rank in index:
                    index[rank].append(part)
                else:
                    index[rank] = [part]
                    heapq.heappush(order, rank)

        enter(np.arange(size), rank_at)
        while order:
            rank = heapq.heappop(order)
            parts = index.pop(rank)
            places = np.unique(np.concatenate(parts)) if len(parts) > 1 else np.sort(parts[0])
            places = places[rank_at[places] == rank]
            if not len(places):
                continue
            owner = word_at[places]
            first = np.ones(len(places), bool)
            first[1:] = owner[1:] != owner[:-1]
            if not first.all():
                index[rank] = [places[~first]]
                heapq.heappush(order, rank)
                places = places[first]
            gone = following[places]
            beyond = following[gone]
            token[places], token[gone] = rank, -2
            rank_at[gone] = -1
            following[places] = beyond
            previous[beyond] = places
            right = self._lookup(self.by_left, rank, token[beyond])
            rank_at[places] = right
            enter(places, right)
            before = previous[places]
            before = before[before >= 0]
            before = before[token[before] >= 0]
            left = self._lookup(self.by_right, rank, token[before])
            rank_at[before] = left
            enter(before, left)
        live = token != -2
        token = token[live]
        ends = np.flatnonzero(token == -1)
        data, starts = token.astype("<u4").tobytes(), np.concatenate(([0], ends[:-1] + 1))
        return [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]

    def learn(self, chunks: set[str]) -> None:
        """Adds the ids of chunks, each with a space before it, to those known."""
        if len(self.known) + len(chunks) > KEPT_CHUNKS:
            self.known.clear()
        plain = [chunk for chunk in chunks if chunk.isalpha()]  # one match each
        self.known.update(zip(plain, self.ids_of([" " + chunk for chunk in plain])))
        # A chunk that is empty or begins with white space belongs to the space before it.
        split = {chunk: self.find(" " + chunk) for chunk in chunks if chunk and not chunk.isalpha() and not chunk[0].isspace()}
        words = list({word for parts in split.values() for word in parts})
        ids = dict(zip(words, self.ids_of(words)))
        self.known.update((chunk, b"".join([ids[part] for part in parts])) for chunk, parts in split.items())
        self.known.update((chunk, None) for chunk in chunks if not chunk or chunk[0].isspace())

    def ids_of(self, words: list[str]) -> list[bytes]:
        raws = [word.encode() for word in words]
        ranks = [self.ranks.get(raw) for raw in raws]
        rest = iter(self.replay([raw for raw, rank in zip(raws, ranks) if rank is None]))
        return [next(rest) if rank is None else rank.to_bytes(4, "little") for rank in ranks]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        chunks: set[str] = set()
        for text in texts:  # split again below: pieces of a whole block would take far more memory
            chunks.update(text.split(" ")[1:])
        new = chunks - self.known.keys()
        if new:
            # `learn` may start anew, so that chunks known before are new again.
            self.learn(new if len(self.known) + len(new) <= KEPT_CHUNKS else chunks)
        del chunks, new
        known, found = self.known.__getitem__, []
        for text in texts:
            first, *parts = text.split(" ")
            try:
                found.append((self.find(first), b"".join(map(known, parts))))
            except TypeError:  # a chunk without ids of its own
                found.append((self.find(text), b""))
        words = list({word for head, _ in found for word in head})
        ids = dict(zip(words, self.ids_of(words)))
        return [b"".join([*[ids[word] for word in head], rest]) for head, rest in found]


class Decoder:
    """Bytes of all tokens in one buffer."""

    def __init__(self, lines: bytes):
        ranks = read_ranks(lines)
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.buffer = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(token) for token in tokens])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: bytes) -> bytes:
        tokens = np.frombuffer(ids, "<u4")
        sizes = self.sizes[tokens]
        ends = np.cumsum(sizes)
        if not len(ends):
            return b""
        steps = np.repeat(self.starts[tokens] - (ends - sizes), sizes)
        return self.buffer[steps + np.arange(ends[-1])].tobytes()


@functools.lru_cache(maxsize=2)
def _vocabulary(lines: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(lines, pattern)


@functools.lru_cache(maxsize=2)
def _decoder(lines: bytes) -> Decoder:
    return Decoder(lines)


def vocabulary_lines(path: str) -> bytes:
    """The rank file; it is read once, where the job is planned, and is part of the job."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Id column, `n_tokens` and `ids` (little-endian unsigned 32-bit integers) of each text.

    The rank file has a fixed size and goes to the executors as a broadcast variable.
    """
    docs = docs.select(id_column, text_column)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary_lines(path))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared.value, pattern)
        for batch in slices(batches, text_column, BLOCK_BYTES):
            ids = vocabulary.encode([raw.decode() for raw in to_bytes(batch.column(1))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                names=[id_column, "n_tokens", "ids"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.mapInArrow(task, f"`{id_column}` {kind}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, ids_column: str = "ids") -> DataFrame:
    """The encoded rows with `decoded`, the bytes that their ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary_lines(path))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(shared.value)
        for batch in slices(batches, ids_column, BLOCK_BYTES):
            texts = [decoder.decode(ids or b"") for ids in batch.column(ids_column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], names=[*batch.schema.names, "decoded"])

    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in encoded.schema.fields)
    return encoded.mapInArrow(task, f"{fields}, decoded binary")
