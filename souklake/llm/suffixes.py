"""Removal of repeated byte strings by blockwise suffix sorting with difference covers.

A difference cover of v holds residues such that any two positions have a common shift below v that
takes both to a covered residue.

1. Cover samples: two equal strings of `WIDTH` bytes share, at some shift below 21, a sampled string
   of WIDTH - 20 bytes. Only sampled positions are fingerprinted; fingerprints found in two documents
   or more mark the suffixes before them as candidates. All others are unique.
2. Buckets: a candidate goes to a suffix bucket by the least hash of the 16-byte strings in its WIDTH
   bytes; neighbours with one bucket travel as one fragment of text, once per block of documents.
3. A task folds fragments that several blocks sent, leaves out suffixes whose string's hash is in a
   cell of its own (they are unique), and sorts the others by 16 bytes. For ties, ranks of the samples
   of a cover of 7 are computed first; then one inner bucket of tied suffixes at a time is resolved by
   sample ranks: a suffix's place is the number of smaller suffixes of each residue, counted at the
   shift that both residues share. Equal strings are then neighbours, compared in full.

Bytes inside a string of WIDTH bytes that also starts in a document with a smaller id are removed;
strings are judged on the input and do not cross documents. Null texts are empty. Documents with one
id (repeated rows) do not remove each other's bytes; rows without id neither remove nor lose bytes.
Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import blocks as B
from .text import covered, mix, powers, prefix_sums

WIDTH = 50
#: Perfect difference covers.
SAMPLE_PERIOD, SAMPLE_COVER = 21, (3, 6, 7, 12, 14)
SORT_PERIOD, SORT_COVER = 7, (0, 1, 3)
GRAM = 16
#: Bytes compared before ranks; at least SORT_PERIOD.
HEAD = 16
CELLS_PER_SAMPLE = 256
BUCKET_BYTES = 16 << 20
INNER_SUFFIXES = 1 << 20


def shift(a: int, b: int) -> int:
    """Shift that takes both residues of SORT_PERIOD to covered ones."""
    return next(d for d in range(SORT_PERIOD) if (a + d) % SORT_PERIOD in SORT_COVER and (b + d) % SORT_PERIOD in SORT_COVER)


def string_hashes(sums: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[starts + width] - sums[starts]) * down[starts])


class Plan:
    def __init__(self, size: int, width: int):
        if width < SAMPLE_PERIOD + GRAM:
            raise ValueError(f"strings must have {SAMPLE_PERIOD + GRAM} bytes or more")
        self.width = width
        self.gram = width - SAMPLE_PERIOD + 1
        samples = max(1, size * len(SAMPLE_COVER) // SAMPLE_PERIOD)
        self.bits = min(56, B.width_bits(samples * CELLS_PER_SAMPLE, 24))
        self.shard_bits = B.width_bits(samples / B.SHARD_KEYS, 0)
        self.buckets = int(4 * size // BUCKET_BYTES) + 1

    def samples(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sampled positions of a text, the cells of their strings, and the text's prefix sums."""
        count = len(text) - self.gram + 1
        if len(text) < self.width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(1, np.uint64)
        periods = np.arange(0, count + SAMPLE_PERIOD, SAMPLE_PERIOD)[:, None] + np.array(SAMPLE_COVER)
        starts = periods.ravel()
        starts = starts[starts < count]
        sums = prefix_sums(np.frombuffer(text, np.uint8))
        return starts, string_hashes(sums, starts, self.gram) >> np.uint64(64 - self.bits), sums

    def sample(self, block: B.Block, told: dict) -> list[tuple[int, bytes]]:
        cells = np.concatenate([np.zeros(0, np.uint64), *(np.unique(self.samples(block.texts[i])[1]) for i in block.open)])
        return B.send_cells(cells, self.bits, self.shard_bits)

    def pieces(self, text: bytes, full: B.Members) -> list[tuple[int, int, int]]:
        """(bucket, first, end) of the runs of candidate suffixes of one bucket."""
        starts, cells, sums = self.samples(text)
        hit = starts[full(cells)]
        if not len(hit):
            return []
        count = len(text) - self.width + 1
        steps = np.zeros(count + SAMPLE_PERIOD + 1, np.int32)
        np.add.at(steps, np.maximum(0, np.minimum(hit, count + SAMPLE_PERIOD - 1) - SAMPLE_PERIOD + 1), 1)
        np.add.at(steps, np.minimum(hit, count + SAMPLE_PERIOD - 1) + 1, -1)
        wanted = np.flatnonzero(np.cumsum(steps)[:count] > 0)
        if not len(wanted):
            return []
        begin, end = int(wanted[0]), int(wanted[-1]) + 1
        grams = string_hashes(sums, np.arange(begin, end + self.width - GRAM), GRAM)
        span, least = self.width - GRAM + 1, grams
        size = 1
        while size < span:
            step = min(size, span - size)
            least = np.minimum(least[: len(least) - step], least[step:])
            size += step
        bucket = (mix(least[wanted - begin], 3) % np.uint64(self.buckets)).astype(np.int64)
        cuts = np.flatnonzero((np.diff(wanted) != 1) | (np.diff(bucket) != 0)) + 1
        firsts = np.concatenate(([0], cuts))
        lasts = np.concatenate((cuts, [len(wanted)])) - 1
        return list(zip(bucket[firsts].tolist(), wanted[firsts].tolist(), (wanted[lasts] + 1).tolist()))

    def request(self, block: B.Block, told: dict) -> list[tuple[int, bytes]]:
        """Fragments by bucket, each once with the smallest id that has it; the block notes where they occur."""
        full = B.full_cells(told, "sample", self.bits, self.shard_bits)
        by: dict[int, dict[bytes, list[int]]] = {}
        owners, firsts, places = [], [], []
        for i in block.open:  # in order of ids: the first occurrence has the smallest
            text, own = block.texts[i], int(block.ids[i])
            for bucket, first, end in self.pieces(text, full):
                held = by.setdefault(bucket, {})
                place = held.setdefault(text[first : end + self.width - 1], [own, 0])
                owners.append(i)
                firsts.append(first)
                places.append(place)
        rows, at = [], 0
        for bucket, held in by.items():
            least = B.pack(np.array([place[0] for place in held.values()], np.int64))
            lengths = B.pack(np.array([len(data) for data in held], np.uint32))
            rows.append((bucket, B.bundle([lengths, least, B.pack(np.frombuffer(b"".join(held), np.uint8))])))
            for number, place in enumerate(held.values(), at):
                place[1] = number
            at += len(held)
        every = [(bucket, len(data) - self.width + 1, place[0]) for bucket, held in by.items() for data, place in held.items()]
        columns = [*(np.array([x[c] for x in every], np.int64) for c in range(3)), np.array(owners, np.int64), np.array(firsts, np.int64), np.array([place[1] for place in places], np.int64)]
        return [*rows, (B.note(block.number), B.bundle([B.pack(column) for column in columns]))]

    def sort(self, data: list[bytes]) -> list[bytes | None]:
        return sort_bucket(data, self.width)

    def result(self, block: B.Block, told: dict) -> pa.Table:
        noted = B.unbundle(told["sort", B.note(block.number)])
        bucket, size, least, owner, first, number = (B.unpack(column, np.int64) for column in noted)
        # Bits of all fragments, bucket by bucket in the order of the note.
        bits = np.zeros(int(size.sum()), bool)
        starts = np.flatnonzero(np.diff(bucket, prepend=-1))
        offset = np.cumsum(size) - size
        for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(bucket)]):
            found = told.get(("sort", int(bucket[a])))
            if found is not None:
                count = int(size[a:b].sum())
                bits[offset[a] : offset[a] + count] = np.unpackbits(np.frombuffer(found, np.uint8), count=count).astype(bool)
        # Removed suffixes of all occurrences at once: whole fragments under a larger id, else by bit.
        count = size[number]
        steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        gone = np.repeat(block.ids[owner] > least[number], count) | bits[np.repeat(offset[number], count) + steps]
        place, owner = (np.repeat(first, count) + steps)[gone], np.repeat(owner, count)[gone]
        cuts = np.searchsorted(owner, np.arange(len(block.ids) + 1))
        rows = []
        for i, text in enumerate(block.texts):
            size = len(text)
            if block.copy[i]:
                mask = np.full(size, size >= self.width)
            elif cuts[i + 1] > cuts[i]:
                mask = covered(size, place[cuts[i] : cuts[i + 1]], self.width)
            else:
                mask = np.zeros(size, bool)
            edges = np.flatnonzero(np.diff(np.concatenate(([False], mask, [False])).astype(np.int8)))
            kept = np.frombuffer(text, np.uint8)[~mask].tobytes() if len(edges) else text
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(edges[0::2], edges[1::2])]
            rows.append((None if block.ids[i] == B.NO_ID else int(block.ids[i]), size, int(mask.sum()), len(spans), hashlib.sha256(kept).hexdigest(), spans))
        columns = list(zip(*rows))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
        names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")
        return pa.table({name: pa.array(column, kind) for name, column, kind in zip(names, columns, kinds)})


def _words(buffer: np.ndarray, at: np.ndarray, width: int) -> list[np.ndarray]:
    """The `width` bytes at each position as big-endian 64-bit numbers, the last one cut to the width."""
    words = np.ndarray((len(buffer) - 7,), ">u8", buffer=buffer, strides=(1,))
    found = [words[at + offset].astype(np.uint64) for offset in range(0, width, 8)]
    if width % 8:
        found[-1] >>= np.uint64(64 - 8 * (width % 8))
    return found


def sort_bucket(data: list[bytes], width: int) -> list[bytes | None]:
    """Per block, a bit for each suffix of its fragments: has another fragment its string under a smaller id?"""
    parts = [B.unbundle(x) for x in data]
    sizes = [B.unpack(part[0], np.uint32).astype(np.int64) for part in parts]
    lengths = np.concatenate(sizes)
    owners = np.concatenate([B.unpack(part[1], np.int64) for part in parts])
    buffer = np.concatenate([*(B.unpack(part[2], np.uint8) for part in parts), np.zeros(width + 2 * SORT_PERIOD + 8, np.uint8)])
    del parts
    starts = np.cumsum(lengths) - lengths
    counts = lengths - width + 1

    # A fragment that several blocks sent is sorted once, under its smallest id.
    whole, numbers = buffer.tobytes(), {}
    one = np.array([numbers.setdefault(whole[a : a + n], len(numbers)) for a, n in zip(starts.tolist(), lengths.tolist())], np.int64)
    del whole, numbers
    lead = np.unique(one, return_index=True)[1]
    lowest = np.full(len(lead), B.NO_ID)
    np.minimum.at(lowest, one, owners)
    sorted_counts = counts[lead]
    firsts = np.cumsum(sorted_counts) - sorted_counts
    every = np.repeat(starts[lead] - firsts, sorted_counts) + np.arange(sorted_counts.sum())

    # A suffix alone in the cell of its string's hash is unique; equal strings share a cell.
    cells = B.width_bits(4 * len(every))
    cell = (string_hashes(prefix_sums(buffer), every, width) >> np.uint64(64 - cells)).astype(np.int64)
    met = np.flatnonzero(np.bincount(cell, minlength=1 << cells)[cell] > 1)
    del cell
    suffixes, least = every[met], np.repeat(lowest, sorted_counts)[met]
    del every

    # Suffixes alone with their first bytes are sorted already; only ties need ranks.
    head = _words(buffer, suffixes, HEAD)
    by_head = np.lexsort(head[::-1])
    tie = np.zeros(len(by_head) + 1, bool)  # equal to the one before
    tie[1:-1] = np.logical_and.reduce([word[by_head[1:]] == word[by_head[:-1]] for word in head])
    tied = tie[:-1] | tie[1:]
    by_head, group = by_head[tied], np.cumsum(~tie[:-1])[tied]
    del head

    # Ranks of the cover samples that ties can ask for.
    reach = np.zeros(len(buffer), bool)
    for d in range(SORT_PERIOD):
        reach[suffixes[by_head] + d] = True
    reach &= np.isin(np.arange(SORT_PERIOD), SORT_COVER)[np.arange(len(buffer)) % SORT_PERIOD]
    rank = np.zeros(len(buffer), np.int64)
    sampled = np.flatnonzero(reach)
    rank[sampled] = _ranks(buffer, sampled, width)
    del reach, sampled

    # Inner buckets: whole groups of tied suffixes, about INNER_SUFFIXES at a time.
    edges = np.flatnonzero(np.diff(group)) + 1
    cuts = [0]
    for aim in range(INNER_SUFFIXES, len(by_head), INNER_SUFFIXES):
        at = np.searchsorted(edges, aim)
        if at < len(edges) and edges[at] > cuts[-1]:
            cuts.append(int(edges[at]))
    smaller = np.zeros(len(suffixes), bool)
    for a, b in zip(cuts, [*cuts[1:], len(by_head)]):
        inner = by_head[a:b]
        if len(inner) > 1:
            at = inner[_inner_order(suffixes[inner], group[a:b] - group[a], rank)]
            first = np.ones(len(at), bool)
            first[1:] = np.logical_or.reduce([word[1:] != word[:-1] for word in _words(buffer, suffixes[at], width)])
            smallest = np.minimum.reduceat(least[at], np.flatnonzero(first))
            smaller[at] = smallest[np.cumsum(first) - 1] < least[at]
    found = np.zeros(int(sorted_counts.sum()), bool)
    found[met] = smaller
    steps = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    smaller = found[np.repeat(firsts[one], counts) + steps] | np.repeat(owners > lowest[one], counts)
    ends = np.cumsum([int((size - width + 1).sum()) for size in sizes])[:-1]
    return [np.packbits(bits).tobytes() if bits.any() else None for bits in np.split(smaller, ends)]


def _ranks(buffer: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Rank of the `width` bytes at each position; equal strings have equal ranks.

    Sorted by eight bytes after the other; only ties go on to the next eight.
    """
    rank = np.zeros(len(at), np.int64)
    left = np.arange(len(at))
    for offset in range(0, width, 8):
        word = _words(buffer, at[left] + offset, min(8, width - offset))[0]
        order = np.lexsort((word, rank[left]))
        left, word = left[order], word[order]
        own = rank[left]
        start = np.ones(len(left), bool)  # of a group of equal ranks so far
        start[1:] = own[1:] != own[:-1]
        new = start.copy()
        new[1:] |= word[1:] != word[:-1]
        # A group's members keep its rank plus the number of members that are smaller.
        places = np.arange(len(left))
        rank[left] = own + (np.maximum.accumulate(np.where(new, places, 0)) - np.maximum.accumulate(np.where(start, places, 0)))
        alone = new & np.append(new[1:], True)
        left = left[~alone]
        if not len(left):
            break
    return rank


def _inner_order(suffixes: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Order of suffixes in groups of ties: by sample ranks at the shift that two residues share."""
    count = int(group[-1]) + 1
    dense = np.concatenate(([True], group[1:] != group[:-1]))
    place = np.flatnonzero(dense)[np.cumsum(dense) - 1]
    lists = [np.flatnonzero(suffixes % SORT_PERIOD == residue) for residue in range(SORT_PERIOD)]
    high = group << np.int64(32)
    for other, theirs in enumerate(lists):
        if not len(theirs):
            continue
        before = np.cumsum(np.bincount(group[theirs], minlength=count)) - np.bincount(group[theirs], minlength=count)
        shifts = [shift(one, other) for one in range(SORT_PERIOD)]
        keys = {d: np.sort(high[theirs] | rank[suffixes[theirs] + d]) for d in set(shifts)}
        for one, own in enumerate(lists):
            if len(own):
                d = shifts[one]
                place[own] += np.searchsorted(keys[d], high[own] | rank[suffixes[own] + d]) - before[group[own]]
    return np.argsort(place, kind="stable")


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """(id column, n_bytes, n_removed, n_spans, kept_sha256, spans) of each row; spans are removed [start, end) bytes."""
    size, count = B.sized(docs, text_column, block_bytes)
    plan = Plan(size, width)
    texts, copies = B.blocked(docs, id_column, text_column, count)
    told = copies.union(B.answer(B.ask(texts, copies, plan.sample), "sample", B.merge_cells))
    told = told.union(B.answer(B.ask(texts, told, plan.request), "sort", plan.sort))
    found = B.finish(
        texts, told, plan.result, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:bigint,end:bigint>>"
    )
    return found.withColumnRenamed("doc_id", id_column)
