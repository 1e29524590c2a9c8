"""Near-duplicates by SuperMinHash, banding, verification and grouping.

A document's set holds its distinct shingles of `WORDS` lower-cased words as 64-bit hashes (one
shingle of all words where it has fewer). SuperMinHash deals each shingle a random permutation of the
signature's places with ranks 0 + u, 1 + u, ...; a place keeps its smallest rank. Rank j of all
shingles is dealt together, and dealing stops as soon as no place can improve.

Steps, none of which brings a group of copies into one task:
1. Documents with equal sets become one class (grouped by a 128-bit digest, folded before the shuffle).
2. Classes that share a band of their signatures are candidates. A bucket is known by its smallest
   class; a class points to the least of its buckets' and these to it, about one edge a class. The
   connected parts of these edges are the candidate groups (ids only).
3. The sets of a candidate group are dealt out in chunks of bounded size; each pair of chunks is one
   group of rows, in which an inverted index over the rarest shingles of each set finds the pairs that
   can reach the similarity, and full sets confirm them. Only a spanning forest of the confirmed links
   leaves the task.
4. Components of the confirmed links over classes, and of documents by their class.

With 24 bands of 4 places a pair of similarity 0.85 shares a band but for a chance of 2e-8. A group of
g distinct near copies sends each set to g / chunk tasks; a chunk grows with the data up to
`CHUNK_SHINGLES`, so that only groups beyond it are sent more often than the partitions need.

Null and wordless texts have an empty set and stay alone. Ids are integers. Repeated rows (same id) are one
node; different texts of an id are judged one by one. Rows without id form no links and are their own component. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components, stored
from .text import mix, to_bytes, window_hashes, word_hashes

WORDS = 5
BANDS, ROWS = 24, 4
PLACES = BANDS * ROWS
LEAST_CHUNK, CHUNK_SHINGLES = 1 << 14, 1 << 22


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    hashes = word_hashes(text.lower())
    if not len(hashes):
        return hashes
    return np.unique(window_hashes(hashes, min(words, len(hashes))))


def signature(items: np.ndarray, places: int = PLACES) -> np.ndarray:
    """SuperMinHash: per place, the smallest rank (rank number + fraction) over all items."""
    best = np.full(places, np.inf)
    if not len(items):
        return best
    rows = np.arange(len(items))
    order: np.ndarray | None = None
    for rank in range(places):
        if best.max() < rank:  # no later rank can be smaller
            break
        draw = mix(items, rank + 1)
        swap = rank + ((draw >> np.uint64(40)) % np.uint64(places - rank)).astype(np.int64)
        fraction = (draw & np.uint64((1 << 40) - 1)).astype(np.float64) * 2.0**-40
        if order is None:
            place = swap  # the permutation is still the identity
            if len(items) * 4 < places * 64:
                order = np.tile(np.arange(places, dtype=np.int16), (len(items), 1))
                order[rows, swap] = 0
        else:
            place = order[rows, swap].astype(np.int64)
            order[rows, swap] = order[:, rank]
        np.minimum.at(best, place, rank + fraction)
        if order is None:  # many items: nearly always every place is filled by now
            if best.max() < 1:
                break
            order = np.tile(np.arange(places, dtype=np.int16), (len(items), 1))
            order[rows, swap] = 0
    return best


def band_hashes(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One hash per band of consecutive places; equal bands have equal hashes within a band number."""
    bits = values.view(np.uint64).reshape(bands, rows)
    found = np.arange(bands, dtype=np.uint64)
    for row in range(rows):
        found = mix(found ^ bits[:, row], row + 17)
    return found.view(np.int64)


def described(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS) -> DataFrame:
    """(id, n_shingles, digest, bands) of each document with an id."""
    docs = docs.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), text_column)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, bands = [], [], []
            for text in to_bytes(batch.column(1)):
                items = shingles(text, words)
                sizes.append(len(items))
                digests.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                bands.append(band_hashes(signature(items)) if len(items) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["id", "n_shingles", "digest", "bands"],
            )

    return docs.mapInArrow(task, "id long, n_shingles long, digest binary, bands array<long>")


def links(sets: list[np.ndarray], side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the pairs i < j with 100 * |i & j| >= percent * |i | j|, by full sets.

    `side` is 0 for all sets, or tells two chunks apart whose own pairs are found elsewhere.
    """
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    sizes = np.array([len(items) for items in sets])
    _, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    cuts = np.cumsum(sizes)[:-1]
    tokens = [part[np.argsort(counts[part], kind="stable")] for part in np.split(inverse, cuts)]
    across = len(set(side.tolist())) > 1
    # Per token, sets by what they are linked to already (and by side): a part that has the set is passed over whole.
    index: dict[int, dict[tuple[int, int], list[int]]] = {}
    found = []
    for j in np.argsort(sizes, kind="stable").tolist():  # shorter sets first
        size = int(sizes[j])
        # A set can only reach the similarity with another that shares one of its rarest tokens.
        prefix = tokens[j][: size - -(-percent * size // 100) + 1].tolist()
        least = -(-percent * size // 100)
        seen: set[int] = set()
        for token in prefix:
            parts = index.get(token)
            if not parts:
                continue
            for key in [key for key in parts if root(key[0]) != key[0]]:
                moved, now = parts.pop(key), (root(key[0]), key[1])
                held = parts.get(now, [])
                small, large = sorted((moved, held), key=len)
                large += small
                parts[now] = large
            for (top, of), members in parts.items():
                if root(top) == root(j) or (across and of == side[j]):
                    continue
                for i in members:
                    if i in seen or sizes[i] < least:
                        continue
                    seen.add(i)
                    common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * common >= percent * (size + sizes[i] - common):
                        parent[root(j)] = root(i)
                        found.append((i, j))
                        break
        own = root(j), int(side[j])
        for token in prefix:
            index.setdefault(token, {}).setdefault(own, []).append(j)
    return found


def _verified(sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within each (part, pair of chunks)."""

    def task(table: pa.Table) -> pa.Table:
        ids = np.array(table.column("id").to_pylist(), np.int64)
        items = [np.frombuffer(data, np.int64) for data in table.column("items").to_pylist()]
        one, other = table.column("one")[0].as_py(), table.column("other")[0].as_py()
        chunk = np.array(table.column("chunk").to_pylist())
        side = np.zeros(len(ids), np.int8) if one == other else (chunk == other).astype(np.int8)
        found = links(items, side, percent)
        return pa.table({"a": pa.array([int(ids[i]) for i, _ in found], pa.int64()), "b": pa.array([int(ids[j]) for _, j in found], pa.int64())})

    return sets.groupBy("part", "one", "other").applyInArrow(task, "a long, b long")


def duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 85, words: int = WORDS
) -> DataFrame:
    """(id column, n_shingles, component_id, kept) of each row of the documents."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias(id_column), text_column)
    found = stored(described(docs, id_column, text_column, words))
    # 1. Classes of equal sets; the smallest id stands for its class.
    classes = stored(
        found.where("n_shingles > 0").groupBy("digest").agg(F.min("id").alias("class"), F.first("n_shingles").alias("n_shingles"), F.first("bands").alias("bands"))
    )
    # 2. Buckets of at least two classes; each points to its smallest one.
    bands = classes.select("class", F.posexplode("bands").alias("band", "hash"))
    smallest = bands.groupBy("band", "hash").agg(F.min("class").alias("b"), F.count("*").alias("n")).where("n > 1").drop("n")
    # A class meets at most one smallest class per band: it points to the least of them, they to each other.
    met = bands.join(smallest, ["band", "hash"]).groupBy("class").agg(F.min("b").alias("b"), F.collect_set("b").alias("others"))
    edges = met.select(F.explode(F.concat(F.array("class"), "others")).alias("a"), "b").where("a <> b").distinct()
    parts = components(edges).withColumnRenamed("component", "part")
    # 3. Chunks: about even over the partitions, within bounds.
    near = stored(parts.join(classes.select(F.col("class").alias("id"), "n_shingles"), "id"))
    total = near.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    size = max(LEAST_CHUNK, min(CHUNK_SHINGLES, total // max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    chunks = near.groupBy("part").agg(F.ceil(F.sum("n_shingles") / F.lit(size)).cast("int").alias("chunks"))
    placed = near.join(chunks, "part").select("id", "part", "chunks", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).hint("merge").join(placed, "id")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [shingles(text, words).tobytes() for text in to_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("part"), batch.column("chunks"), batch.column("chunk"), pa.array(items, pa.binary())],
                names=["id", "part", "chunks", "chunk", "items"],
            )

    sets = texts.select("id", "part", "chunks", "chunk", "text").mapInArrow(task, "id long, part long, chunks int, chunk int, items binary")
    paired = sets.withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(
        "id", "part", "chunk", F.least("chunk", "with").alias("one"), F.greatest("chunk", "with").alias("other"), "items"
    )
    # 4. Components of classes, then of documents.
    grouped = components(stored(_verified(paired, percent))).select(F.col("id").alias("class"), "component")
    joined = (
        found.join(classes.select("digest", "class"), "digest", "left")
        .join(grouped, "class", "left")
        .select("id", "n_shingles", F.coalesce("component", "class", "id").alias("component_id"))
        .distinct()
    )
    # Rows without an id: counted by the same function, alone.
    alone = described_alone(docs.where(F.col(id_column).isNull()), text_column, words)
    result = joined.select(F.col("id").alias(id_column), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
    return result.unionByName(alone.select(F.lit(None).cast("long").alias(id_column), "n_shingles", F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept")))


def without_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 85, words: int = WORDS) -> DataFrame:
    """The rows, with all their columns, of one document per group: the one with the smallest id.

    Of repeated rows (same id and text) one stays; different texts of an id stay if one of them is to; rows
    without id stay.
    """
    found = duplicates(docs, id_column, text_column, percent, words)
    kept = found.where(F.col("kept") & F.col(id_column).isNotNull()).select(id_column)
    named = docs.where(F.col(id_column).isNotNull()).join(kept.hint("merge"), id_column, "left_semi").dropDuplicates([id_column, text_column])
    return named.select(*docs.columns).unionByName(docs.where(F.col(id_column).isNull()))


def described_alone(docs: DataFrame, text_column: str, words: int = WORDS) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(shingles(text, words)) for text in to_bytes(batch.column(0))], pa.int64())], names=["n_shingles"])

    return docs.select(text_column).mapInArrow(task, "n_shingles long")
