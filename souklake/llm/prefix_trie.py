"""Prefix trie of conversations, with totals per subtree, by depth bands.

A node is a distinct sequence of the first d turns. Its key is 128 bits: the XOR of one mixed hash
pair a turn, taken from the turn's digest and place, so that keys of long conversations come from
partial XORs, however the turns are dealt to tasks.

Subtree totals: depths are cut into bands of BAND. A node explodes only to its ancestors within its
band. The roots of the bands form a smaller tree of the same kind, whose completed totals explode
to the ancestors of one band above. It is solved the same way, so that the rounds are the logarithm
of the depth and no row explodes more than BAND-fold.

Defined results: rows without conv_id take no part; a null turn comes first; turns of one number go
by the digest of role and text; repeated rows are turns of their own; null role or text is empty.
An empty table has no conversation, so no node either, the root included.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import stored

#: Depths in a band: no row explodes further, and no array is longer than this and one.
BAND = 16
#: Conversations that share their first turns, and the number of first turns they may share.
FAMILY, SHARED = 5, 9
#: Bytes of identifiers that one row holds on the way to a digest.
CHUNK_BYTES = 1 << 16

_KEY = "struct<a: bigint, b: bigint>"
_ROOT = "named_struct('a', 0L, 'b', 0L)"


# turns --------------------------------------------------------------------------------------


def placed(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, part, place, digest, n_bytes) of every turn in order, and (conv_id, part, first,
    n, before) of each conversation's stretch in each part.

    Turns are sorted by ranges over all columns, so that one long conversation spreads over tasks;
    its turns are numbered from the lengths of the stretches before.
    """
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    narrow = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.octet_length(text).cast("bigint").alias("n_bytes"),
    )
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("digest")]
    dealt = narrow.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = stored(dealt.select("conv_id", "digest", "n_bytes", F.monotonically_increasing_id().alias("place")))
    turns = turns.withColumn("part", F.shiftright("place", 33))
    stretches = turns.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("conv_id").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return turns, stretches.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their family: (conv_id, depth, digest, n_bytes)
    of every turn, and (conv_id, length) of every conversation, turnless ones included.

    Conversation c takes the first h turns of conversation c - c % FAMILY (all if it has fewer,
    none if it is absent), with h = crc32(c) % SHARED, then its own turns after its first h.
    """
    turns, stretches = placed(conversations)
    stretches = stored(stretches)
    sizes = stretches.groupBy("conv_id").agg(F.sum("n").alias("length"))
    wanted = F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED
    first = sizes.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    convs = stored(
        sizes.select("conv_id", "length", wanted.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
        .join(first, "base", "left")
        .select(
            "conv_id",
            "base",
            "h",
            F.least("h", F.coalesce("base_length", F.lit(0))).alias("taken"),
            F.greatest(F.col("length") - F.col("h"), F.lit(0)).alias("own"),
        )
    )
    numbered = turns.join(stretches, ["conv_id", "part"])
    position = F.col("place") - F.col("first") + F.col("before") + 1
    # What a turn needs of its conversation comes with the stretch: one row a conversation and part.
    with_convs = stretches.join(convs.select("conv_id", "h", "taken"), "conv_id")
    own = (
        turns.join(with_convs, ["conv_id", "part"])
        .where(position > F.col("h"))
        .select("conv_id", (position - F.col("h") + F.col("taken")).alias("depth"), "digest", "n_bytes")
    )
    heads = numbered.where((F.col("conv_id") % FAMILY == 0) & (position < SHARED)).select(
        F.col("conv_id").alias("base"), position.alias("depth"), "digest", "n_bytes"
    )
    heads = heads.join(convs, "base").where(F.col("depth") <= F.col("taken")).select("conv_id", "depth", "digest", "n_bytes")
    return stored(own.unionByName(heads)), convs.select("conv_id", (F.col("taken") + F.col("own")).alias("length"))


# levels -------------------------------------------------------------------------------------


def _chunks(items: DataFrame) -> DataFrame:
    """(conv_id, band, items, a, b): the items of a band in order, and the XOR of all of them."""
    members = F.struct(*[name for name in ("index", "a", "b", "n_bytes") if name in items.columns])
    return items.groupBy("conv_id", F.expr(f"(index - 1) div {BAND}").alias("band")).agg(
        F.array_sort(F.collect_list(members)).alias("items"),  # BAND at most
        F.bit_xor("a").alias("a"),
        F.bit_xor("b").alias("b"),
    )


def _with_keys(chunks: DataFrame, start: DataFrame | None) -> DataFrame:
    """Adds `path`: the key of the band root and of each item. `start` has the band roots' keys."""
    if start is None:
        chunks = chunks.withColumn("start", F.expr(_ROOT))
    else:
        roots = start.select("conv_id", F.col("index").alias("band"), F.col("key").alias("start"))
        chunks = chunks.join(roots, ["conv_id", "band"], "left").withColumn("start", F.coalesce("start", F.expr(_ROOT)))

    def lane(name: str) -> str:
        return f"aggregate(slice(items, 1, i), start.{name}, (done, item) -> done ^ item.{name})"

    path = f"transform(sequence(0, size(items)), i -> named_struct('a', {lane('a')}, 'b', {lane('b')}))"
    return chunks.select("conv_id", "band", "items", F.expr(path).alias("path"))


def _items(chunks: DataFrame) -> DataFrame:
    """One row an item: its index and key, its parent's key, the keys from its band root to itself
    (`chain`), and for a root of a further band the keys of the band above (`above`)."""
    several = chunks.select("conv_id", "path", F.posexplode("items").alias("at", "item"))
    closes = F.col("at") == BAND - 1
    key = F.element_at("path", F.col("at") + 2)
    none = F.array().cast(f"array<{_KEY}>")
    return several.select(
        "conv_id",
        "item.*",
        key.alias("key"),
        F.element_at("path", F.col("at") + 1).alias("parent"),
        F.when(closes, F.array(key)).otherwise(F.slice("path", 1, F.col("at") + 2)).alias("chain"),
        F.when(closes, F.slice("path", 1, BAND)).otherwise(none).alias("above"),
    )


def levels(turns: DataFrame) -> list[DataFrame]:
    """Items of every level, keys included. Level 0 has the turns; the items of a higher level are
    the roots of the bands below, at every BAND-th depth of the level before."""
    hashed = turns.select(
        "conv_id",
        F.col("depth").alias("index"),
        F.xxhash64("digest", "depth").alias("a"),
        F.xxhash64("depth", F.lit("b"), "digest").alias("b"),
        "n_bytes",
    )
    chunks = [stored(_chunks(hashed))]
    while not (full := chunks[-1].where(F.size("items") == BAND)).isEmpty():
        chunks.append(stored(_chunks(full.select("conv_id", (F.col("band") + 1).alias("index"), "a", "b"))))
    found: list[DataFrame] = []
    for level in reversed(chunks):
        found.append(stored(_items(_with_keys(level, found[-1] if found else None))))
    return found[::-1]


# nodes --------------------------------------------------------------------------------------


def _shared_out(rows: DataFrame, to: str) -> DataFrame:
    """Totals of each key that the rows name in the array `to`."""
    return (
        rows.select(F.explode(to).alias("key"), "leaves", "saved")
        .groupBy("key")
        .agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    )


def rollup(shapes: list[DataFrame], values: DataFrame) -> DataFrame:
    """(key, leaves, saved) summed over each item's subtree.

    `shapes` has for each level the distinct items (key, chain, above); `values` those of level 0.
    """
    shape = shapes[0]
    own = stored(_shared_out(shape.join(values, "key"), "chain"))
    if len(shapes) == 1:
        return own
    done = rollup(shapes[1:], own.join(shapes[1].select("key"), "key"))
    crossing = _shared_out(shape.where(F.size("above") > 0).join(done, "key"), "above")
    both = own.unionByName(crossing).groupBy("key")
    return stored(both.agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (key, conv_id) rows as rows (key, first, ids) of about CHUNK_BYTES."""
    key, first, ids, size = None, None, [], 0

    def row() -> pa.RecordBatch:
        text = ",".join(ids)
        return pa.RecordBatch.from_pylist([{"a": key[0], "b": key[1], "first": first, "ids": text}], _PACKED)

    for batch in batches:
        for a, b, conv in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "conv_id"))):
            if ids and (key != (a, b) or size > CHUNK_BYTES):
                yield row()
                ids, size = [], 0
            if not ids:
                key, first = (a, b), conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield row()


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's ids; the rows come sorted, and one running digest is all that is held."""
    key, digest = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([{"a": key[0], "b": key[1], "ends_sha256": digest.hexdigest()}], _DIGESTS)

    for batch in batches:
        for a, b, ids in zip(*(batch.column(n).to_pylist() for n in ("a", "b", "ids"))):
            if key == (a, b):
                digest.update(b",")
            else:
                if key is not None:
                    yield row()
                key, digest = (a, b), hashlib.sha256()
            digest.update(ids.encode())
    if key is not None:
        yield row()


_PACKED = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
_DIGESTS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])


def _ends(ended: DataFrame) -> DataFrame:
    """(key, ends_sha256) of (key, conv_id) rows: ids ascending, comma-joined.

    Ids are packed while they lie dealt by ranges, so that a node that very many conversations end
    at reaches the task that digests it as few rows, which stream through.
    """
    flat = ended.select("key.a", "key.b", "conv_id")
    packed = flat.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    packed = packed.mapInArrow(_packed, "a bigint, b bigint, first bigint, ids string")
    sorted_rows = packed.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    digests = sorted_rows.mapInArrow(_digested, "a bigint, b bigint, ends_sha256 string")
    return digests.select(F.struct("a", "b").alias("key"), "ends_sha256")


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of (conv_id, depth, digest, n_bytes) turns, depths from 1 on, and of
    (conv_id, length) conversations.

    Returns (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): see the contract of the query. A node is named by its smallest member and depth.
    """
    every = levels(turns)
    members = every[0].select("conv_id", F.col("index").alias("depth"), "key", "parent", "n_bytes", "chain", "above")
    root, none = F.expr(_ROOT), F.array().cast(f"array<{_KEY}>")
    tops = convs.select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), root.alias("key"), F.lit(None).cast(_KEY).alias("parent"),
        F.lit(0).cast("bigint").alias("n_bytes"), F.array(root).alias("chain"), none.alias("above"),
    )
    same = ("depth", "n_bytes", "parent", "chain", "above")  # alike in all members
    nodes = stored(
        members.unionByName(tops)
        .groupBy("key")
        .agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *[F.first(c).alias(c) for c in same])
    )
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    known = stored(nodes.drop("chain", "above").join(children, "key", "left").fillna(0, ["n_children"]))
    values = known.select(
        "key",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved"),
    )
    higher = [level.groupBy("key").agg(F.first("chain").alias("chain"), F.first("above").alias("above")) for level in every[1:]]
    totals = rollup([nodes.select("key", "chain", "above"), *map(stored, higher)], values)
    last = members.join(convs, "conv_id").where(F.col("depth") == F.col("length")).select("key", "conv_id")
    ends = _ends(last.unionByName(convs.where("length = 0").select(root.alias("key"), "conv_id")))
    parents = known.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        known.join(totals, "key")
        .join(ends, "key", "left")
        .join(parents, "parent", "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
