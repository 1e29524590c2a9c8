"""Exact search for the highest inner products, by elimination over a pivot table.

A candidate x gets one more component, sqrt(M - |x|^2) with M the largest squared norm, and a query
q a zero, so that the inner product falls as the distance grows: d^2 = |q|^2 + M - 2 q.x. For every
candidate the distances to PIVOTS pivots are computed once. By the triangle inequality a distance is
at least the largest difference of the two distances to a pivot, which gives each candidate its
highest possible score. Candidates are evaluated in the order of that bound until no further one can
enter the list.

Equal vectors are one candidate, with the smallest ids that a list can need, and one query. Both are
dealt by nearest pivot and cut into blocks, each a row of packed bytes with the range of distances to
each pivot. A query block first meets its most promising candidate blocks, which gives every query a
score to beat; then all candidate blocks that can beat it for one of the block's queries, found from
the ranges alone. A task holds one pair of blocks at a time.

Pivots come from a sample of about SAMPLE vectors and only decide how much is eliminated. Distances
are doubles with a margin above their error, scores are whole and exact.

Defined results: see `whole_vectors` for rows that take no part; rows without an id neither ask nor
answer; repeated rows count once; an id with several vectors is a candidate with each of them and
asks with each. A query's own id is no candidate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .components import stored
from .vectors import matrix

PIVOTS, SAMPLE = 32, 1024
#: Rows of a block, and block summaries of a page.
CANDIDATES, QUESTIONS, PAGE = 4096, 256, 256
#: Candidates of a block that are evaluated at once.
STEP = 1024
#: Candidate blocks that a query block meets first.
SEEDS = 2

_BLOCK = "block bigint, n int, vectors binary, ids array<bigint>, cuts array<int>, low array<double>, high array<double>"
_ASKED = "asked bigint, n int, vectors binary, keys array<string>"
_FOUND = "asked bigint, at int, score bigint, vec_id bigint"


class _Space:
    """Pivots and what distances to them need; small and of fixed size, so tasks get it with their code."""

    def __init__(self, largest: float, pivots: np.ndarray):
        self.largest = largest
        self.pivots, self.norms = pivots, (pivots * pivots).sum(1)
        self.heights = np.sqrt(np.maximum(largest - self.norms, 0))
        #: Above the rounding error of a score's upper bound, which is a sum of a few terms of this size.
        self.margin = 1e-9 * (1 + largest) * max(1, pivots.shape[1]) ** 0.5 + 0.25

    def table(self, x: np.ndarray, queries: bool = False) -> np.ndarray:
        """Distances, a row for each pivot."""
        norms = (x * x).sum(1)
        height = np.zeros(len(x)) if queries else np.sqrt(np.maximum(self.largest - norms, 0))
        square = norms + self.norms[:, None] - 2 * (self.pivots @ x.T) + (self.heights[:, None] - height) ** 2
        return np.sqrt(np.maximum(square, 0))

    def highest(self, norm: np.ndarray | float, apart: np.ndarray) -> np.ndarray:
        """Highest possible score of a query of that squared norm at least so far away."""
        # A distance's own error is the root of rounding near zero, so the bound is taken nearer first.
        near = np.maximum(apart - 1e-6 * np.sqrt(1 + self.largest), 0)
        return (norm + self.largest - near * near) / 2 + self.margin + 1e-9 * norm


def _key(x: Column) -> Column:
    return F.md5(F.array_join(x.cast("array<string>"), ","))


def _packed(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x, dtype="<i8").tobytes()


def _unpacked(vectors: bytes, n: int) -> np.ndarray:
    return np.frombuffer(vectors, "<i8").reshape(n, -1).astype(np.float64)


def _space(vectors: DataFrame) -> _Space | None:
    """Pivots spread over a sample: each is the vector furthest from those before."""
    norm = F.aggregate("x", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    size = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest")).first()
    if not size["n"]:
        return None
    if size["largest"] >= 2.0**53:
        raise ValueError("scores of vectors this long are beyond exact doubles")
    drawn = F.pmod(F.xxhash64("key"), F.lit(size["n"])) < SAMPLE
    rows = vectors.where(drawn).select("x").limit(4 * SAMPLE).collect()
    sample = np.array([r["x"] for r in rows] or [vectors.first()["x"]], dtype=np.float64)
    sample = sample[np.lexsort(sample.T)] if sample.shape[1] else sample
    full = np.column_stack([sample, np.sqrt(np.maximum(size["largest"] - (sample * sample).sum(1), 0))])
    chosen, apart = [0], ((full - full[0]) ** 2).sum(1)
    while len(chosen) < min(PIVOTS, len(full)) and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, ((full - full[chosen[-1]]) ** 2).sum(1))
    return _Space(size["largest"], sample[chosen])


def _dealt(vectors: DataFrame, space: _Space, queries: bool) -> DataFrame:
    """The rows sorted by nearest pivot and distance from it, dealt to tasks by ranges of those."""

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = space.table(matrix(batch).astype(np.float64), queries)
                home = table.argmin(0)
                near = table[home, np.arange(len(home))]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(home, pa.int32()), pa.array(near)], [*batch.schema.names, "home", "near"]
                )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    placed = vectors.mapInArrow(homes, f"{kinds}, home int, near double")
    return placed.repartitionByRange("home", "near", "key").sortWithinPartitions("home", "near", "key")


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.Table]]:
    """Numbered stretches of at most `limit` rows; a new pivot begins a new one where the old is half full."""
    number, held, home = TaskContext.get().partitionId() << 32, [], None
    for batch in batches:
        homes = np.asarray(batch.column("home"))
        start, count = 0, sum(b.num_rows for b in held)
        for i, h in enumerate(homes.tolist()):
            size = count + i - start
            if size and (size >= limit or (h != home and 2 * size >= limit)):
                yield number, pa.Table.from_batches([*held, batch.slice(start, i - start)])
                number, held, start, count = number + 1, [], i, 0
            home = h
        held.append(batch.slice(start))
    if sum(b.num_rows for b in held):
        yield number, pa.Table.from_batches(held)


def _candidate_blocks(vectors: DataFrame, space: _Space) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _runs(batches, CANDIDATES):
            batch = rows.combine_chunks().to_batches()[0]
            x, ids = matrix(batch), batch.column("ids")
            table = space.table(x.astype(np.float64))
            cuts = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))])
            row = {"block": number, "n": len(x), "vectors": _packed(x), "ids": ids.flatten().to_pylist(), "cuts": cuts.tolist()}
            row |= {"low": table.min(1).tolist(), "high": table.max(1).tolist()}
            yield pa.RecordBatch.from_pylist([row], _arrow(_BLOCK))

    return stored(_dealt(vectors, space, queries=False).mapInArrow(cut, _BLOCK))


def _query_blocks(vectors: DataFrame, space: _Space) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _runs(batches, QUESTIONS):
            batch = rows.combine_chunks().to_batches()[0]
            x = matrix(batch)
            row = {"asked": number, "n": len(x), "vectors": _packed(x), "keys": batch.column("key").to_pylist()}
            yield pa.RecordBatch.from_pylist([row], _arrow(_ASKED))

    return stored(_dealt(vectors, space, queries=True).mapInArrow(cut, _ASKED))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
    fields = []
    for part in schema.split(", "):
        name, kind = part.split(" ")
        inner = kind.removeprefix("array<").removesuffix(">")
        fields.append((name, pa.list_(kinds[inner]) if kind.startswith("array<") else kinds[kind]))
    return pa.schema(fields)


def _chances(space: _Space, vectors: bytes, n: int, page: list[dict]) -> np.ndarray:
    """Highest possible score of each query with each block of a page."""
    q = _unpacked(vectors, n)
    table = space.table(q, queries=True)
    low, high = (np.array([b[side] for b in page]) for side in ("low", "high"))
    apart = np.zeros((n, len(page)))
    for p in range(len(table)):
        mine = table[p][:, None]
        np.maximum(apart, np.maximum(low[:, p] - mine, mine - high[:, p]), out=apart)
    return space.highest((q * q).sum(1)[:, None], apart)


def _pages(blocks: DataFrame) -> tuple[DataFrame, int]:
    """Summaries of the candidate blocks, about PAGE in a row."""
    count = -(-blocks.count() // PAGE)
    page = F.pmod(F.xxhash64("block"), F.lit(count)).cast("int").alias("page")
    rows = blocks.groupBy(page).agg(F.collect_list(F.struct("block", "low", "high")).alias("blocks"))
    return stored(rows), count


def _best(found: DataFrame, keep: int) -> DataFrame:
    order = W.partitionBy("asked", "at").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= keep)


def _met(pairs: DataFrame, asked: DataFrame, blocks: DataFrame, space: _Space, keep: int) -> DataFrame:
    """(asked, at, score, vec_id): the `keep` best of each pair of blocks that reach what the query has."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pair = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                hits = _search(space, pair, keep)
                if len(hits[0]):
                    whose = pa.array(np.full(len(hits[0]), pair["asked"]), pa.int64())
                    yield pa.RecordBatch.from_arrays([whose, *map(pa.array, hits)], schema=_arrow(_FOUND))

    both = pairs.join(asked.drop("keys"), "asked").join(
        blocks.select("block", F.col("n").alias("m"), F.col("vectors").alias("theirs"), "ids", "cuts"), "block"
    )
    return both.mapInArrow(meet, _FOUND)


def _search(space: _Space, pair: dict, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Elimination inside one pair of blocks: query number, score and id of all that may count.

    Candidates come in the order of their bound against the whole query block, STEP at a time. A step
    is one product with the queries that its best bound can still serve.
    """
    q, x = _unpacked(pair["vectors"], pair["n"]), _unpacked(pair["theirs"], pair["m"])
    mine, theirs = space.table(q, queries=True), space.table(x)
    ids, cuts, norms = np.array(pair["ids"], np.int64), np.array(pair["cuts"]), (q * q).sum(1)
    bars = np.full(len(q), -np.inf)
    for entry in pair["to_beat"] or []:
        bars[entry["at"]] = entry["score"]
    low, high = mine.min(1)[:, None], mine.max(1)[:, None]
    apart = np.maximum(np.maximum(theirs - high, low - theirs).max(0), 0)
    order = np.argsort(apart, kind="stable")
    tops = np.full((len(q), keep), -np.inf)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for start in range(0, len(order), STEP):
        part = order[start : start + STEP]
        open_to = np.flatnonzero(space.highest(norms, apart[part[0]]) >= bars)
        if not len(open_to):
            break
        got = q[open_to] @ x[part].T
        tops[open_to] = np.partition(np.hstack([tops[open_to], got]), -keep, axis=1)[:, -keep:]
        bars[open_to] = np.maximum(bars[open_to], tops[open_to].min(1))
        rows, columns = np.nonzero(got >= bars[open_to][:, None])
        out.append((open_to[rows], got[rows, columns], part[columns]))
    at, scores, found = map(np.concatenate, zip(*out)) if out else (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    enough = scores >= bars[at]  # bars rise with every step
    at, scores, found = at[enough], scores[enough], found[enough]
    took = np.diff(cuts)[found]
    steps = np.arange(took.sum()) - np.repeat(np.cumsum(took) - took, took)
    at, scores, owners = np.repeat(at, took), np.repeat(scores, took), ids[np.repeat(cuts[found], took) + steps]
    sorted_by = np.lexsort((owners, -scores, at))
    at, scores, owners = at[sorted_by], scores[sorted_by], owners[sorted_by]
    best = np.arange(len(at)) - np.searchsorted(at, at) < keep
    return at[best].astype(np.int32), scores[best].astype(np.int64), owners[best]


def search(vectors: DataFrame, asks: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row of (vec_id, x) that `asks`, the k highest inner
    products among rows of other ids, ties to the smaller id; all if there are fewer."""
    keep = k + 1  # a query's own id may be among them
    rows = vectors.where("vec_id IS NOT NULL").select("vec_id", "x", _key(F.col("x")).alias("key"))
    rows = rows.dropDuplicates(["key", "vec_id"])
    first = W.partitionBy("key").orderBy("vec_id")
    folded = stored(
        rows.withColumn("place", F.row_number().over(first))
        .where(F.col("place") <= keep)
        .groupBy("key")
        .agg(F.first("x").alias("x"), F.array_sort(F.collect_list("vec_id")).alias("ids"))  # `keep` ids at most
    )
    queries = stored(rows.where(asks).select("key", "vec_id", "x"))
    space = _space(folded)
    if space is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    blocks = _candidate_blocks(folded, space)
    asked = _query_blocks(queries.groupBy("key").agg(F.first("x").alias("x")), space)
    pages, count = _pages(blocks)
    every_page = F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    def promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hope = _chances(space, row["vectors"], row["n"], row["blocks"]).mean(0)
                best = np.argsort(-hope, kind="stable")[:SEEDS]
                made = [{"asked": row["asked"], "block": row["blocks"][i]["block"], "hope": float(hope[i])} for i in best]
                yield pa.RecordBatch.from_pylist(made, _arrow("asked bigint, block bigint, hope double"))

    visits = asked.select("asked", "n", "vectors", every_page.alias("page")).join(pages, "page")
    hopes = visits.mapInArrow(promising, "asked bigint, block bigint, hope double")
    order = W.partitionBy("asked").orderBy(F.desc("hope"), "block")
    seeds = stored(hopes.withColumn("place", F.row_number().over(order)).where(F.col("place") <= SEEDS).select("asked", "block"))
    nothing = F.lit(None).cast("array<struct<at: int, score: bigint>>").alias("to_beat")
    early = stored(_best(_met(seeds.select("*", nothing), asked, blocks, space, keep), keep))

    bars = early.where(F.col("place") == keep).groupBy("asked").agg(F.collect_list(F.struct("at", "score")).alias("to_beat"))
    met = seeds.groupBy("asked").agg(F.collect_list("block").alias("met"))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bar = np.full(row["n"], -np.inf)
                for entry in row["to_beat"] or []:
                    bar[entry["at"]] = entry["score"]
                hopeful = (_chances(space, row["vectors"], row["n"], row["blocks"]) >= bar[:, None]).any(0)
                made = [
                    {"asked": row["asked"], "block": b["block"]}
                    for b, can in zip(row["blocks"], hopeful)
                    if can and b["block"] not in row["met"]
                ]
                if made:
                    yield pa.RecordBatch.from_pylist(made, _arrow("asked bigint, block bigint"))

    armed = stored(asked.join(met, "asked").join(bars, "asked", "left"))
    visits = armed.select("asked", "n", "vectors", "met", "to_beat", every_page.alias("page")).join(pages, "page")
    pairs = stored(visits.mapInArrow(possible, "asked bigint, block bigint"))
    late = _met(pairs.join(armed.select("asked", "to_beat"), "asked"), asked, blocks, space, keep)
    best = _best(early.drop("place").unionByName(late), keep)
    lists = best.groupBy("asked", "at").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id"))).alias("best"))
    keys = asked.select("asked", F.posexplode("keys").alias("at", "key"))
    answers = stored(lists.join(keys, ["asked", "at"]).select("key", "best"))
    mine = queries.select("key", F.col("vec_id").alias("query_id")).join(answers, "key")
    others = mine.select("query_id", F.filter("best", lambda b: b["vec_id"] != F.col("query_id")).alias("best"))
    return others.select("query_id", F.posexplode(F.slice("best", 1, k)).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "b.vec_id", (-F.col("b.down")).alias("score")
    )
