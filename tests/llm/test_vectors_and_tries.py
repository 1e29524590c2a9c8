"""Prefix trie, exact search and whitening against brute force, with odd rows."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from souklake.llm import pivot_search, prefix_trie, whitening
from souklake.llm.queries import op13_whitening
from souklake.llm.vectors import whole_vectors

CONVERSATIONS = "conv_id long, turn long, role string, text string, depth string, key string, band int"
EMBEDDINGS = "vec_id long, embedding array<float>, x string, key string, label int"


# tries --------------------------------------------------------------------------------------


def brute_trie(rows):
    turns = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [(role, text) for *_, role, text in sorted(of)] for c, of in turns.items()}
    convs = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        convs[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    members, children = {}, {}
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[n] for n in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[n] for n in below)
    result = []
    for node, of in members.items():
        ends = ",".join(map(str, sorted(c for c in of if len(convs[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        result.append((min(of), len(node), parent, len(of), len(children.get(node, [])), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(result, key=repr)


def conversation_rows():
    """Lengths about the bands' heights, hot copies, ties, null and negative ids, turns and texts, repeated rows."""
    draw, rows = random.Random(3), []
    for c in range(-12, 60):
        length = 270 if c % 7 == 0 else draw.choice([1, 2, 5, 15, 16, 17, 31, 32, 33, 48, 300])
        for turn in range(length):
            role = draw.choice(["user", None, ""]) if c % 3 else "user"
            text = draw.choice(["", "é", None, "same"]) if c % 3 else "same"
            rows.append((c, turn if draw.random() < 0.95 else None, role, text, "clash", "clash", 1))
    return rows + [(None, 1, "user", "lost", "", "", 0), (61, None, None, None, "", "", 0), (61, None, None, None, "", "", 0), (62, 1, "user", "x" * 100_000, "", "", 0)]


@pytest.mark.parametrize("rows", [conversation_rows(), [], [(None, None, None, None, None, None, None)], [(7, 1, "user", "only", "", "", 0)]])
def test_trie_matches_brute_force(spark, rows):
    found = prefix_trie.trie(*prefix_trie.rebuilt(spark.createDataFrame(rows, CONVERSATIONS)))
    assert sorted(map(tuple, found.collect()), key=repr) == brute_trie(rows)


def test_ends_are_digested_in_order_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK_BYTES", 7)
    keys = [(1, 2), (1, 3), (-4, 2)]
    ended = [(keys[i % 3], i) for i in range(200)]
    rows = spark.createDataFrame(ended, "key struct<a: bigint, b: bigint>, conv_id bigint")
    found = {tuple(r["key"]): r["ends_sha256"] for r in prefix_trie._ends(rows).collect()}
    assert found == {k: hashlib.sha256(",".join(str(i) for key, i in ended if key == k).encode()).hexdigest() for k in keys}


# vectors ------------------------------------------------------------------------------------


def vector_rows():
    """Short and empty vectors, many copies, ids twice, nulls and non-finite components."""
    draw = random.Random(1)
    rows = [(i, [draw.uniform(-2, 2) for _ in range(draw.choice([3, 3, 3, 2, 0]))], "clash", "clash", 1) for i in range(300)]
    rows += [(i, [1.0, 1.0, 1.0], "", "", 0) for i in range(300, 700)]
    odd = [(5, [0.5, 0.5, 0.5]), (20, [1.0, 1.0, 1.0]), (20, [1.0, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (900, None), (920, [None, 1.0]), (940, [float("nan")]), (960, [float("inf")]), (980, [0.0, 0.0, 0.0])]
    return rows + [(i, v, None, None, None) for i, v in odd]


def brute_search(rows, k):
    rows = sorted({(i, tuple(x)) for i, x in rows if i is not None})
    x, ids, result = np.array([x for _, x in rows]), np.array([i for i, _ in rows]), []
    for query, vector in rows:
        if query % 20 == 0:
            scores, others = x @ np.array(vector), ids != query
            order = np.lexsort((ids[others], -scores[others]))[:k]
            result += [(query, rank, int(ids[others][j]), int(scores[others][j])) for rank, j in enumerate(order, start=1)]
    return sorted(result)


@pytest.mark.parametrize("count", [0, 3, None])
@pytest.mark.parametrize("sizes", [(4096, 256, 256), (32, 8, 4)])
def test_search_matches_brute_force(spark, monkeypatch, count, sizes):
    for name, size in zip(("CANDIDATES", "QUESTIONS", "PAGE"), sizes):
        monkeypatch.setattr(pivot_search, name, size)
    vectors = whole_vectors(spark.createDataFrame(vector_rows()[:count], EMBEDDINGS), 64)
    found = pivot_search.search(vectors, F.col("vec_id") % 20 == 0)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute_search([(r.vec_id, r.x) for r in vectors.collect()], 20)


def test_search_eliminates(spark, monkeypatch):
    """Of clustered vectors most are never evaluated, and the bound is never below the score."""
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(8, 16)) * 400
    x = (centres[np.arange(800) % 8] + draw.normal(size=(800, 16))).astype(np.int64)
    rows = [(i, v.tolist(), str(i)) for i, v in enumerate(x)]
    space = pivot_search._space(spark.createDataFrame(rows, "vec_id long, x array<bigint>, key string"))
    q = x[:20].astype(float)
    theirs, mine = space.table(x.astype(float)), space.table(q, queries=True)
    chance = space.highest((q * q).sum(1)[:, None], np.abs(mine[:, :, None] - theirs[:, None, :]).max(0))
    scores = q @ x.T.astype(float)
    assert (chance >= scores).all()
    assert (chance >= np.sort(scores, axis=1)[:, -21][:, None]).mean() < 0.3


def test_search_evaluates_a_pair_of_blocks_in_steps(monkeypatch):
    """All queries of a block share a step; ties across steps go to the smaller ids."""
    monkeypatch.setattr(pivot_search, "STEP", 16)
    made = np.random.default_rng(5)
    x, q = made.integers(-3, 4, (150, 5)), made.integers(-3, 4, (20, 5))
    ids = made.permutation(300)
    space = pivot_search._Space(float((x * x).sum(1).max()), x[:4].astype(float))
    pair = {"n": 20, "m": 150, "vectors": pivot_search._packed(q), "theirs": pivot_search._packed(x)}
    pair |= {"ids": ids.tolist(), "cuts": list(range(0, 301, 2)), "to_beat": None}
    at, scores, found = pivot_search._search(space, pair, 7)
    for n in range(20):
        wanted = sorted((-int(q[n] @ x[i // 2]), int(ids[i])) for i in range(300))[:7]
        assert sorted(zip((-scores[at == n]).tolist(), found[at == n].tolist())) == wanted


def test_search_in_a_pair_of_blocks_returns_what_reaches_the_score_to_beat():
    x = np.arange(40).reshape(20, 2)
    space = pivot_search._Space(float((x * x).sum(1).max()), x[:4].astype(float))
    pair = {"vectors": pivot_search._packed(x[:2]), "n": 2, "theirs": pivot_search._packed(x), "m": 20}
    pair |= {"ids": list(range(20)), "cuts": list(range(21)), "to_beat": [{"at": 1, "score": 190}]}
    at, score, ids = pivot_search._search(space, pair, 3)
    assert list(zip(at.tolist(), score.tolist(), ids.tolist())) == [(0, 39, 19), (0, 37, 18), (0, 35, 17), (1, 193, 19)]


def test_rank_one_updates_keep_an_orthogonal_basis():
    draw = np.random.default_rng(4)
    x = np.floor(draw.normal(size=(400, 12)) * draw.uniform(0.1, 50, 12)).astype(np.int64)
    x[:, 3], x[:, 4] = 7, x[:, 5]  # no variance, and a double direction
    x[50:80] = x[50]
    halves = [whitening.Spectrum.empty(12), whitening.Spectrum.empty(12)]
    for i, row in enumerate(x):
        halves[i % 2].add(row)
    halves[0].absorb(halves[1])
    away = x - x.mean(0)
    wanted = np.linalg.eigvalsh(away.T @ away)[::-1]
    found = halves[0].values[::-1]
    assert halves[0].n == 400 and (halves[0].sums == x.sum(0)).all()
    assert np.allclose(found, wanted[: len(found)], rtol=1e-7) and np.abs(wanted[len(found) :]).max() < 1e-6
    assert np.abs(halves[0].basis.T @ halves[0].basis - np.eye(len(found))).max() < 1e-12


@pytest.mark.parametrize("rank", [128, 6])
def test_whitening_matches_eigh(spark, monkeypatch, tmp_path, rank):
    """Also where the spectrum keeps too few directions and the refinement has to find the rest."""
    monkeypatch.setattr(whitening, "RANK", rank)
    draw = np.random.default_rng(5)
    made = draw.normal(size=(500, 20)) * np.linspace(4, 0.5, 20)
    rows = [(i, v.tolist(), "clash", "clash", 1) for i, v in enumerate(made)] + [(i, made[0].tolist(), "", "", 0) for i in range(500, 900)]
    rows += [(901, None, "", "", 0), (902, [float("inf")], "", "", 0), (None, made[1].tolist(), "", "", 0), (7, made[7].tolist(), "", "", 0)]
    spark.createDataFrame(rows, EMBEDDINGS).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = op13_whitening(spark, str(tmp_path)).toPandas()
    assert len(found) == 4 * (len(rows) - 2)
    x = np.unique(np.floor(np.array([np.array(v, np.float32) for i, v, *_ in rows if v and len(v) == 20], np.float64) * 256).astype(np.int64), axis=0)
    away = x - x.sum(0) / len(x)
    values, vectors = np.linalg.eigh(away.T @ away / len(x))
    values, vectors = values[::-1], vectors[:, ::-1]
    own = np.floor(np.array(rows[3][1], np.float32).astype(np.float64) * 256).astype(np.int64)
    mine = found[found.vec_id == 3].sort_values("component")
    assert (mine.n == len(x)).all() and (mine.deviation == int(((len(x) * own - x.sum(0)) ** 2).sum())).all()
    assert np.allclose(mine.explained, values[:4] / values.sum(), rtol=1e-10)
    assert np.allclose(np.abs(mine.whitened), np.abs((own - x.sum(0) / len(x)) @ vectors[:, :4] / np.sqrt(values[:4])), rtol=1e-9, atol=1e-10)
    assert found.identity_error.max() <= 1e-4


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], "", "", 0), (2, [1.0, 2.0], "", "", 0)], [(1, [], "", "", 0)], [(1, None, "", "", 0)]])
def test_whitening_without_variance_is_empty(spark, tmp_path, rows):
    spark.createDataFrame(rows, EMBEDDINGS).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op13_whitening(spark, str(tmp_path)).collect() == []
