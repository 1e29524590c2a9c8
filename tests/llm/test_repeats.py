"""Exact repeats (words, bytes) and near duplicates against brute force, with odd rows."""

import hashlib
import random
import time

import numpy as np
import pytest

from souklake.llm import minhash, substrings, suffixes
from souklake.llm.components import components

SCHEMA = "doc_id long, text string, n_words string, kept string"


@pytest.fixture(scope="module")
def rows():
    """Passages, copies, near copies, ties, nulls, empty and long texts, repeated rows."""
    draw = random.Random(4)
    words = [f"w{i}" for i in range(400)] + ["é", "中文", " x"]
    passage = " ".join(draw.choices(words, k=90))
    common = " ".join(draw.choices(words, k=55))
    made = []
    for i in range(120):
        text = " ".join(draw.choices(words, k=draw.randrange(1, 200)))
        if i % 5 == 0:
            text += "\n" + passage + "  \t" + text
        if i % 3 == 0:
            text = common + " " + text
        if i % 7 == 0 and made:
            text = draw.choice(made)[1]
        if i % 11 == 0 and made:
            parts = (draw.choice(made)[1] or "x").split(" ")
            parts[draw.randrange(len(parts))] = "changed"
            text = " ".join(parts)
        made.append((i * 3 % 127, text, "clash", "clash"))
    made += [(200, None, None, None), (201, "", None, None), (202, " \n\t", None, None), (203, "ab" * 4000, None, None), (204, "w1 " * 3000, None, None)]
    made += [made[3], made[3], (205, passage, None, None), (206, passage.upper(), None, None), (None, passage, None, None), (None, None, None, None)]
    return made


def brute(rows, unit):
    first = {}
    result = []
    for d, x in sorted((d, (x or "").encode()) for d, x, *_ in rows if d is not None):
        parts = x.split() if unit else x
        for i in range(len(parts) - 49):
            first.setdefault(b" ".join(parts[i : i + 50]) if unit else parts[i : i + 50], d)
    for d, x, *_ in rows:
        parts = (x or "").encode()
        parts = parts.split() if unit else parts
        gone = bytearray(len(parts))
        for i in range(len(parts) - 49):
            if d is not None and first[b" ".join(parts[i : i + 50]) if unit else parts[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        kept = [part for part, out in zip(parts, gone) if not out]
        digest = hashlib.sha256(b" ".join(kept) if unit else bytes(kept)).hexdigest()
        spans = sum(1 for i in range(len(gone)) if gone[i] and not (i and gone[i - 1]))
        result.append((d, len(parts), sum(gone), digest) if unit else (d, len(parts), sum(gone), spans, digest))
    return sorted(result, key=repr)


@pytest.mark.parametrize("operator, unit", [(substrings, 1), (suffixes, 0)])
def test_texts_of_one_id_are_judged_by_themselves(spark, operator, unit):
    one, two, three = (" ".join(f"{x}{i}" for i in range(80)) for x in ("abcdefgh", "é", "w"))
    rows = [(1, one, None, None), (5, one, None, None), (5, two, None, None), (5, two, None, None), (3, three, None, None), (5, two + " " + three, None, None), (7, two, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("doc_id", "id")
    found = operator.deduplicate(frame, id_column="id")
    assert found.columns[0] == "id"
    assert sorted((tuple(row) for row in found.drop("kept", "spans").collect()), key=repr) == brute(rows, unit)


@pytest.mark.parametrize("size", [3_000, 1 << 30])
@pytest.mark.parametrize("operator, unit", [(substrings, 1), (suffixes, 0)])
def test_repeats_match_brute_force(spark, rows, operator, unit, size):
    found = operator.deduplicate(spark.createDataFrame(rows, SCHEMA), block_bytes=size)
    names = [name for name in found.columns if name not in ("kept", "spans")]
    assert sorted((tuple(row) for row in found.select(*names).collect()), key=repr) == brute(rows, unit)


@pytest.mark.parametrize("operator", [substrings, suffixes])
def test_repeats_of_empty_table(spark, operator):
    assert operator.deduplicate(spark.createDataFrame([], SCHEMA)).collect() == []


def test_real_outputs(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text), (2, "before " + text + " after")], "doc_id long, text string")
    assert {r.doc_id: r.kept for r in substrings.deduplicate(docs).collect()}[2] == "before after"
    spans = {r.doc_id: r.spans for r in suffixes.deduplicate(docs).collect()}[2]
    assert [(s.start, s.end) for s in spans] == [(7, 7 + len(text))]


def test_cover_shift_is_covered():
    for a in range(suffixes.SORT_PERIOD):
        for b in range(suffixes.SORT_PERIOD):
            d = suffixes.shift(a, b)
            assert {(a + d) % 7, (b + d) % 7} <= set(suffixes.SORT_COVER)
    cover, period = suffixes.SAMPLE_COVER, suffixes.SAMPLE_PERIOD
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_bucket_in_many_inner_buckets(monkeypatch):
    """Suffix classes do not depend on how a bucket is cut."""
    draw = random.Random(9)
    text = bytes(draw.choices(b"ab", k=3000))
    fragments = [text[i : i + 120] for i in range(0, 2800, 37)] * 2 + [bytes(draw.choices(range(256), k=60))]
    sizes, owners = np.array([len(x) for x in fragments], np.uint32), np.arange(len(fragments), dtype=np.int64)

    def sent(part):
        return suffixes.B.bundle([suffixes.B.pack(sizes[part]), suffixes.B.pack(owners[part]), suffixes.B.pack(np.frombuffer(b"".join(fragments[part]), np.uint8))])

    first = {}
    for owner, x in enumerate(fragments):
        for i in range(len(x) - 49):
            first.setdefault(x[i : i + 50], owner)
    want = [first[x[i : i + 50]] < owner for owner, x in enumerate(fragments) for i in range(len(x) - 49)]
    for size in (7, 500, 1 << 20):
        monkeypatch.setattr(suffixes, "INNER_SUFFIXES", size)
        for cut in (0, 90):  # one block; two blocks that share fragments
            parts = [part for part in (slice(0, cut), slice(cut, len(fragments))) if fragments[part]]
            found = []
            for part, bits in zip(parts, suffixes.sort_bucket([sent(part) for part in parts], 50)):
                count = int((sizes[part].astype(int) - 49).sum())
                found += np.unpackbits(np.frombuffer(bits, np.uint8), count=count).astype(bool).tolist() if bits else [False] * count
            assert found == want


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_near_duplicates_match_brute_force(spark, rows, monkeypatch):
    monkeypatch.setattr(minhash, "LEAST_CHUNK", 300)  # several chunks per group
    monkeypatch.setattr(minhash, "CHUNK_SHINGLES", 300)
    found = minhash.duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    sets = {d: shingle_set(x) for d, x, *_ in rows if d is not None}
    parent = {d: d for d in sets}

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                one, other = sorted((root(a), root(b)))
                parent[other] = one
    named = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found if r.doc_id is not None}
    assert named == {(d, len(sets[d]), root(d), root(d) == d) for d in sets}
    assert sorted(r.n_shingles for r in found if r.doc_id is None) == sorted(len(shingle_set(x)) for d, x, *_ in rows if d is None)
    kept = minhash.without_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "n_words", "kept"]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(d for d in sets if root(d) == d)


def test_near_duplicates_with_texts_of_one_id(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    rows = [(1, one, "p", None), (5, one, "q", None), (5, two, "r", None), (5, two, "s", None), (9, one, "t", None)]
    kept = minhash.without_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, one), (5, one), (5, two)]


@pytest.mark.parametrize("sides", [1, 2])
def test_links_of_many_near_copies(sides):
    draw = np.random.default_rng(5)
    base = np.unique(draw.integers(0, 1 << 40, 210).astype(np.uint64))[:200]
    own = draw.integers(1 << 41, 1 << 42, (4000, 2)).astype(np.uint64)
    sets = [np.unique(np.concatenate((np.delete(base, draw.integers(0, 200, 2)), extra))) for extra in own]
    started = time.process_time()
    found = minhash.links(sets, np.arange(4000) % sides, 85)
    assert len(found) == 3999 and time.process_time() - started < 8
    assert all(sides == 1 or (i + j) % 2 for i, j in found)


def test_links_match_brute_force():
    draw = np.random.default_rng(9)
    for sides in (1, 2):
        sets = []
        for i in range(150):  # groups that grow together by way of members between them
            start = draw.integers(0, 12) * 7
            sets.append(np.unique(np.delete(np.arange(start, start + 60), draw.integers(0, 60, draw.integers(0, 6)))).astype(np.uint64))
        side = np.arange(150) % sides
        chained, plain = list(range(150)), list(range(150))

        def root(parent, x):
            return x if parent[x] == x else root(parent, parent[x])

        for i, j in minhash.links(sets, side, 80):
            chained[root(chained, i)] = root(chained, j)
        for i in range(150):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if (sides == 1 or side[i] != side[j]) and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                    plain[root(plain, i)] = root(plain, j)
        same = [{(i, j) for i in range(150) for j in range(i) if root(p, i) == root(p, j)} for p in (chained, plain)]
        assert same[0] == same[1] and 0 < len(same[0]) < 150 * 149 // 2


def test_near_duplicates_of_empty_table(spark):
    assert minhash.duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_signature_estimates_similarity():
    draw = np.random.default_rng(3)
    for size in (3, 40, 900):
        shared, own = draw.integers(1, 1 << 62, size * 8).astype(np.uint64), draw.integers(1, 1 << 62, size * 4).astype(np.uint64)
        a, b = np.concatenate((shared, own[: size * 2])), np.concatenate((shared, own[size * 2 :]))
        same = (minhash.signature(a, 512) == minhash.signature(b, 512)).mean()
        assert abs(same - 8 / 12) < 0.1
        assert np.isfinite(minhash.signature(a[:3])).all()


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 102), (101, 102), (7, 7)]
    found = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}
