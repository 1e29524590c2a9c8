"""Pipeline on the smallest given tables against a plain version of its stages."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from souklake.llm import decontaminate, quality_model, secrets

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def shingle_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    machine = quality_model.fit(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"), usable=quality_model.fold() != 2)
    good = {r.doc_id for r in quality_model.score(docs, machine).where("score >= 0.7").collect()}
    texts = {r.doc_id: r.text for r in docs.orderBy("doc_id").collect() if r.doc_id in good}
    sets = {d: shingle_set(x) for d, x in texts.items()}
    group = {d: d for d in texts}
    for _ in range(5):
        for a in texts:
            for b in texts:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    group[b] = min(group[b], group[a])
    kept = {d for d in texts if group[d] == d}
    patterns = {p for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect() for p in decontaminate.windows(r.text.encode())}
    clean = set()
    for d in kept:
        w = decontaminate.words(texts[d].encode())
        hit = set()
        for i in range(len(w)):
            for size in {p.count(b" ") - 1 for p in patterns}:
                if i + size <= len(w) and b" " + b" ".join(w[i : i + size]) + b" " in patterns:
                    hit |= set(range(i, i + size))
        if not decontaminate.contaminated(len(w), len(hit)):
            clean.add(d)
    assert {r.doc_id for r in found} == clean and len(found) == len(clean)
    assert 0 < len(clean) < len(kept) < len(texts) < docs.count()
    import public_tokenizers

    from souklake.llm import bpe

    decoder = bpe.Decoder(bpe.vocabulary_lines(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")))
    for r in found:
        text = texts[r.doc_id]
        assert decoder.decode(bytes(r.ids)).decode() == secrets.redact_text(text, secrets.scan_text(text))


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).schema.names == docs.schema.names, name
    empty = docs.where(F.lit(False))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
