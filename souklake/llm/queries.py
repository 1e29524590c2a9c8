"""Registered queries of the text operators: each applies its operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    html_text,
    minhash,
    oracle,
    pivot_search,
    prefix_trie,
    quality_model,
    quality_rules,
    secrets,
    shards,
    substrings,
    suffixes,
    whitening,
)
from .vectors import whole_vectors

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
SHARDS = [f"shard-{i:03d}" for i in range(128)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.deduplicate(table(spark, sf_dir, "documents")).drop("kept")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(table(spark, sf_dir, "documents")).drop("spans")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.drop("rules_run", "rejected_by")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in ("assign", "access", "hex")),
        F.sha2(joined(of("assign", "access", "hex")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_text.extracted(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, pattern), path)
    return decoded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicates(table(spark, sf_dir, "documents"))


def op9_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    machine = quality_model.fit(docs, labels, usable=quality_model.fold() != 2)
    return quality_model.score(docs, machine).select(
        "doc_id",
        (quality_model.fold() == 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op10_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = shards.place(docs, SHARDS, ["doc_id"])
    return placed.select("doc_id", "source", "slot", "shard", F.octet_length("text").cast("long").alias("n_bytes"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*prefix_trie.rebuilt(table(spark, sf_dir, "conversations")))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"), 64)
    return pivot_search.search(vectors, asks=F.col("vec_id") % 20 == 0, k=20)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = whole_vectors(table(spark, sf_dir, "embeddings"), 256)
    fitted = whitening.fit(vectors, top=4)
    if fitted is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    found, error = fitted
    sums = F.array(*[F.lit(int(s)) for s in found.sums])
    squares = F.zip_with("x", sums, lambda x, s: (F.lit(found.n) * x - s) * (F.lit(found.n) * x - s))
    shares = F.array(*[F.lit(float(e / found.trace)) for e in found.values])
    rows = whitening.whitened(vectors, found).select(
        "vec_id", F.aggregate(squares, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("deviation"), F.posexplode("whitened").alias("at", "whitened")
    )
    return rows.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(found.n).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_decontaminate": op3_decontaminate,
    "op4_quality_rules": op4_quality_rules,
    "op5_secret_scan": op5_secret_scan,
    "op6_main_text": op6_main_text,
    "op7_bpe": op7_bpe,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality_model": op9_quality_model,
    "op10_shard_documents": op10_shard_documents,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_top_k": op12_top_k,
    "op13_whitening": op13_whitening,
}
ORACLE: dict[str, str] = {
    "op1_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op10_shard_documents": oracle.shard_documents(SHARDS),
    "op11_prefix_trie": oracle.PREFIX_TRIE,
    "op12_top_k": oracle.TOP_K,
}
