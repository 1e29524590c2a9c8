"""Embedding rows as vectors of whole numbers, shared by the vector operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(embeddings: DataFrame, scale: int, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, x): floor(scale * component) of every row whose vector is whole.

    Vectors that are null or hold null or non-finite components take no part; rows without an id
    stay. Products beyond the long range stop at its ends. Vectors shorter than the longest end in
    zeros, so that all have one length; an empty vector is all zeros.
    """
    value = F.col(vector_column).cast("array<double>")
    bad = F.exists(value, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = embeddings.where(F.col(vector_column).isNotNull() & ~bad).select(
        F.col(id_column).cast("bigint").alias("vec_id"),
        F.transform(value, lambda e: F.floor(e * F.lit(float(scale))).cast("bigint")).alias("x"),
    )
    longest = rows.agg(F.max(F.size("x")).alias("n")).first()["n"] or 0
    padding = F.array_repeat(F.lit(0).cast("bigint"), F.lit(longest) - F.size("x"))
    return rows.withColumn("x", F.when(F.size("x") < longest, F.concat("x", padding)).otherwise(F.col("x")))


def matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """The vectors of a batch as rows of a matrix; all have one length."""
    lists = batch.column(column)
    return np.asarray(lists.flatten(), dtype=np.int64).reshape(len(lists), -1)
