"""Packing: optimal length buckets and token-budget batches.

A length is what the caller gives as ``length_col`` (token counts, such as
``n_tokens`` of op8), and without it the count of words between white space: a
text written without spaces is then one word.  Lengths are read in one scan.  The global histogram has one bin for
every length up to 512 and 256 bins an octave above, so it has at most some
thousand rows whatever the input; each bin knows its row count, its sum and its
greatest length.  Dynamic programming over the bins chooses the bucket bounds
that minimise padding, ``sum(bound - length)``, among all choices of at most
``BUCKETS`` bounds at greatest lengths.  Inside a bucket rows are numbered in
the order of a hash of the id, and every ``budget // bound`` of them form a
batch.  Numbering splits a bucket into range slices, so no bucket meets in one
task.

Defined results: null and empty texts, and null given lengths, have length 0
and lie in the first bucket.  A text longer than the budget forms a batch of its own.  Null and
repeated ids are placed like others, each row once.  Only the id and the
text, or the given length, are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.functions.sequence import sequence_within
from encore.llm.names import quoted
from encore.llm.quality_rules import words
from encore.session import materialize

BUCKETS = 16
BUDGET = 65_536          # padded length of a batch
EXACT_BITS = 9           # lengths below 2^9 have their own bins


def _bin(n: Column) -> list[Column]:
    shift = F.greatest(F.floor(F.log2(F.greatest(n, F.lit(1)).cast("double"))).cast("int") - (EXACT_BITS - 1),
                       F.lit(0))
    return [shift.alias("shift"), F.floor(n / F.pow(F.lit(2.0), shift)).cast("long").alias("bin")]


def histogram(lengths: DataFrame, col: str = "n_tokens") -> DataFrame:
    return (lengths.select(F.col(col).alias("n"), *_bin(F.col(col))).groupBy("shift", "bin")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("total"), F.max("n").alias("top")))


def optimal_bounds(rows: np.ndarray, total: np.ndarray, top: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """Bounds of least padding; bins come in the order of ``top``."""
    n, s = np.concatenate([[0], np.cumsum(rows)]), np.concatenate([[0], np.cumsum(total)])
    best = np.full(len(n), np.inf)
    best[0] = 0.0
    cuts = []
    for _ in range(min(buckets, len(rows))):
        new, cut = np.full(len(n), np.inf), np.zeros(len(n), np.int64)
        new[0] = 0.0
        for j in range(1, len(n)):       # the last bucket holds the bins i..j-1
            cost = best[:j] + top[j - 1] * (n[j] - n[:j]) - (s[j] - s[:j])
            cut[j] = int(np.argmin(cost))
            new[j] = cost[cut[j]]
        best = new
        cuts.append(cut)
    bounds, j = [], len(rows)
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(top[j - 1]))
        j = int(cut[j])
    return bounds[::-1]


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS,
         budget: int = BUDGET, length_col: str | None = None) -> DataFrame:
    """``(id_col, n_tokens, bucket, bucket_len, batch, slot)`` of every row;
    ``length_col`` names a column with the lengths, words are counted without it."""
    length = (F.coalesce(docs[quoted(length_col)], F.lit(0)) if length_col
              else F.size(words(docs[quoted(text_col)])))
    # the row number parts rows of one id, so that no id fills a slice
    lengths = materialize(docs.select(docs[quoted(id_col)].alias("_id"), length.cast("long").alias("n_tokens"),
                                      F.monotonically_increasing_id().alias("_rid")), "lengths")
    # at most 512 + 256 an octave rows
    h = sorted(histogram(lengths).collect(), key=lambda r: r["top"])
    if not h:
        known = T.StructType.fromDDL("n_tokens long, bucket int, bucket_len long, batch long, slot int")
        return docs.sparkSession.createDataFrame(
            [], T.StructType([T.StructField(id_col, lengths.schema["_id"].dataType), *known.fields]))
    bounds = optimal_bounds(np.array([r["rows"] for r in h], float), np.array([r["total"] for r in h], float),
                            np.array([r["top"] for r in h], float), buckets)
    n = F.col("n_tokens")
    bucket = bound = None
    for i, b in enumerate(bounds):
        bucket = F.when(n <= b, i) if bucket is None else bucket.when(n <= b, i)
        bound = F.when(n <= b, F.lit(b)) if bound is None else bound.when(n <= b, F.lit(b))
    placed = lengths.select("_id", "_rid", "n_tokens", bucket.cast("int").alias("bucket"),
                            bound.cast("long").alias("bucket_len"), F.xxhash64("_id").alias("_h"))
    rows = sequence_within(placed, "bucket", ["_h", "_id", "n_tokens", "_rid"], out="_seq")
    capacity = F.greatest(F.floor(F.lit(budget) / F.greatest("bucket_len", F.lit(1))), F.lit(1))
    at = F.col("_seq") - 1
    return rows.select(F.col("_id").alias(id_col), "n_tokens", "bucket", "bucket_len",
                       F.floor(at / capacity).cast("long").alias("batch"),
                       (at % capacity).cast("int").alias("slot"))


def op5_packing(spark, d):
    return pack(spark.read.parquet(f"{d}/documents.parquet"))


QUERIES = {"op5_packing": op5_packing}
ORACLE: dict[str, str] = {}
