"""Weight statistics (OP-14) and the global z-score (OP-15).

Contract (D1): mean = integer sum divided by the count, truncated toward
zero; std = population deviation about that truncated mean.  Both come from
one partial aggregation: with integer weights
``sum((w - m)^2) = sum(w^2) - 2 m sum(w) + n m^2`` is exact in DECIMAL(38,0),
so no second pass and no floating cancellation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def weight_stats(ratings: DataFrame, col: str = "weight") -> DataFrame:
    """One row ``(n, total, mean, std)``; ``mean``/``std`` NULL on empty input."""
    w = F.col(col).cast("decimal(20,0)")
    agg = ratings.agg(F.count(F.lit(1)).alias("n"),
                      F.sum(F.col(col).cast("bigint")).alias("total"),
                      F.sum(w * w).alias("sq"))
    mean = F.expr("CASE WHEN n > 0 THEN total div n END")
    dev2 = (F.col("sq") - F.lit(2) * F.col("mean").cast("decimal(20,0)") * F.col("total")
            + F.col("n") * F.col("mean").cast("decimal(20,0)") * F.col("mean"))
    return (agg.withColumn("mean", mean)
            .select("n", "total", "mean",
                    F.sqrt(F.try_divide(dev2.cast("double"), F.col("n").cast("double"))).alias("std")))


def zscore(ratings: DataFrame, col: str = "weight", stats=None) -> DataFrame:
    """OP-15: add ``score = (weight - mean) / std`` over the whole table.

    The two statistics are one row, fetched as driver scalars and folded into
    the projection as literals: no join, no broadcast of anything that grows.
    ``std = 0`` gives a NULL score (D2).
    """
    if stats is None:
        stats = weight_stats(ratings, col).first()
    if stats is None or stats["mean"] is None:
        return ratings.withColumn("score", F.lit(None).cast("double"))
    diff = (F.col(col) - F.lit(int(stats["mean"]))).cast("double")
    std = stats["std"]
    score = F.try_divide(diff, F.lit(float(std))) if std else F.lit(None).cast("double")
    return ratings.withColumn("score", score)
