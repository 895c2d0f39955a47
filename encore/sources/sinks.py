"""Table sinks: overwrite (OP-03) and the rating table laid out for lookups
by user and item (OP-04)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from encore.schemas import RATING


def write_table(df: DataFrame, path: str) -> None:
    """OP-03: replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_ratings(ratings: DataFrame, path: str, files: int | None = None) -> None:
    """OP-04: replace the rating table, clustered by ``uid`` then ``mid``.

    Range partitioning gives each file a disjoint ``uid`` range and sorting
    inside files tightens row-group min/max, so ``uid = ?`` and ``mid`` filters
    prune files and row groups: the file layout plays the role of an index.
    """
    n = files or int(ratings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (ratings.repartitionByRange(n, "uid", "mid").sortWithinPartitions("uid", "mid")
     .write.mode("overwrite").parquet(path))


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """OP-05 for the rating table, with its fixed schema."""
    return spark.read.schema(RATING).parquet(path)
