"""The similar-item table as versions that a running job can swap (OP-40).

A version holds one row an item ``(mid, recs)`` with its neighbours best first,
in buckets of the item id, so a reader that knows its items reads only their
buckets.  ``publish`` adds a version; a reader looks at the newest manifest and
keeps its DataFrame until the number changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.versions import Versions

BUCKETS = 64
LISTS = "mid int, recs array<struct<nb_mid: int, score: double>>, bucket int"


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(key.cast("long")), F.lit(buckets)).cast("int")


def buckets_in(rows: DataFrame, col: str, buckets: int = BUCKETS) -> list[int]:
    """The buckets of a column's values: at most ``buckets`` numbers."""
    return sorted(r["b"] for r in rows.select(bucket_of(F.col(col), buckets).alias("b")).distinct().collect())


def publish(long: DataFrame, path: str) -> int:
    """Write ``(mid, nb_mid, score, ...)`` as the next version; its number."""
    versions = Versions(long.sparkSession, path)
    number = versions.latest()[0] + 1
    best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("_s"), "nb_mid", "score")))
    lists = (long.groupBy("mid").agg(best.alias("_r"))
             .select("mid", F.transform("_r", lambda r: F.struct(r["nb_mid"].alias("nb_mid"), r["score"].alias("score")))
                     .alias("recs"), bucket_of(F.col("mid")).alias("bucket")))
    folder = f"lists/v={number}"
    (lists.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/{folder}"))
    versions.commit(number, {"folders": [folder]})
    return number


class Neighbours:
    """The newest published lists, or a plain long table at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.versions, self.number, self._table = Versions(spark, path), None, None

    def refresh(self) -> int:
        """Number of the newest version; its table is opened only when it is new."""
        number, manifest = self.versions.latest()
        if number >= 0 and number != self.number:
            self._table = self.spark.read.schema(LISTS).parquet(f"{self.path}/{manifest['folders'][0]}")
        self.number = number
        return number

    def lists(self, buckets: list[int] | None = None) -> DataFrame:
        """``(mid, recs)`` of the items of these buckets (None: of all)."""
        if self.number is None:
            self.refresh()
        if self.number < 0:
            long = self.spark.read.parquet(self.path)
            best = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("_s"), "nb_mid", "score")))
            return long.groupBy("mid").agg(best.alias("_r")).select("mid", F.transform(
                "_r", lambda r: F.struct(r["nb_mid"].alias("nb_mid"), r["score"].alias("score"))).alias("recs"))
        table = self._table if buckets is None else self._table.where(F.col("bucket").isin(buckets))
        return table.select("mid", "recs")

    def pairs(self, buckets: list[int] | None = None) -> DataFrame:
        """The long form ``(mid, nb_mid, score)``."""
        return self.lists(buckets).select("mid", F.inline("recs"))
