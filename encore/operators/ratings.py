"""The rating table, kept up to date in place (OP-04, 13, 14, 15, 28).

Rows ``(uid, mid, weight)`` lie in buckets of the user id, sorted by user and
item, with a bloom filter on the item.  A batch of clicks rewrites only the
buckets of its users; the manifest of the new version lists the new folders of
those buckets and the old folders of all others, so a reader sees the batch
whole or not at all.  The manifest also names the last batch that is counted: a
batch that comes again changes nothing.

The weight statistics are kept beside the rows as exact sums ``n``, ``sum w`` and
``sum w^2``.  A click count ``d`` on a weight ``w`` adds ``d`` to the second and ``2 w d +
d^2`` to the third, found in the pass that rewrites the rows, so the z-score needs
no scan for its mean and deviation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from encore.operators.normalize import zscore
from encore.sources.neighbours import bucket_of, buckets_in
from encore.sources.versions import Versions

BUCKETS = 64
ROWS = "uid int, mid int, weight long"


def _sums(weight, before=None) -> list:
    """Aggregates of ``(n, total, sq)``, or of their change from ``before``."""
    w = F.coalesce(weight.cast("decimal(19,0)"), F.lit(0))
    old = F.lit(0) if before is None else F.coalesce(before.cast("decimal(19,0)"), F.lit(0))
    new = F.lit(1) if before is None else F.when(before.isNull(), 1).otherwise(0)
    total = lambda c, name: F.coalesce(F.sum(c).cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)")).alias(name)
    return [total(new, "n"), total(w - old, "total"), total(w * w - old * old, "sq")]


class RatingTable:
    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.versions = Versions(spark, path)
        known = self.versions.latest()[1]
        self.buckets = known.get("n_buckets", buckets)

    def _write(self, rows: DataFrame, number: int, sums: list) -> tuple[dict, Row]:
        """Write rows in their buckets; the folder of each bucket, and the sums."""
        seen = Observation(f"sums-{number}")
        folder = f"v{number}"
        (rows.observe(seen, *sums).select("uid", "mid", "weight", "bucket")
         .hint("rebalance", "bucket").sortWithinPartitions("bucket", "uid", "mid")
         .write.mode("overwrite").option("parquet.bloom.filter.enabled#mid", "true")
         .partitionBy("bucket").parquet(f"{self.path}/{folder}"))
        fs, where = self.versions._fs(folder)
        names = [s.getPath().getName() for s in fs.listStatus(where)]
        return ({n.split("=")[1]: f"{folder}/{n}" for n in names if n.startswith("bucket=")}, seen.get)

    def _commit(self, number: int, buckets: dict, applied: int, sums: dict) -> None:
        self.versions.commit(number, {
            "folders": sorted(buckets.values()), "buckets": buckets, "n_buckets": self.buckets, "applied": applied,
            "sums": {k: str(v) for k, v in sums.items()}})

    def create(self, ratings: DataFrame) -> "RatingTable":
        """The first version, of unique ``(uid, mid, weight)`` rows."""
        rows = ratings.select("uid", "mid", F.col("weight").cast("long").alias("weight")).withColumn(
            "bucket", bucket_of(F.col("uid"), self.buckets))
        folders, sums = self._write(rows, 0, _sums(F.col("weight")))
        self._commit(0, folders, -1, {k: int(sums[k]) for k in ("n", "total", "sq")})
        return self

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(*[f"{self.path}/{f}" for f in folders])

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """OP-05: the newest version, of these buckets (None: all)."""
        at = self.versions.latest()[1]["buckets"]
        return self._read([f for b, f in sorted(at.items()) if buckets is None or int(b) in buckets])

    def of_users(self, users: DataFrame) -> DataFrame:
        """OP-13 ``uid IN``: rows of the users in ``users``; other buckets are not read."""
        return self.read(buckets_in(users, "uid", self.buckets)).join(
            users.select("uid").distinct(), "uid", "left_semi")

    def of_items(self, mids: list[int]) -> DataFrame:
        """OP-13 ``mid IN`` a short list: pushed down to row groups and bloom filters."""
        return self.read().where(F.col("mid").isin([int(m) for m in mids]))

    def of_pairs(self, pairs: DataFrame) -> DataFrame:
        """OP-13 by ``(uid, mid)``: the pairs with their weight, null where not rated."""
        return pairs.join(self.read(buckets_in(pairs, "uid", self.buckets)), ["uid", "mid"], "left")

    def apply(self, clicks: DataFrame, batch_id: int) -> bool:
        """OP-28 for one batch: each click adds 1 to its pair or inserts it.  False
        when the batch is counted already.  Batches come in order."""
        number, m = self.versions.latest()
        if batch_id <= m["applied"]:
            return False
        delta = clicks.groupBy("uid", "mid").agg(F.count(F.lit(1)).alias("_d"))
        touched = buckets_in(clicks, "uid", self.buckets)
        old = self.read(touched).withColumnRenamed("weight", "_old")
        rows = (old.join(delta, ["uid", "mid"], "full")
                .select("uid", "mid", "_old", (F.coalesce("_old", F.lit(0)) + F.coalesce("_d", F.lit(0))).alias("weight"),
                        bucket_of(F.col("uid"), self.buckets).alias("bucket")))
        folders, change = self._write(rows, number + 1, _sums(F.col("weight"), F.col("_old")))
        sums = {k: int(m["sums"][k]) + int(change[k]) for k in ("n", "total", "sq")}
        self._commit(number + 1, m["buckets"] | folders, batch_id, sums)
        return True

    def stats(self) -> DataFrame:
        """OP-14 from the kept sums: one row ``(n, total, mean, std)``, no scan."""
        s = {k: int(v) for k, v in self.versions.latest()[1]["sums"].items()}
        n, total = s["n"], s["total"]
        if not n:
            return self.spark.createDataFrame([(0, None, None, None)], "n long, total long, mean long, std double")
        mean = abs(total) // n * (1 if total >= 0 else -1)          # truncated toward zero (D1)
        around = s["sq"] - 2 * mean * total + n * mean * mean
        return self.spark.createDataFrame([(n, total, mean, (float(around) / float(n)) ** 0.5)],
                                          "n long, total long, mean long, std double")

    def scored(self) -> DataFrame:
        """OP-15 with the kept statistics."""
        return zscore(self.read(), stats=self.stats().first())
