"""The stream's keyed store (OP-07), folded as it grows.

Four tables under one manifest, so a reader sees a batch in all of them or in
none:

  heads   ``(uid, event_id, ts, seq, queue)``  the user's last scored click and recent queue
  recs    ``(uid, event_id, mid, score, rank)``  the list written at that click
  counts  ``(uid, mid, clicks)``  clicks of the user on the item
  files   ``(file)``  log files that are scored

A batch writes one part of level 0; its rows say what changed.  ``FAN`` parts of a
level are folded into one of the next (newest head a user, its list, sums of the
counts), so ``n`` batches leave at most ``FAN`` parts a level and ``log n`` levels.
Folded parts lie in buckets of the user id, and a batch reads only the buckets
of its users.  A batch that is already in the manifest is not written again.
Old parts stay for readers of the last few versions and are then dropped.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.sources.neighbours import bucket_of
from encore.sources.versions import Versions

LAYOUT = 2               # 1: a folder a batch without manifests
FAN = 8                  # parts of a level that are folded into one
KEEP = 30                # versions that stay readable: a minute of batches for a reader
BUCKETS = 64
TABLES = {
    "heads": "uid int, event_id long, ts long, seq long, queue array<int>, bucket int",
    "recs": "uid int, event_id long, mid int, score double, rank int, bucket int",
    "counts": "uid int, mid int, clicks long, bucket int",
    "files": "file string, bucket int",
}


def newest_heads(heads: DataFrame) -> DataFrame:
    last = heads.groupBy("uid").agg(F.max_by(F.struct("event_id", "ts", "seq", "queue", "bucket"), "seq").alias("_h"))
    return last.select("uid", "_h.*")


class StreamSink:
    def __init__(self, spark: SparkSession, out: str, fan: int = FAN, keep: int = KEEP):
        self.spark, self.out, self.fan, self.keep = spark, out.rstrip("/"), fan, keep
        self.versions = Versions(spark, out)

    def manifest(self) -> tuple[int, dict]:
        number, m = self.versions.latest()
        if number < 0 and self.versions.exists("heads"):
            raise RuntimeError(f"{self.out} was written in layout 1; give the stream a new folder")
        if number >= 0 and m["layout"] != LAYOUT:
            raise RuntimeError(f"{self.out} has layout {m['layout']}, this code writes {LAYOUT}")
        return number, m

    def open(self, checkpoint: str, after: str | None = None) -> dict:
        """Bind the folder to a checkpoint: a run with another one would number
        its batches anew over those that are here, so it is refused.  ``after``
        is kept from the first run on."""
        number, m = self.manifest()
        if number < 0:
            m = {"layout": LAYOUT, "checkpoint": checkpoint, "after": after, "batch": -1, "parts": [], "folders": []}
            self.versions.commit(0, m)
        elif m["checkpoint"] != checkpoint:
            raise RuntimeError(f"{self.out} belongs to the checkpoint {m['checkpoint']}")
        elif m["batch"] >= 0 and not Versions(self.spark, checkpoint).exists():
            raise RuntimeError(f"{self.out} holds batches up to {m['batch']}, but its checkpoint {checkpoint} is gone")
        return m

    # -- writing -----------------------------------------------------------------

    def add(self, batch_id: int, tables: dict[str, DataFrame]) -> None:
        """Commit a batch; a batch that is there already is left as it is."""
        number, m = self.manifest()
        if number >= 0 and m["batch"] >= batch_id:
            return
        folder = f"parts/0-{batch_id}"
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.out}/{folder}/{name}")
        parts = m.get("parts", []) + [{"level": 0, "folder": folder}]
        self._commit(number + 1, m | {"layout": LAYOUT, "batch": batch_id, "parts": parts})
        self.fold()

    def _commit(self, number: int, m: dict) -> None:
        self.versions.commit(number, m | {"folders": [p["folder"] for p in m["parts"]]}, self.keep)

    def fold(self, everything: bool = False) -> int:
        """Fold full levels (or all parts into one); the number of parts left."""
        while True:
            number, m = self.manifest()
            parts = m.get("parts", [])
            levels = sorted({p["level"] for p in parts})
            if everything:
                group = parts if len(parts) > 1 else []
            else:
                full = [x for x in levels if sum(p["level"] == x for p in parts) >= self.fan]
                group = [p for p in parts if p["level"] == full[0]] if full else []
            if not group:
                return len(parts)
            level = max(p["level"] for p in group) + 1
            folder = f"parts/{level}-{m['batch']}"
            heads = newest_heads(self._read("heads", group))
            merged = {
                "heads": heads,
                "recs": self._read("recs", group).join(heads.select("uid", "event_id"), ["uid", "event_id"], "left_semi"),
                "counts": self._read("counts", group).groupBy("uid", "mid", "bucket").agg(F.sum("clicks").alias("clicks")),
                "files": self._read("files", group),
            }
            for name, df in merged.items():
                (df.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket")
                 .parquet(f"{self.out}/{folder}/{name}"))
            kept = [p for p in parts if p not in group]
            at = parts.index(group[0])
            self._commit(number + 1, m | {"parts": kept[:at] + [{"level": level, "folder": folder}] + kept[at:]})

    # -- reading -----------------------------------------------------------------

    def _read(self, name: str, parts: list[dict], buckets: list[int] | None = None) -> DataFrame:
        schema = TABLES[name]
        flat = [f"{self.out}/{p['folder']}/{name}" for p in parts if p["level"] == 0]
        found = [self.spark.read.schema(schema).parquet(*flat)] if flat else []
        found += [self.spark.read.schema(schema).parquet(f"{self.out}/{p['folder']}/{name}")
                  for p in parts if p["level"] > 0]
        if not found:
            return self.spark.createDataFrame([], schema)
        rows = reduce(DataFrame.unionByName, found)
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))

    def table(self, name: str, buckets: list[int] | None = None) -> DataFrame:
        """All rows of a table's live parts, of these user buckets (None: all)."""
        return self._read(name, self.manifest()[1].get("parts", []), buckets)


def with_bucket(df: DataFrame, key: str = "uid") -> DataFrame:
    return df.withColumn("bucket", bucket_of(F.col(key), BUCKETS))
