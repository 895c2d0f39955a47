"""Structured Streaming: click log source (OP-06), micro-batch trigger
(OP-36), per-user recent queue (OP-37/38), versioned similarity side (OP-40),
keyed store (OP-07), status from progress (OP-29).

Flow:  log lines (files or a Kafka topic) -> ``parse_click_log`` (rejects to
their own file sink) -> ``foreachBatch(score_batch)``.

A batch is worked on as a set, in DataFrame operations only.  A user's clicks
are counted by a partial aggregation and the newest ``queue_cap`` of them found
by a partial top-k, so a user with half a million clicks in a batch is spread
over all tasks.  They go before the queue that the keyed store holds for the
user, and the result is the new queue.  The list of the user's last click in the
batch is scored; lists of the clicks before it in the same batch would replace
each other at once, as the store keeps one list a user.

Clicks are ordered by second, then as the log has them: file name, place of the
read block in the file, line (Kafka: partition, offset).

The checkpoint lies in ``out/_checkpoint`` unless one is given, so a restarted
job goes on where it stopped, whatever application runs it; a folder is bound to
its checkpoint.  ``event_id`` of a click is ``uid * 2^31 + seq``.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from encore.config import DEFAULT
from encore.operators import realtime
from encore.operators.ratings import RatingTable
from encore.sources.neighbours import Neighbours, buckets_in
from encore.sources.text import parse_click_log
from encore.streaming.sink import StreamSink, newest_heads, with_bucket

ORDER = ["ts", "_file", "_block", "_line"]
STORE = "store"          # the keyed store's folder under ``out``


def click_lines(spark: SparkSession, path: str | None = None, fmt: str = "text",
                max_files_per_trigger: int | None = None, options: dict | None = None) -> DataFrame:
    """OP-06: the raw log as a stream ``(value, _file, _block)``.

    ``fmt="text"`` reads a directory of log files (what the log shipper
    writes); ``fmt="kafka"`` subscribes to a topic through Spark's Kafka
    source (``options`` such as ``kafka.bootstrap.servers``, ``subscribe``,
    ``startingOffsets``); that needs the Kafka connector on the classpath.
    """
    r = spark.readStream.format(fmt)
    if max_files_per_trigger and fmt == "text":
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if options:
        r = r.options(**options)
    df = r.load(path) if path else r.load()
    if fmt == "kafka":
        return df.selectExpr("CAST(value AS STRING) AS value", "concat(topic, '-', partition) AS _file",
                             "offset AS _block", "timestamp AS _written")
    return df.select("value", F.col("_metadata.file_path").alias("_file"),
                     F.col("_metadata.file_block_start").alias("_block"),
                     F.col("_metadata.file_modification_time").alias("_written"))


def click_source(spark: SparkSession, path: str | None, prefix: str = DEFAULT.click_prefix,
                 max_files_per_trigger: int | None = None, fmt: str = "text",
                 options: dict | None = None, after: str | None = None) -> tuple[DataFrame, DataFrame]:
    """OP-06 + OP-35: parsed clicks and the rejected lines (D4), both streams.
    ``after`` (a timestamp) leaves out files written before it."""
    lines = click_lines(spark, path, fmt, max_files_per_trigger, options)
    if after is not None:
        lines = lines.where(F.col("_written") >= F.lit(after).cast("timestamp"))
    return parse_click_log(lines.drop("_written"), prefix, keep=("_file", "_block"))


def batch_heads(clicks: DataFrame, heads: DataFrame, cap: int = DEFAULT.queue_cap) -> DataFrame:
    """OP-37: ``(uid, mid, ts, seq, queue)`` of each user after these clicks:
    the last click, its number and the newest ``cap`` items.  ``clicks`` is
    ``(uid, mid)`` with the ``ORDER`` columns, ``heads`` what was stored before,
    one row a user."""
    newest = Window.partitionBy("uid").orderBy(*[F.col(c).desc() for c in ORDER])
    fresh = (clicks.withColumn("pos", F.row_number().over(newest)).where(F.col("pos") <= cap)
             .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("pos", "mid"))).alias("_q"),
                                 F.max("ts").alias("ts")))
    counted = clicks.groupBy("uid").agg(F.count(F.lit(1)).alias("_n"))
    before = heads.select("uid", F.col("seq").alias("_seq"), F.col("queue").alias("_old"))
    queue = F.slice(F.concat(F.transform("_q", lambda e: e["mid"]),
                             F.coalesce("_old", F.array().cast("array<int>"))), 1, cap)
    return (fresh.join(counted, "uid").join(before, "uid", "left")
            .select("uid", F.col("_q")[0]["mid"].alias("mid"), "ts",
                    (F.coalesce("_seq", F.lit(0)) + F.col("_n")).alias("seq"), queue.alias("queue")))


def score_batch(batch: DataFrame, batch_id: int, similar: Neighbours, stored_path: str, sink: StreamSink,
                knobs=DEFAULT, round_digits: int | None = None) -> None:
    """OP-39 for one micro-batch, committed to the store; a batch that is
    committed already is skipped, so a retried one changes nothing."""
    if sink.manifest()[1].get("batch", -1) >= batch_id:
        return
    spark = batch.sparkSession
    similar.refresh()                                          # OP-40: the current version
    # lines of a block are read in order, so the id grows with the line
    clicks = batch.withColumn("_line", F.monotonically_increasing_id()).persist()
    try:
        users = clicks.select("uid").distinct()
        of_batch = buckets_in(users, "uid")

        def mine(table: DataFrame) -> DataFrame:
            return table.join(users, "uid", "left_semi")

        heads = batch_heads(clicks, newest_heads(mine(sink.table("heads", of_batch))), knobs.queue_cap)
        heads = heads.withColumn("event_id", F.col("uid").cast("long") * F.lit(1 << 31) + F.col("seq")).persist()
        try:
            counts = clicks.groupBy("uid", "mid").agg(F.count(F.lit(1)).alias("clicks"))
            rated = (mine(_stored(spark, stored_path, users))
                     .unionByName(mine(sink.table("counts", of_batch).select("uid", "mid")))
                     .unionByName(counts.select("uid", "mid")).distinct()
                     .withColumn("from_seq", F.lit(0).cast("long")))
            cands = realtime.click_candidates(heads, similar.pairs(buckets_in(heads, "mid")), rated,
                                              knobs.candidate_n).persist()
            recent = heads.select("event_id", F.array_sort(F.slice("queue", 1, knobs.recent_k)).alias("_recent"))
            try:
                recs = realtime.score_with_lists(cands, recent, similar.lists(buckets_in(cands, "cand")), round_digits)
                sink.add(batch_id, {
                    "heads": with_bucket(heads.select("uid", "event_id", "ts", "seq", "queue")),
                    "recs": with_bucket(recs.select("uid", "event_id", "mid", "score", "rank")),
                    "counts": with_bucket(counts.select("uid", "mid", "clicks")),
                    "files": clicks.select(F.col("_file").alias("file")).distinct().withColumn("bucket", F.lit(0)),
                })
            finally:
                cands.unpersist()
        finally:
            heads.unpersist()
    finally:
        clicks.unpersist()


def _stored(spark: SparkSession, path: str, users: DataFrame) -> DataFrame:
    """``(uid, mid)`` of the stored ratings: of the users' buckets where the path is
    a ``RatingTable``, else all of a plain table."""
    table = RatingTable(spark, path)
    if table.versions.latest()[0] >= 0:
        return table.read(buckets_in(users, "uid", table.buckets)).select("uid", "mid")
    return spark.read.schema("uid int, mid int").parquet(path)


def run_stream(spark: SparkSession, clicks_dir: str | None, sims_path: str, stored_path: str,
               out: str, checkpoint: str | None = None, available_now: bool = False,
               knobs=DEFAULT, max_files_per_trigger: int | None = 1000,
               round_digits: int | None = None, fmt: str = "text", options: dict | None = None,
               keep_rejects: bool = True, start: str = "earliest"):
    """Start the streaming recommender; returns the ``StreamingQuery``.

    ``sims_path`` is a table published by ``neighbours.publish`` (a new version
    counts from the next batch on) or a plain long table; ``stored_path`` is a
    ``RatingTable`` (its newest version is read, of the batch's users only) or a
    plain table.  ``checkpoint``
    defaults to ``out/_checkpoint``.  ``available_now`` processes what is there
    and stops (tests, catch-up runs); otherwise a batch fires every
    ``knobs.batch_seconds`` (OP-36).  ``start="latest"`` leaves out log files
    written before the first run.  With ``keep_rejects`` a second query appends
    malformed lines to ``out/rejects`` (file sink, exactly once); it is reachable
    as ``query.rejects``.
    """
    if start not in ("earliest", "latest"):
        raise ValueError(f"unknown start {start!r}")
    ckpt = checkpoint or os.path.join(out, "_checkpoint")
    sink = StreamSink(spark, os.path.join(out, STORE))
    begun = sink.open(ckpt, str(spark.sql("SELECT current_timestamp()").first()[0]) if start == "latest" else None)
    clicks, rejects = click_source(spark, clicks_dir, knobs.click_prefix, max_files_per_trigger,
                                   fmt, options, begun["after"] if fmt == "text" else None)
    similar = Neighbours(spark, sims_path)
    w = (clicks.writeStream.option("checkpointLocation", os.path.join(ckpt, "recs"))
         .foreachBatch(lambda df, bid: score_batch(df, bid, similar, stored_path, sink, knobs, round_digits)))
    r = None
    if keep_rejects:
        r = (rejects.drop("_file", "_block").writeStream.format("parquet").option("path", os.path.join(out, "rejects"))
             .option("checkpointLocation", os.path.join(ckpt, "rejects")))
    if available_now:
        w = w.trigger(availableNow=True)
        r = r.trigger(availableNow=True) if r is not None else None
    else:
        w = w.trigger(processingTime=f"{knobs.batch_seconds} seconds")
        r = r.trigger(processingTime=f"{knobs.batch_seconds} seconds") if r is not None else None
    q = w.start()
    q.rejects = r.start() if r is not None else None
    return q


def _sink(spark: SparkSession, out: str) -> StreamSink:
    return StreamSink(spark, os.path.join(out, STORE))


def latest_stream_recs(spark: SparkSession, out: str) -> DataFrame:
    """OP-07 read side: each user's current list ``(uid, event_id, mid, score, rank)``
    (the list of the user's highest ``seq``; empty lists have no rows, D12)."""
    _, m = _sink(spark, out).manifest()
    parts = m.get("parts", [])
    heads = newest_heads(_sink(spark, out)._read("heads", parts)).select("uid", "event_id")
    return (_sink(spark, out)._read("recs", parts).join(heads, ["uid", "event_id"], "left_semi")
            .select("uid", "event_id", "mid", "score", "rank"))


def stream_queues(spark: SparkSession, out: str) -> DataFrame:
    """OP-37 read side: ``(uid, seq, queue)``, newest item first."""
    return newest_heads(_sink(spark, out).table("heads")).select("uid", "seq", "queue")


def stream_counts(spark: SparkSession, out: str) -> DataFrame:
    """``(uid, mid, clicks)`` of everything the stream has scored."""
    return _sink(spark, out).table("counts").groupBy("uid", "mid").agg(F.sum("clicks").alias("clicks"))


def waiting_files(spark: SparkSession, out: str, log_dir: str) -> list[str]:
    """Log files that no committed batch has read (one name a file of the folder)."""
    listed = spark.createDataFrame([(f,) for f in spark.read.text(log_dir).inputFiles()], "file string")
    path = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")
    done = _sink(spark, out).table("files").select(path(F.col("file")).alias("_p"))
    return [r["file"] for r in listed.withColumn("_p", path(F.col("file"))).join(done, "_p", "left_anti").collect()]


def stream_user_status(spark: SparkSession, out: str, log_dir: str,
                       prefix: str = DEFAULT.click_prefix) -> DataFrame:
    """OP-29 against a running stream (D11): ``waiting`` for users with a click
    in a log file that is not scored yet, ``done`` for the others that have a
    head.  Only the files that wait are read.  Users are everyone with a click
    in the log.  ``(uid, status)``."""
    heads = _sink(spark, out).table("heads").select("uid").distinct()
    files = waiting_files(spark, out, log_dir)
    if not files:
        return heads.withColumn("status", F.lit("done"))
    clicks, _ = parse_click_log(spark.read.text(files), prefix)
    waiting = clicks.select("uid").distinct()
    return (waiting.withColumn("status", F.lit("waiting"))
            .unionByName(heads.join(waiting, "uid", "left_anti").withColumn("status", F.lit("done"))))


def compact_stream(spark: SparkSession, out: str) -> int:
    """Fold all parts of the store into one now; batches fold themselves as they
    come, so this only shortens reads after a stop.  The last batch it covers."""
    sink = _sink(spark, out)
    sink.fold(everything=True)
    return sink.manifest()[1].get("batch", -1)
