"""The seven jobs, runnable with ``spark-submit`` (or ``python -m encore.jobs``):

  load     interaction + catalog text -> z-scored rating table (OP-01/02/04/14/15)
           and catalog table (OP-03/09); rejects written beside them
  tune     rating table -> RMSE for each (rank, reg) of the grid and the best (OP-33/34/17)
  similar  rating table -> ALS item factors -> top-k similar items (OP-30/31/19/12/18)
  stream   click log directory or Kafka topic -> per-user real-time lists (OP-06/07/36/37/40)
  fold     rating table + click log -> rating table with the clicks counted (OP-28/15)
  upsert   clicks of a log, as one batch, into a RatingTable in place (OP-28/14)
  views    rating table, catalog, click log, stream output -> per-user views (OP-24..27, 29, 41)

Paths may be any file system Spark reads; the session's ``spark.checkpoint.dir``
is used for checkpoints.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.config import DEFAULT
from encore.operators import factors, normalize, serving, similarity
from encore.operators.ratings import RatingTable
from encore.session import ensure_checkpoint_dir, materialize
from encore.sources import neighbours, sinks, text
from encore.streaming import stream


def load(spark: SparkSession, ratings_text: str, catalog_text: str, out: str, table: bool = False) -> None:
    ok, bad = text.read_interactions(spark, ratings_text)
    ok = materialize(ok)                       # read twice by the z-score
    if table:                                  # the form that clicks are added to in place
        unique = ok.groupBy("uid", "mid").agg(F.sum("weight").alias("weight"))
        RatingTable(spark, os.path.join(out, "rating_table")).create(unique)
    sinks.write_ratings(normalize.zscore(ok), os.path.join(out, "ratings"))
    bad.write.mode("overwrite").parquet(os.path.join(out, "rejects", "ratings"))
    items, bad_items = text.read_catalog(spark, catalog_text)
    sinks.write_table(spark.sql("SELECT mid, name, url FROM {items}", items=items),
                      os.path.join(out, "catalog"))
    bad_items.write.mode("overwrite").parquet(os.path.join(out, "rejects", "catalog"))


def tune(spark: SparkSession, ratings: str, out: str, ranks=DEFAULT.grid_ranks,
         regs=DEFAULT.grid_regs) -> None:
    train, test = factors.train_test(sinks.read_ratings(spark, ratings))
    grid = factors.grid_search(train, test, ranks, regs)
    sinks.write_table(grid, os.path.join(out, "grid"))
    for r in grid.collect():                   # a dozen rows, printed as the original did
        print((r["rank"], r.reg, r.rmse))
    best = factors.best_config(grid).first()
    print("best:", (best["rank"], best.reg, best.rmse) if best else None)


def similar(spark: SparkSession, ratings: str, out: str, knobs=DEFAULT) -> None:
    model = factors.fit_with_hot_users(sinks.read_ratings(spark, ratings), knobs.als_hot_degree, knobs.als_rank,
                                       knobs.als_iterations, knobs.als_reg)
    long = similarity.item_similarity(factors.item_factors(model), knobs.sim_threshold,
                                      knobs.top_k_similar)
    neighbours.publish(long, os.path.join(out, "similar"))       # a running stream takes it up


def logged_clicks(spark: SparkSession, log: str, prefix: str = DEFAULT.click_prefix) -> DataFrame:
    """Clicks of a log; those of one second go by item id, as in the stream."""
    clicks, _ = text.parse_click_log(spark.read.text(log), prefix)
    return clicks.withColumn("event_id", F.col("mid").cast("long"))


def fold(spark: SparkSession, ratings: str, log: str, out: str) -> None:
    """The next rating table: every logged click adds one to its pair."""
    now = materialize(serving.apply_clicks(sinks.read_ratings(spark, ratings), logged_clicks(spark, log)))
    sinks.write_ratings(normalize.zscore(now), os.path.join(out, "ratings"))


def upsert(spark: SparkSession, table: str, log: str, batch: int) -> bool:
    """Count the clicks of a log in a ``RatingTable``, as batch ``batch``; a batch
    that is counted already changes nothing."""
    return RatingTable(spark, table).apply(logged_clicks(spark, log), batch)


def views(spark: SparkSession, ratings: str, catalog: str, log: str, recs: str, out: str,
          knobs=DEFAULT) -> None:
    """``ratings`` is the table after ``fold``, ``recs`` the stream's output."""
    rated, items = sinks.read_ratings(spark, ratings), spark.read.parquet(catalog)
    board = serving.user_dashboard(
        serving.user_history(logged_clicks(spark, log), items, rated, knobs.history_n),
        serving.user_recs(stream.latest_stream_recs(spark, recs), items, rated, knobs.recs_n),
        serving.user_favourites(rated, items, knobs.history_n))
    board.write.mode("overwrite").partitionBy("section").parquet(os.path.join(out, "dashboard"))
    sinks.write_table(stream.stream_user_status(spark, recs, log, knobs.click_prefix),
                      os.path.join(out, "status"))


def kafka_options(servers: str, topic: str, max_offsets: int) -> dict:
    """New clicks only, and a bounded micro-batch."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest",
            "maxOffsetsPerTrigger": str(max_offsets)}


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="encore.jobs")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("load")
    a.add_argument("--ratings-text", required=True)
    a.add_argument("--catalog-text", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--table", action="store_true", help="also write OUT/rating_table, for upsert and stream")
    a = sub.add_parser("tune")
    a.add_argument("--ratings", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--ranks", type=int, nargs="*", default=list(DEFAULT.grid_ranks))
    a.add_argument("--regs", type=float, nargs="*", default=list(DEFAULT.grid_regs))
    a = sub.add_parser("similar")
    a.add_argument("--ratings", required=True)
    a.add_argument("--out", required=True)
    a = sub.add_parser("stream")
    a.add_argument("--clicks", help="directory of log files")
    a.add_argument("--kafka-servers", help="instead of --clicks; needs Spark's Kafka connector")
    a.add_argument("--topic", default="clicks")
    a.add_argument("--max-offsets", type=int, default=100_000, help="most messages of a micro-batch")
    a.add_argument("--similar", required=True, help="similar-item table, as the similar job publishes it")
    a.add_argument("--ratings", required=True, help="stored rating table")
    a.add_argument("--out", required=True)
    a.add_argument("--checkpoint", help="default: _checkpoint under --out, so a restart goes on")
    a.add_argument("--start", choices=("earliest", "latest"), default="earliest", help="log files of before the first run")
    a.add_argument("--available-now", action="store_true")
    a = sub.add_parser("fold")
    for name in ("--ratings", "--clicks", "--out"):
        a.add_argument(name, required=True)
    a = sub.add_parser("upsert")
    a.add_argument("--ratings", required=True, help="a rating table of load --table")
    a.add_argument("--clicks", required=True)
    a.add_argument("--batch", type=int, required=True, help="number of this batch; batches come in order")
    a = sub.add_parser("views")
    for name in ("--ratings", "--catalog", "--clicks", "--recs", "--out"):
        a.add_argument(name, required=True)
    args = p.parse_args(argv)
    if args.job == "stream" and bool(args.clicks) == bool(args.kafka_servers):
        p.error("give --clicks or --kafka-servers")

    spark = SparkSession.builder.appName(f"encore-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.job == "load":
        load(spark, args.ratings_text, args.catalog_text, args.out, args.table)
    elif args.job == "tune":
        tune(spark, args.ratings, args.out, args.ranks, args.regs)
    elif args.job == "similar":
        similar(spark, args.ratings, args.out)
    elif args.job == "fold":
        fold(spark, args.ratings, args.clicks, args.out)
    elif args.job == "upsert":
        print("counted" if upsert(spark, args.ratings, args.clicks, args.batch) else "was counted already")
    elif args.job == "views":
        views(spark, args.ratings, args.catalog, args.clicks, args.recs, args.out)
    else:
        kafka = args.kafka_servers and kafka_options(args.kafka_servers, args.topic, args.max_offsets)
        q = stream.run_stream(spark, args.clicks, args.similar, args.ratings, args.out, args.checkpoint,
                              available_now=args.available_now, fmt="kafka" if kafka else "text",
                              options=kafka, start=args.start)
        for query in (q, q.rejects):
            if query is not None:
                query.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
