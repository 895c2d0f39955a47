"""The job entry points end to end on text derived from the sf0.001 tables."""

from pyspark.sql import functions as F

from conftest import SF001
from encore import jobs
from encore.operators import normalize, realtime
from encore.operators.ratings import RatingTable
from encore.sources import neighbours, sinks, tables, text
from encore.streaming import stream


def test_load_tune_similar(spark, workdir, capsys):
    w = workdir
    text.interaction_lines(tables.weights(spark, SF001)).write.text(f"{w}/ratings_txt")
    text.catalog_lines(tables.catalog(spark, SF001)).write.text(f"{w}/catalog_txt")
    jobs.load(spark, f"{w}/ratings_txt", f"{w}/catalog_txt", f"{w}/out", table=True)
    clicks = tables.clicks(spark, SF001)
    text.format_click_log(clicks).select(F.col("line").alias("value")).write.text(f"{w}/log")
    table = RatingTable(spark, f"{w}/out/rating_table")
    before = table.stats().first()
    assert jobs.upsert(spark, f"{w}/out/rating_table", f"{w}/log", 0)
    assert not jobs.upsert(spark, f"{w}/out/rating_table", f"{w}/log", 0)
    assert table.stats().first().total == before.total + clicks.count()
    r = spark.read.parquet(f"{w}/out/ratings")
    assert r.count() == tables.weights(spark, SF001).count()
    assert r.where(F.col("score").isNull()).count() == 0
    assert spark.read.parquet(f"{w}/out/catalog").count() == 200
    jobs.tune(spark, f"{w}/out/ratings", f"{w}/out", ranks=(2, 4), regs=(0.1,))
    assert "best:" in capsys.readouterr().out
    assert spark.read.parquet(f"{w}/out/grid").count() == 2
    jobs.similar(spark, f"{w}/out/ratings", f"{w}/out",
                 jobs.DEFAULT.with_(als_rank=8, als_iterations=3))
    lists = neighbours.Neighbours(spark, f"{w}/out/similar").lists()
    assert lists.count() > 0 and lists.agg(F.max(F.size("recs"))).first()[0] <= 100


def test_fold_and_views(spark, workdir):
    w = workdir
    sinks.write_ratings(normalize.zscore(tables.base_ratings(spark, SF001)), f"{w}/ratings")
    clicks = tables.clicks(spark, SF001)
    text.format_click_log(clicks).select(F.col("line").alias("value")).write.text(f"{w}/log")
    tables.catalog(spark, SF001).write.parquet(f"{w}/catalog")
    jobs.fold(spark, f"{w}/ratings", f"{w}/log", f"{w}/next")
    before, after = (spark.read.parquet(f"{w}/{p}") for p in ("ratings", "next/ratings"))
    total = lambda df: df.agg(F.sum("weight")).first()[0]
    assert total(after) == total(before) + clicks.count()
    sims = realtime.sequence_clicks(clicks).selectExpr("mid", "mid + 1 nb_mid", "0.5D score").distinct()
    sims.write.parquet(f"{w}/sims")
    q = stream.run_stream(spark, f"{w}/log", f"{w}/sims", f"{w}/ratings", f"{w}/recs",
                          available_now=True)
    q.awaitTermination()
    q.rejects.awaitTermination()
    jobs.views(spark, f"{w}/next/ratings", f"{w}/catalog", f"{w}/log", f"{w}/recs", f"{w}/views")
    board = spark.read.parquet(f"{w}/views/dashboard")
    assert {r[0] for r in board.select("section").distinct().collect()} >= {"history", "favourites"}
    status = spark.read.parquet(f"{w}/views/status")
    assert status.count() == clicks.select("uid").distinct().count()
    assert status.where("status != 'done'").count() == 0


def test_kafka_options_bound_a_batch():
    o = jobs.kafka_options("h:1", "t", 7)
    assert o["startingOffsets"] == "latest" and o["maxOffsetsPerTrigger"] == "7" and o["subscribe"] == "t"
