"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
over the whole given tables.  Names follow SURVEY §2 (``T:`` column).

Only these wrappers round floating results (similarity to 6 digits before
threshold and rank, scores and errors to 9) so that a second engine can be
compared value by value; the library defaults stay unrounded.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from encore.config import DEFAULT
from encore.operators import factors, normalize, ratings, realtime, serving, similarity
from encore.schemas import CATALOG_ITEM
from encore.session import materialize, scratch_path
from encore.sources import neighbours, sinks, tables, text
from encore.streaming import stream

SIM_DIGITS = 6
SCORE_DIGITS = 9
# The click ids (0-99) and the item vectors share an id space; vectors of
# this data are far apart, so the stream side keeps cosines above 0.1.
STREAM_SIM_THRESHOLD = 0.1


# -- shared inputs -----------------------------------------------------------

def zscored(spark, d):
    # The rating table the loader stores: derived from a join, read twice by
    # the z-score (statistics, then scores), so written once first.
    return normalize.zscore(materialize(tables.weights(spark, d)))


def stream_sims(spark, d, k=DEFAULT):
    # The offline job's output: written once (checkpoint folder) and then read
    # by every branch that looks up candidates or similarities.
    return materialize(similarity.item_similarity(tables.item_vectors(spark, d),
                                                  STREAM_SIM_THRESHOLD, k.top_k_similar,
                                                  round_digits=SIM_DIGITS))


def all_click_recs(spark, d, k=DEFAULT):
    return realtime.replay(tables.clicks(spark, d), stream_sims(spark, d, k),
                           tables.base_ratings(spark, d), k, round_digits=SCORE_DIGITS)


def latest_long(spark, d, k=DEFAULT):
    recs = realtime.replay(tables.clicks(spark, d), stream_sims(spark, d, k),
                           tables.base_ratings(spark, d), k, only_latest=True,
                           round_digits=SCORE_DIGITS)
    return recs.select("uid", "event_id", "mid", "score", "rank")


def ratings_now(spark, d):
    return serving.apply_clicks(tables.base_ratings(spark, d), tables.clicks(spark, d))


# -- sources and sinks -------------------------------------------------------

def q_parse_interactions(spark, d):
    rows, _ = text.parse_interactions(text.interaction_lines(tables.weights(spark, d)))
    return rows


def q_parse_catalog(spark, d):
    rows, _ = text.parse_catalog(text.catalog_lines(tables.catalog(spark, d)))
    return rows


def q_catalog_projection(spark, d):
    rows, _ = text.parse_catalog(text.catalog_lines(tables.catalog(spark, d)))
    return spark.sql("SELECT mid, name, url FROM {items}", items=rows)


def q_stored_ratings_roundtrip(spark, d):
    path = scratch_path(spark, "ratings")
    sinks.write_ratings(zscored(spark, d), path)
    return sinks.read_ratings(spark, path)


def q_stored_table_roundtrip(spark, d):
    """OP-03: a table is replaced by the next write, rows and columns."""
    path = scratch_path(spark, "catalog")
    sinks.write_table(tables.base_ratings(spark, d), path)
    sinks.write_table(tables.catalog(spark, d), path)
    return tables.read_table(spark, path.rsplit("/", 1)[0], path.rsplit("/", 1)[1], CATALOG_ITEM, suffix="")


def q_format_click_log(spark, d):
    return text.format_click_log(tables.clicks(spark, d))


def q_parse_click_log(spark, d):
    rows, _ = text.parse_click_log(tables.event_log_lines(spark, d, DEFAULT.click_prefix),
                                   keep=("event_id",))
    return rows


def q_click_log_rejects(spark, d):
    _, rejects = text.parse_click_log(tables.event_log_lines(spark, d, DEFAULT.click_prefix),
                                      keep=("event_id",))
    return rejects


# -- statistics ---------------------------------------------------------------

def q_weight_stats(spark, d):
    return normalize.weight_stats(tables.weights(spark, d))


def q_zscore_ratings(spark, d):
    return zscored(spark, d)


def q_train_test_split(spark, d):
    return factors.split_ratings(zscored(spark, d)).select("uid", "mid", "score", "split")


def q_rmse_baseline(spark, d):
    """OP-16 on given predictions: each item's mean training score."""
    train, test = factors.train_test(zscored(spark, d))
    pred = train.groupBy("mid").agg(F.avg("score").alias("prediction"))
    pairs = test.select("uid", "mid").join(pred, "mid")
    r = factors.rmse(test, pairs)
    return r.select("n", F.round("rmse", SCORE_DIGITS).alias("rmse"))


# -- similarity ----------------------------------------------------------------

def q_item_cosine_pairs(spark, d):
    return similarity.cosine_pairs(tables.item_vectors(spark, d), DEFAULT.sim_threshold,
                                   top_k=None, round_digits=SIM_DIGITS)


def q_similar_items(spark, d):
    return similarity.item_similarity(tables.item_vectors(spark, d), DEFAULT.sim_threshold,
                                      DEFAULT.top_k_similar, round_digits=SIM_DIGITS)


def q_item_neighbours_nested(spark, d):
    long = similarity.item_similarity(tables.item_vectors(spark, d), DEFAULT.sim_threshold,
                                      DEFAULT.top_k_similar, round_digits=SIM_DIGITS)
    nested = similarity.nest_neighbours(long)
    return nested.select("mid", F.posexplode("recs").alias("pos", "r")).select(
        "mid", (F.col("pos") + 1).cast("int").alias("pos"),
        F.col("r.mid").alias("nb_mid"), F.col("r.score").alias("score"))


# -- click stream, replayed in batch -----------------------------------------

def q_recent_queue(spark, d):
    return realtime.recent_queue(tables.clicks(spark, d))


def q_recent_clicks(spark, d):
    return realtime.recent_clicks(tables.clicks(spark, d))


def q_click_candidates(spark, d):
    clicks = tables.clicks(spark, d)
    seq = materialize(realtime.sequence_clicks(clicks))
    rated = realtime.rated_as_of(tables.base_ratings(spark, d), seq)
    c = realtime.click_candidates(seq, stream_sims(spark, d), rated)
    return c.select("event_id", "uid", F.col("cand").alias("mid"), "sim",
                    F.col("cand_rank").cast("int").alias("cand_rank"))


def q_realtime_scores(spark, d):
    r = realtime.replay(tables.clicks(spark, d), stream_sims(spark, d),
                        tables.base_ratings(spark, d), only_latest=True,
                        round_digits=SCORE_DIGITS)
    return r.select("uid", "event_id", "mid", "score", "rank")


def q_realtime_recs_all_clicks(spark, d):
    return all_click_recs(spark, d).select("event_id", "uid", "mid", "score", "rank")


def q_realtime_recs_latest(spark, d):
    return latest_long(spark, d)


def _streamed(spark, d, slices):
    """The Structured Streaming path over the click log: it arrives as text in
    slices of time, each consumed by a restarted stream that goes on from the
    store and its checkpoint; the similar-item table is published anew before
    the last.  The folder of the store."""
    base = scratch_path(spark, "stream")
    sims = stream_sims(spark, d)
    sinks.write_ratings(tables.base_ratings(spark, d), f"{base}/stored")   # uid-clustered
    clicks = tables.clicks(spark, d)
    cuts = clicks.agg(F.percentile_approx("ts", [i / slices for i in range(1, slices)]).alias("c")).first()["c"]
    for i in range(slices):
        if i in (0, slices - 1):
            neighbours.publish(sims, f"{base}/similar")
        part = clicks
        if cuts:
            part = part.where(F.col("ts") > cuts[i - 1]) if i else part
            part = part.where(F.col("ts") <= cuts[i]) if i < slices - 1 else part
        # the log is written in the order of the clicks
        (text.format_click_log(part.orderBy("ts", "event_id")).select(F.col("line").alias("value"))
         .write.mode("append").text(f"{base}/in"))
        q = stream.run_stream(spark, f"{base}/in", f"{base}/similar", f"{base}/stored", f"{base}/out",
                              available_now=True, round_digits=SCORE_DIGITS)
        for query in (q, q.rejects):
            if query is not None:
                query.awaitTermination()
                if query.exception() is not None:
                    raise RuntimeError(str(query.exception()))
    return f"{base}/out"


def q_stream_recs_latest(spark, d):
    """Each user's current list after three restarted slices.  Must equal the
    batch replay (``realtime_recs_latest``); stream click ids are synthetic, so
    the comparison leaves ``event_id`` out."""
    return stream.latest_stream_recs(spark, _streamed(spark, d, 3)).select("uid", "mid", "score", "rank")


def q_stream_queue(spark, d):
    """OP-37 as the stream keeps it, over two slices; equals ``recent_queue``."""
    queues = stream.stream_queues(spark, _streamed(spark, d, 2))
    return queues.select("uid", F.posexplode("queue").alias("pos", "mid")).select(
        "uid", (F.col("pos") + 1).cast("int").alias("pos"), "mid")


def _upserted(spark, d):
    """The rating table after three batches of clicks, one of which came twice."""
    table = ratings.RatingTable(spark, scratch_path(spark, "ratings")).create(tables.base_ratings(spark, d))
    clicks = tables.clicks(spark, d)
    cuts = clicks.agg(F.percentile_approx("ts", [1 / 3, 2 / 3]).alias("c")).first()["c"] or [0, 0]
    late = F.when(F.col("ts") <= cuts[0], 0).when(F.col("ts") <= cuts[1], 1).otherwise(2)
    for batch in (0, 1, 1, 2):
        table.apply(clicks.where(late == batch), batch)
    return table


def q_ratings_after_clicks(spark, d):
    """OP-28 bucket by bucket; equals one upsert of all clicks."""
    return _upserted(spark, d).read()


def q_weight_stats_after_clicks(spark, d):
    """OP-14 from the sums kept beside the table, without a scan of it."""
    return _upserted(spark, d).stats()


def q_clicked_ratings(spark, d):
    """OP-13 by ``(uid, mid)``: the stored weight of every clicked pair."""
    table = ratings.RatingTable(spark, scratch_path(spark, "ratings")).create(tables.base_ratings(spark, d))
    return table.of_pairs(tables.clicks(spark, d).select("uid", "mid").distinct())


# -- per-user views -------------------------------------------------------------

def q_enrich_items(spark, d):
    items = realtime.recent_clicks(tables.clicks(spark, d), DEFAULT.history_n)
    return serving.enrich_items(items, tables.catalog(spark, d), ratings_now(spark, d))


def q_user_history(spark, d):
    return serving.user_history(tables.clicks(spark, d), tables.catalog(spark, d),
                                ratings_now(spark, d))


def q_user_favourites(spark, d):
    return serving.user_favourites(ratings_now(spark, d), tables.catalog(spark, d))


def q_user_recs_by_score(spark, d):
    return serving.user_recs(latest_long(spark, d), tables.catalog(spark, d),
                             ratings_now(spark, d), order="score")


def q_user_recs_by_mid(spark, d):
    return serving.user_recs(latest_long(spark, d), tables.catalog(spark, d),
                             ratings_now(spark, d), order="mid_desc")


def q_user_status(spark, d):
    clicks = tables.clicks(spark, d)
    users = tables.base_ratings(spark, d).select("uid").unionByName(clicks.select("uid"))
    # lists stored when the log was at its middle second: later clickers wait
    middle = clicks.agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    scored = clicks.join(F.broadcast(middle), F.col("ts") <= F.expr("a + (b - a) DIV 2")).select(clicks.columns)
    heads = realtime.latest_clicks(scored).select("uid", "event_id")
    return serving.user_status(users, clicks, heads)


def q_user_dashboard(spark, d):
    # The current ratings feed all three enrichments and the favourites: write once.
    clicks, cat = tables.clicks(spark, d), tables.catalog(spark, d)
    rn = materialize(ratings_now(spark, d))
    return serving.user_dashboard(serving.user_history(clicks, cat, rn),
                                  serving.user_recs(latest_long(spark, d), cat, rn),
                                  serving.user_favourites(rn, cat))


# -- factorisation (no SQL oracle: iterative solver) -------------------------

def q_als_item_factors(spark, d):
    m = factors.fit_factors(zscored(spark, d))
    return factors.item_factors(m)


def q_als_similar_items(spark, d):
    """The offline job as the original runs it: z-scores -> ALS (rank 100,
    5 iterations, reg 0.1) -> item factors -> cosine > 0.4 -> top 100."""
    m = factors.fit_factors(zscored(spark, d))
    return similarity.item_similarity(factors.item_factors(m), DEFAULT.sim_threshold,
                                      DEFAULT.top_k_similar)


def q_als_rmse(spark, d):
    train, test = factors.train_test(zscored(spark, d))
    return factors.model_rmse(factors.fit_factors(train), test)


def q_als_grid(spark, d):
    """Every point of the grid with the number of pairs its error is over."""
    train, test = factors.train_test(materialize(zscored(spark, d)))
    grid = factors.grid_search(train, test)
    return grid.select("rank", "reg", "n", (F.col("rmse") > 0).alias("has_rmse"))


def q_als_grid_best(spark, d):
    train, test = factors.train_test(zscored(spark, d))
    return factors.best_config(factors.grid_search(train, test))


def q_best_config(spark, d):
    """OP-17 on errors read from a table: the mean quantity of each
    (line number, discount) stands for a grid point's error."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet")
    grid = lines.groupBy(F.col("l_linenumber").cast("int").alias("rank"),
                         F.col("l_discount").alias("reg")).agg(F.avg("l_quantity").alias("rmse"))
    return factors.best_config(grid)


def q_als_factor_shape(spark, d):
    """OP-30/31: every item with a training score has a factor of the rank."""
    v = factors.item_factors(factors.fit_factors(zscored(spark, d)))
    return v.select("mid", F.size("v").alias("dim"))


def q_als_test_pairs(spark, d):
    """OP-16/32: the test pairs that get a prediction (user and item trained),
    and whether each prediction is the product of the exported factors."""
    train, test = factors.train_test(materialize(zscored(spark, d)))
    model = factors.fit_factors(train)
    gap = F.abs(F.col("prediction") - F.col("product"))
    agreed = lambda part: factors.with_products(model, factors.predict_pairs(model, part)).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(gap <= 1e-4).alias("n_agree"))
    parts = factors.slices(test.where(F.col("score").isNotNull()), 2 * model.rank)     # each vector is joined twice
    if len(parts) == 1:
        return agreed(parts[0])
    return factors.one_by_one(agreed, parts, "n long, n_agree long").agg(F.sum("n").alias("n"), F.sum("n_agree").alias("n_agree"))


QUERIES = {
    "parse_interactions": q_parse_interactions,
    "parse_catalog": q_parse_catalog,
    "catalog_projection": q_catalog_projection,
    "stored_ratings_roundtrip": q_stored_ratings_roundtrip,
    "stored_table_roundtrip": q_stored_table_roundtrip,
    "format_click_log": q_format_click_log,
    "parse_click_log": q_parse_click_log,
    "click_log_rejects": q_click_log_rejects,
    "weight_stats": q_weight_stats,
    "zscore_ratings": q_zscore_ratings,
    "train_test_split": q_train_test_split,
    "rmse_baseline": q_rmse_baseline,
    "item_cosine_pairs": q_item_cosine_pairs,
    "similar_items": q_similar_items,
    "item_neighbours_nested": q_item_neighbours_nested,
    "recent_queue": q_recent_queue,
    "recent_clicks": q_recent_clicks,
    "click_candidates": q_click_candidates,
    "realtime_scores": q_realtime_scores,
    "realtime_recs_all_clicks": q_realtime_recs_all_clicks,
    "realtime_recs_latest": q_realtime_recs_latest,
    "stream_recs_latest": q_stream_recs_latest,
    "stream_queue": q_stream_queue,
    "ratings_after_clicks": q_ratings_after_clicks,
    "weight_stats_after_clicks": q_weight_stats_after_clicks,
    "clicked_ratings": q_clicked_ratings,
    "enrich_items": q_enrich_items,
    "user_history": q_user_history,
    "user_favourites": q_user_favourites,
    "user_recs_by_score": q_user_recs_by_score,
    "user_recs_by_mid": q_user_recs_by_mid,
    "user_status": q_user_status,
    "user_dashboard": q_user_dashboard,
    "als_item_factors": q_als_item_factors,
    "als_similar_items": q_als_similar_items,
    "als_rmse": q_als_rmse,
    "als_grid": q_als_grid,
    "als_grid_best": q_als_grid_best,
    "best_config": q_best_config,
    "als_factor_shape": q_als_factor_shape,
    "als_test_pairs": q_als_test_pairs,
}
