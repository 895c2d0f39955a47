"""Counts recorded in FIXTURES.md from independent probes at sf0.01, with the
click-side similarity built over the vectors whose ids match the click id
range (vec_id < 100) and threshold 0.1.  (Registered queries use the whole
embeddings table; this fixture exists to compare with those probes.)"""

from pyspark.sql import functions as F

from conftest import SF01
from encore.operators import realtime, serving, similarity
from encore.sources import tables


def test_probe_counts_sf001(spark):
    vecs = tables.item_vectors(spark, SF01).where(F.col("mid") < 100)
    sims = similarity.item_similarity(vecs, 0.1, 100, round_digits=6).persist()
    assert sims.count() == 2074
    clicks, stored = tables.clicks(spark, SF01), tables.base_ratings(spark, SF01)
    assert clicks.count() == 2006 and stored.count() == 1856
    assert realtime.recent_clicks(clicks).count() == 1999
    all_recs = realtime.replay(clicks, sims, stored, round_digits=9).persist()
    assert all_recs.count() == 33373
    latest = realtime.latest_recs(clicks, all_recs)
    assert latest.count() == 2386 and latest.select("uid").distinct().count() == 150
    lo, hi = latest.agg(F.min("score"), F.max("score")).first()
    assert 0.52 <= lo and hi <= 1.42
    now = serving.apply_clicks(stored, clicks)
    assert now.count() == 3502
    assert serving.favourite_items(now).count() == 2929
    assert serving.history_items(clicks).count() == 1871
