"""OP-20..23, OP-37..39, OP-07 (D10, D12, D13) on golden inputs."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01, rows
from encore.functions.sequence import sequence_within
from encore.operators import realtime
from encore.sources import tables

CLICK = "event_id long, uid int, mid int, ts long"
SIM = "mid int, nb_mid int, score double"
STORED = "uid int, mid int, weight long"


def _clicks(spark, seq_of_mids, uid=1):
    return spark.createDataFrame([(i, uid, m, 1000 + i) for i, m in enumerate(seq_of_mids)], CLICK)


def test_queue_keeps_newest_40_and_recent_20(spark):
    c = _clicks(spark, list(range(50)))
    q = [r.mid for r in realtime.recent_queue(c).orderBy("pos").collect()]
    assert q == list(range(49, 9, -1))
    r = [r.mid for r in realtime.recent_clicks(c).orderBy("pos").collect()]
    assert r == list(range(49, 29, -1))


def test_sequence_matches_row_number_on_skewed_key(spark):
    # uid 0 holds 2/3 of the rows; enough rows that range bounds come from a
    # partial sample (whose seed changes per execution).
    data = [(i, 0 if i % 3 else 1 + i % 7, i % 5, i // 2) for i in range(60000)]
    df = spark.createDataFrame(data, CLICK).repartition(8)
    got = sequence_within(df, "uid", ["ts", "event_id"], slices=4)
    w = Window.partitionBy("uid").orderBy("ts", "event_id")
    want = df.withColumn("seq", F.row_number().over(w).cast("long"))
    assert rows(got, "event_id", "seq") == rows(want, "event_id", "seq")


def test_candidates_drop_rated_and_keep_order(spark):
    c = spark.createDataFrame([(1, 7, 1, 10)], CLICK)
    sims = spark.createDataFrame([(1, 2, 0.9), (1, 3, 0.8), (1, 4, 0.8)], SIM)
    stored = spark.createDataFrame([(7, 2, 1)], STORED)
    seq = realtime.sequence_clicks(c)
    cands = realtime.click_candidates(seq, sims, realtime.rated_as_of(stored, seq))
    assert [r.cand for r in cands.orderBy("cand_rank").collect()] == [3, 4]


def test_unknown_item_gives_no_candidates(spark):
    c = spark.createDataFrame([(1, 7, 99, 10)], CLICK)
    sims = spark.createDataFrame([(1, 2, 0.9)], SIM)
    stored = spark.createDataFrame([], STORED)
    assert realtime.replay(c, sims, stored).count() == 0


def test_score_average_plus_log_bonus(spark):
    # recents [a=10, b=11] (b is the click itself); sim(c=5, a) = .8, sim(5, b) missing.
    c = spark.createDataFrame([(1, 7, 10, 1), (2, 7, 11, 2)], CLICK)
    sims = spark.createDataFrame([(11, 5, 0.9), (5, 10, 0.8)], SIM)
    out = realtime.replay(c, sims, spark.createDataFrame([], STORED))
    got = {(r.event_id, r.mid): r.score for r in out.collect()}
    assert got == {(2, 5): pytest.approx(0.4 + math.log10(2))}


def test_repeats_count(spark):
    c = spark.createDataFrame([(1, 7, 10, 1), (2, 7, 10, 2)], CLICK)
    sims = spark.createDataFrame([(10, 5, 0.9), (5, 10, 0.8)], SIM)
    out = realtime.replay(c, sims, spark.createDataFrame([], STORED)).collect()
    assert [(r.event_id, round(r.score, 9)) for r in sorted(out)] == [
        (1, round(0.8, 9)), (2, round(0.8 + math.log10(2), 9))]


def test_clicked_items_become_rated_as_of_the_click(spark):
    # user clicks 5 first, then 10 whose neighbour is 5: 5 is rated by then.
    c = spark.createDataFrame([(1, 7, 5, 1), (2, 7, 10, 2), (3, 8, 10, 3)], CLICK)
    sims = spark.createDataFrame([(10, 5, 0.9)], SIM)
    out = realtime.replay(c, sims, spark.createDataFrame([], STORED))
    assert rows(out, "event_id", "mid") == [(3, 5)]


def test_latest_list_can_be_empty(spark):
    c = spark.createDataFrame([(1, 7, 10, 1), (2, 7, 99, 2)], CLICK)
    sims = spark.createDataFrame([(10, 5, 0.9)], SIM)
    recs = realtime.replay(c, sims, spark.createDataFrame([], STORED))
    assert realtime.latest_recs(c, recs).count() == 0
    nested = realtime.latest_recs_nested(c, recs).collect()
    assert [(r.uid, r.event_id, r.recs) for r in nested] == [(7, 2, [])]


def test_latest_only_equals_all_clicks_then_latest(spark):
    from encore.plans.queries import stream_sims
    c, stored = tables.clicks(spark, SF01), tables.base_ratings(spark, SF01)
    sims = stream_sims(spark, SF01).persist()
    direct = realtime.replay(c, sims, stored, only_latest=True, round_digits=9)
    via_all = realtime.latest_recs(c, realtime.replay(c, sims, stored, round_digits=9))
    cols = ("uid", "event_id", "mid", "score", "rank")
    assert rows(direct, *cols) == rows(via_all, *cols)
    assert direct.select("uid").distinct().count() == 150
