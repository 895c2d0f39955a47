"""OP-14 / OP-15 (D1, D2)."""

import math

from hypothesis import given, settings, strategies as st

from conftest import SF01
from encore.operators.normalize import weight_stats, zscore
from encore.sources import tables


def _w(spark, ws):
    return spark.createDataFrame([(i, i, w) for i, w in enumerate(ws)], "uid int, mid int, weight long")


def test_golden_stats_and_scores(spark):
    df = _w(spark, [1, 2, 4, 10])
    s = weight_stats(df).first()
    assert (s.n, s.total, s.mean, s.std) == (4, 17, 4, 3.5)
    got = [r.score for r in zscore(df).orderBy("uid").collect()]
    assert [round(x, 9) for x in got] == [-0.857142857, -0.571428571, 0.0, 1.714285714]


def test_zero_std_gives_null(spark):
    got = zscore(_w(spark, [5, 5])).collect()
    assert [r.score for r in got] == [None, None]


def test_truncation_toward_zero(spark):
    s = weight_stats(_w(spark, [-7, 0])).first()
    assert s.mean == -3


def test_driver_weights_sf001(spark):
    s = weight_stats(tables.weights(spark, SF01)).first()
    assert (s.n, s.mean) == (59391, 25)
    assert abs(s.std - 14.753094113682074) < 1e-12


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 10_000), min_size=2, max_size=30))
def test_scores_order_like_weights(spark, ws):
    out = zscore(_w(spark, ws)).orderBy("uid").collect()
    n, mean = len(ws), int(sum(ws) / len(ws))
    std = math.sqrt(sum((w - mean) ** 2 for w in ws) / n)
    for r in out:
        if std == 0:
            assert r.score is None
        else:
            assert abs(r.score - (r.weight - mean) / std) < 1e-9
