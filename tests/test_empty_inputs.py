"""Empty inputs give empty outputs (D2), nothing raises."""

from encore.operators import realtime, serving, similarity
from encore.operators.normalize import weight_stats, zscore
from encore.sources.text import parse_click_log, parse_interactions

CLICK = "event_id long, uid int, mid int, ts long"
SIM = "mid int, nb_mid int, score double"
STORED = "uid int, mid int, weight long"


def test_empty_everywhere(spark):
    e = lambda schema: spark.createDataFrame([], schema)
    s = weight_stats(e(STORED)).first()
    assert s.n == 0 and s.mean is None and s.std is None
    assert zscore(e(STORED)).count() == 0
    assert similarity.item_similarity(e("mid int, v array<double>")).count() == 0
    clicks, sims, stored = e(CLICK), e(SIM), e(STORED)
    assert realtime.replay(clicks, sims, stored).count() == 0
    assert realtime.recent_queue(clicks).count() == 0
    assert serving.apply_clicks(stored, clicks).count() == 0
    assert serving.user_favourites(stored, e("mid int, name string, url string")).count() == 0
    ok, bad = parse_interactions(e("value string"))
    assert ok.count() == 0 and bad.count() == 0
    ok, bad = parse_click_log(e("value string"))
    assert ok.count() == 0 and bad.count() == 0
