"""OP-24..29, OP-41 on golden inputs."""

from conftest import rows
from encore.operators import serving

CLICK = "event_id long, uid int, mid int, ts long"
STORED = "uid int, mid int, weight long"
CAT = "mid int, name string, url string"


def test_click_upsert(spark):
    stored = spark.createDataFrame([(1, 2, 5)], STORED)
    clicks = spark.createDataFrame([(1, 1, 2, 1), (2, 1, 2, 2), (3, 1, 3, 3)], CLICK)
    assert rows(serving.apply_clicks(stored, clicks)) == [(1, 2, 7), (1, 3, 1)]


def test_favourites_order(spark):
    r = spark.createDataFrame([(1, 12, 7), (1, 13, 9), (1, 14, 7)], STORED)
    got = serving.favourite_items(r).orderBy("pos").collect()
    assert [x.mid for x in got] == [13, 12, 14]


def test_history_distinct_newest_first(spark):
    # newest first: 5, 6, 5, 7
    c = spark.createDataFrame([(1, 1, 7, 1), (2, 1, 5, 2), (3, 1, 6, 3), (4, 1, 5, 4)], CLICK)
    got = serving.history_items(c).orderBy("pos").collect()
    assert [x.mid for x in got] == [5, 6, 7]


def test_recs_orders(spark):
    stored = spark.createDataFrame([(1, 9, 7, 0.9, 1), (1, 9, 12, 0.5, 2)],
                                   "uid int, event_id long, mid int, score double, rank int")
    by_score = [r.mid for r in serving.rec_items(stored).orderBy("pos").collect()]
    by_mid = [r.mid for r in serving.rec_items(stored, order="mid_desc").orderBy("pos").collect()]
    assert by_score == [7, 12] and by_mid == [12, 7]


def test_enrichment_keeps_order_duplicates_and_defaults(spark):
    items = spark.createDataFrame([(1, 1, 3), (1, 2, 9), (1, 3, 3)], "uid int, pos int, mid int")
    cat = spark.createDataFrame([(3, "three", "/item/3")], CAT)
    r = spark.createDataFrame([(1, 3, 4)], STORED)
    assert rows(serving.enrich_items(items, cat, r)) == [
        (1, 1, 3, "three", "/item/3", 4), (1, 3, 3, "three", "/item/3", 4)]
    none = spark.createDataFrame([], STORED)
    assert [x.clicks for x in serving.enrich_items(items, cat, none).collect()] == [0, 0]


def test_status(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "uid int")
    clicks = spark.createDataFrame([(10, 2, 1, 1), (11, 3, 1, 1), (12, 3, 1, 2)], CLICK)
    heads = spark.createDataFrame([(2, 10), (3, 11)], "uid int, event_id long")
    got = dict(rows(serving.user_status(users, clicks, heads)))
    assert got == {1: "waiting", 2: "done", 3: "waiting"}


def test_dashboard_sections(spark):
    cat = spark.createDataFrame([(3, "three", "/item/3")], CAT)
    r = spark.createDataFrame([(1, 3, 4)], STORED)
    items = spark.createDataFrame([(1, 1, 3)], "uid int, pos int, mid int")
    e = serving.enrich_items(items, cat, r)
    d = serving.user_dashboard(e, e, e)
    assert sorted(x.section for x in d.collect()) == ["favourites", "history", "recommendations"]
