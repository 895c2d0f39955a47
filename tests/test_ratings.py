"""The rating table: upserts bucket by bucket, kept statistics, key lookups."""

import os
import random

import pytest

from encore.operators import normalize, serving
from encore.operators.ratings import RatingTable


def rated(spark, seed, users=200, n=1500):
    rng = random.Random(seed)
    pairs = {(rng.randrange(users), rng.randrange(60)): rng.randint(1, 90) for _ in range(n)}
    return spark.createDataFrame([(u, m, w) for (u, m), w in pairs.items()], "uid int, mid int, weight long")


def clicked(spark, seed, users, n=300):
    rng = random.Random(seed)
    return spark.createDataFrame([(i, rng.choice(users), rng.randrange(80), i) for i in range(n)],
                                 "event_id long, uid int, mid int, ts long")


def as_set(df):
    return sorted(tuple(r) for r in df.select("uid", "mid", "weight").collect())


def test_batches_equal_one_upsert_and_repeat_without_effect(spark, workdir):
    base = rated(spark, 1)
    table = RatingTable(spark, f"{workdir}/t", buckets=8).create(base)
    assert as_set(table.read()) == as_set(base)
    all_clicks = None
    for batch in range(3):
        clicks = clicked(spark, 10 + batch, users=list(range(batch * 40, batch * 40 + 300, 7)))
        all_clicks = clicks if all_clicks is None else all_clicks.unionByName(clicks)
        assert table.apply(clicks, batch) and not table.apply(clicks, batch)
    want = serving.apply_clicks(base, all_clicks)
    again = RatingTable(spark, f"{workdir}/t")               # another process: buckets come from the manifest
    assert again.buckets == 8 and as_set(again.read()) == as_set(want)
    kept, counted = again.stats().first(), normalize.weight_stats(want).first()
    assert (kept.n, kept.total, kept["mean"]) == (counted.n, counted.total, counted["mean"])
    assert kept["std"] == pytest.approx(counted["std"], abs=1e-12)
    assert not any("/t/v" in f for f in again.stats().inputFiles())
    scores = {(r.uid, r.mid): r.score for r in normalize.zscore(want).collect()}
    assert all(scores[r.uid, r.mid] == pytest.approx(r.score, abs=1e-12) for r in again.scored().collect())


def test_a_batch_rewrites_its_buckets_only(spark, workdir):
    table = RatingTable(spark, f"{workdir}/t", buckets=16).create(rated(spark, 2))
    before = table.versions.latest()[1]["buckets"]
    clicks = spark.createDataFrame([(0, 5, 3, 0), (1, 5, 3, 1), (2, 5, 999, 2)], "event_id long, uid int, mid int, ts long")
    table.apply(clicks, 7)
    after = table.versions.latest()[1]["buckets"]
    assert sum(before.get(k) != v for k, v in after.items()) == 1
    held = {(r.uid, r.mid): r.weight for r in table.of_users(clicks.select("uid")).collect()}
    assert held[5, 999] == 1 and {u for u, _ in held} == {5}


def test_lookups_read_only_what_they_need(spark, workdir):
    table = RatingTable(spark, f"{workdir}/t", buckets=16).create(rated(spark, 3))
    files = len(table.read().inputFiles())
    one = spark.createDataFrame([(5,)], "uid int")
    assert 0 < len(table.of_users(one).inputFiles()) < files / 4
    pairs = spark.createDataFrame([(5, m) for m in range(60)] + [(100_000, 1)], "uid int, mid int")
    got = {(r.uid, r.mid): r.weight for r in table.of_pairs(pairs).collect()}
    want = {(r.uid, r.mid): r.weight for r in table.read().collect()}
    assert got == {p: want.get(p) for p in got} and len(got) == 61
    items = table.of_items([3, 7])
    assert {r.mid for r in items.collect()} == {3, 7}
    plan = items._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(mid, [3,7])]" in plan


def test_empty_table_and_crashed_writer(spark, workdir):
    table = RatingTable(spark, f"{workdir}/t", buckets=4).create(rated(spark, 4).limit(0))
    assert table.read().count() == 0 and table.stats().first().n == 0
    # a writer that died after its data and before its manifest leaves no trace
    os.makedirs(f"{workdir}/t/v1/bucket=0")
    clicks = clicked(spark, 5, users=[1, 2, 3], n=10)
    assert table.apply(clicks, 0)
    assert table.stats().first().total == 10 and sum(r.weight for r in table.read().collect()) == 10
