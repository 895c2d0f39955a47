"""What travels for the similar items (F10 to F19) and the candidates (F1, F9)."""

import glob

import numpy as np
from pyspark.sql import functions as F

from conftest import rows
from encore.operators import realtime, similarity
from encore.session import scratch_paths

VEC = "mid int, v array<double>"


def _vectors(spark, n, dim, seed):
    m = np.random.default_rng(seed).normal(size=(n, dim))
    return spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(m)], VEC)


def test_an_item_leaves_its_best_rows_whatever_the_number_of_tiles(spark):
    v = _vectors(spark, 400, 3, 2)
    for tile_rows in (400, 100, 20):
        pairs = similarity.cosine_pairs(v, -0.9, 5, round_digits=9, tile_rows=tile_rows)
        assert pairs.groupBy("mid").count().agg(F.max("count")).first()[0] == 5


def test_vectors_are_written_once(spark):
    v = _vectors(spark, 300, 8, 3)
    before = set(scratch_paths(spark))
    similarity.cosine_pairs(v, 0.2, 5, tile_rows=10)
    made = [p for p in scratch_paths(spark) if p not in before and "/tiles-" in p]
    packed = spark.read.parquet(*made)
    assert packed.select(F.sum(F.length("ids"))).first()[0] == 300 * 8
    assert packed.select(F.sum(F.length("unit"))).first()[0] == 300 * 8 * 8
    assert len(glob.glob(made[0].removeprefix("file:") + "/*.parquet")) <= packed.count()


def test_kernel_merges_many_tiles_and_ties():
    rng = np.random.default_rng(7)
    m = np.repeat(rng.normal(size=(60, 4)), 5, axis=0)          # every vector five times
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    ids = np.arange(300, dtype=np.int64)
    import pandas as pd

    def frames():
        for i in range(0, 300, 30):
            yield pd.DataFrame([(0, 1, ids.tobytes(), m.tobytes(), ids[i:i + 30].tobytes(), m[i:i + 30].tobytes())])
    for k in (1, 4, 25):
        got = pd.concat(list(similarity._kernel(0.1, k, 6, 3)(frames())))
        s = np.floor(np.abs(m @ m.T) * 1e6 + 0.5) / 1e6 * np.sign(m @ m.T)
        want = []
        for a in range(1, 300, 3):
            best = sorted((-s[a, b], b) for b in range(300) if b != a and s[a, b] > 0.1)[:k]
            want += [(a, b) for _, b in best]
        assert sorted(zip(got["mid"], got["nb_mid"])) == sorted(want)


def _clicks(spark):
    rng = np.random.default_rng(11)
    t = [(i, int(rng.integers(0, 6)), int(rng.integers(0, 12)), i + 1) for i in range(120)]
    t += [(119, 3, t[119][2] + 1, 500), (None, 1, 2, 400), (None, 2, 3, 400)]      # repeated and missing ids
    targets = spark.createDataFrame(t, "event_id long, uid int, mid int, seq long")
    sims = spark.createDataFrame([(m, b, float((m * 7 + b * 3) % 10) / 10) for m in range(11) for b in range(40)],
                                 "mid int, nb_mid int, score double")
    rated = spark.createDataFrame([(u, m, int(rng.integers(0, 150))) for u in range(5) for m in range(0, 40, 1 + u)]
                                  + [(1, None, 0)], "uid int, mid int, from_seq long")
    return targets, sims, rated


def test_candidates_are_the_same_for_light_and_heavy_users(spark):
    targets, sims, rated = _clicks(spark)
    out = [sorted(map(str, rows_)) for rows_ in (
        realtime.click_candidates(targets, sims, rated, 7, light=x).collect() for x in (0, 15, 1000))]
    assert out[0] == out[1] == out[2] and len(out[0]) > 200


def test_candidates_move_few_rows_and_no_click_side_is_broadcast(spark):
    targets, sims, rated = _clicks(spark)
    cands = realtime.click_candidates(targets, sims, rated, 7)
    p = cands._jdf.queryExecution().executedPlan().toString()
    assert "array_contains" in p and "BroadcastHashJoin" not in p
    recent = realtime.recent_rows(targets, 5)
    p = recent._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in p and "BroadcastHashJoin" not in p
    assert rows(recent.groupBy("r_pos").count(), "r_pos")[0] == (1,)
