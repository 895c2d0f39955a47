"""Stream = batch, restarts, the keyed store, log order (OP-06, 07, 29, 36, 37, 40)."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from conftest import SF01, rows
from encore.operators import realtime
from encore.operators.ratings import RatingTable
from encore.plans.queries import stream_sims
from encore.sources import neighbours, tables
from encore.sources.text import format_click_log
from encore.streaming import sink as store
from encore.streaming import stream


def _stage(spark, work, clicks, parts=3):
    lines = format_click_log(clicks).withColumn(
        "part", F.ntile(parts).over(__import__("pyspark.sql").sql.Window.orderBy("event_id")))
    for p in range(1, parts + 1):
        (lines.where(F.col("part") == p).orderBy("event_id").select(F.col("line").alias("value")).coalesce(1)
         .write.text(f"{work}/stage/{p}"))
    os.makedirs(f"{work}/in")


def _push(work, p):
    src = f"{work}/stage/{p}"
    for n in os.listdir(src):
        if n.startswith("part-"):
            os.link(os.path.join(src, n), f"{work}/in/p{p}-{n}")


def _run(*args, **kw):
    q = stream.run_stream(*args, available_now=True, **kw)
    for query in (q, q.rejects):
        query.awaitTermination()
        assert query.exception() is None


def _log(work, name, *clicks):
    os.makedirs(f"{work}/in", exist_ok=True)
    with open(f"{work}/in/{name}", "w") as f:
        f.writelines(f"x  INFO --- MUSIC_LISTENING_PREFIX:{u}|{m}|{t}\n" for u, m, t in clicks)


def _small(spark, work, pairs=((2, 3, 0.5),), stored=((9, 9, 1),)):
    neighbours.publish(spark.createDataFrame(list(pairs), "mid int, nb_mid int, score double"), f"{work}/sims")
    spark.createDataFrame(list(stored), "uid int, mid int, weight long").write.parquet(f"{work}/stored")
    return spark, f"{work}/in", f"{work}/sims", f"{work}/stored", f"{work}/out"


def test_stream_equals_batch_over_two_sessions(spark, workdir):
    w = workdir
    clicks = tables.clicks(spark, SF01)
    stream_sims(spark, SF01).write.parquet(f"{w}/sims")
    tables.base_ratings(spark, SF01).write.parquet(f"{w}/stored")
    _stage(spark, w, clicks)
    _push(w, 1)
    _push(w, 2)
    args = (f"{w}/in", f"{w}/sims", f"{w}/stored", f"{w}/out")
    _run(spark, *args, max_files_per_trigger=1)
    first = stream.stream_counts(spark, f"{w}/out").agg(F.sum("clicks")).first()[0]
    _push(w, 3)
    lagging = dict(rows(stream.stream_user_status(spark, f"{w}/out", f"{w}/in")))
    assert "waiting" in lagging.values() and "done" in lagging.values()
    other = spark.newSession()                          # nothing of the first run is known here
    _run(other, *args, max_files_per_trigger=1)
    assert stream.stream_counts(spark, f"{w}/out").agg(F.sum("clicks")).first()[0] == clicks.count() > first
    assert spark.read.parquet(f"{w}/out/rejects").count() == 0
    caught_up = stream.stream_user_status(spark, f"{w}/out", f"{w}/in")
    assert not any("/in/" in f for f in caught_up.inputFiles())          # the log is not read
    caught_up = dict(rows(caught_up))
    assert set(caught_up.values()) == {"done"} and len(caught_up) == 150

    before = sorted(tuple(r) for r in stream.latest_stream_recs(spark, f"{w}/out").collect())
    assert stream.compact_stream(spark, f"{w}/out") == stream.compact_stream(spark, f"{w}/out") == 2
    assert before == sorted(tuple(r) for r in stream.latest_stream_recs(spark, f"{w}/out").collect())
    sims, stored = spark.read.parquet(f"{w}/sims"), spark.read.parquet(f"{w}/stored")
    want = realtime.latest_recs(clicks, realtime.replay(clicks, sims, stored)).select("uid", "mid", "score", "rank")
    a = sorted(tuple(r) for r in stream.latest_stream_recs(spark, f"{w}/out")
               .select("uid", "mid", "score", "rank").collect())
    b = sorted(tuple(r) for r in want.collect())
    assert len(a) == len(b) > 0
    for x, y in zip(a, b):
        assert x[:2] == y[:2] and x[3] == y[3] and x[2] == pytest.approx(y[2], abs=1e-12)
    with pytest.raises(RuntimeError, match="belongs to the checkpoint"):
        stream.run_stream(spark, *args, checkpoint=f"{w}/elsewhere", available_now=True)


def test_a_rating_table_is_read_by_bucket_and_in_its_newest_version(spark, workdir):
    args = _small(spark, workdir, pairs=[(2, m, 0.5) for m in (3, 4, 5)])
    table = RatingTable(spark, f"{workdir}/table").create(
        spark.createDataFrame([(u, 3, 1) for u in range(100)], "uid int, mid int, weight long"))
    args = (*args[:3], f"{workdir}/table", args[4])
    _log(workdir, "a.log", (1, 2, 5))
    _run(*args)
    got = lambda: sorted(r.mid for r in stream.latest_stream_recs(spark, f"{workdir}/out").collect())
    assert got() == [4, 5]
    table.apply(spark.createDataFrame([(1, 4)], "uid int, mid int"), 0)
    _log(workdir, "b.log", (1, 2, 6))
    _run(*args)
    assert got() == [5]
    one = stream._stored(spark, f"{workdir}/table", spark.createDataFrame([(1,)], "uid int"))
    assert len(one.inputFiles()) < len(table.read().inputFiles()) / 4


def test_rejects_side_output(spark, workdir):
    args = _small(spark, workdir)
    os.makedirs(f"{workdir}/in")
    with open(f"{workdir}/in/a.log", "w") as f:
        f.write("x  INFO --- MUSIC_LISTENING_PREFIX:1|2|3\nplain INFO line\nMUSIC_LISTENING_PREFIX:1|x|3\n")
    _run(*args)
    rej = sorted(r.reason for r in spark.read.parquet(f"{workdir}/out/rejects").collect())
    assert rej == ["no_prefix", "not_an_int"]
    assert [(r.uid, r.mid, r.rank) for r in stream.latest_stream_recs(spark, f"{workdir}/out").collect()] == [(1, 3, 1)]


def test_clicks_of_one_second_keep_the_order_of_the_log(spark, workdir):
    args = _small(spark, workdir)
    _log(workdir, "a.log", (1, 9, 5), (1, 2, 5), (1, 7, 5), (2, 1, 4))
    _run(*args)
    _log(workdir, "b.log", (1, 1, 5), (2, 8, 4), (2, 3, 3))
    _run(*args)
    queues = {r.uid: (r.seq, r.queue) for r in stream.stream_queues(spark, f"{workdir}/out").collect()}
    assert queues == {1: (4, [1, 7, 2, 9]), 2: (3, [8, 3, 1])}


def test_latest_start_leaves_out_older_files(spark, workdir):
    args = _small(spark, workdir)
    _log(workdir, "old.log", (1, 2, 5))
    os.utime(f"{workdir}/in/old.log", (1_000_000_000, 1_000_000_000))
    _run(*args, start="latest")
    time.sleep(1.1)
    _log(workdir, "new.log", (2, 2, 6))
    _run(*args, start="latest")
    assert [r.uid for r in stream.stream_queues(spark, f"{workdir}/out").collect()] == [2]


def test_a_published_version_counts_from_the_next_batch_on(spark, workdir):
    args = _small(spark, workdir, pairs=[(m, m + 1000, 0.5) for m in range(200)])
    _log(workdir, "a.log", (1, 2, 5), (2, 7, 5))
    _run(*args)
    neighbours.publish(spark.createDataFrame([(2, 5, 0.9), (5, 2, 0.9)], "mid int, nb_mid int, score double"),
                       f"{workdir}/sims")
    _log(workdir, "b.log", (1, 2, 6))
    _run(*args)
    assert sorted((r.uid, r.mid) for r in stream.latest_stream_recs(spark, f"{workdir}/out").collect()) == [(1, 5), (2, 1007)]
    table = neighbours.Neighbours(spark, f"{workdir}/sims")
    assert table.refresh() == 1 and table._table is not None
    held = table._table
    table.refresh()
    assert table._table is held                          # opened once a version
    plan = table.pairs([3, 4])._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan and "IN (3,4)" in plan.replace(" ", "").replace("IN(", "IN (")


def test_a_hot_user_is_spread_over_tasks(spark):
    n = 500_000
    clicks = spark.range(n, numPartitions=8).select(
        ((F.col("id") / 10_000_000).cast("int") + 7).alias("uid"),
        (F.col("id") % 1000).cast("int").alias("mid"), (F.col("id") / 3).cast("long").alias("ts"),
        F.lit("f").alias("_file"), F.lit(0).cast("long").alias("_block"), F.col("id").alias("_line"))
    heads = spark.createDataFrame([(7, 100, [5, 6])], "uid int, seq long, queue array<int>")
    got = stream.batch_heads(clicks, heads)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Python" not in plan and "Pandas" not in plan
    r = got.first()
    assert (r.seq, r.mid, r.queue) == (n + 100, (n - 1) % 1000, [(n - 1 - i) % 1000 for i in range(40)])


def test_store_folds_itself_and_readers_see_whole_versions(spark, workdir):
    sink = store.StreamSink(spark, f"{workdir}/s", fan=3, keep=4)
    sink.open(f"{workdir}/c")
    rng, heads, counts, recs = random.Random(1), {}, {}, {}
    seen = []
    for batch in range(14):
        users = rng.sample(range(12), 4)
        for u in users:
            heads[u] = (batch + 1) * 10 + u
            counts[u, batch % 5] = counts.get((u, batch % 5), 0) + 1
            recs[u] = [(batch, k) for k in range(u % 3)]
        tables_ = {
            "heads": spark.createDataFrame([(u, heads[u] * 100, 1, heads[u], [batch]) for u in users],
                                           "uid int, event_id long, ts long, seq long, queue array<int>"),
            "recs": spark.createDataFrame([(u, heads[u] * 100, b, float(k), k) for u in users for b, k in recs[u]],
                                          "uid int, event_id long, mid int, score double, rank int"),
            "counts": spark.createDataFrame([(u, batch % 5, 1) for u in users], "uid int, mid int, clicks long"),
        }
        tables_ = {n: store.with_bucket(df) for n, df in tables_.items()}
        tables_["files"] = spark.createDataFrame([(f"f{batch}", 0)], store.TABLES["files"])
        sink.add(batch, tables_)
        sink.add(batch, tables_)                         # a retried batch changes nothing
        seen.append(sink.manifest())
    number, m = sink.manifest()
    assert len(m["parts"]) <= 2 * 3 and m["batch"] == 13
    folders = sum(len(os.listdir(f"{workdir}/s/{d}")) for d in ("parts",))
    assert folders <= 3 * 3 + 4 * 4                      # live ones and those of the last versions
    assert len(sink.versions.numbers()) <= 5
    got = {r.uid: r.seq for r in store.newest_heads(sink.table("heads")).collect()}
    assert got == heads
    total = {(r.uid, r.mid): r.n for r in sink.table("counts").groupBy("uid", "mid").agg(F.sum("clicks").alias("n")).collect()}
    assert total == counts
    old = sink.versions.read(sink.versions.numbers()[0])     # a reader that began earlier
    assert sink._read("files", old["parts"]).count() == old["batch"] + 1
    sink.fold(everything=True)
    assert len(sink.manifest()[1]["parts"]) == 1
    assert {r.uid: r.seq for r in sink.table("heads").collect()} == heads
    assert sorted((r.uid, r["rank"]) for r in sink.table("recs").collect()) == sorted(
        (u, k) for u in recs for _, k in recs[u])
    assert sink.table("files").count() == 14
    user = next(iter(heads))
    some = neighbours.buckets_in(spark.createDataFrame([(user,)], "uid int"), "uid", store.BUCKETS)
    assert len(some) == 1 and user in [r.uid for r in sink.table("heads", some).collect()]
    with pytest.raises(RuntimeError, match="is taken"):
        sink.versions.commit(sink.manifest()[0], {"folders": []})


def test_two_batches_of_the_timed_trigger(spark, workdir):
    args = _small(spark, workdir)
    _log(workdir, "a.log", (1, 2, 5))
    q = stream.run_stream(*args, keep_rejects=False)
    try:
        end = time.time() + 90
        while stream._sink(spark, f"{workdir}/out").manifest()[1]["batch"] < 0 and time.time() < end:
            time.sleep(0.5)
        _log(workdir, "b.log", (1, 4, 6))
        while stream._sink(spark, f"{workdir}/out").manifest()[1]["batch"] < 1 and time.time() < end:
            time.sleep(0.5)
    finally:
        q.stop()
    assert q.exception() is None
    assert [(r.seq, r.queue) for r in stream.stream_queues(spark, f"{workdir}/out").collect()] == [(2, [4, 2])]


def test_old_layout_is_refused(spark, workdir):
    os.makedirs(f"{workdir}/s/heads")
    with pytest.raises(RuntimeError, match="layout 1"):
        store.StreamSink(spark, f"{workdir}/s").manifest()


def test_kafka_needs_its_connector(spark):
    with pytest.raises(AnalysisException) as e:       # the connector jar is not installed here
        stream.click_lines(spark, None, fmt="kafka",
                           options={"kafka.bootstrap.servers": "localhost:1", "subscribe": "t"})
    assert "kafka" in str(e.value).lower() and "STRUCTURED_STREAMING_KAFKA" in str(e.value).upper().replace(" ", "_") \
        or "Failed to find data source: kafka" in str(e.value) or e.value.getCondition() == "DATA_SOURCE_NOT_FOUND"
