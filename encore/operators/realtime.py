"""Real-time re-ranking, set-wise: recent queue (OP-37/38), candidates with
the rated set removed (OP-20/22), similarity lookup and score (OP-21/23),
and the per-click replay (OP-39).

Each click ``c`` of user ``u`` is scored as of that click (D13): the recent
list is u's newest ``recent_k`` clicks up to and including ``c``; the rated
set is u's stored ratings plus u's clicks up to and including ``c``.  The
same functions serve the batch replay and each streaming micro-batch.

Shapes used throughout:
  clicks   ``(event_id, uid, mid, ts)``, ordered per user by ``(ts, event_id)``
  seq      clicks plus ``seq``: 1-based position in the user's click order
  sims     ``(mid, nb_mid, score, ...)``: each item's truncated neighbour list
  rated    ``(uid, mid, from_seq)``: pair counts as rated for clicks with
           ``seq >= from_seq`` (stored ratings have ``from_seq = 0``)
  recents  ``(event_id, uid, r_mid, r_pos)``: r_pos 1 is the newest
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.config import DEFAULT
from encore.functions.sequence import sequence_within
from encore.session import materialize as write_once

CLICK_ORDER = ["ts", "event_id"]


def sequence_clicks(clicks: DataFrame) -> DataFrame:
    """Add ``seq`` per user (skew-safe, see ``sequence_within``)."""
    return sequence_within(clicks, "uid", CLICK_ORDER)


def latest_clicks(clicks: DataFrame) -> DataFrame:
    """The last click of each user: one partial aggregation, no window."""
    last = clicks.groupBy("uid").agg(F.max(F.struct(*CLICK_ORDER, *[
        c for c in clicks.columns if c not in ("uid", *CLICK_ORDER)])).alias("_l"))
    return last.select("uid", "_l.*").select(*clicks.columns)


def recent_rows(seq: DataFrame, k: int = DEFAULT.recent_k, targets: DataFrame | None = None) -> DataFrame:
    """OP-38 as of each target click: clicks of the same user with
    ``seq`` in ``(s - k, s]``.  Each click is fanned out to the ``k`` later
    positions it is recent for and matched on ``(uid, seq)``, a unique key,
    so a heavy user's rows spread over all tasks.  With ``targets`` (say,
    each user's last click) only clicks within ``k`` positions of some
    target of the user are fanned out."""
    src = seq.select("uid", "seq", "mid")
    if targets is not None:
        lo = targets.groupBy("uid").agg((F.min("seq") - k).alias("_lo"),
                                        F.max("seq").alias("_hi"))
        src = (src.join(lo, "uid")
               .where((F.col("seq") > F.col("_lo")) & (F.col("seq") <= F.col("_hi")))
               .drop("_lo", "_hi"))
    fan = (src.select("uid", F.col("seq").alias("_src"), F.col("mid").alias("r_mid"))
           .withColumn("_d", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
           .withColumn("seq", F.col("_src") + F.col("_d")))
    tgt = (targets if targets is not None else seq).select("event_id", "uid", "seq")
    # both sides grow with the clicks: never a broadcast, whatever their files weigh
    return tgt.join(fan.hint("merge"), ["uid", "seq"]).select(
        "event_id", "uid", "r_mid", (F.col("_d") + 1).cast("int").alias("r_pos"))


def rated_as_of(stored: DataFrame, seq: DataFrame) -> DataFrame:
    """``(uid, mid, from_seq)``: stored ratings from the start, clicked items
    from the user's first click on them (the click upsert, OP-28)."""
    first = seq.groupBy("uid", "mid").agg(F.min("seq").alias("from_seq"))
    base = stored.select("uid", "mid", F.lit(0).cast("bigint").alias("from_seq"))
    return (base.unionByName(first).groupBy("uid", "mid")
            .agg(F.min("from_seq").alias("from_seq")))


LIGHT = 200              # rated items of a user that travel with a click


def click_candidates(targets: DataFrame, sims: DataFrame, rated: DataFrame,
                     n: int = DEFAULT.candidate_n, light: int = LIGHT) -> DataFrame:
    """OP-22 with OP-20: the clicked item's neighbours not yet rated, best
    ``n`` by similarity then item id (D7).  Unknown item -> no rows.
    Output ``(event_id, uid, seq, cand, sim, cand_rank)``.

    A click takes the items that its user has rated with it, meets its item's list
    once and leaves at most ``n`` rows, so no row is shuffled for each neighbour of
    each click.  Users with more than ``light`` rated items, whose sets are too
    large to go with every click, are looked up row by row.  Merge joins throughout:
    clicks compress so well that they would be broadcast by their measured size."""
    own = Window.partitionBy("uid").orderBy("mid")
    few = (rated.withColumn("_at", F.row_number().over(own)).where(F.col("_at") <= light + 1)
           .groupBy("uid").agg(F.collect_list(F.struct("mid", "from_seq")).alias("_rated")))
    t = targets.select("event_id", "uid", "mid", "seq").join(few.hint("merge"), "uid", "left")
    is_light = F.col("_rated").isNull() | (F.size("_rated") <= light)
    taken = F.transform(F.filter("_rated", lambda r: r["mid"].isNotNull() & (r["from_seq"] <= F.col("seq"))),
                        lambda r: r["mid"])
    lists = (sims.groupBy("mid").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("_s"), F.col("nb_mid").alias("cand"), F.col("score").alias("sim")))).alias("_nb")))
    left = F.slice(F.filter("_nb", lambda e: ~F.coalesce(F.array_contains("_taken", e["cand"]), F.lit(False))), 1, n)
    c = (t.where(is_light).select("event_id", "uid", "mid", "seq", taken.alias("_taken")).join(lists.hint("merge"), "mid")
         .select("event_id", "uid", "seq", F.inline(left)).select("event_id", "uid", "seq", "cand", "sim"))
    nb = sims.select("mid", F.col("nb_mid").alias("cand"), F.col("score").alias("sim"))
    h = t.where(~is_light).select("event_id", "uid", "seq", "mid").join(nb.hint("merge"), "mid").drop("mid")
    r = rated.select(F.col("uid").alias("_u"), F.col("mid").alias("_m"), "from_seq").hint("merge")
    c = c.unionByName(h.join(r, (h.uid == r._u) & (h.cand == r._m) & (r.from_seq <= h.seq), "left_anti"))
    w = Window.partitionBy("event_id").orderBy(F.col("sim").desc(), F.col("cand").asc())
    return (c.withColumn("cand_rank", F.row_number().over(w))
            .where(F.col("cand_rank") <= n)
            .select("event_id", "uid", "seq", "cand", "sim", "cand_rank"))


def recent_lists(recents: DataFrame) -> DataFrame:
    """``(event_id, _recent)``: each click's recent items as a sorted array."""
    return recents.groupBy("event_id").agg(F.array_sort(F.collect_list("r_mid")).alias("_recent"))


def score_candidates(cands: DataFrame, recents: DataFrame, sims: DataFrame,
                     round_digits: int | None = None) -> DataFrame:
    """OP-21 + OP-23: ``avg(sim(cand, r)) + log10(#recent pairs)``
    over the click's recent list, a missing similarity counting as 0 and
    repeats counting (D10).  One row per candidate: it carries the click's
    recent items (at most ``recent_k``) and meets its own neighbour list (at
    most ``top_k_similar``) once, by ``cand``.  Output ``(event_id, uid, mid,
    score, rank)``, rank by score desc then item id."""
    lists = sims.groupBy("mid").agg(F.collect_list(F.struct("nb_mid", "score")).alias("recs"))
    return score_with_lists(cands, recent_lists(recents), lists, round_digits)


def score_with_lists(cands: DataFrame, recent: DataFrame, neighbours: DataFrame,
                     round_digits: int | None = None) -> DataFrame:
    """``score_candidates`` on prepared inputs: ``recent`` is ``(event_id,
    _recent)`` and ``neighbours`` ``(mid, recs ARRAY<STRUCT<nb_mid, score>>)``."""
    lists = neighbours.select(F.col("mid").alias("cand"), F.map_from_entries("recs").alias("_sims"))
    pairs = (cands.select("event_id", "uid", "cand").join(recent.hint("merge"), "event_id")
             .join(lists, "cand", "left"))
    n = F.size("_recent").cast("double")
    total = F.aggregate("_recent", F.lit(0.0),
                        lambda acc, r: acc + F.coalesce(F.element_at("_sims", r), F.lit(0.0)))
    out = pairs.select("event_id", "uid", F.col("cand").alias("mid"),
                       (total / n + F.log10(n)).alias("score"))
    if round_digits is not None:
        out = out.withColumn("score", F.round("score", round_digits))
    w = Window.partitionBy("event_id").orderBy(F.col("score").desc(), F.col("mid").asc())
    return out.withColumn("rank", F.row_number().over(w).cast("int"))


def replay(clicks: DataFrame, sims: DataFrame, stored: DataFrame, knobs=DEFAULT,
           only_latest: bool = False, round_digits: int | None = None,
           materialize: bool = True) -> DataFrame:
    """OP-39: score every click as of itself (or only each user's last click).

    ``(event_id, uid, mid, score, rank)``: the list written for the user at
    that click.  A click with no candidates writes an empty list (D12): it has
    no rows here; ``latest_recs_nested`` keeps the empty list.

    The sequenced clicks feed four branches (targets, recent lists, rated
    set); with ``materialize`` they are checkpointed once to the shared
    checkpoint folder, which also cuts the lineage a lost executor replays.
    """
    seq = sequence_clicks(clicks)
    if materialize:
        seq = write_once(seq)
    targets = latest_clicks(seq) if only_latest else seq
    recents = recent_rows(seq, min(knobs.recent_k, knobs.queue_cap), targets if only_latest else None)
    rated = rated_as_of(stored, seq)
    cands = click_candidates(targets, sims, rated, knobs.candidate_n)
    return score_candidates(cands, recents, sims, round_digits)


def latest_recs(clicks: DataFrame, all_click_recs: DataFrame) -> DataFrame:
    """OP-07 read side: the list from each user's last write wins.
    Long form ``(uid, event_id, mid, score, rank)``."""
    last = latest_clicks(clicks).select("uid", "event_id")
    return all_click_recs.join(last, ["uid", "event_id"]).select(
        "uid", "event_id", "mid", "score", "rank")


def latest_recs_nested(clicks: DataFrame, recs_long: DataFrame) -> DataFrame:
    """``(uid, event_id, recs ARRAY<STRUCT<mid, score>>)``; empty list when the
    user's last click produced nothing (D12)."""
    last = latest_clicks(clicks).select("uid", "event_id")
    r = recs_long.select("event_id", F.struct("rank", "mid", "score").alias("_e"))
    return (last.join(r, "event_id", "left").groupBy("uid", "event_id")
            .agg(F.array_sort(F.collect_list("_e")).alias("_r"))
            .select("uid", "event_id", F.transform("_r", lambda e: F.struct(
                e["mid"].alias("mid"), e["score"].alias("score"))).alias("recs")))


def recent_queue(clicks: DataFrame, cap: int = DEFAULT.queue_cap) -> DataFrame:
    """OP-37 final state per user: newest ``cap`` clicked items, newest first,
    repeats kept.  ``(uid, pos, mid)``; top-k per user is planned as a
    partial WindowGroupLimit, so no task holds a whole heavy user."""
    w = Window.partitionBy("uid").orderBy(*[F.col(c).desc() for c in CLICK_ORDER])
    return (clicks.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= cap)
            .select("uid", F.col("pos").cast("int").alias("pos"), "mid"))


def recent_clicks(clicks: DataFrame, k: int = DEFAULT.recent_k,
                  cap: int = DEFAULT.queue_cap) -> DataFrame:
    """OP-38 read of the current queue: its first ``k`` entries."""
    return recent_queue(clicks, min(k, cap))
