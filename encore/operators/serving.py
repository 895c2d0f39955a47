"""Per-user views and the click upsert, set-wise over all users at once:
enrichment (OP-24), history (OP-25), favourites (OP-26), stored
recommendations (OP-27), click upsert (OP-28), status (OP-29), dashboard
(OP-41).  A served item is ``(uid, pos, mid, name, url, clicks)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.config import DEFAULT
from encore.operators.realtime import latest_clicks, recent_queue

ITEM_COLS = ["uid", "pos", "mid", "name", "url", "clicks"]


def apply_clicks(stored: DataFrame, clicks: DataFrame) -> DataFrame:
    """OP-28: a click adds 1 to an existing ``(uid, mid)`` weight or inserts
    weight 1.  ``(uid, mid, weight)``; the score is recomputed from weights
    by OP-15 when needed (D3).  Partial aggregation keeps a heavy pair cheap."""
    c = clicks.select("uid", "mid", F.lit(1).cast("bigint").alias("weight"))
    s = stored.select("uid", "mid", F.col("weight").cast("bigint").alias("weight"))
    return s.unionByName(c).groupBy("uid", "mid").agg(F.sum("weight").alias("weight"))


def enrich_items(items: DataFrame, catalog: DataFrame, ratings: DataFrame) -> DataFrame:
    """OP-24: ``(uid, pos, mid)`` lists -> catalog rows, items missing from
    the catalog dropped, ``clicks`` = the user's weight on the item or 0.
    Order (``pos``) and duplicates are kept.  Join strategies are Catalyst's:
    a small catalog is broadcast on its measured size, a large one shuffled."""
    w = ratings.select("uid", "mid", F.col("weight").alias("_w"))
    return (items.select("uid", "pos", "mid").join(catalog.select("mid", "name", "url"), "mid")
            .join(w, ["uid", "mid"], "left")
            .select("uid", F.col("pos").cast("int").alias("pos"), "mid", "name", "url",
                    F.coalesce(F.col("_w"), F.lit(0)).cast("int").alias("clicks")))


def history_items(clicks: DataFrame, n: int = DEFAULT.history_n,
                  cap: int = DEFAULT.queue_cap) -> DataFrame:
    """OP-25 before enrichment: the newest ``n`` queue entries, distinct;
    ``pos`` is the queue position of the item's newest click (D14)."""
    q = recent_queue(clicks, min(n, cap))
    return q.groupBy("uid", "mid").agg(F.min("pos").alias("pos"))


def user_history(clicks: DataFrame, catalog: DataFrame, ratings: DataFrame,
                 n: int = DEFAULT.history_n) -> DataFrame:
    """OP-25: recently played items per user, enriched."""
    return enrich_items(history_items(clicks, n), catalog, ratings)


def favourite_items(ratings: DataFrame, n: int = DEFAULT.history_n) -> DataFrame:
    """OP-26 before enrichment: the user's items by weight desc (ties: item
    id), first ``n`` distinct.  Top-k per user runs as a partial
    WindowGroupLimit before the shuffle."""
    r = ratings.groupBy("uid", "mid").agg(F.max("weight").alias("weight"))
    w = Window.partitionBy("uid").orderBy(F.col("weight").desc(), F.col("mid").asc())
    return (r.withColumn("pos", F.row_number().over(w)).where(F.col("pos") <= n)
            .select("uid", "pos", "mid"))


def user_favourites(ratings: DataFrame, catalog: DataFrame,
                    n: int = DEFAULT.history_n) -> DataFrame:
    """OP-26: the user's most played items, enriched."""
    return enrich_items(favourite_items(ratings, n), catalog, ratings)


def rec_items(stored_long: DataFrame, n: int = DEFAULT.recs_n, order: str = "score") -> DataFrame:
    """OP-27 before enrichment.  ``order="score"`` keeps the stored rank;
    ``order="mid_desc"`` re-sorts by item id descending as the original
    service did (D8).  Stored lists hold at most ``candidate_n`` entries."""
    if order == "score":
        pos = F.col("rank")
    elif order == "mid_desc":
        pos = F.row_number().over(Window.partitionBy("uid").orderBy(F.col("mid").desc()))
    else:
        raise ValueError(f"unknown order {order!r}")
    return stored_long.select("uid", "mid", pos.alias("pos")).where(F.col("pos") <= n)


def user_recs(stored_long: DataFrame, catalog: DataFrame, ratings: DataFrame,
              n: int = DEFAULT.recs_n, order: str = "score") -> DataFrame:
    """OP-27: the user's stored real-time recommendations, enriched."""
    return enrich_items(rec_items(stored_long, n, order), catalog, ratings)


def user_status(users: DataFrame, clicks: DataFrame, stored_heads: DataFrame) -> DataFrame:
    """OP-29 (D11): ``waiting`` when nothing is stored for the user or the
    stored list predates the user's last click, else ``done``.
    ``stored_heads`` is ``(uid, event_id)`` of the list each user has stored."""
    last = latest_clicks(clicks).select("uid", F.col("event_id").alias("_last"))
    st = stored_heads.select("uid", F.col("event_id").alias("_stored"))
    status = (F.when(F.col("_stored").isNull(), "waiting")
              .when(F.col("_last").isNull() | (F.col("_stored") == F.col("_last")), "done")
              .otherwise("waiting"))
    return (users.select("uid").distinct().join(st, "uid", "left").join(last, "uid", "left")
            .select("uid", status.alias("status")))


def user_dashboard(history: DataFrame, recs: DataFrame, favourites: DataFrame) -> DataFrame:
    """OP-41: the three views in one result with a ``section`` column."""
    parts = [(history, "history"), (recs, "recommendations"), (favourites, "favourites")]
    out = None
    for df, name in parts:
        d = df.select(F.lit(name).alias("section"), *ITEM_COLS)
        out = d if out is None else out.unionByName(d)
    return out
