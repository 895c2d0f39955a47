"""Sharding by balanced label propagation, in DataFrame functions only.

A document is linked to groups (for the registered query: one group for each
text that several rows share); a link names the group, so a group of any size
costs one row a member and never a row a pair.  Labels are shards.

*Placement.* Every document gets a shard by hash.  The few documents of at
least a quarter of a shard (at most ``4 x shards``) are placed largest first on
the emptiest shard and stay there.

*Propagation.* In each round the bytes of every group are summed by shard (one
row a group) and joined back to the links; a document wants the shard where
its groups have most bytes, equal sums being settled alike for all members of a
group.  Shards accept movers up to what is left of their quota, small groups
first, so that small groups stay whole and only a group that no shard can hold
is cut.  A shard that had to refuse takes no further movers and the refused go
on to the next best one.  Only groups that are still cut take part.

*Balance.* Shards above the even level release documents and shards below take
them: documents without links first, linked ones group by group where those do
not suffice.  The releases of all shards form one line of bytes, the room of
the others another, and a document goes where its place on the first line falls
on the second, if that makes its two shards more even.  Rounds draw other
documents each time and end when the shards are even to ``EVEN`` of a shard or
``STALLS`` rounds gain nothing.

Running sums come from range slices and their offsets, so neither a shard nor
a group ever meets in one task; at most a thousand groups that hold a
thousandth of all links each are joined by broadcast, all others by a shuffled
join.  What reaches the driver is a row a shard, a row a slice of a running
sum, and the large documents.

Defined results: a null text counts as empty and has size 1.  Null and repeated
ids are rows like others; rows with equal texts form a group whatever their
ids.  An empty table gives no row.  Slots number the rows of a shard from 0
without gaps.  Few or very long documents leave shards as uneven as their sizes
are; with fewer documents than shards some stay empty.  Only the id and the
text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from encore.functions.sequence import sequence_within
from encore.llm.heavy import MOST_KEYS, heavy_keys, join_by_key
from encore.llm.names import quoted
from encore.session import materialize

SHARDS = 16
ROUNDS = 12                # label rounds at most; each ends earlier when nothing moves
BALANCE_ROUNDS = 12        # of which most move a few rows
STALLS = 2                 # rounds without a gain that end it
EVEN = 0.003               # bytes above the even level that need no move, as a share of it
LARGE = 4                  # documents of a LARGE-th of a shard are placed first

STATE = ["_rid", "_id", "_size", "_crc", "_fixed", "_shard"]


def running_sum(df: DataFrame, key: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of ``key`` up to and
    including this one.  ``order`` must be total.  A key may fill many slices."""
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(slices, key, *order).withColumn("_slice", F.spark_partition_id()), "ranged")
    inside = (Window.partitionBy("_slice", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(key, "_slice").agg(F.sum(value).alias("_total"))     # a row a slice and key
    offset = sums.select(key, "_slice", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_before"))
    return (ranged.withColumn(out, F.sum(value).over(inside)).join(F.broadcast(offset), [key, "_slice"])
            .withColumn(out, F.col(out) + F.col("_before")).drop("_slice", "_before"))


def _loads(rows: DataFrame, shards: int) -> list[int]:
    got = {r["_shard"]: r["b"] for r in rows.groupBy("_shard").agg(F.sum("_size").alias("b")).collect()}
    return [got.get(k, 0) for k in range(shards)]


def _level(floors: list[int], total: int) -> float:
    """The even level of shards that cannot go below their floors."""
    floors = sorted(floors)
    for k in range(len(floors), 0, -1):
        level = (total - sum(floors[k:])) / k
        if level >= floors[k - 1]:
            return level
    return 0.0


def _pick(values: list, by: Column) -> Column:
    """``values[by]`` as an expression."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), by.cast("int") + 1)


def _place_large(state: DataFrame, shards: int, total: int) -> DataFrame:
    """At most ``LARGE * shards`` rows: largest first, to the emptiest shard."""
    large = state.where(F.col("_size") * F.lit(LARGE * shards) >= F.lit(total)).select("_rid", "_size").collect()
    load, at = [0] * shards, []
    for r in sorted(large, key=lambda r: (-r["_size"], r["_rid"])):
        k = min(range(shards), key=lambda j: (load[j], j))
        load[k] += r["_size"]
        at.append((r["_rid"], k))
    if not at:
        return state
    spots = F.broadcast(state.sparkSession.createDataFrame(at, "_rid long, _spot int"))
    return (state.join(spots, "_rid", "left").withColumn("_fixed", F.col("_spot").isNotNull())
            .withColumn("_shard", F.coalesce("_spot", "_shard")).select(STATE))


def _propagate(state: DataFrame, links: DataFrame, shards: int, level: float) -> DataFrame:
    """``(_rid, _shard)`` of the linked documents after the label rounds."""
    labels = materialize(state.join(links.select("_rid").distinct(), "_rid", "left_semi")
                         .select("_rid", "_size", "_fixed", "_shard"), "labels")
    heavy = heavy_keys(links, "_group")
    names = [f"_s{k}" for k in range(shards)]
    room = [True] * shards
    for _ in range(ROUNDS):
        held = links.select("_rid", "_group").join(labels, "_rid")
        tally = (held.groupBy("_group").agg(*[F.sum(F.when(F.col("_shard") == k, F.col("_size")).otherwise(0)).alias(n)
                                              for k, n in enumerate(names)]))
        cut = materialize(tally.where(sum((F.col(n) > 0).cast("int") for n in names) > 1)
                          .withColumn("_bytes", sum(F.col(n) for n in names)), "tally")
        if cut.isEmpty():
            break
        # a member of several groups adds up their sums and sides with the smallest
        votes = (join_by_key(held.where("NOT _fixed"), cut, "_group", heavy).groupBy("_rid")
                 .agg(F.first("_size").alias("_size"), F.first("_shard").alias("_shard"),
                      F.min(F.struct("_bytes", "_group")).alias("_lead"),
                      *[F.sum(n).alias(n) for n in names]))
        choice = F.array_max(F.array(*[
            F.when(F.lit(room[k]) | (F.col("_shard") == k),
                   F.struct(F.col(n).alias("v"), F.xxhash64("_lead._group", F.lit(k)).alias("h"), F.lit(k).alias("k")))
            for k, n in enumerate(names)]))
        wish = materialize(votes.select("_rid", "_size", "_shard", F.col("_lead._bytes").alias("_bytes"),
                                        F.col("_lead._group").alias("_group"), choice["k"].alias("_to")), "wishes")
        moving = wish.where("_to != _shard")
        if moving.isEmpty():
            break
        leaving = _loads(moving, shards)
        staying = [a - b for a, b in zip(_loads(labels, shards), leaving)]
        quota = [max(0.0, level - s) for s in staying]
        line = materialize(running_sum(moving, "_to", ["_bytes", "_group", "_rid"], "_size", "_sum")
                           .withColumn("_in", F.col("_sum") <= _pick(quota, F.col("_to"))), "movers")
        # the group at the end of a quota: a small one moves as a whole or not
        edge = line.where("NOT _in").groupBy("_to").agg(
            F.min_by(F.struct("_group", "_bytes"), "_sum").alias("e")).collect()      # a row a shard
        accepted = F.col("_in")
        for r in edge:
            room[r["_to"]] = False
            if r["e"]["_bytes"] * LARGE < level:
                accepted &= ~((F.col("_to") == r["_to"]) & (F.col("_group") == r["e"]["_group"]))
        moved = line.where(accepted).select("_rid", F.col("_to").alias("_new"))
        if moved.isEmpty() and not edge:
            break
        labels = materialize(labels.join(moved, "_rid", "left")
                             .withColumn("_shard", F.coalesce("_new", "_shard")).drop("_new"), "labels")
    return labels.select("_rid", F.col("_shard").alias("_new"))


def _balance(state: DataFrame, shards: int, total: int) -> DataFrame:
    """Moves documents from shards above the even level to those below it."""
    fixed = _loads(state.where("_fixed"), shards)
    level = _level(fixed, total)
    load = _loads(state, shards)
    stalled = 0
    for number in range(BALANCE_ROUNDS):
        over = [int(max(0, b - max(level, f))) for b, f in zip(load, fixed)]
        under = [int(max(0, level - b)) for b in load]
        if max(over) <= EVEN * level or not any(under) or stalled == STALLS:
            break
        # a document of this size makes two shards more even, whatever it leaves
        fits = ~F.col("_fixed") & (_pick(over, F.col("_shard")) > 0) & (
            F.col("_size") < _pick([o + max(under) for o in over], F.col("_shard")))
        alone = {r["_shard"]: r["b"] for r in state.where(fits & F.col("_lead").isNull())
                 .groupBy("_shard").agg(F.sum("_size").alias("b")).collect()}
        # of the documents without links, enough to cover the excess twice; linked
        # ones only where those do not suffice
        need = [2 * (o + max(under)) / alone[k] if k in alone else 2.0 for k, o in enumerate(over)]
        draw = F.pmod(F.xxhash64("_rid", F.lit(number)), F.lit(1 << 20)) < _pick(need, F.col("_shard")) * (1 << 20)
        linked = _pick([n >= 1.0 for n in need], F.col("_shard"))
        tagged = state.withColumn("_goes", fits & F.when(F.col("_lead").isNull(), draw).otherwise(linked))
        line = running_sum(tagged.where("_goes").withColumn("_linked", F.col("_lead").isNotNull())
                           .withColumn("_turn", F.when(F.col("_lead").isNull(), F.xxhash64("_rid", F.lit(-number)))),
                           "_shard", ["_linked", "_lead", "_turn", "_rid"], "_size", "_sum")
        middle = F.col("_sum") - F.col("_size") / 2
        spot = middle + _pick([sum(over[:k]) for k in range(shards)], F.col("_shard"))
        target, reach = F.col("_shard"), sum(under)
        for k in reversed(range(shards)):
            if under[k]:
                better = F.col("_size") < _pick([o + under[k] for o in over], F.col("_shard"))
                target = F.when(spot < reach, F.when(better, k).otherwise(F.col("_shard"))).otherwise(target)
                reach -= under[k]
        moved = line.withColumn("_shard", F.when(middle <= _pick(over, F.col("_shard")), target)
                                .otherwise(F.col("_shard")).cast("int"))
        after = materialize(tagged.where("NOT _goes").select(*STATE, "_lead")
                            .unionByName(moved.select(*STATE, "_lead")), "state")
        new = _loads(after, shards)
        if sum(b * b for b in new) < sum(b * b for b in load):
            state, load, stalled = after, new, 0
        else:
            stalled += 1
    return state


def assign(nodes: DataFrame, links: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``nodes`` is ``(_rid, _id, _size, _crc)`` with ``_rid`` unique and sizes
    of at least 1, ``links`` ``(_rid, _group)``, both written tables; adds ``_shard``."""
    total = nodes.agg(F.sum("_size")).first()[0]
    start = nodes.select("_rid", "_id", "_size", "_crc", F.lit(False).alias("_fixed"),
                         F.pmod(F.xxhash64("_id", "_crc", "_size"), F.lit(shards)).cast("int").alias("_shard"))
    if total is None:
        return start
    state = materialize(_place_large(start, shards, total), "state")
    lead = links.groupBy("_rid").agg(F.min("_group").alias("_lead"))
    if not links.isEmpty():
        labels = _propagate(state, links, shards, _level(_loads(state.where("_fixed"), shards), total))
        state = (state.join(labels.join(lead, "_rid"), "_rid", "left")
                 .withColumn("_shard", F.coalesce("_new", "_shard")).drop("_new"))
    else:
        state = state.withColumn("_lead", F.lit(None).cast(links.schema["_group"].dataType))
    return _balance(materialize(state.select(*STATE, "_lead"), "state"), shards, total)


def equal_text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Nodes of ``assign`` and a link for every row whose text another row has."""
    text = F.coalesce(docs[quoted(text_col)], F.lit(""))
    rows = materialize(docs.select(
        F.monotonically_increasing_id().alias("_rid"), docs[quoted(id_col)].alias("_id"),
        (F.octet_length(text) + 1).cast("long").alias("_size"), F.crc32(text.cast("binary")).alias("_crc"),
        F.unhex(F.sha2(text, 256)).alias("_group")), "rows")
    many = rows.groupBy("_group").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    many = materialize(many, "groups")
    # at most MOST_KEYS groups hold that part of all rows
    heavy = many.where(F.col("c") * F.lit(MOST_KEYS) >= F.lit(rows.count())).select("_group")
    links = materialize(join_by_key(rows.select("_rid", "_group"), many.select("_group"), "_group", heavy), "links")
    return rows.drop("_group"), links


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """``(id_col, size, text_crc32, law, shard, slot, grown_shard)`` of every row."""
    nodes, links = equal_text_groups(docs, id_col, text_col)
    placed = assign(nodes, links, shards).select("_rid", "_id", "_size", "_crc", "_shard", F.xxhash64("_rid").alias("_h"))
    return sequence_within(placed, "_shard", ["_h", "_rid"], out="_seq").select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_crc").alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("_shard").alias("shard"), (F.col("_seq") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def op11_sharding(spark, d):
    return shard_documents(spark.read.parquet(f"{d}/documents.parquet"))


QUERIES = {"op11_sharding": op11_sharding}
ORACLE: dict[str, str] = {}
