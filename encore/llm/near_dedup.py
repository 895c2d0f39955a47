"""Near duplicates: MinHash, banding, verification, components.

1. Each text becomes the set of its word shingles (64-bit hashes) and ``BANDS
   * ROWS`` universal hash minima ``min((a x + b) mod 2^32)``, ``a`` odd.
   Texts with the same set form one class and go on as one node.
2. Nodes meet in a bucket when all minima of a band agree.  At a similarity of
   0.8 a pair misses all 40 bands of 5 with probability 1.2e-7.
3. Inside a bucket pairs are never all written out.  In each of two rounds
   the next few nodes of a bucket, its hubs, are compared with the later nodes
   that are not yet in a hub's component; then components are joined.  A bucket
   is done when the rest of it is one component, so a group of copies of any
   size ends after a round or two.  What is left are buckets of many texts that
   are alike but not linked.  Buckets that share nodes form a group; its nodes
   are cut into blocks of about ``BLOCK_SHINGLES`` shingles, and every pair of
   blocks is compared in one task from the full sets, which writes only links
   that join two components.  So no link between components is lost.
4. A pair must agree in the size bound and in its signature's estimate before
   both full sets are loaded and the Jaccard similarity is computed from them.
5. Links become components by alternating large-star and small-star.

Shuffles are keyed by set digest, band key, node or root; every group meets in
a task only as a partial aggregate, the hubs of buckets that hold a thousandth of
all rows are broadcast (at most a thousand buckets), and the other joins may be
split by AQE when a key is skewed.  Nothing but a few counts reaches the driver.

Defined results: null and empty texts have no shingle, link with nothing and
are kept.  Null ids are allowed and lose to any other id of the component.  Of
rows that repeat the same id and text one is kept.  Other columns of the input
are not read unless named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from encore.llm.components import components
from encore.llm.heavy import heavy_keys, join_by_key
from encore.llm.names import quoted
from encore.llm.shingles import shingle_set
from encore.session import materialize

BANDS, ROWS = 40, 5
ESTIMATE_SLACK = 0.2       # signatures may estimate this much below the threshold (over 6 sigma)
HUBS = (1, 4)              # hubs of a bucket in each round
BLOCK_SHINGLES = 200_000   # shingles of a block in the last comparison
_rng = np.random.default_rng(20240607)
_A = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, BANDS * ROWS, dtype=np.uint32)
_CHUNK = 512               # shingles hashed at once: bounds memory, keeps to the cache


def minima(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    low = np.full(BANDS * ROWS, 2**32 - 1, np.uint32)
    for i in range(0, len(x), _CHUNK):
        h = np.multiply.outer(_A, x[i:i + _CHUNK])
        h += _B[:, None]
        np.minimum(low, h.min(axis=1), out=low)
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    bands = low.reshape(BANDS, ROWS)
    return np.array([xxhash.xxh3_64_intdigest(row.tobytes(), seed=i) for i, row in enumerate(bands)],
                    np.uint64).view(np.int64)


_SKETCH = pa.schema([("_rid", pa.int64()), ("_n", pa.int64()), ("_set", pa.binary()),
                     ("_sig", pa.binary()), ("_keys", pa.list_(pa.int64()))])
_SETS = pa.schema([("_node", pa.int64()), ("_hashes", pa.binary())])


def _texts(batch: pa.RecordBatch, column: str = "_text"):
    for t in batch.column(column):
        yield t.as_buffer().to_pybytes() if t.is_valid else b""


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols: list[list] = [[], [], [], []]
            for text in _texts(batch):
                s = shingle_set(text, size)
                low = minima(s) if len(s) else None
                cols[0].append(len(s))
                cols[1].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                cols[2].append((low & np.uint32(255)).astype(np.uint8).tobytes() if len(s) else None)
                cols[3].append(band_keys(low) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_rid")] + [pa.array(c, t) for c, t in zip(cols, _SKETCH.types[1:])],
                schema=_SKETCH)
    return run


def _sets(size: int):
    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column("_node"),
                     pa.array([shingle_set(t, size).tobytes() for t in _texts(part)], pa.binary())],
                    schema=_SETS)
    return run


def _alike(percent: int):
    """Pairs whose full sets reach the similarity."""
    def run(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("_x"), batch.column("_y")):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(a, b, assume_unique=True))
                ok.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(ok, pa.bool_()))
    return run


def _agree(percent: int):
    """Pairs whose signatures agree in enough places to be worth a full test."""
    least = (percent / 100 - ESTIMATE_SLACK) * BANDS * ROWS

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(v.as_buffer().to_pybytes() for v in batch.column(c)), np.uint8)
                    .reshape(-1, BANDS * ROWS) for c in ("_x", "_y"))
            yield batch.select(["u", "v"]).filter(pa.array((x == y).sum(axis=1) >= least))
    return run


def _with_both(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    t = table.select("_node", value)
    return (pairs.join(t.select(F.col("_node").alias("u"), F.col(value).alias("_x")), "u")
            .join(t.select(F.col("_node").alias("v"), F.col(value).alias("_y")), "v")
            .select("u", "v", "_x", "_y"))


def _links(docs: DataFrame, nodes: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Edges ``(u, v)`` that connect what the similarity connects."""
    bands = nodes.select("_node", "_n", F.explode("_keys").alias("_key"))
    shared = bands.groupBy("_key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("_key")
    open_bands = materialize(bands.join(shared, "_key").select("_key", "_node", "_n"), "buckets")
    if open_bands.isEmpty():
        return None
    wanted = nodes.join(open_bands.select("_node").distinct(), "_node").select("_node", "_id", "_print")
    texts = (docs.join(wanted, docs["_id"].eqNullSafe(wanted["_id"]) & (docs["_print"] == wanted["_print"]))
             .select("_node", "_text").dropDuplicates(["_node"]))
    sets = materialize(texts.mapInArrow(_sets(size), "_node long, _hashes binary"), "sets")
    sigs = nodes.select("_node", "_sig")

    edges, label, last, tested = [], None, None, []
    for hubs in HUBS:
        state = _unresolved(open_bands, label, last)
        if state.isEmpty():
            return label
        open_bands = state.select("_key", "_node", "_n")
        rank = F.row_number().over(Window.partitionBy("_key").orderBy("_node"))
        top = (state.withColumn("_r", rank).where(F.col("_r") <= hubs)
               .select("_key", F.col("_node").alias("u"), F.col("_n").alias("_nu"),
                       F.col("_root").alias("_ru")))
        last = materialize(top.groupBy("_key").agg(F.max("u").alias("_last")), "hubs")
        pairs = (join_by_key(state, top, "_key", heavy_keys(state, "_key")).where("_node > u AND _root != _ru")
                 .where(F.lit(100) * F.least("_n", "_nu") >= F.lit(percent) * F.greatest("_n", "_nu"))
                 .select("u", F.col("_node").alias("v")).distinct())
        if tested:
            pairs = pairs.join(reduce(DataFrame.unionByName, tested), ["u", "v"], "left_anti")
        pairs = materialize(pairs, "pairs")
        tested.append(pairs)
        near = _with_both(pairs, sigs, "_sig").mapInArrow(_agree(percent), "u long, v long")
        found = materialize(_with_both(near, sets, "_hashes").mapInArrow(_alike(percent), "u long, v long"),
                            "links")
        edges, label = _joined(edges, found, label)
    state = _unresolved(open_bands, label, last)
    if not state.isEmpty():
        found = materialize(_block_links(state, sets, percent), "links")
        edges, label = _joined(edges, found, label)
    return label


def _joined(edges: list[DataFrame], found: DataFrame, label: DataFrame | None):
    if found.isEmpty():
        return edges, label
    label = components(reduce(DataFrame.unionByName, edges + [found]))
    return [label.select("u", "v")], label         # same components, fewer edges


def _unresolved(bands: DataFrame, label: DataFrame | None, last: DataFrame | None) -> DataFrame:
    """Rows ``(_key, _node, _n, _root)`` after the hubs used so far, of the
    buckets whose rest is not one component."""
    state = bands.withColumn("_root", F.col("_node")) if label is None else (
        bands.join(label.select(F.col("u").alias("_node"), F.col("v").alias("_root")), "_node", "left")
        .withColumn("_root", F.coalesce("_root", "_node")))
    if last is not None:
        state = state.join(last, "_key", "left").where("_last IS NULL OR _node > _last").drop("_last")
    undone = (state.groupBy("_key").agg(F.min("_root").alias("a"), F.max("_root").alias("b"))
              .where("a != b").select("_key"))
    return materialize(state.join(undone, "_key"), "buckets")


def _block_links(state: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components inside groups of overlapping buckets."""
    first = state.groupBy("_key").agg(F.min("_node").alias("v"))
    group = components(state.join(first, "_key").select(F.col("_node").alias("u"), "v"))
    nodes = (state.select("_node", "_n", "_root").distinct()
             .join(group.select(F.col("u").alias("_node"), F.col("v").alias("_g")), "_node", "left")
             .withColumn("_g", F.coalesce("_g", "_node")))
    size = nodes.groupBy("_g").agg(F.ceil(F.sum("_n") / BLOCK_SHINGLES).cast("int").alias("_blocks"))
    blocks = (nodes.join(size, "_g")
              .withColumn("_block", F.pmod(F.xxhash64("_node"), F.col("_blocks")).cast("int"))
              .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
              .select("_g", F.least("_block", "_other").alias("_i"), F.greatest("_block", "_other").alias("_j"),
                      "_block", "_node", "_root"))
    return (blocks.join(sets, "_node").groupBy("_g", "_i", "_j")
            .applyInPandas(_block_kernel(percent), "u long, v long"))


def _block_kernel(percent: int):
    def kernel(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        i, j = int(key[1]), int(key[2])
        left = frame[frame["_block"] == i]
        right = frame[frame["_block"] == j]
        nodes = right["_node"].to_numpy()
        arrays = [np.frombuffer(h, np.uint64) for h in right["_hashes"]]
        sizes = np.array([len(a) for a in arrays])
        hashes, owner = np.concatenate(arrays), np.repeat(np.arange(len(arrays)), sizes)
        order = np.argsort(hashes, kind="stable")
        hashes, owner = hashes[order], owner[order]
        parent = {r: r for r in frame["_root"]}

        def root(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        roots, out = right["_root"].to_numpy(), []
        for u, r, h in zip(left["_node"], left["_root"], left["_hashes"]):
            mine = np.frombuffer(h, np.uint64)
            lo, hi = np.searchsorted(hashes, mine, "left"), np.searchsorted(hashes, mine, "right")
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(nodes))
            for k in np.flatnonzero(100 * both >= percent * (len(mine) + sizes - both)):
                a, b = root(r), root(roots[k])
                if a != b:
                    parent[a] = b
                    out.append((u, nodes[k]))
        return pd.DataFrame(out, columns=["u", "v"], dtype="int64")
    return kernel


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                    percent: int = 80, carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``(id_col, n_shingles, component_id, kept)``
    plus ``row``, a struct of the ``carry`` columns.  Texts are linked whose
    sets of ``size``-word shingles have a Jaccard similarity of ``percent``
    in a hundred or more."""
    own_id, own_text = docs[quoted(id_col)].alias("_id"), docs[quoted(text_col)].alias("_text")
    src = docs.select(own_id, own_text, F.xxhash64(docs[quoted(text_col)]).alias("_print"))
    tagged = docs.select(own_id, own_text,
                         F.struct(*[docs[quoted(c)].alias(c) for c in (carry or [id_col])]).alias("row"),
                         F.monotonically_increasing_id().alias("_rid"))
    # the row id must mean the same row in the sketch and beside it: both are
    # written by one job, the sketch riding on the row it was made from
    sketch = materialize(_sketched(tagged, size), "sketch")

    best = F.struct(F.col("_id").isNull().alias("x"), F.col("_id").alias("id"), F.col("_rid").alias("rid"))
    classes = materialize(
        sketch.where("_n > 0").groupBy("_set").agg(F.min("_rid").alias("_node"), F.min(best).alias("_best")),
        "classes")
    nodes = materialize(
        sketch.join(classes.select(F.col("_node").alias("_rid")), "_rid")
        .select(F.col("_rid").alias("_node"), "_id", "_print", "_n", "_sig", "_keys"), "nodes")
    label = _links(src, nodes, size, percent)

    if label is not None:
        roots = (classes.join(label.select(F.col("u").alias("_node"), F.col("v").alias("_root")), "_node", "left")
                 .withColumn("_root", F.coalesce("_root", "_node")))
        winner = roots.groupBy("_root").agg(F.min("_best").alias("_best"))
        classes = roots.drop("_best").join(winner, "_root").select("_set", "_best")
    out = (sketch.select("_id", "_rid", "_n", "_set", "row")
           .join(classes.select("_set", "_best"), "_set", "left"))
    return out.select(
        F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"),
        F.when(F.col("_best").isNull(), F.col("_id")).otherwise(F.col("_best.id")).alias("component_id"),
        F.coalesce(F.col("_best.rid") == F.col("_rid"), F.lit(True)).alias("kept"), "row")


def _sketched(tagged: DataFrame, size: int) -> DataFrame:
    rows = tagged.select("_rid", "_id", "_text", F.xxhash64("_text").alias("_print"), "row")
    known = T.StructType.fromDDL("_rid long, _n long, _set binary, _sig binary, _keys array<long>")
    schema = T.StructType(known.fields + [T.StructField("_id", tagged.schema["_id"].dataType),
                                          T.StructField("_print", T.LongType()),
                                          T.StructField("row", tagged.schema["row"].dataType)])
    sketch = _sketch(size)

    def run(batches):
        for batch in batches:
            (out,) = sketch(iter([batch]))
            extra = ["_id", "_print", "row"]
            yield pa.RecordBatch.from_arrays(out.columns + [batch.column(c) for c in extra],
                                             names=out.schema.names + extra)
    return rows.mapInArrow(run, schema)


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                percent: int = 80) -> DataFrame:
    """The input rows that stay (one of each component), with all their columns."""
    kept = near_duplicates(docs, id_col, text_col, size, percent, carry=docs.columns).where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op7_minhash_near_dedup(spark, d):
    return near_duplicates(spark.read.parquet(f"{d}/documents.parquet"), size=4).drop("row")


QUERIES = {"op7_minhash_near_dedup": op7_minhash_near_dedup}
ORACLE: dict[str, str] = {}
