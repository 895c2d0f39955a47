"""Exact deduplication by distributed MSD radix partitioning.

Texts are split by successive bytes, most significant first.  One radix digit
is a run of bytes; runs grow by a fixed factor, so a text of ``n`` bytes needs
``O(log n)`` levels.  At each level the rows of an open group are counted by
``(group, ended, digit)``, where ``ended`` says that the text has no byte
after this digit.  A row leaves when it is alone (singleton) or its group has
ended: two rows of an ended group agree in every byte, so equality rests on
the bytes and not on a digest.

Each level is a partial aggregation over digits and one join back to the open
rows.  A hot group therefore meets in one task only as its pre-aggregated
count, and the join is an ordinary one that AQE splits when a key is skewed.  What was
compared is cut off, so texts that share a beginning shrink from level to level.
Only open rows (texts that share a beginning) move; the others are settled by
their first digit.

Defined results: a null text counts as empty.  All empty texts are equal.
Null ids are allowed and lose against any other id.  Of rows that repeat both
id and text exactly one is kept.  Columns of the input other than the id, the
text and those asked for in ``carry`` are never read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.names import quoted
from encore.session import materialize

FIRST_DIGIT = 64     # bytes of the first digit
GROWTH = 16          # each further digit is this many times longer


def _digit(width: int) -> list[Column]:
    """Whether the text ends with its next digit, and that digit."""
    return [(F.length("_b") <= width).alias("_ended"), F.substring("_b", 1, width).alias("_digit")]


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     carry: list[str] | None = None, first_digit: int = FIRST_DIGIT,
                     growth: int = GROWTH) -> DataFrame:
    """One row per input row: ``(id_col, keep_id, group_size, kept,
    text_sha256)`` plus ``row``, a struct of the ``carry`` columns if any."""
    others = [c for c in carry or [] if c != text_col]
    text = F.coalesce(F.col("_t"), F.lit("")).cast("binary")
    # a row travels with its text once; other columns only where they are asked for
    src = docs.select(docs[quoted(id_col)].alias("_id"), docs[quoted(text_col)].alias("_t"),
                      F.struct(F.lit(True).alias("_"), *[docs[quoted(c)].alias(c) for c in others]).alias("_row"))
    first = src.withColumn("_b", text).select("_id", "_t", "_row", *_digit(first_digit))
    # groups are written before the join, so that AQE can split a hot key of it
    shared = materialize(first.groupBy("_ended", "_digit").agg(F.count(F.lit(1)).alias("_n"))
                         .where("_n > 1").select("_ended", "_digit", F.lit(True).alias("_hit")), "radix")
    rows = materialize(
        first.join(shared.hint("merge"), ["_ended", "_digit"], "left")
        .select("_id", "_row", F.sha2(text, 256).alias("text_sha256"),
                F.coalesce("_hit", F.lit(False)).alias("_open"),
                (F.col("_t") if text_col in (carry or []) else F.when(F.col("_hit"), F.col("_t"))).alias("_t"))
        .withColumn("_rid", F.monotonically_increasing_id()), "radix")

    settled = []
    open_rows = rows.where("_open").select("_rid", "_id", text.alias("_b"), F.lit(0).cast("long").alias("_group"))
    width = first_digit * growth
    while not open_rows.isEmpty():
        level = open_rows.select("*", *_digit(width))
        keys = ["_group", "_ended", "_digit"]
        groups = materialize(level.groupBy(*keys).agg(F.count(F.lit(1)).alias("group_size"),
                                                      F.max(F.struct("_id", "_rid")).alias("_keep")), "radix")
        step = materialize(
            level.join(groups.hint("merge"), keys)
            .withColumn("_done", F.col("_ended") | (F.col("group_size") == 1))
            # a row id belongs to one group only, so it names the group below;
            # what was compared is cut off
            .select("_rid", "_id", F.col("_keep._rid").alias("_group"), "group_size", "_done",
                    F.col("_keep._id").alias("keep_id"),
                    F.when(~F.col("_done"), F.expr(f"substring(_b, {width + 1})")).alias("_b")), "radix")
        settled.append(step.where("_done").select("_rid", "_group", "keep_id", "group_size"))
        open_rows = step.where("NOT _done").select("_rid", "_id", "_b", "_group")
        width *= growth

    out = ["_id", "keep_id", "group_size", "kept", "text_sha256", "_row", "_t"]
    alone = (rows.where("NOT _open")
             .select("*", F.col("_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                     F.lit(True).alias("kept")).select(out))
    if settled:
        members = (rows.where("_open").join(reduce(DataFrame.unionByName, settled), "_rid")
                   .withColumn("kept", F.col("_rid") == F.col("_group")).select(out))
        alone = alone.unionByName(members)
    fields = [(F.col("_t") if c == text_col else F.col("_row").getField(c)).alias(c) for c in carry or []]
    return alone.select(F.col("_id").alias(id_col), *out[1:5], *([F.struct(*fields).alias("row")] if fields else []))


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows that stay, with all their columns."""
    kept = exact_duplicates(docs, id_col, text_col, carry=docs.columns).where("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op3_exact_dedup(spark, d):
    return exact_duplicates(spark.read.parquet(f"{d}/documents.parquet"))


SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""

QUERIES = {"op3_exact_dedup": op3_exact_dedup}
ORACLE = {"op3_exact_dedup": SQL}
