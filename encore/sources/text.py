"""Text readers and writers: interactions (OP-01), catalog (OP-02),
click log lines (OP-35) and their format (OP-08).

Each parser takes a DataFrame with a ``value`` string column (what
``spark.read.text`` yields) and returns ``(rows, rejects)``.  Rejects carry
the line and a reason (D4); ``mode="failfast"`` raises on the first one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.config import DEFAULT
from encore.functions.columns import strict_int, trim_controls


def _fields(value: Column, sep: str) -> Column:
    # Split like the JVM's String.split: trailing empty fields are dropped.
    body = F.regexp_replace(value, re.escape(sep) + "+$", "")
    return F.split(body, re.escape(sep))


def _finish(parsed: DataFrame, cols: list[str], mode: str,
            keep: tuple = ()) -> tuple[DataFrame, DataFrame]:
    # Each line yields zero or one record on each side (a flatMap, written as
    # ``inline`` of an optional one-element array).  A plain ``where`` would be
    # pushed below the parsing projection with every field re-derived in it.
    ok = F.col("_reason").isNull()
    rows = parsed.select(F.inline(F.when(ok, F.array(F.struct(*cols)))))
    rejects = parsed.select(F.inline(F.when(~ok, F.array(F.struct(
        *keep, F.col("value").alias("line"), F.col("_reason").alias("reason"))))))
    if mode == "failfast":
        bad = rejects.limit(1).collect()
        if bad:
            raise ValueError(f"malformed line ({bad[0].reason}): {bad[0].line!r}")
    return rows, rejects


def _split_once(lines: DataFrame, value: Column, sep: str, keep: tuple = ()) -> DataFrame:
    # The field array gets its own projection so it is computed once per line
    # (Catalyst keeps a non-cheap expression that is referenced many times).
    return lines.select("value", *keep, _fields(value, sep).alias("_f"))


def parse_interactions(lines: DataFrame, mode: str = "permissive") -> tuple[DataFrame, DataFrame]:
    """OP-01: ``uid,mid,weight`` -> ``(uid INT, mid INT, weight BIGINT)``.

    Fields beyond the third are ignored; fewer than three, or a field that is
    not a whole number, is a reject.
    """
    f = F.col("_f")
    parsed = (_split_once(lines, F.col("value"), ",")
              .select("value", "_f", *[strict_int(F.get(f, i)).alias(c)
                                      for i, c in enumerate(("uid", "mid", "weight"))])
              .select("value", "uid", "mid", F.col("weight").cast("bigint").alias("weight"),
                      F.when(F.size(f) < 3, "too_few_fields")
                       .when(F.col("uid").isNull() | F.col("mid").isNull()
                             | F.col("weight").isNull(), "not_an_int").alias("_reason")))
    return _finish(parsed, ["uid", "mid", "weight"], mode)


def parse_catalog(lines: DataFrame, mode: str = "permissive") -> tuple[DataFrame, DataFrame]:
    """OP-02: ``mid,name,url`` -> ``(mid INT, name, url)``, name and url trimmed.

    Only positions 0-2 are read, so a name holding a comma is cut there (D5).
    """
    f = F.col("_f")
    parsed = (_split_once(lines, F.col("value"), ",")
              .select("value", "_f", strict_int(F.get(f, 0)).alias("mid"),
                      trim_controls(F.get(f, 1)).alias("name"), trim_controls(F.get(f, 2)).alias("url"))
              .select("value", "mid", "name", "url",
                      F.when(F.size(f) < 3, "too_few_fields")
                       .when(F.col("mid").isNull(), "not_an_int").alias("_reason")))
    return _finish(parsed, ["mid", "name", "url"], mode)


def format_click_line(uid: Column, mid: Column, ts: Column, prefix: str = DEFAULT.click_prefix) -> Column:
    """OP-08: the click message ``<prefix>uid|mid|epoch_seconds``."""
    return F.concat(F.lit(prefix), F.concat_ws("|", uid.cast("string"), mid.cast("string"),
                                                ts.cast("string")))


def format_click_log(clicks: DataFrame, prefix: str = DEFAULT.click_prefix) -> DataFrame:
    """OP-08 over a click table: ``(event_id, line)``."""
    return clicks.select("event_id", format_click_line(F.col("uid"), F.col("mid"), F.col("ts"),
                                                       prefix).alias("line"))


def parse_click_log(lines: DataFrame, prefix: str = DEFAULT.click_prefix,
                    mode: str = "permissive", keep: tuple = ()) -> tuple[DataFrame, DataFrame]:
    """OP-35: text after the *last* prefix, trimmed, split on ``|``, three ints.

    Lines without the prefix are rejects (the shared log holds other lines).
    ``keep`` names extra input columns to carry through (e.g. an offset).
    """
    payload = trim_controls(F.element_at(F.split(F.col("value"), re.escape(prefix)), -1))
    f = F.col("_f")
    parsed = (_split_once(lines, payload, "|", keep)
              .select("value", *keep, "_f", strict_int(F.get(f, 0)).alias("uid"),
                      strict_int(F.get(f, 1)).alias("mid"),
                      strict_int(F.get(f, 2), "bigint").alias("ts"))
              .select("value", *keep, "uid", "mid", "ts",
                      F.when(F.instr(F.col("value"), prefix) == 0, "no_prefix")
                       .when(F.size(f) < 3, "too_few_fields")
                       .when(F.col("uid").isNull() | F.col("mid").isNull() | F.col("ts").isNull(),
                             "not_an_int").alias("_reason")))
    return _finish(parsed, [*keep, "uid", "mid", "ts"], mode, keep)


def read_interactions(spark: SparkSession, path: str, mode: str = "permissive"):
    """OP-01 from text files."""
    return parse_interactions(spark.read.text(path), mode)


def read_catalog(spark: SparkSession, path: str, mode: str = "permissive"):
    """OP-02 from text files."""
    return parse_catalog(spark.read.text(path), mode)


def interaction_lines(w: DataFrame) -> DataFrame:
    """Text form ``uid,mid,weight`` of an interaction table."""
    return w.select(F.concat_ws(",", "uid", "mid", "weight").alias("value"))


def catalog_lines(c: DataFrame) -> DataFrame:
    """Text form ``mid,name,url`` of a catalog table."""
    return c.select(F.concat_ws(",", "mid", "name", "url").alias("value"))
