"""Table sources (OP-05) and adapters from the driver's parquet tables.

The adapters re-express the reference's inputs (interaction counts, a
catalog, item vectors, a click stream) over the given tables; every one is
a plain Spark projection/aggregation so its work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from encore.functions.columns import epoch_seconds


def read_table(spark: SparkSession, sf_dir: str, name: str,
               schema: StructType | None = None, suffix: str = ".parquet") -> DataFrame:
    """OP-05: typed load of a stored table (parquet)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.parquet(f"{sf_dir.rstrip('/')}/{name}{suffix}")


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x item play counts: ``uid=o_custkey, mid=l_partkey, weight=sum(qty)``."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").cast("int").alias("uid"),
                     F.col("l_partkey").cast("int").alias("mid"))
            .agg(F.sum("l_quantity").cast("bigint").alias("weight")))


def _events_k(spark: SparkSession, sf_dir: str, event_type: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return (ev.where(F.col("event_type") == event_type)
            .select("event_id", "ts",
                    F.col("user_id").cast("int").alias("uid"),
                    F.get_json_object("props", "$.k").cast("int").alias("mid")))


def base_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored ratings before any click: purchases counted per ``(uid, mid)``."""
    return (_events_k(spark, sf_dir, "purchase")
            .groupBy("uid", "mid").agg(F.count(F.lit(1)).alias("weight")))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Click events ``(event_id, uid, mid, ts)``; ``ts`` in whole seconds."""
    return (_events_k(spark, sf_dir, "click")
            .select("event_id", "uid", "mid", epoch_seconds("ts").alias("ts")))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item factor vectors ``(mid, v ARRAY<DOUBLE>)`` from ``embeddings``."""
    return (read_table(spark, sf_dir, "embeddings")
            .select(F.col("vec_id").cast("int").alias("mid"),
                    F.col("embedding").cast("array<double>").alias("v")))


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item catalog ``(mid, name, url)`` from ``part``."""
    p = read_table(spark, sf_dir, "part")
    mid = F.col("p_partkey").cast("int")
    return p.select(mid.alias("mid"), F.col("p_name").alias("name"),
                    F.concat(F.lit("/item/"), mid.cast("string")).alias("url"))


def event_log_lines(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """The service log as text: clicks carry the click message, other events
    are ordinary log lines without it.  Columns ``(event_id, value)``."""
    from encore.sources.text import format_click_line

    ev = read_table(spark, sf_dir, "events")
    stamp = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss,SSS")
    k = F.get_json_object("props", "$.k")
    click_msg = format_click_line(F.col("user_id"), k, epoch_seconds("ts"), prefix)
    other_msg = F.concat_ws(" ", F.col("event_type"), F.col("user_id").cast("string"), k)
    msg = F.when(F.col("event_type") == "click", click_msg).otherwise(other_msg)
    return ev.select("event_id", F.concat(stamp, F.lit("  INFO --- "), msg).alias("value"))
