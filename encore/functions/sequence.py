"""Position of each row inside its key, safe when one key is huge.

A plain ``row_number() over (partition by key order by ...)`` sorts a key's
rows inside one task; a user holding a third of all clicks would make that
task hold a third of the table.  Instead we range-partition on
``(key, order...)`` so a hot key is spread over many contiguous slices,
number rows inside each ``(key, slice)``, and add the counts of the key's
earlier slices.  Every group that is sorted or windowed is bounded by a
slice, and the per-slice count table has at most ``keys + slices`` rows.

Range bounds come from sampling whose seed changes with every execution, so
the slice-tagged rows are written once (``materialize``) and both the
numbering and the counts are derived from that one copy; otherwise two
executions of the range exchange could cut the slices differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from encore.session import materialize


def sequence_within(df: DataFrame, key: str, order: list[str], out: str = "seq",
                    slices: int | None = None) -> DataFrame:
    """Add ``out``: 1-based position of the row within ``key`` by ``order``.

    ``order`` must be a total order inside a key (e.g. ``ts, event_id``).
    """
    spark = df.sparkSession
    n = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(df.repartitionByRange(n, key, *order)
                         .withColumn("_slice", F.spark_partition_id()))
    local = ranged.withColumn(
        "_local", F.row_number().over(Window.partitionBy(key, "_slice").orderBy(*order)))
    counts = ranged.groupBy(key, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = (Window.partitionBy(key).orderBy("_slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(key, "_slice",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(offsets, [key, "_slice"])
            .withColumn(out, (F.col("_local") + F.col("_off")).cast("bigint"))
            .drop("_slice", "_local", "_off"))
