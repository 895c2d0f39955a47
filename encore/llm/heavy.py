"""Joins by a key that may hold a third of all rows.

The other side has a few rows a key.  Keys that hold a share of the rows are
few by that very share, so their rows of the other side have a proven bound and
are broadcast: no row of a heavy key is shuffled.  All other keys meet in an
ordinary shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.session import materialize

MOST_KEYS = 1000       # a heavy key holds at least this part of all rows, so there are no more


def heavy_keys(rows: DataFrame, key: str, most: int = MOST_KEYS) -> DataFrame:
    """The keys that hold at least one in ``most`` rows: at most ``most`` keys."""
    total = rows.count()
    return materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
                       .where(F.col("_c") * F.lit(most) >= F.lit(total)).select(key), "heavy")


def join_by_key(rows: DataFrame, table: DataFrame, key: str, heavy: DataFrame, how: str = "inner") -> DataFrame:
    """``rows`` joined (``inner`` or ``left_semi``) with ``table``, which has a
    bounded number of rows a key; ``heavy`` comes from ``heavy_keys`` of these rows."""
    if how not in ("inner", "left_semi"):
        raise ValueError(f"no {how!r} join by heavy keys")
    listed = F.broadcast(heavy.select(key))
    light = rows.join(listed, key, "left_anti").join(table.join(listed, key, "left_anti"), key, how)
    return light.unionByName(rows.join(F.broadcast(table.join(listed, key, "left_semi")), key, how))
