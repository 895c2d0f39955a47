"""Column expressions shared by the operators; all JVM-side built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INT_TEXT = r"\A[+-]?[0-9]+\z"


def trim_controls(c: Column) -> Column:
    """Drop every character up to U+0020 at both ends (blanks, tabs, controls)."""
    return F.regexp_replace(c, r"\A[\x00-\x20]+|[\x00-\x20]+\z", "")


def strict_int(c: Column, to: str = "int") -> Column:
    """Whole-number text to an integer, NULL when it is not one.

    Plain ``try_cast`` would also accept padded or fractional text; the
    readers we mirror accept only optional sign plus digits.
    """
    return F.when(c.rlike(_INT_TEXT), c.try_cast(to))


def md5_bucket(cols: list, seed: int, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from ``md5(c1|c2|...|seed)``.

    First 8 hex digits read as an unsigned number, modulo ``buckets``; the
    same rule is easy to state in any SQL engine.
    """
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in cols], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(buckets))


def epoch_seconds(name: str) -> Column:
    """Whole seconds since 1970 of the TIMESTAMP_NTZ column ``name``,
    independent of the session time zone."""
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{name}`)")
