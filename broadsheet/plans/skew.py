"""Membership joins against keys of a table.

No hint is given: the key side grows, so its side is chosen by its size. Both
sides are meant to be plain shuffled inputs (state read from files), which the
adaptive skew join splits on the left where one key holds many rows. A semi or
anti join needs no distinct keys on the right.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def member_join(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` of ``left`` against the keys of ``right``."""
    if how not in ("left_semi", "left_anti"):
        raise ValueError("how must be left_semi or left_anti")
    return left.join(right.select(key), key, how)


def mark_members(left: DataFrame, right: DataFrame, key: str, out: str) -> DataFrame:
    """All rows of ``left`` with a flag: is the key in ``right``. One join answers both ways."""
    joined = left.join(right.select(key).distinct().withColumn(out, F.lit(True)), key, "left")
    return joined.withColumn(out, F.coalesce(out, F.lit(False)))
