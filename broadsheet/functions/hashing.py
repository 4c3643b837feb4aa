"""Stable bucket assignment from a 128-bit digest."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_mod(text: Column, n: int) -> Column:
    """``int(md5(text)) mod n`` over all 128 bits, for ``1 <= n < 2**31``.

    The digest is folded 32 bits at a time: each step stays below 2**63, so the
    result is exact in BIGINT and the whole expression is code-generated.
    """
    if not 1 <= n < 2**31:
        raise ValueError("n must be between 1 and 2**31 - 1")
    digest = F.md5(text)
    rest = F.lit(0).cast("bigint")
    for start in (1, 9, 17, 25):
        word = F.conv(F.substring(digest, start, 8), 16, 10).cast("bigint")
        rest = (rest * F.lit(2**32) + word) % F.lit(n)
    return rest
