"""Catalog lookups: newest entry per family and nearest size bucket, from a literal or from a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import parse_size
from ..plans.ordered import surrounding

# Read timeout in seconds per size bucket, and the one used without a size.
TIMEOUT_BY_SIZE = {8: 600, 14: 900, 30: 1200}
DEFAULT_TIMEOUT = 600


def latest_per_family(entries: DataFrame, families: Sequence[str]) -> DataFrame:
    """Newest id per family, null when a family has none.

    An entry belongs to every family its id contains, ignoring case. As soon as
    one entry of a family is dated, undated ones do not count; otherwise the
    greatest id wins. ``entries`` has ``id`` and ``created`` (null if undated).
    All families are found in one pass with one aggregate.
    """
    lowered = F.lower("id")
    literal = F.array(*[F.lit(f) for f in families])
    matched = entries.filter(F.coalesce("id", F.lit("")) != "").select(
        "id", "created",
        F.explode(F.filter(literal, lambda f: F.contains(lowered, F.lower(f)))).alias("family"),
    )
    newest = matched.groupBy("family").agg(
        F.max(F.when(F.col("created").isNotNull(), F.struct("created", "id"))).alias("_dated"),
        F.max("id").alias("_any"),
    )
    asked = entries.sparkSession.range(1).select(F.explode(literal).alias("family"))
    return asked.join(newest, "family", "left").select(
        "family", F.coalesce(F.col("_dated.id"), F.col("_any")).alias("id")
    )


def nearest(value: Column, buckets: Mapping[float, int], default: int) -> Column:
    """Value of the bucket closest to ``value``; the smaller bucket wins a tie.

    The bucket table is a literal, so the lookup is an expression and not a join.
    """
    options = F.array(*[
        F.struct(F.abs(F.lit(float(b)) - value).alias("gap"), F.lit(float(b)).alias("bucket"), F.lit(v).alias("value"))
        for b, v in buckets.items()
    ])
    return F.when(value.isNull(), F.lit(default)).otherwise(F.array_min(options)["value"])


def nearest_in(df: DataFrame, value: str, buckets: DataFrame, bucket: str, found: str, default: Column, out: str) -> DataFrame:
    """``df`` with the column ``found`` of the bucket closest to its ``value``, as ``out``; the smaller bucket wins a tie.

    For bucket tables of any size. Of rows that share a bucket the smallest ``found`` counts.
    Null and non-finite values get ``default``, and so does every row where there is
    no bucket; null and non-finite buckets and those without a ``found`` are none.
    Only distinct values look for their bucket, so one with a third of all rows is
    searched once; it comes back by a join whose other side has one row per value.
    """
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    # Adding zero makes one value of the two zeros.
    key = F.col(value).cast("double") + F.lit(0.0)
    asked = df.select(key.alias("at")).filter(finite(F.col("at"))).distinct()
    marks = buckets.select((F.col(bucket).cast("double") + F.lit(0.0)).alias("at"), F.col(found).alias("mark"))
    near = surrounding(asked, marks.filter(finite(F.col("at")) & F.col("mark").isNotNull()))
    below, above = F.col("at") - F.col("before.at"), F.col("after.at") - F.col("at")
    pick = F.when(F.col("before").isNull() | (above < below), F.col("after.mark")).otherwise(F.col("before.mark"))
    picked = near.select(F.col("at").alias("_at"), pick.alias("_found"))
    # Rows without a value meet nothing; they are spread instead of sharing one key.
    rows = df.withColumn("_key", F.when(finite(key), key)).alias("r")
    joined = rows.join(picked.alias("p"), F.col("r._key") == F.col("p._at"), "left")
    kept = [F.col(f"r.`{c}`") for c in df.columns if c != out]
    return joined.select(*kept, F.coalesce("p._found", default).alias(out))


def timeout_for(name: Column) -> Column:
    """Timeout of a model name by the size it states."""
    return nearest(parse_size(name), TIMEOUT_BY_SIZE, DEFAULT_TIMEOUT)
