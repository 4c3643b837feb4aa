"""Ordered computations over groups of any size.

A plain running window puts a whole group into one task. Here the group is cut
into chunks of its integer order column: windows run inside chunks, one row per
chunk carries the total (or last value) on, and a join brings the offset back.
The largest single-task input shrinks from n rows to max(chunk, n / chunk).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

CHUNK = 1 << 16


def _chunk(order: str, size: int) -> Column:
    return F.floor(F.col(order) / F.lit(size)).cast("bigint")


def running_totals(
    df: DataFrame,
    group: Sequence[str],
    order: str,
    values: Mapping[str, Column],
    ties: Sequence[str] = (),
    chunk: int = CHUNK,
    thin: DataFrame | None = None,
) -> DataFrame:
    """Add inclusive running sums of ``values`` per group in ``order``.

    ``order`` is an integer column; ``ties`` order rows that share its value.
    ``thin`` holds the same rows with the columns named here alone; where ``df``
    carries more, the sums of whole chunks are taken from it.
    """
    base = df.withColumn("_chunk", _chunk(order, chunk))
    inner = (
        Window.partitionBy(*group, "_chunk").orderBy(order, *ties)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = base.withColumns({name: F.sum(v).over(inner) for name, v in values.items()})
    before = (
        Window.partitionBy(*group).orderBy("_chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    summed = base if thin is None else thin.withColumn("_chunk", _chunk(order, chunk))
    totals = summed.groupBy(*group, "_chunk").agg(*[F.sum(v).alias(f"_t_{n}") for n, v in values.items()])
    offsets = totals.select(
        *group, "_chunk",
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in values],
    )
    joined = local.join(offsets, [*group, "_chunk"])
    return joined.select(
        *[c for c in df.columns if c not in values],
        *[(F.col(n) + F.col(f"_o_{n}")).alias(n) for n in values],
    )


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Add each row's number, from 1, per group in an order of any columns.

    Rows are dealt out by ranges of group and order and written once; counts per range
    give each its first number, so a group of any size is spread over tasks.
    """
    keys = [*[F.col(g).asc_nulls_first() for g in group], *order]
    laid = settle(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys)
        .select("*", F.monotonically_increasing_id().alias("_at"), F.spark_partition_id().alias("_range")), "laid")
    spans = laid.groupBy(*group, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    same = F.col("l._range") == F.col("s._range")
    for g in group:
        same = same & F.col(f"l.{g}").eqNullSafe(F.col(f"s.{g}"))
    joined = laid.alias("l").join(spans.alias("s"), same)
    number = F.col("l._at") - F.col("s._first") + F.col("s._before") + 1
    return joined.select(*[F.col(f"l.`{c}`") for c in df.columns], number.alias(name))


def previous_value(
    df: DataFrame, group: Sequence[str], order: str, value: str, out: str, chunk: int = CHUNK
) -> DataFrame:
    """Add ``value`` of the row before, per group in ``order`` (unique integers).

    The value must not be null, so a null in ``out`` marks the first row.
    """
    base = df.withColumn("_chunk", _chunk(order, chunk))
    local = base.withColumn(
        out, F.lag(value).over(Window.partitionBy(*group, "_chunk").orderBy(order))
    )
    last = base.groupBy(*group, "_chunk").agg(F.max_by(value, order).alias("_last"))
    carried = last.select(
        *group, "_chunk",
        F.lag("_last").over(Window.partitionBy(*group).orderBy("_chunk")).alias("_carried"),
    )
    joined = local.join(carried, [*group, "_chunk"])
    return joined.select(*df.columns, F.coalesce(out, "_carried").alias(out))


def surrounding(asked: DataFrame, marks: DataFrame) -> DataFrame:
    """The nearest marks around each ``at`` of ``asked``: ``at``, ``before`` and ``after``, each a struct (at, mark) or null.

    A mark at the very place is both. ``marks`` has ``at`` and ``mark``, which must not be null; the
    smallest of a place counts. The sorted union is dealt out by ranges and written
    once. Inside a range the last mark is carried on and back by running windows; one
    row per range carries it across, so no task holds more than a range.
    """
    places = asked.select("at", F.lit(None).cast(marks.schema["mark"].dataType).alias("mark"), F.lit(True).alias("asked")).unionByName(
        marks.select("at", "mark", F.lit(False).alias("asked")))
    single = places.groupBy("at").agg(F.min("mark").alias("mark"), F.bool_or("asked").alias("asked"))
    point = F.when(F.col("mark").isNotNull(), F.struct("at", "mark"))
    laid = settle(
        single.repartitionByRange("at").select("at", "asked", point.alias("point"), F.spark_partition_id().alias("_range")), "places")
    ends = laid.groupBy("_range").agg(F.min("point").alias("_first"), F.max("point").alias("_last"))
    # One row per range.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        "_range", F.last("_last", ignorenulls=True).over(earlier).alias("_on"), F.last("_first", ignorenulls=True).over(later).alias("_back"))
    # Running frames only: a frame that ends with its range would be walked anew for every row.
    up = Window.partitionBy("_range").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = Window.partitionBy("_range").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = laid.select(
        "at", "asked", "_range", F.last("point", ignorenulls=True).over(up).alias("before"), F.last("point", ignorenulls=True).over(down).alias("after"))
    return local.filter("asked").join(carried, "_range").select(
        "at", F.coalesce("before", "_on").alias("before"), F.coalesce("after", "_back").alias("after"))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    The optimizer rewrites a filter on a derived column by repeating its whole
    expression below the projection. A one-element explode keeps the filter above
    the value, still inside code generation and without a shuffle.
    """
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.explode(F.array(value)).alias(name))


def first_rows(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int, rank: str | None = None
) -> DataFrame:
    """First ``n`` rows per group.

    ``row_number() <= n`` lets Spark keep at most n rows per group and map task
    before the shuffle, so a hot group never arrives whole in one task.
    """
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= n)
    return kept if rank else kept.drop(name)


def last_wins(df: DataFrame, key: Sequence[str], order: Column, first_seen: str | None = None) -> DataFrame:
    """One row per key: the one with the greatest ``order``.

    An aggregate, so copies of a hot key collapse before the shuffle.
    ``first_seen`` adds the smallest order of the key, the place where it first
    appeared.
    """
    rest = [c for c in df.columns if c not in key]
    aggs = [F.max_by(F.struct(*rest), order).alias("_row")]
    if first_seen:
        aggs.append(F.min(order).alias(first_seen))
    picked = df.groupBy(*key).agg(*aggs)
    extra = [first_seen] if first_seen else []
    out = picked.select(*key, *[F.col("_row")[c].alias(c) for c in rest], *extra)
    return out.select(*df.columns, *extra)
