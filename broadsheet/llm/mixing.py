"""Mixing sources to target weights along a time-varying curriculum.

Each source gets a target: its weight's share of ``share`` times all words, at
most ``repeats`` times its own size; what is above that is shared again among the
others by weight. The source's documents, in an order drawn from a digest of
their ids, are laid end to end on a line of words and the line is repeated until
the target is reached; the last document taken is cut there.

A source's weight changes over training time t in [0, 1] as
``1 + tilt * (2t - 1)`` times its weight. The integral of that schedule is the
part of its target that is due by t, so inverting it at a document's place on the
line gives the document's training position. Sorting by position by ranges of the
key gives the curriculum.

Running sums are made in chunks of the digest, so no source is ever in one task.

Null and empty texts have size 0 and are never taken. A null source is a source,
last in order. Rows with equal ids are ordered by size; equal rows are
interchangeable. An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.frames import settle
from broadsheet.plans.ordered import running_totals

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
TILTS = (-0.5, 0.0, 0.5)
#: 60 bits of the digest, in 4,096 chunks per source.
CHUNK = 1 << 48
#: Sources up to which their table is broadcast, some hundred bytes each.
FEW_SOURCES = 10_000


def _cycle(values: Sequence, i: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (i % len(values) + 1).cast("int"))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, tilts: Sequence[float] = TILTS,
    share: tuple[int, int] = (3, 2), repeats: int = 2,
) -> DataFrame:
    """source, source_no, source_size, tilt, target per source of (source, size) rows.

    ``share`` is a fraction. One row per source; the windows run over these alone.
    """
    up, down = share
    every = F.lit(0)
    at = Window.partitionBy(every).orderBy(F.col("source").asc_nulls_last())
    per = (
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
        .withColumn("source_no", F.row_number().over(at) - 1)
        .withColumn("w", _cycle(weights, F.col("source_no")).cast("bigint"))
        .withColumn("cap", F.col("source_size") * repeats)
        .withColumn("total", F.sum("source_size").over(Window.partitionBy(every)))
    )
    # Sources fill up in the order of cap / w: each takes what its weight gives it of
    # what the full ones before it left.
    order = Window.partitionBy(every).orderBy(F.col("cap") / F.col("w"), "source_no")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.partitionBy(every)
    rest = F.col("total") * up - F.coalesce(F.sum("cap").over(before), F.lit(0)) * down
    per = (
        per.withColumn("rest", rest).withColumn("weights", F.sum("w").over(after))
        .withColumn("full", F.col("w") * F.col("rest").cast("double") > F.col("cap").cast("double") * F.col("weights") * down)
        .withColumn("taken_caps", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0)).over(all_rows))
        .withColumn("open_weights", F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(all_rows))
    )
    share_of_rest = F.col("w") * (F.col("total") * up - F.col("taken_caps") * down) / (F.col("open_weights") * down)
    return per.select(
        "source", "source_no", "source_size", _cycle(tilts, F.col("source_no")).alias("tilt"),
        F.when(F.col("full"), F.col("cap").cast("double")).otherwise(share_of_rest).alias("target"),
    )


def _digest(key: Column) -> Column:
    """60 bits that depend on the key alone and are the same in every engine."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":mix"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def position(done: Column, target: Column, tilt: Column) -> Column:
    """Training time at which ``done`` words of ``target`` are due."""
    u = done / target
    k = F.lit(1.0) - tilt
    return F.lit(2.0) * u / (k + F.sqrt(k * k + F.lit(4.0) * tilt * u))


def mix(docs: DataFrame, keep_row: bool = False, **targets) -> DataFrame:
    """doc_id, size, source_size, target, taken, position, position_again for every row.

    The positions are those of the first and the second copy, null where none is
    taken. ``keep_row`` adds the whole input row as the struct ``row``.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")
    thin = settle(docs.select("doc_id", "source", size), "mix-sizes")
    known = settle(source_targets(thin.select("source", "size"), **targets).withColumnRenamed("source", "_source"), "mix-targets")
    # Few sources go to every task; with more, rows meet their source by a shuffle.
    few = known.limit(FEW_SOURCES + 1).count() <= FEW_SOURCES

    def placed(rows: DataFrame) -> DataFrame:
        joined = rows.join(F.broadcast(known) if few else known, F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
        return joined.withColumn("_digest", _digest(F.col("doc_id")))

    # Whole rows are dealt out once, by source and chunk; all sums come from the thin table.
    rows = placed(docs.select("doc_id", "source", size, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")) if keep_row else thin)
    summed = running_totals(
        rows, ["source_no"], "_digest", {"_end": F.col("size")}, ["doc_id", "size"], CHUNK, placed(thin) if keep_row else None)
    limit, size = F.floor(F.col("target")).cast("bigint"), F.col("size")
    start, none = F.col("_end") - size, F.lit(0).cast("bigint")
    second = start + F.col("source_size")
    first, again = (F.greatest(none, F.least(size, limit - at)) for at in (start, second))
    at = [F.when(n > 0, position(a.cast("double"), F.col("target"), F.col("tilt"))) for n, a in ((first, start), (again, second))]
    return summed.select(
        "doc_id", "size", "source_size", "target", (first + again).alias("taken"),
        at[0].alias("position"), at[1].alias("position_again"), *(["row"] if keep_row else []),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The documents of the mix in curriculum order, each as often as it is taken.

    Documents stay whole: the one that the end of its source's target cuts counts
    as taken if at least half of it is.
    """
    m = mix(docs, keep_row=True)
    copies = F.round(F.col("taken") / F.greatest(F.col("size"), F.lit(1))).cast("int")
    parts = m.select("row", F.explode(F.slice(F.array("position", "position_again"), F.lit(1), copies)).alias("at"))
    return parts.orderBy("at", "row.doc_id").select("row.*")
