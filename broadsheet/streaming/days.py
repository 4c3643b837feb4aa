"""Days that close: counts per feed, and an alert for every feed and day without rows, each once.

A stream emits nothing for what did not happen, and a day without any row closes no
window. So the job keeps a frontier, the first day that is still open, in the state
log, and moves it by the newest event time. What the frontier passes is filled up
with zeros from the feed table and written once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.statelog import StateLog
from ..session import remove
from .jobs import _run

OPEN = T.StructType([T.StructField("date", T.DateType()), T.StructField("source", T.StringType()), T.StructField("n_rows", T.LongType())])
CLOSED = T.StructType([*OPEN.fields, T.StructField("alert", T.StringType())])
LATE = OPEN
FRONTIER = T.StructType([T.StructField("frontier", T.DateType()), T.StructField("newest", T.LongType())])

#: Message for a feed that had no row on a day.
SILENT = "no articles"


def close_days(
    log: StateLog, rows: DataFrame, run: int, feeds: DataFrame, event_time: str, lateness: str = "1 day", as_of=None
) -> None:
    """Count a drop and close the days whose end is ``lateness`` behind the newest event seen.

    ``rows`` has ``source`` and ``event_time``; rows without a time count for no day and don't move
    the frontier, and neither do rows dated after ``as_of``, which wait for their day. ``feeds`` (``source``) says
    who is expected as of now; sources outside it, null among them, are counted and raise no
    alert. Days begin with the first one of the first drop that has any; what is older than that is late.
    Written per run: ``closed`` (date, source, n_rows, alert), ``late`` (rows
    of days closed before, which reopen nothing), ``open`` (counts of days still open, the whole
    carry to the next run) and the frontier. A repeated run overwrites its own.

    A run reads its drop, the open counts of one run and one row of frontier, so its
    cost does not grow with the history. Rows of a hot feed collapse on the map side.
    """
    spark = log.spark
    happened = F.lit(True) if as_of is None else F.col(event_time).cast("timestamp") <= F.lit(as_of).cast("timestamp")
    log.write(
        rows.filter(F.col(event_time).isNotNull()).groupBy(F.to_date(event_time).alias("date"), "source").agg(
            F.count(F.lit(1)).alias("n_rows"), F.max(F.when(happened, F.unix_micros(F.col(event_time).cast("timestamp")))).alias("newest")),
        "drop", run)
    drop = log.written("drop", run)

    # One row: the state of the last run moved by the extent of this drop.
    nothing = F.lit(None)
    before = log.read("frontier", FRONTIER, run).select("run", "frontier", nothing.cast("date").alias("first"), "newest")
    extent = drop.select(nothing.cast("bigint").alias("run"), nothing.cast("date").alias("frontier"), F.when(F.col("newest").isNotNull(), F.col("date")).alias("first"), "newest")
    passed = F.to_date(F.timestamp_micros(F.col("newest")) - F.expr(f"INTERVAL {lateness}"))
    at = before.unionByName(extent).agg(
        F.max("run").alias("last"), F.coalesce(F.max("frontier"), F.min("first")).alias("old"), F.max("newest").alias("newest"),
    ).select("last", "old", F.greatest("old", passed).alias("new"), "newest").collect()[0]
    old, new = F.lit(at["old"]).cast("date"), F.lit(at["new"]).cast("date")

    is_late = F.coalesce(F.col("date") < old, F.lit(False))
    log.write(drop.filter(is_late).select(*LATE.fieldNames()), "late", run)
    carried = log.read("open", OPEN, run).filter(F.col("run") == F.lit(-1 if at["last"] is None else at["last"]))
    counts = carried.select(*OPEN.fieldNames()).unionByName(drop.filter(~is_late).select(*OPEN.fieldNames()))
    closes = F.coalesce(F.col("date") < new, F.lit(False))
    log.write(counts.filter(~closes).groupBy("date", "source").agg(F.sum("n_rows").alias("n_rows")), "open", run)

    # Every expected feed on every day between the frontiers; none if it stands still.
    days = F.filter(F.sequence(old, new), lambda d: d < new)
    names = feeds.select("source").filter(F.col("source").isNotNull()).distinct()
    expected = names.select(F.explode(days).alias("date"), "source", F.lit(0).cast("bigint").alias("n_rows"))
    filled = expected.unionByName(counts.filter(closes)).groupBy("date", "source").agg(F.sum("n_rows").alias("n_rows"))
    log.write(filled.withColumn("alert", F.when(F.col("n_rows") == 0, SILENT)), "closed", run)
    log.write(spark.createDataFrame([(at["new"], at["newest"])], FRONTIER), "frontier", run)
    log.commit(run)
    remove(spark, log.path("drop", run))


def closing_days(
    stream: DataFrame, log: StateLog, checkpoint: str, feeds: DataFrame, event_time: str, lateness: str = "1 day",
    as_of: Callable[[int], str | None] = lambda batch_id: None,
) -> None:
    """Every batch counts and closes; runs are those of the job "days"."""
    log = log.of_job("days")

    def batch(df: DataFrame, batch_id: int) -> None:
        close_days(log, df, batch_id, feeds, event_time, lateness, as_of(batch_id))

    _run(stream, checkpoint, lambda w: w.foreachBatch(batch))


def closed_days(log: StateLog, before: int = 2**31) -> DataFrame:
    """date, source, n_rows and alert of all days closed so far."""
    return log.of_job("days").read("closed", CLOSED, before).drop("run")
