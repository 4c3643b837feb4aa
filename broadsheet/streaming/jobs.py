"""Incremental jobs over landed files: one ``availableNow`` run per schedule tick.

Every job has a checkpoint folder of its own, the same at every tick: it holds
which files were taken in, and its batch ids go on from tick to tick. Sinks that
keep state go through ``foreachBatch`` with the batch id as run id, so a batch that
is replayed after a lost executor or driver overwrites its own output, and a later
tick neither loses nor repeats rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import articles as A
from ..operators import state as S
from ..plans.daily import StateLog, run_daily, run_sweep_merge
from ..plans.ordered import last_wins
from ..plans.skew import member_join


def landed(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None) -> DataFrame:
    """Stream of files as they land. A cap on files bounds the size of one batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _run(stream: DataFrame, checkpoint: str, configure: Callable) -> None:
    writer = configure(stream.writeStream.option("checkpointLocation", checkpoint))
    writer.trigger(availableNow=True).start().awaitTermination()


def ingest(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append new rows to a parquet table, exactly once per landed file."""
    _run(stream, checkpoint, lambda w: w.format("parquet").option("path", out).outputMode("append"))


def ingest_recent(stream: DataFrame, out: str, checkpoint: str, as_of) -> None:
    """Keep rows of the last day at processing time; undated rows pass.

    This compares with the batch clock. A watermark would trail the newest event
    seen instead and has no rule for undated rows.
    """
    def batch(df: DataFrame, batch_id: int) -> None:
        A.recent(df, as_of).write.mode("overwrite").parquet(f"{out}/run={batch_id}")

    _run(stream, checkpoint, lambda w: w.foreachBatch(batch))


def daily_stream(
    stream: DataFrame, log: StateLog, checkpoint: str, as_of: Callable[[int], str], digest_of: Callable[[DataFrame], DataFrame],
    deliver: Callable[[DataFrame], bool] = lambda published: True, sweep_of: Callable[[int], DataFrame | None] = lambda batch_id: None,
) -> None:
    """Every batch is a daily run: dedup against the log, publish, then commit.

    ``sweep_of`` gives the signals of the sweep that is due with a batch, if one is;
    they become visible by the same commit, behind the same delivery.
    """
    def batch(df: DataFrame, batch_id: int) -> None:
        run_daily(log, df, batch_id, as_of(batch_id), digest_of, deliver, signals=sweep_of(batch_id))

    _run(stream, checkpoint, lambda w: w.foreachBatch(batch))


def dedup_within(stream: DataFrame, out: str, checkpoint: str, event_time: str, horizon: str = "7 days") -> None:
    """First row of each article key within an event-time horizon, bounded state.

    Unlike the exact dedup this also collapses duplicates inside a batch.
    """
    kept = stream.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(["article_key"])
    _run(kept, checkpoint, lambda w: w.format("parquet").option("path", out).outputMode("append"))


def sweep_stream(stream: DataFrame, log: StateLog, checkpoint: str, as_of) -> None:
    """Every batch is a sweep: flag fresh signals against the log, then merge. Runs are those of the job "sweep"."""
    log = log.of_job("sweep")

    def batch(df: DataFrame, batch_id: int) -> None:
        run_sweep_merge(log, df, batch_id, as_of)

    _run(stream, checkpoint, lambda w: w.foreachBatch(batch))


def daily_counts(stream: DataFrame, out: str, checkpoint: str, event_time: str, lateness: str = "1 day") -> None:
    """Rows per day and source, emitted when the day is closed by the watermark."""
    counts = (
        stream.withWatermark(event_time, lateness)
        .groupBy(F.window(event_time, "1 day").alias("w"), "source")
        .agg(F.count("*").alias("n_rows"))
        .select(F.col("w.start").alias("day"), "source", "n_rows")
    )
    _run(counts, checkpoint, lambda w: w.format("parquet").option("path", out).outputMode("append"))


def silent_sources(counts: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Registered feeds without rows, per day from the first to the last of ``counts``.

    The days come from the calendar, so one without any row is reported for every feed.
    """
    names = F.array(*[F.lit(s) for s in sources])
    span = counts.agg(F.min("day").cast("date").alias("a"), F.max("day").cast("date").alias("b")).filter("a IS NOT NULL")
    days = span.select(F.explode(F.sequence("a", "b")).alias("d"))
    expected = days.select(F.date_format("d", "yyyy-MM-dd").alias("day"), F.explode(names).alias("source"))
    return expected.join(counts, ["day", "source"], "left_anti")


def threads_stream(stream: DataFrame, log: StateLog, checkpoint: str, as_of: Callable[[int], str]) -> None:
    """Insert-if-absent per link with a lifetime: every batch adds the links the log does not hold.

    Of new duplicates the last in feed order is kept; a link comes back once its
    entry has outlived the retention. Runs are those of the job "threads".
    """
    log = log.of_job("threads")

    def batch(df: DataFrame, batch_id: int) -> None:
        now = as_of(batch_id)
        known = log.threads(batch_id, now).select(F.col("url").alias("link"))
        fresh = member_join(A.thread_articles(df), known, "link", "left_anti")
        latest = last_wins(fresh, ["link"], F.struct("feed_ord", "feed_pos"))
        log.write(S.build_threads(latest, now), "threads", batch_id, now)
        log.commit(batch_id)

    _run(stream, checkpoint, lambda w: w.foreachBatch(batch))
