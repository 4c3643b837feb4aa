"""Keyed state: sent articles, discussion threads, signal history, retained files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import html_to_text
from ..functions.text import WS, strip
from ..functions.times import days_before, epoch_seconds, moment
from ..plans.ordered import first_rows, last_wins
from ..plans.skew import member_join
from .articles import thread_articles

# Retention horizons and limits.
SENT_DAYS = 7
SIGNAL_DAYS = 45
AUDIO_DAYS = 10
MAX_THREADS = 20
SELFTEXT_LIMIT = 2000


def retained(state: DataFrame, column: str, as_of, days: int = SENT_DAYS) -> DataFrame:
    """Rows strictly younger than ``days``; rows without a time go."""
    return state.filter(F.col(column) > days_before(as_of, days))


def mark_sent(history: DataFrame, batch: DataFrame, as_of) -> DataFrame:
    """Upsert a delivered batch: one row per key, the last in feed order wins over all."""
    columns = ["article_key", "title", "link", "source", "sent_at"]
    old = history.select(*columns, F.lit(0).alias("_gen"), F.lit(0).alias("_ord"), F.lit(0).cast("bigint").alias("_pos"))
    new = batch.select(
        *columns[:4], moment(as_of).alias("sent_at"), F.lit(1).alias("_gen"),
        F.col("feed_ord").alias("_ord"), F.col("feed_pos").cast("bigint").alias("_pos"),
    )
    merged = last_wins(old.unionByName(new), ["article_key"], F.struct("_gen", "_ord", "_pos"))
    return merged.select(*columns)


def history_size(state: DataFrame) -> DataFrame:
    return state.agg(F.count("*").alias("n_rows"))


def selftext(summary: Column) -> Column:
    """Thread text of a feed summary: markup gone, submission trailer gone, cut."""
    text = html_to_text(F.coalesce(summary, F.lit("")), " ")
    tail = rf"(?d)[{WS}]*submitted by[{WS}]*/u/[^{WS}]+.*$"
    return F.left(strip(F.regexp_replace(text, tail, "")), F.lit(SELFTEXT_LIMIT))


def build_threads(articles: DataFrame, as_of) -> DataFrame:
    """Thread rows out of feed articles. Feeds carry no votes or comments."""
    created = F.coalesce(epoch_seconds(F.col("published")), F.lit(0)).cast("double")
    return articles.select(
        F.col("link").alias("url"),
        "title",
        selftext(F.col("summary")).alias("selftext"),
        F.lit("").alias("author"),
        F.lit(0).alias("score"),
        F.lit(0).alias("num_comments"),
        F.regexp_extract("link", r"reddit\.com/r/([^/]+)/", 1).alias("subreddit"),
        created.alias("created_utc"),
        F.array().cast("array<string>").alias("top_comments"),
        moment(as_of).alias("fetched_at"),
    )


def uncached(articles: DataFrame, cached: DataFrame) -> DataFrame:
    """Thread articles whose link is not cached. Duplicate links all stay."""
    return member_join(thread_articles(articles), cached.select(F.col("url").alias("link")), "link", "left_anti")


def uncached_threads(articles: DataFrame, cached: DataFrame, run: list[str], n: int = MAX_THREADS) -> DataFrame:
    """First n thread articles of a run that are not cached, in article order.

    Duplicate links are not collapsed here: each takes one of the n places.
    """
    return first_rows(uncached(articles, cached), run, ["feed_ord", "feed_pos"], n)


def add_threads(existing: DataFrame, articles: DataFrame, as_of, n: int = MAX_THREADS) -> DataFrame:
    """Insert absent threads. Cached rows never change; of new duplicates the last wins."""
    run = articles.withColumn("_run", F.lit(0))
    picked = uncached_threads(run, existing, ["_run"], n).drop("_run")
    latest = last_wins(picked, ["link"], F.struct("feed_ord", "feed_pos"))
    return existing.unionByName(build_threads(latest, as_of))


def merge_signals(history: DataFrame, batch: DataFrame, as_of, days: int = SIGNAL_DAYS) -> DataFrame:
    """Rolling signal history: later rows replace earlier ones whole, then the horizon applies.

    Rows need ``seq``; history comes before the batch. ``first_seen`` is the order
    of first appearance, which the output keeps. Retention is by day, inclusive.
    """
    keep = [c for c in history.columns]
    rows = history.withColumn("_gen", F.lit(0)).unionByName(batch.select(*keep).withColumn("_gen", F.lit(1)))
    with_id = rows.filter(F.coalesce("id", F.lit("")) != "")
    merged = last_wins(with_id, ["id"], F.struct("_gen", "seq"), first_seen="first_seen").drop("_gen")
    cutoff = F.date_format(days_before(as_of, days), "yyyy-MM-dd")
    return merged.filter(F.coalesce("date", F.lit("")) >= cutoff)


def expired_audio(files: DataFrame, as_of, keep_days: int = AUDIO_DAYS) -> DataFrame:
    """Dated episode files to remove, and undatable ones to report.

    ``files`` has ``name``. A file whose name holds today's date is left out; a
    file exactly ``keep_days`` old has expired.
    """
    name = F.col("name")
    today = F.date_format(moment(as_of), "yyyy-MM-dd")
    episodes = files.filter(name.rlike(r"^digest-.*\.mp3$") & ~F.contains(name, today))
    stem = F.regexp_replace(F.regexp_replace(name, r"\.mp3$", ""), "digest-", "")
    day = F.when(stem.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(stem, "yyyy-M-d"))
    return episodes.select(
        "name", day.alias("file_date"),
        F.when(day.isNull(), "unreadable")
        .when(day.cast("timestamp_ntz") < days_before(as_of, keep_days), "expired")
        .otherwise("kept").alias("status"),
    )


def expired_logs(files: DataFrame, base: str, as_of, days: int) -> DataFrame:
    """Rotated logs (``base.*``) last modified before the horizon; never ``base`` itself.

    ``files`` has ``name`` and ``modified``. A horizon of zero or less keeps all.
    """
    rotated = files.filter(F.startswith("name", F.lit(base + ".")))
    if days <= 0:
        return rotated.limit(0)
    return rotated.filter(F.col("modified") < days_before(as_of, days))
