"""Article intake: field rules, recency, per-source top-k, dedup against history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import content_key
from ..functions.times import days_before, parse_feed_date
from ..plans.ordered import first_rows
from ..plans.skew import member_join

# Fixed values of the intake contract.
SUMMARY_LIMIT = 500
MAX_PER_SOURCE = 20
NO_TITLE = "No title"
STORY_FEED = "Hacker News"
STORY_SOURCE = "Hacker News (Top)"
STORY_FEED_ORD = 2**31 - 1
THREAD_HOST = "reddit.com"


def published_at(published: Column, updated: Column) -> Column:
    """Published time, else updated time, else null, in UTC at second precision."""
    return F.coalesce(parse_feed_date(published), parse_feed_date(updated))


def article_summary(summary: Column, description: Column) -> Column:
    """Summary when present (also when empty), else description, cut to 500 code points."""
    return F.left(F.coalesce(summary, description, F.lit("")), F.lit(SUMMARY_LIMIT))


def items_to_articles(items: DataFrame) -> DataFrame:
    """Raw feed items to article rows with the field defaults applied."""
    return items.select(
        F.coalesce("title", F.lit(NO_TITLE)).alias("title"),
        F.coalesce("link", F.lit("")).alias("link"),
        article_summary(F.col("summary"), F.col("description")).alias("summary"),
        "source",
        published_at(F.col("published"), F.col("updated")).alias("published"),
        "feed_ord",
        "feed_pos",
    )


def recent(articles: DataFrame, as_of, column: str = "published") -> DataFrame:
    """Drop what is older than a day. Undated and future rows stay, so does the boundary."""
    c = F.col(column)
    return articles.filter(c.isNull() | (c >= days_before(as_of, 1)))


def top_per_source(articles: DataFrame, as_of, k: int = MAX_PER_SOURCE) -> DataFrame:
    """First 2k entries of a feed, then recency, then the first k of what is left.

    The order of the steps is the contract: a fresh entry behind position 2k is
    lost. The second ranking reuses the partitioning of the first.
    """
    head = first_rows(articles, ["source"], ["feed_pos"], 2 * k)
    return first_rows(recent(head, as_of), ["source"], ["feed_pos"], k)


def intake(items: DataFrame, as_of, k: int = MAX_PER_SOURCE) -> DataFrame:
    """``top_per_source`` for raw feed items.

    The first 2k entries of a feed are taken before dates are parsed and texts
    are cut, so only rows that can still count pay for that work.
    """
    head = items_to_articles(first_rows(items, ["source"], ["feed_pos"], 2 * k))
    return first_rows(recent(head, as_of), ["source"], ["feed_pos"], k)


def with_article_key(articles: DataFrame) -> DataFrame:
    return articles.withColumn("article_key", content_key(F.col("title"), F.col("link")))


def accepted_items(items: DataFrame, fetches: DataFrame) -> DataFrame:
    """Items of feeds that answered 200. A malformed feed keeps the items it yielded."""
    answered = fetches.filter(F.col("status") == 200).select("source")
    return items.join(answered, "source", "left_semi")


def feed_health(feeds: DataFrame, fetches: DataFrame, items: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """One row per registered feed with its status and accepted row count; feeds never fetched included.

    ``errors`` (source, state) adds how many items were lost and how many were recovered.
    """
    counts = rows_per_source(feeds, accepted_items(items, fetches))
    n = F.col("n_rows")
    status = (
        F.when(F.col("status").isNull(), "not_fetched")
        .when(F.col("status") != 200, "http_error")
        .when(F.col("malformed") & (n == 0), "malformed_empty")
        .when(F.col("malformed"), "malformed_kept")
        .when(n == 0, "empty")
        .otherwise("ok")
    )
    joined = counts.join(fetches, "source", "left")
    extra = []
    if errors is not None:
        states = errors.groupBy("source").agg(*[F.count_if(F.col("state") == s).alias(f"n_{s}") for s in ("lost", "recovered")])
        joined = joined.join(states, "source", "left")
        extra = [F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_lost", "n_recovered")]
    return joined.select("source", status.alias("health"), "n_rows", *extra)


def union_sources(feed_articles: DataFrame, story_articles: DataFrame) -> DataFrame:
    """All feeds in registry order, the story API last and its feed twin left out."""
    feeds = feed_articles.filter(F.col("source") != STORY_FEED)
    return feeds.unionByName(story_articles)


def rows_per_source(feeds: DataFrame, articles: DataFrame) -> DataFrame:
    """Row count per registered feed, zeros included."""
    counts = articles.groupBy("source").agg(F.count("*").alias("n_rows"))
    return feeds.select("source").join(counts, "source", "left").select(
        "source", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows")
    )


def thread_articles(articles: DataFrame) -> DataFrame:
    """Rows that link to the discussion site, whatever their source."""
    return articles.filter(F.contains("link", F.lit(THREAD_HOST)))


def not_sent(articles: DataFrame, sent: DataFrame) -> DataFrame:
    """Articles whose key is not in the history. Duplicates inside the batch all stay.

    No broadcast hint: the history grows, so its side is chosen by size.
    """
    return member_join(articles, sent, "article_key", "left_anti")


def already_sent(articles: DataFrame, sent: DataFrame) -> DataFrame:
    """The rows ``not_sent`` removes."""
    return member_join(articles, sent, "article_key", "left_semi")


def skip_report(articles: DataFrame, sent: DataFrame) -> DataFrame:
    """Skipped rows with the title cut the way the run report shows it."""
    return already_sent(articles, sent).select(
        "article_key", F.left("title", F.lit(50)).alias("title"), "source"
    )
