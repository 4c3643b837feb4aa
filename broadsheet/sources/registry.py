"""Small reference tables that ship with the job."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..schemas import FEED


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A table of rows that are part of the program.

    Built through Arrow it stays a local relation, so the optimizer knows its
    exact size and decides by that whether a join broadcasts it.
    """
    names = schema.fieldNames()
    columns = {n: [r[i] for r in rows] for i, n in enumerate(names)}
    arrow = pa.Table.from_pydict(columns, schema=to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema=schema)


# Feeds in reading order, by category.
FEEDS = {
    "Tech & AI": [
        ("Hacker News", "https://hnrss.org/frontpage"),
        ("TechCrunch", "https://techcrunch.com/feed/"),
        ("TechCrunch AI", "https://techcrunch.com/category/artificial-intelligence/feed/"),
        ("Ars Technica", "https://feeds.arstechnica.com/arstechnica/index"),
        ("The Verge", "https://www.theverge.com/rss/index.xml"),
        ("MIT Tech Review", "https://www.technologyreview.com/feed/"),
        ("VentureBeat AI", "https://venturebeat.com/category/ai/feed/"),
        ("The Information", "https://www.theinformation.com/feed"),
    ],
    "Robotics & Automation": [
        ("IEEE Spectrum Robotics", "https://spectrum.ieee.org/feeds/topic/robotics"),
        ("The Robot Report", "https://www.therobotreport.com/feed/"),
    ],
    "Automotive & EVs": [
        ("Electrek", "https://electrek.co/feed/"),
        ("InsideEVs", "https://insideevs.com/rss/news/"),
        ("The Drive", "https://www.thedrive.com/feed"),
    ],
    "Social Platforms & Policy": [
        ("Platformer", "https://www.platformer.news/rss/"),
    ],
    "Web3 & Blockchain": [
        ("The Block", "https://www.theblock.co/rss.xml"),
        ("Decrypt", "https://decrypt.co/feed"),
        ("CoinDesk", "https://www.coindesk.com/arc/outboundfeeds/rss/"),
    ],
    "Health & Longevity": [
        ("STAT News", "https://www.statnews.com/feed/"),
        ("Longevity Technology", "https://longevity.technology/feed/"),
    ],
    "Climate Tech": [
        ("Canary Media", "https://www.canarymedia.com/feed"),
        ("CleanTechnica", "https://cleantechnica.com/feed/"),
    ],
    "Major News Outlets": [
        ("BBC News", "https://feeds.bbci.co.uk/news/rss.xml"),
        ("Reuters", "https://www.reutersagency.com/feed/"),
        ("NPR News", "https://feeds.npr.org/1001/rss.xml"),
        ("AP News", "https://rsshub.app/apnews/topics/apf-topnews"),
        ("Al Jazeera", "https://www.aljazeera.com/xml/rss/all.xml"),
    ],
    "US News": [
        ("Politico", "https://www.politico.com/rss/politicopicks.xml"),
        ("The Hill", "https://thehill.com/feed/"),
        ("USA Today", "https://www.usatoday.com/news/nation/"),
    ],
    "Finance & Business": [
        ("Bloomberg", "https://feeds.bloomberg.com/markets/news.rss"),
        ("Financial Times", "https://www.ft.com/rss/home"),
        ("MarketWatch", "https://feeds.marketwatch.com/marketwatch/topstories/"),
    ],
    "Fintech & Crypto Industry": [
        ("Finextra", "https://www.finextra.com/rss/headlines.aspx"),
        ("CoinTelegraph", "https://cointelegraph.com/rss"),
        ("TechCrunch Fintech", "https://techcrunch.com/category/fintech/feed/"),
        ("Crunchbase News", "https://news.crunchbase.com/feed/"),
    ],
    "Legal & Regulatory": [
        ("Reuters Legal", "https://www.reuters.com/legal/rss"),
        ("The Register", "https://www.theregister.com/headlines.atom"),
        ("Rest of World", "https://restofworld.org/feed/"),
    ],
    "Science & Space": [
        ("Science Daily", "https://www.sciencedaily.com/rss/all.xml"),
        ("Phys.org", "https://phys.org/rss-feed/"),
        ("Nature News", "https://www.nature.com/nature.rss"),
        ("NASA", "https://www.nasa.gov/rss/dyn/breaking_news.rss"),
        ("Space.com", "https://www.space.com/feeds/all"),
    ],
    "Entertainment": [
        ("The Hollywood Reporter", "https://www.hollywoodreporter.com/feed/"),
    ],
    "Reddit": [
        ("Reddit r/artificial", "https://www.reddit.com/r/artificial/new/.rss"),
        ("Reddit r/MachineLearning", "https://www.reddit.com/r/MachineLearning/new/.rss"),
        ("Reddit r/LangChain", "https://www.reddit.com/r/LangChain/new/.rss"),
        ("Reddit r/AI_Agents", "https://www.reddit.com/r/AI_Agents/new/.rss"),
        ("Reddit r/LocalLLaMA", "https://www.reddit.com/r/LocalLLaMA/new/.rss"),
        ("Reddit r/programming", "https://www.reddit.com/r/programming/new/.rss"),
        ("Reddit r/SideProject", "https://www.reddit.com/r/SideProject/new/.rss"),
    ],
}


def feed_table(spark: SparkSession, feeds: dict[str, list[tuple[str, str]]] = FEEDS) -> DataFrame:
    """The feed registry; ``feed_ord`` keeps the reading order."""
    rows, n = [], 0
    for category, entries in feeds.items():
        for source, url in entries:
            rows.append((n, source, url, category, "thread" if "reddit.com" in url else "feed"))
            n += 1
    return literal_table(spark, rows, FEED)
