"""Row shapes of the tables the operators read and write.

Times are kept as TIMESTAMP_NTZ holding UTC, so results do not depend on the
session time zone. Streaming event time is cast to TIMESTAMP where a watermark
needs it.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, INT, LONG, DOUBLE, TIME = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()


def shape(text: str = "", **others: T.DataType) -> T.StructType:
    """A struct of text columns (names in ``text``) followed by columns of other types."""
    fields = [T.StructField(n, TEXT) for n in text.split()]
    return T.StructType(fields + [T.StructField(n, t) for n, t in others.items()])


FEED = shape(feed_ord=INT, source=TEXT, url=TEXT, category=TEXT, kind=TEXT)
ARTICLE = shape("title link summary source", published=TIME, feed_ord=INT, feed_pos=LONG)
STORY_RANK = shape("run", pos=INT, id=LONG)
STORY = shape("title url", id=LONG, score=LONG, descendants=LONG, time=LONG)
SENT = shape("article_key title link source", sent_at=TIME)
THREAD = shape(
    "url title selftext author", score=INT, num_comments=INT, subreddit=TEXT, created_utc=DOUBLE,
    top_comments=T.ArrayType(TEXT), fetched_at=TIME,
)
LANE = shape("key topic topic_label framing brief", target_signals=INT, extra_rules=TEXT)
SIGNAL = shape(
    "id batch date lane topic topic_label signal_type subject summary relevance source_name source_url "
    "observed_at metrics severity entity role bucket",
    seq=shape(payload_seq=LONG, pos=INT),
)
