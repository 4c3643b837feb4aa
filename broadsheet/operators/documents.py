"""Document transforms over tables of pages, replies and digests. All of them map rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import markdown as M
from ..functions.html import html_to_text
from ..functions.text import join_text_blocks
from ..plans.ordered import once


def page_text(pages: DataFrame, html: str = "html", separator: str = "\n") -> DataFrame:
    """Replace the markup column by its visible text."""
    return pages.withColumn("text", html_to_text(F.col(html), separator)).drop(html)


def _marked_up(replies: DataFrame, content: str) -> DataFrame:
    """Each step of the conversion feeds several uses of the next, so each is made once."""
    rows = once(replies, "_c", M.unfence(F.col(content)))
    rows = once(rows, "_m", M.marked_up(F.col("_c")))
    return once(rows, "_k", F.when(~M.is_html(F.col("_c")), M.line_classes(M.split_lines(F.col("_m")))))


def digest_html(replies: DataFrame, content: str = "content") -> DataFrame:
    """Replies normalized to HTML: HTML stays, markdown is converted in full."""
    html = F.when(F.col("_k").isNull(), F.col("_m")).otherwise(M.render_lines(F.col("_m"), F.col("_k")))
    return _marked_up(replies, content).withColumn("html", html).drop(content, "_c", "_m", "_k")


def list_state(replies: DataFrame, key: str, content: str = "content") -> DataFrame:
    """Per line of a markdown reply: is the line inside a list. Replies in HTML have no lines."""
    rows = _marked_up(replies.select(key, content), content).filter(F.col("_k").isNotNull())
    lines = rows.select(key, F.posexplode(M.line_states(F.col("_m"), F.col("_k"))).alias("line_no", "_l"))
    return lines.select(key, "line_no", F.col("_l.line").alias("line"), F.col("_l.in_list").alias("in_list"))


def topics(digests: DataFrame, key: str, html: str = "html") -> DataFrame:
    """Up to five topic titles per digest: the lead section's, else the longer links.

    Only the first lead heading counts, also when no list follows it.
    """
    page = F.col(html)
    rows = once(digests.select(key, html), "_lead", H.lead_titles(page))
    found = F.when(F.size("_lead") > 0, F.col("_lead")).otherwise(H.longer_links(page))
    return rows.select(key, F.posexplode(F.slice(found, 1, H.TOPIC_LIMIT)).alias("pos", "topic"))


def reply_text(replies: DataFrame, blocks: str = "blocks") -> tuple[DataFrame, DataFrame]:
    """Text of block replies, and the replies that carry none."""
    joined = replies.withColumn("text", join_text_blocks(F.col(blocks)))
    return joined.filter(F.col("text") != "").drop(blocks), joined.filter(F.col("text") == "").drop("text")
