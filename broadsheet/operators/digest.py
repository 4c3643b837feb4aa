"""Digest documents: article blocks, prompts and rendered HTML."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import html_escape
from ..plans.ordered import numbered
from .curation import SECTIONS, Section, priority_order
from .signals import fill

# Fixed value: the block one article takes in a prompt.
ARTICLE_BLOCK = "\n---\nArticle {i}:\nSource: {source}\nTitle: {title}\nLink: {link}\nSummary: {summary}\n"
# Fixed value: the head of a rendered digest.
DIGEST_TITLE = "🗞️ Daily News Digest"


def _joined(number: Column, piece: Column, separator: str) -> Column:
    """Ordered concatenation as an aggregate."""
    pieces = F.array_sort(F.collect_list(F.struct(number.alias("n"), piece.alias("p"))))
    return F.array_join(F.transform(pieces, lambda x: x["p"]), separator)


def article_blocks(articles: DataFrame, digest: Sequence[str]) -> DataFrame:
    """Numbered article blocks of a digest as one text, in feed order.

    A digest holds what the per-source top-k let through: at most k rows per
    registered feed, so one digest is a bounded group and one bounded value.
    """
    w = Window.partitionBy(*digest).orderBy("feed_ord", "feed_pos")
    numbered = articles.withColumn("_i", F.row_number().over(w))
    block = fill(ARTICLE_BLOCK, {
        "i": F.col("_i").cast("string"),
        **{c: F.coalesce(F.col(c), F.lit("")) for c in ("source", "title", "link", "summary")},
    })
    return numbered.groupBy(*digest).agg(
        _joined(F.col("_i"), block, "").alias("blocks"), F.count("*").alias("n_articles")
    )


def prompts(blocks: DataFrame, template: str, **values: str) -> DataFrame:
    """One prompt per digest: a template with ``{articles}`` and any named places."""
    columns = {"articles": F.col("blocks"), **{k: F.lit(v) for k, v in values.items()}}
    return blocks.withColumn("prompt", fill(template, columns)).drop("blocks")


#: Articles in one part of a rendered digest.
PART = 200


def render(
    chosen: DataFrame, digest: Sequence[str], date: Column, sections: Sequence[Section] = SECTIONS, size: int = PART
) -> DataFrame:
    """HTML of each digest in numbered parts: sections in fixed order, best articles first.

    Must-watch articles are exempt from the digest's cap, so a digest may be long:
    a part holds at most ``size`` articles and the parts together hold all. Articles
    are numbered by ranges of their order, so no digest is ever in one task.
    """
    link = F.concat(
        F.lit('  <li>\n    <strong><a href="'), html_escape(F.col("link")), F.lit('">'),
        html_escape(F.col("title")), F.lit("</a></strong> ("), html_escape(F.col("source")),
        F.lit(")<br>\n    "), html_escape(F.col("summary")), F.lit("\n  </li>"),
    )
    placed = numbered(chosen, digest, [F.asc("section_ord"), *priority_order()], "_n")
    placed = placed.withColumn("part_no", F.floor((F.col("_n") - 1) / size).cast("int"))
    items = placed.groupBy(*digest, "part_no", "section_ord").agg(
        _joined(F.col("_n"), link, "\n").alias("items"), F.count("*").alias("_c")
    )
    headings = F.array(*[F.lit(s.heading) for s in sections])
    body = F.concat(
        F.lit("<h2>"), html_escape(F.get(headings, F.col("section_ord"))), F.lit("</h2>\n<ul>\n"),
        F.col("items"), F.lit("\n</ul>"),
    )
    head = F.when(F.col("part_no") == 0, F.concat(
        F.lit(f"<h1>{DIGEST_TITLE}</h1>\n<p>Good morning! Here's your personalized news for "),
        date, F.lit(".</p>\n\n"),
    )).otherwise("")
    return items.groupBy(*digest, "part_no").agg(
        F.concat(head, _joined(F.col("section_ord"), body, "\n\n")).alias("html"),
        F.sum("_c").cast("bigint").alias("n_articles"),
    )
