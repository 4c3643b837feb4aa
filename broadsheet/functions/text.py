"""String helpers with the whitespace and escaping rules of the contract."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as whitespace when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same set as a regex character class body, for use inside [...].
WS = r"\s\x1c-\x1f\x85\p{Z}"


def strip(c: Column) -> Column:
    """Trim every Unicode whitespace character, not only the blank ``trim`` knows."""
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_default(c: Column, default: str) -> Column:
    """``default`` where the text is null or empty."""
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def html_escape(c: Column) -> Column:
    """Escape the five markup characters; the ampersand goes first."""
    # Replacement text per character.
    for raw, entity in (
        ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"),
    ):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def content_key(title: Column, link: Column) -> Column:
    """Identity of an article or signal: md5 over lowered, stripped title and link.

    Nulls count as empty text, so a missing link never nulls the whole key.
    """
    def part(c: Column) -> Column:
        return strip(F.lower(F.coalesce(c, F.lit(""))))

    return F.md5(F.concat(part(title), F.lit("|"), part(link)))


def truncate(c: Column, limit: int, suffix: str = "") -> Column:
    """Cut to ``limit`` code points; ``suffix`` marks a text that was cut."""
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit(suffix))).otherwise(c)


def strip_reasoning(c: Column) -> Column:
    """Drop ``<think>`` blocks and the blanks behind them from a stripped reply."""
    return F.regexp_replace(strip(c), rf"(?s)<think>.*?</think>[{WS}]*", "")


# Fixed value: the note put behind a text that was over its length budget.
TRUNCATION_NOTE = "\n\n[Content truncated for length]"
FULL_BUDGET = 40000
SAMPLE_BUDGET = 4000


def length_budget(c: Column, sample: bool = False) -> Column:
    return truncate(c, SAMPLE_BUDGET if sample else FULL_BUDGET, TRUNCATION_NOTE)


def parse_size(c: Column) -> Column:
    """Number in front of a ``b``/``B`` size mark; the part after the first colon wins."""
    def number(text: Column) -> Column:
        return F.nullif(F.regexp_extract(text, r"(\d+(?:\.\d+)?)[bB]", 1), F.lit("")).try_cast("double")

    has_tag = F.instr(c, ":") > 0
    tag = F.substr(c, F.instr(c, ":") + 1)
    return F.coalesce(F.when(has_tag, number(tag)), number(c))


def join_text_blocks(blocks: Column) -> Column:
    """One text out of an ``array<struct<type, text>>`` reply.

    Text blocks count, reasoning blocks never do, other blocks count when they
    carry text. The result is stripped; an empty one is an error for the caller.
    """
    kept = F.filter(
        blocks,
        lambda b: ~F.coalesce(b["type"], F.lit("")).isin("thinking", "redacted_thinking")
        & b["text"].isNotNull(),
    )
    return strip(F.array_join(F.transform(kept, lambda b: b["text"]), ""))


def ordered_distinct(values: Column) -> Column:
    """First occurrence of each non-empty entry, order kept."""
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))
