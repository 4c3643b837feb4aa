"""Markdown that slipped into a digest, turned into HTML inside the row.

The list pass is a two-state scan over lines. It is expressed as one class
letter per line and a pattern over the letters, which is linear in the lines
and needs neither an explode nor a window.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, strip


# The patterns of the constructs and what they become.
BOLD = (r"(?d)\*\*(.+?)\*\*", "<strong>$1</strong>")
LINK = (r"\[([^\]]+)\]\(([^)]+)\)", '<a href="$2">$1</a>')
ITALIC = (r"(?<![:/])\*([^*]+)\*(?![/])", "<em>$1</em>")
RULE = (r"(?md)^---+$", "<hr>")


def _bold(c: Column) -> Column:
    return F.regexp_replace(c, *BOLD)


def _links(c: Column) -> Column:
    return F.regexp_replace(c, *LINK)


def unfence(c: Column) -> Column:
    """Drop code fences around a reply, then strip."""
    c = F.regexp_replace(c, rf"(?md)^```html[{WS}]*\n?", "")
    return strip(F.regexp_replace(c, rf"(?md)\n?```[{WS}]*$", ""))


def inline_markup(c: Column) -> Column:
    """Headings, bold, italics, links and rules. Italics may span lines."""
    for level in (3, 2, 1):
        c = F.regexp_replace(c, rf"(?md)^{'#' * level} (.+)$", f"<h{level}>$1</h{level}>")
    c = _bold(c)
    c = F.regexp_replace(c, *ITALIC)
    return F.regexp_replace(_links(c), *RULE)


def line_classes(lines: Column) -> Column:
    """One letter per line: ``b`` bullet, ``c`` closes a list, ``n`` leaves it as it is."""
    def letter(line: Column) -> Column:
        s = strip(line)
        bullet = (F.startswith(s, F.lit("- ")) | F.startswith(s, F.lit("* "))) & ~F.startswith(s, F.lit("---"))
        return F.when(bullet, "b").when((s == "") | F.startswith(s, F.lit("<li")), "n").otherwise("c")

    return F.array_join(F.transform(lines, letter), "")


def list_states(classes: Column) -> Column:
    """Letters rewritten so that ``1`` stands for every line inside a list.

    A list runs from a bullet over bullets and neutral lines; ``\\G`` carries the
    run on without nested repetition.
    """
    return F.regexp_replace(classes, r"(?:\G(?!^)|(?=b))[bn]", "1")


def render_lines(content: Column, classes: Column) -> Column:
    """Lines with list tags, items and paragraphs in place."""
    states = list_states(classes)
    before = F.concat(F.lit("0"), F.substr(states, F.lit(1), F.length(states) - 1))
    # Per line: its class letter and the state in front of it, as a two-letter code.
    codes = F.zip_with(F.split(classes, ""), F.split(before, ""), lambda a, b: F.concat(a, b))

    def render(line: Column, code: Column) -> Column:
        s = strip(line)
        was_in = F.endswith(code, F.lit("1"))
        bullet = F.startswith(code, F.lit("b"))
        lead = (
            F.when(bullet & ~was_in, F.lit("<ul>\n"))
            .when(F.startswith(code, F.lit("c")) & was_in, F.lit("</ul>\n"))
            .otherwise(F.lit(""))
        )
        body = (
            F.when(bullet, F.concat(F.lit("<li>"), F.substr(s, F.lit(3)), F.lit("</li>")))
            .when((s == "") | F.startswith(s, F.lit("<")) | F.endswith(s, F.lit(">")), line)
            .otherwise(F.concat(F.lit("<p>"), s, F.lit("</p>")))
        )
        return F.concat(lead, body)

    closing = F.when(F.endswith(states, F.lit("1")), F.lit("\n</ul>")).otherwise(F.lit(""))
    return F.concat(F.array_join(F.zip_with(split_lines(content), codes, render), "\n"), closing)


def split_lines(content: Column) -> Column:
    return F.split(content, "\n", -1)


def is_html(content: Column) -> Column:
    """Does an unfenced reply already start as HTML."""
    return (
        F.startswith(content, F.lit("<h1>"))
        | F.startswith(content, F.lit("<div"))
        | F.startswith(content, F.lit("<!"))
    )


def marked_up(content: Column) -> Column:
    """Inline markup of an unfenced reply. HTML only gets bold and links."""
    return F.when(is_html(content), _links(_bold(content))).otherwise(inline_markup(content))


def line_states(content: Column, classes: Column) -> Column:
    """``array<struct<line, in_list>>`` of a marked-up text."""
    flags = F.split(list_states(classes), "")
    return F.zip_with(
        split_lines(content), flags,
        lambda line, s: F.struct(line.alias("line"), (s == "1").alias("in_list")),
    )
