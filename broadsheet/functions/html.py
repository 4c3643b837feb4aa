"""HTML to text inside the row: no explode, no shuffle, no Python worker.

One pattern finds everything that is not text (markup, comments, declarations
and whole script/style elements) and the page is split on it, so the pieces are
the text nodes in page order.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""

# Order matters: an element whose content is skipped is tried before its tag,
# and a tag with broken quotes falls through to the plain form.
NON_TEXT = (
    r"(?is)"
    rf"<script\b{_ATTRS}>.*?(?:</script\s*>|\z)"
    rf"|<style\b{_ATTRS}>.*?(?:</style\s*>|\z)"
    r"|<!--.*?(?:-->|\z)"
    r"|<[!?][^>]*>"
    rf"|</?[a-z]{_ATTRS}>"
    r"|</?[a-z][^>]*>"
)

# Characters behind the code points 128-159, which pages use with their Windows meaning.
WINDOWS = "".join(bytes([i]).decode("cp1252", errors="replace") for i in range(128, 160))

# Names met most often lead the table, because a literal map is scanned in order.
_COMMON = ["amp", "quot", "lt", "gt", "nbsp", "apos", "copy", "middot", "mdash", "ndash",
           "hellip", "rsquo", "lsquo", "rdquo", "ldquo", "reg", "trade", "euro", "bull"]


def entity_table() -> Column:
    table = {"apos": "'", **{name: chr(cp) for name, cp in name2codepoint.items()}}
    ordered = _COMMON + sorted(name for name in table if name not in _COMMON)
    return F.str_to_map(
        F.lit("\x02".join(f"{name}\x01{table[name]}" for name in ordered)),
        F.lit("\x02"), F.lit("\x01"),
    )


def _code_point(cp: Column) -> Column:
    usable = cp.between(1, 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
    exact = F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")
    return (
        F.when(cp.between(128, 159), F.substr(F.lit(WINDOWS), (cp - 127).cast("int"), F.lit(1)))
        .when(usable, exact)
        .otherwise(F.lit("�"))
    )


def unescape(c: Column) -> Column:
    """Resolve numeric and named character references once, left to right.

    The text is cut at ampersands and each piece resolves its own reference, so
    ``&amp;lt;`` becomes ``&lt;`` and never ``<``. Unknown names stay as written.
    """
    reference = r"^(#[0-9]{1,9}|#[xX][0-9a-fA-F]{1,7}|[A-Za-z][A-Za-z0-9]*);?"

    def resolve(piece: Column) -> Column:
        name = F.regexp_extract(piece, reference, 1)
        whole = F.regexp_extract(piece, reference, 0)
        number = F.when(
            F.lower(F.left(name, F.lit(2))) == "#x",
            F.conv(F.substr(name, F.lit(3)), 16, 10).try_cast("bigint"),
        ).otherwise(F.substr(name, F.lit(2)).try_cast("bigint"))
        found = F.when(F.left(name, F.lit(1)) == "#", _code_point(number)).otherwise(
            F.try_element_at(entity_table(), name)
        )
        return F.when(
            (name != "") & found.isNotNull(),
            F.concat(found, F.substr(piece, F.length(whole) + 1)),
        ).otherwise(F.concat(F.lit("&"), piece))

    pieces = F.split(c, "&", -1)
    resolved = F.concat(
        F.get(pieces, F.lit(0)),
        F.array_join(F.transform(F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), resolve), ""),
    )
    return F.when(F.contains(c, F.lit("&")), resolved).otherwise(c)


def text_nodes(html: Column) -> Column:
    """Stripped, non-empty text nodes in page order."""
    nodes = F.transform(F.split(html, NON_TEXT, -1), lambda n: strip(unescape(n)))
    return F.filter(nodes, lambda n: n != "")


def html_to_text(html: Column, separator: str = "\n") -> Column:
    """Visible text of a page; runs of blank lines shrink to one blank line."""
    joined = F.array_join(text_nodes(html), separator)
    return strip(F.regexp_replace(joined, r"\n{3,}", "\n\n"))


def inner_text(html: Column) -> Column:
    """Text of an inline fragment, nodes stripped and run together."""
    return F.array_join(text_nodes(html), "")


# A section whose heading contains one of these words leads.
LEAD_WORDS = ("top", "priority")
TOPIC_LIMIT = 5
MIN_LINK_TEXT = 10

_A_HREF = rf"(?is)<a\b(?=[^>]*\bhref\b){_ATTRS}>(.*?)</a\s*>"


def link_texts(html: Column) -> Column:
    """Texts of every link with a target, in page order."""
    return F.transform(F.regexp_extract_all(html, F.lit(_A_HREF), F.lit(1)), inner_text)


# Elements that never hold anything.
VOID = ("area", "base", "basefont", "bgsound", "br", "col", "command", "embed", "frame", "hr", "image", "img", "input",
        "isindex", "keygen", "link", "meta", "nextid", "param", "source", "spacer", "track", "wbr")

_NODE = "\x00"
_LEAD = r"(?i)" + "|".join(LEAD_WORDS)
# Where a walk over a page is.
_SEEK, _HEADING, _SIBLINGS, _LIST, _DONE = range(5)


def tags(html: Column) -> Column:
    """Per tag its lower-case name (a closing one's with a slash), whether it closes at once, and the text behind it."""
    marks = F.regexp_extract_all(html, F.lit(f"({NON_TEXT})"), F.lit(0))
    texts = F.split(html, NON_TEXT, -1)
    behind = F.slice(texts, F.lit(2), F.greatest(F.size(texts) - 1, F.lit(0)))

    def tag(mark: Column, text: Column) -> Column:
        name = F.lower(F.regexp_extract(mark, r"^<(/?[A-Za-z][^\x20\x09-\x0D/>]*)", 1))
        at_once = name.isin(*VOID, "script", "style") | F.endswith(mark, F.lit("/>"))
        return F.struct(name.alias("name"), at_once.alias("at_once"), text.alias("text"))

    return F.zip_with(marks, behind, tag)


def lead_titles(html: Column) -> Column:
    """Per item of the lead section's list the text of its first link, else of its first strong part.

    The lead section's heading is the first ``h2`` with a lead word in its text, its list the next ``ul``
    with the same parent; without one the titles are empty. Items are all ``li`` inside, nested ones too, in
    page order; an outer item's first link may stand in an inner one. At least the first five titles are given.

    One walk over the tags keeps the names of the open elements. A closing tag closes the
    innermost open element of its name and what is open inside it; without one it means nothing. An element
    is known by the length of the stack it was opened on, and is open while the stack is longer.
    """
    item = "struct<level:int,link_at:int,link:string,strong_at:int,strong:string>"

    def step(s: Column, t: Column) -> Column:
        name, stack = t["name"], s["stack"]
        closing = F.startswith(name, F.lit("/"))
        wanted = F.concat(F.lit("/"), F.ltrim(name, F.lit("/")), F.lit("/"))
        inner = F.call_function("substring_index", stack, wanted, F.lit(-1))
        after = (
            F.when(closing & F.contains(stack, wanted), F.left(stack, F.length(stack) - F.length(inner) - F.length(wanted) + 1))
            .when((name == "") | closing | t["at_once"], stack)
            .otherwise(F.concat(stack, name, F.lit("/")))
        )
        return F.struct(s.alias("s"), t.alias("t"), F.length(stack).alias("before"), after.alias("stack"), F.length(after).alias("now"))

    def walked(x: Column) -> Column:
        s, name, before, now = x["s"], x["t"]["name"], x["before"], x["now"]
        phase, at = s["phase"], s["at"]
        heard = F.when(phase == _HEADING, F.concat(s["heard"], x["t"]["text"])).otherwise(F.lit(""))
        starts = (phase == _SEEK) & (name == "h2") & (now > before)
        ended = (phase == _HEADING) & (now <= at)
        listed = (phase == _SIBLINGS) & (name == "ul") & (before == at)
        moved = (
            F.when(starts, _HEADING)
            .when(ended & ~s["heard"].rlike(_LEAD), _SEEK)
            .when(ended, F.when(now < at, _DONE).otherwise(_SIBLINGS))
            .when(listed, F.when(now > before, _LIST).otherwise(_DONE))
            .when((phase == _SIBLINGS) & (now < at), _DONE)
            .when((phase == _LIST) & (now <= at), _DONE)
            .otherwise(phase)
        )
        return F.struct(
            x["stack"].alias("stack"), moved.cast("int").alias("phase"),
            F.when(starts, before).otherwise(at).alias("at"),
            F.when(starts, x["t"]["text"]).otherwise(heard).alias("heard"),
            F.when((phase == _LIST) & (moved == _LIST), items(x)).otherwise(s["items"]).alias("items"),
        )

    def items(x: Column) -> Column:
        name, before, now, text = x["t"]["name"], x["before"], x["now"], x["t"]["text"]

        def part(i: Column, kind: str, tag: str) -> tuple[Column, Column]:
            first = (name == tag) & i[kind].isNull() & (before > i["level"]) & (i["level"] >= 0)
            place = F.when(first & (now > before), before).when(now > i[f"{kind}_at"], i[f"{kind}_at"])
            seen = F.when(first, F.lit("")).otherwise(i[kind])
            return place, F.when(place.isNotNull(), F.concat(seen, F.lit(_NODE), text)).otherwise(seen)

        def each(i: Column) -> Column:
            link_at, link = part(i, "link", "a")
            strong_at, strong = part(i, "strong", "strong")
            level = F.when(now > i["level"], i["level"]).otherwise(F.lit(-1))
            return F.struct(level.alias("level"), link_at.alias("link_at"), link.alias("link"), strong_at.alias("strong_at"), strong.alias("strong"))

        titled = lambda i: i["link"].isNotNull() | i["strong"].isNotNull()
        kept = F.filter(F.transform(x["s"]["items"], each), lambda i: (i["level"] >= 0) | titled(i))
        nothing, untitled = F.lit(None).cast("int"), F.lit(None).cast("string")
        new = F.struct(before.alias("level"), nothing.alias("link_at"), untitled.alias("link"), nothing.alias("strong_at"), untitled.alias("strong"))
        # What starts behind five titles is not among the first five.
        opens = (name == "li") & (now > before) & (F.size(F.filter(x["s"]["items"], titled)) < TOPIC_LIMIT)
        return F.when(opens, F.concat(kept, F.array(new))).otherwise(kept)

    start = F.struct(
        F.lit("/").alias("stack"), F.lit(_SEEK).alias("phase"), F.lit(0).alias("at"), F.lit("").alias("heard"),
        F.array().cast(f"array<{item}>").alias("items"))

    def walk(s: Column, t: Column) -> Column:
        # A step's values are used many times, so they are bound once.
        return F.when(s["phase"] == _DONE, s).otherwise(F.element_at(F.transform(F.array(step(s, t)), walked), 1))

    def title(i: Column) -> Column:
        nodes = F.transform(F.split(F.coalesce(i["link"], i["strong"]), _NODE, -1), lambda n: strip(unescape(n)))
        return F.array_join(nodes, "")

    found = F.aggregate(tags(html), start, walk)["items"]
    titles = F.transform(F.filter(found, lambda i: i["link"].isNotNull() | i["strong"].isNotNull()), title)
    possible = html.rlike(r"(?i)<h2") & html.rlike(_LEAD)
    return F.when(possible, titles).otherwise(F.array().cast("array<string>"))


def longer_links(html: Column) -> Column:
    """Link texts long enough to be a title."""
    return F.filter(link_texts(html), lambda t: F.length(t) > MIN_LINK_TEXT)
