"""Topics of lead sections against a parser that builds the element tree."""

import random
from html.parser import HTMLParser

from pyspark.sql import functions as F

from broadsheet.functions.html import VOID, lead_titles
from broadsheet.operators import documents as D


class Node:
    def __init__(self, name, parent):
        self.name, self.parent, self.inside = name, parent, []


class Tree(HTMLParser):
    """Closing tags close the innermost open element of their name, and mean nothing without one."""

    def __init__(self, page):
        super().__init__()
        self.root = self.at = Node("", None)
        self.feed(page)
        self.close()

    def handle_starttag(self, name, attrs):
        node = Node(name, self.at)
        self.at.inside.append(node)
        if name not in VOID:
            self.at = node

    def handle_startendtag(self, name, attrs):
        self.at.inside.append(Node(name, self.at))

    def handle_endtag(self, name):
        node = self.at
        while node is not None and node.name != name:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.inside.append(data)


def below(node):
    for x in node.inside:
        yield x
        if isinstance(x, Node):
            yield from below(x)


def named(node, name):
    return [x for x in below(node) if isinstance(x, Node) and x.name == name]


def stripped(node):
    return "".join(x.strip() for x in below(node) if isinstance(x, str))


def lead_topics(page):
    for h2 in named(Tree(page).root, "h2"):
        text = "".join(x for x in below(h2) if isinstance(x, str)).lower()
        if "top" in text or "priority" in text:
            behind = h2.parent.inside[h2.parent.inside.index(h2) + 1:]
            lists = [x for x in behind if isinstance(x, Node) and x.name == "ul"]
            items = named(lists[0], "li") if lists else []
            found = [(named(li, "a") or named(li, "strong") or [None])[0] for li in items]
            return [stripped(x) for x in found if x is not None][:5]
    return []


def topics(spark, pages):
    df = spark.createDataFrame(list(enumerate(pages)), "id INT, html STRING")
    got = {i: [] for i in range(len(pages))}
    for r in sorted(D.topics(df, "id").collect()):
        got[r["id"]].append(r["topic"])
    return [got[i] for i in range(len(pages))]


def test_list_is_the_next_sibling(spark):
    item = "<ul><li><a href=u>A</a></li></ul>"
    pages = {
        f"<div><h2>Top</h2></div>{item}": [],
        f"<h2>Top</h2><div>{item}</div>": [],
        f"<div><h2>Top</h2><p>x</p>{item}</div>": ["A"],
        f"<div><div><h2>Top</h2></div></div><div>{item}</div>": [],
        f"<h2>Top</h2></div><br>text<hr/>{item}": ["A"],
        f"<!-- <h2>Top</h2> --><h2>News</h2>{item}": [],
        f"<h2>Top</h2><ul/>{item}": [],
        f"<div><h2>Top</div>{item}": [],
        f"<h2>Top</h2><p>open{item}": [],
        "<h2>Top</h2><UL><LI>x<ul><li><a>In</a></li><li><strong>B</strong></li></ul></LI><li><strong>C</strong> <a>D &amp; <b> e </b></a></li></UL>":
            ["In", "In", "B", "D &e"],
        "<h2>Top</h2><ul><div><li><a></a></li></div><li>plain</li><li><strong>s</strong>": ["", "s"],
        "": [], "<h2>Top": [], "Top <h2": [],
    }
    assert topics(spark, list(pages)) == list(pages.values())
    assert [lead_topics(p) for p in pages] == list(pages.values())
    assert D.topics(spark.createDataFrame([(1, None)], "id INT, html STRING"), "id").collect() == []


def test_random_pages(spark):
    rng = random.Random(8)
    parts = ["<h2>", "</h2>", "<h2>Top</h2>", "<h2>Priority", "<h2>News</h2>", "<ul>", "<ul>", "</ul>", "<li>", "<li>", "</li>", "<a href='x'>", "</a>",
             "<a>l</a>", "<strong>", "</strong>", "<strong>s</strong>", "<div>", "</div>", "<p>", "<br>", "<br/>", "x", " y ", "&lt;", "<!-- <ul> -->"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    pages += ["<h2>Top</h2><ul>" + "".join(rng.choice(parts[8:]) for _ in range(rng.randint(5, 60))) for _ in range(3000)]
    want = [lead_topics(p) for p in pages]
    df = spark.createDataFrame(list(enumerate(pages)), "id INT, html STRING")
    assert [r["t"][:5] for r in df.select("id", lead_titles(F.col("html")).alias("t")).orderBy("id").collect()] == want
    assert sum(map(bool, want)) > 1500


def test_long_pages(spark):
    """Deep, long and unclosed: a walk's cost is tags times the open elements."""
    items = "".join(f"<li><a href=u>t{i}</a></li>" for i in range(20_000))
    deep = "<div>" * 2_000 + "<h2>Top</h2><ul><li><a>x</a></li></ul>"
    assert topics(spark, ["<p>" + items + f"<h2>Top</h2><ul>{items}</ul>", deep]) == [[f"t{i}" for i in range(5)], ["x"]]
