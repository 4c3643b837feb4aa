"""Column helpers against expected values derived by hand or by the Python standard library."""

import hashlib
import random

from pyspark.sql import functions as F

from broadsheet.functions import html as H
from broadsheet.functions import text as X
from broadsheet.functions.hashing import md5_mod
from broadsheet.functions.times import parse_feed_date
from broadsheet.operators import documents as D


def values(spark, rows, make):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i INT, v STRING")
    return [r[1] for r in sorted(df.select("i", make(F.col("v")).alias("out")).collect())]


def test_strip_matches_python_for_unicode_whitespace(spark):
    rows = [f"{a}x {b}y{b}{a}" for a in X.WHITESPACE for b in "  \x1c\t"] + ["", " ", "​z​"]
    assert values(spark, rows, X.strip) == [r.strip() for r in rows]


def test_content_key_lowers_strips_and_survives_nulls(spark):
    df = spark.createDataFrame([(" Title ", " HTTP://X "), (None, None)], "t STRING, l STRING")
    got = [r[0] for r in df.select(X.content_key(F.col("t"), F.col("l"))).collect()]
    assert got == [hashlib.md5(s.encode()).hexdigest() for s in ("title|http://x", "|")]


def test_escape_order(spark):
    assert values(spark, ["<a href='x'>\"&amp;\"</a>"], X.html_escape) == [
        "&lt;a href=&#x27;x&#x27;&gt;&quot;&amp;amp;&quot;&lt;/a&gt;"]


def test_md5_mod_uses_all_128_bits(spark):
    rng = random.Random(7)
    rows = [f"2024-01-{rng.randint(1, 31):02d}-{rng.random()}" for _ in range(200)]
    for n in (1, 3, 5, 8, 1009, 2**31 - 1):
        want = [int(hashlib.md5(r.encode()).hexdigest(), 16) % n for r in rows]
        assert values(spark, rows, lambda c, n=n: md5_mod(c, n)) == want


def test_feed_dates(spark):
    rows = ["Mon, 02 Jan 2006 15:04:05 GMT", "2 Jan 06 15:04 -0700", "2024-01-02T03:04:05.9+02:00",
            "2024-01-02T03:04:05", "Tue, 3 Jan 2006 15:04:05 EST", "soon", "", None]
    got = values(spark, rows, lambda c: F.date_format(parse_feed_date(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2006-01-02 15:04:05", "2006-01-02 22:04:00", "2024-01-02 01:04:05",
                   "2024-01-02 03:04:05", "2006-01-03 20:04:05", None, None, None]


def test_reasoning_budget_and_size(spark):
    assert values(spark, [" <think>a\n</think>\n\nhi ", "<think>open", "a<think></think> b"], X.strip_reasoning) == [
        "hi", "<think>open", "ab"]
    assert values(spark, ["é" * 4000, "é" * 4001], lambda c: X.length_budget(c, True)) == [
        "é" * 4000, "é" * 4000 + "\n\n[Content truncated for length]"]
    assert values(spark, ["q3.5:9b", "a 14.8B", "x7b:latest", "x:y:3b", "none"], X.parse_size) == [9.0, 14.8, 7.0, 3.0, None]


def test_html_text(spark):
    rows = [
        "<p>a&amp;lt; &#8217;&#x1F600;&#150; &foo; &copy 2 AT&T</p>",
        "x<script>if(a<b)'</p>'</script>y<style>p{}</style><!-- <p>no</p> -->z",
        "<b title='x>y'>k</b> a < b",
        "<p>&nbsp;</p><p>one</p>\n\n\n<p>two</p>",
        "<p>a\n\n\n\nb</p>",
        "", "<script>never closed",
    ]
    assert values(spark, rows, H.html_to_text) == [
        "a&lt; ’😀– &foo; © 2 AT&T", "x\ny\nz", "k\na < b", "one\ntwo", "a\n\nb", "", ""]


def test_topics_lead_section_fallback_and_substring_trap(spark):
    lead = "<h2>Laptops</h2><ul><li><strong><a href='u'>A <em>b</em></a></strong></li><li><strong>C</strong></li><li>d</li></ul>"
    rows = [
        "<h2>News</h2><ul><li><a href='x'>not me at all</a></li></ul>" + lead,
        "<h2>Top</h2><p>empty</p><h2>priority</h2><p>x</p><a href='y'>a long link text</a><a>no target at all</a><a href='z'>short</a>",
        "<h2>🔥 Top Priority</h2><ul>" + "".join(f"<li><a href='u'>t{i}</a></li>" for i in range(8)) + "</ul>",
    ]
    df = spark.createDataFrame(list(enumerate(rows)), "id INT, html STRING")
    got = {}
    for r in sorted(D.topics(df, "id").collect()):
        got.setdefault(r["id"], []).append(r["topic"])
    # Inner texts are stripped and run together.
    assert got == {0: ["Ab", "C"], 1: ["a long link text"], 2: ["t0", "t1", "t2", "t3", "t4"]}


def markdown_by_lines(content):
    """Brute force for the line pass: the same contract, one line after the other."""
    out, inside = [], False
    for line in content.split("\n"):
        s = line.strip()
        if s[:2] in ("- ", "* "):
            out += ["<ul>"] * (not inside) + [f"<li>{s[2:]}</li>"]
            inside = True
            continue
        if inside and s and not s.startswith("<li"):
            out.append("</ul>")
            inside = False
        out.append(line if not s or s[0] == "<" or s[-1] == ">" or inside else f"<p>{s}</p>")
    return "\n".join(out + ["</ul>"] * inside)


def test_markdown_line_pass_matches_brute_force(spark):
    rng = random.Random(3)
    kinds = ["- a", "  - b ", "", "  ", "<li>c</li>", "text", "<hr>", "tail>", "-", "---x"]
    rows = ["start\n" + "\n".join(rng.choice(kinds) for _ in range(rng.randint(0, 30))) + "\nend" for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "id INT, content STRING")
    got = {r["id"]: r["html"] for r in D.digest_html(df).collect()}
    assert got == {i: markdown_by_lines(r) for i, r in enumerate(rows)}


def test_markdown_constructs(spark):
    cases = {
        "```html\n<h1>x</h1>**b** [l](u)\n```": "<h1>x</h1><strong>b</strong> <a href=\"u\">l</a>",
        "# T\n* a\n* b": "<h1>T</h1>\n<em> a\n</em> b",
        "- x\n\n- y\nz": "<ul>\n<li>x</li>\n\n<li>y</li>\n</ul>\n<p>z</p>",
        "a\n---\n-----": "<p>a</p>\n<hr>\n<hr>",
        "http:/*x* and /*y*/": "<p>http:/*x<em> and /</em>y*/</p>",
        "": "",
    }
    df = spark.createDataFrame(list(enumerate(cases)), "id INT, content STRING")
    got = {r["id"]: r["html"] for r in D.digest_html(df).collect()}
    assert got == dict(enumerate(cases.values()))


def test_reply_blocks(spark):
    df = spark.createDataFrame(
        [(1, [("thinking", "no"), ("text", " a"), ("tool_use", None), ("other", "b ")]), (2, [("thinking", "x"), ("text", " ")])],
        "id INT, blocks ARRAY<STRUCT<type: STRING, text: STRING>>")
    texts, empty = D.reply_text(df)
    assert [tuple(r) for r in texts.select("id", "text").collect()] == [(1, "ab")]
    assert [r["id"] for r in empty.collect()] == [2]


def test_lead_list_with_a_nested_list_is_read_to_its_own_end(spark):
    html = ("<h2>Top Priority</h2><ul><li><a href='a'>One</a><ul><li><a href='b'>Two</a></li></ul></li>"
            "<li><strong>Three</strong></li></ul><ul><li><a href='c'>Other list</a></li></ul>")
    df = spark.createDataFrame([(1, html), (2, "<h2>Priority</h2><ul><li><a href='x'>Open</a>")], "id INT, html STRING")
    got = {}
    for r in sorted(D.topics(df, "id").collect()):
        got.setdefault(r["id"], []).append(r["topic"])
    assert got == {1: ["One", "Two", "Three"], 2: ["Open"]}


def test_numbers_by_ranges(spark):
    from broadsheet.plans.ordered import numbered
    rows = [(g, (i * 37) % 1000 // 7, i) for g in ("a", None, "b") for i in range({"a": 900, "b": 5}.get(g, 300))]
    df = spark.createDataFrame(rows, "g STRING, x INT, i INT").repartition(7)
    got = {(r["g"], r["i"]): r["n"] for r in numbered(df, ["g"], [F.desc("x"), F.asc("i")], "n").collect()}
    want = {}
    for g in ("a", None, "b"):
        for n, (_, _, i) in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2])), 1):
            want[g, i] = n
    assert got == want


def test_no_window_holds_a_whole_digest(spark):
    from broadsheet.operators import digest as D
    row = spark.range(50).selectExpr(
        "'d' AS lang", "'t' AS title", "'l' AS link", "'s' AS source", "'' AS summary", "0 AS section_ord", "true AS must_watch", "0 AS best_tier", "1L AS n_hits",
        "0 AS feed_ord", "id AS feed_pos", "string(id) AS article_key", "CAST(NULL AS TIMESTAMP_NTZ) AS published")
    plan = D.render(row, ["lang"], F.lit("x"))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_range" in w and "section_ord" not in w for w in windows)
