"""One query per operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import markdown as M
from ..functions.html import html_to_text
from ..functions.text import content_key, html_escape, length_budget, ordered_distinct, parse_size, strip_reasoning
from ..functions.times import moment, parse_feed_date
from ..operators import articles as A
from ..operators import catalogs as C
from ..operators import curation as U
from ..operators import digest as D
from ..operators import documents as X
from ..operators import scripts as P
from ..operators import signals as G
from ..operators import state as S
from ..operators import triage as R
from ..session import scratch_path
from ..sources import scans
from ..streaming import days, jobs, keyed
from .bindings import (
    AS_OF, COMPANIES, LAST_BATCH, PER_SOURCE, RULES, SKIP, SOURCES, STRICT, SWEEP_AS_OF, Tables,
)
from .daily import StateLog, run_daily, run_sweep_merge, signal_history
from .ordered import first_rows, last_wins

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Register a query under its function name."""
    QUERIES[fn.__name__] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
    return fn


ARTICLE_COLUMNS = ["article_key", "title", "link", "source", "published", "feed_pos"]

# ---------------------------------------------------------------- sources


def _printable(c):
    """Drop characters XML cannot carry."""
    return F.regexp_replace(c, "[^\\t\\n\\r\\x20-\\x{D7FF}\\x{E000}-\\x{FFFD}\\x{10000}-\\x{10FFFF}]", "")


def _tagged_text(name, text, attributes=""):
    return F.concat(F.lit(f"<{name}{attributes}>"), html_escape(text), F.lit(f"</{name}>"))


#: Items of one landed snapshot, so that no file grows with the feed.
SNAPSHOT = 2_000


def _snapshots(t: Tables) -> DataFrame:
    """Land the items as feeds serve them and scan them.

    By source in turn: RSS with siblings under other prefixes, bare ampersands and names XML
    does not know, Atom under a prefix with content and an enclosure, RDF with
    CDATA that holds an end tag, and RSS with an unclosed element in every item that
    breaks off inside one more item.
    """
    items = t.feed_items()
    style = F.col("feed_ord") % 4
    title, body = _printable(F.col("title")), _printable(F.col("description"))
    when = F.when(F.col("published") != "soon", F.col("published")).otherwise(F.col("updated"))
    date = lambda name: F.coalesce(_tagged_text(name, when), F.lit(""))
    link = F.col("link")
    odd = F.when(style == 3, "<guid><b>open</guid>").otherwise("<guid>AT&T &nbsp;&unknown; a & b</guid>")
    rss = F.concat(
        F.lit("<item>"), odd, _tagged_text("title", title), _tagged_text("link", link), F.lit('<atom:link href="https://self" rel="self"/>'),
        _tagged_text("description", body), F.lit("<media:title>photo</media:title><media:description>none</media:description>"), date("pubDate"), F.lit("</item>"))
    atom = F.concat(
        F.lit('<a:entry xml:lang="en">'), _tagged_text("a:title", title, ' type="html"'), F.lit('<a:link rel="enclosure" href="https://file"/><a:link rel="alternate" href="'),
        html_escape(link), F.lit('"/>'), _tagged_text("a:content", body, ' type="html"'), date("a:updated"), F.lit("</a:entry>"))
    rdf = F.concat(
        F.lit('<item rdf:about="x"><!-- </item> -->'), _tagged_text("title", title), _tagged_text("link", link), F.lit("<description><![CDATA["),
        F.replace(body, F.lit("]]>"), F.lit("]]]]><![CDATA[>")), F.lit("]]></description><note><![CDATA[</item> & <item>]]></note>"), date("dc:date"), F.lit("</item>"))
    xml = F.when(style == 1, atom).when(style == 2, rdf).otherwise(rss)
    ordered = F.array_sort(F.collect_list(F.struct("feed_pos", xml.alias("x"))))
    files = items.groupBy("source", "feed_ord", F.floor(F.col("feed_pos") / SNAPSHOT).alias("part")).agg(
        F.array_join(F.transform(ordered, lambda x: x["x"]), "\n").alias("x"))
    start = F.when(style == 1, '<a:feed xmlns:a="http://www.w3.org/2005/Atom">').when(style == 2, "<rdf:RDF><channel><title>c</title></channel>").otherwise("<rss><channel><title>c</title>")
    end = F.when(style == 1, "</a:feed>").when(style == 2, "</rdf:RDF>").when(style == 3, "<item><title>cut off</tit").otherwise("</channel></rss>")
    path = scratch_path(t.spark, "feeds")
    files.select("source", F.concat(start, "x", end).alias("value")).write.option("maxRecordsPerFile", 1).partitionBy("source").text(path)
    return scans.snapshots(t.spark, path)


@query
def src1_feed_items(t: Tables) -> DataFrame:
    """Landed feed snapshots, scanned and mapped to articles."""
    read = scans.of_feeds(scans.feed_entries(_snapshots(t)), t.feeds())
    return A.items_to_articles(read).select("title", "link", "source", "published", "feed_ord", "feed_pos", F.length("summary").alias("n_summary"))


@query
def src2_stories(t: Tables) -> DataFrame:
    """Land ranked story ids and items as JSON, then scan the first 20 of every month."""
    ids_path, items_path = scratch_path(t.spark, "ids"), scratch_path(t.spark, "items")
    o = t.orders.withColumn("run", F.date_format("o_orderdate", "yyyy-MM"))
    top = first_rows(o, ["run"], [F.desc("o_totalprice"), F.asc("o_orderkey")], 30, rank="_rank")
    top.select("run", (F.col("_rank") - 1).alias("pos"), F.col("o_orderkey").alias("id")).write.json(ids_path)
    key = F.col("o_orderkey")
    o.select(
        key.alias("id"),
        F.when(key % 10 == 0, "").when(key % 10 != 1, F.concat(F.lit("Story "), key.cast("string"))).alias("title"),
        F.when(key % 3 != 0, F.concat(F.lit("https://example.com/"), key.cast("string"))).alias("url"),
        F.when(key % 4 != 0, F.col("o_totalprice").cast("bigint")).alias("score"),
        F.col("o_custkey").alias("descendants"),
        F.when(key % 6 == 0, F.lit(0)).otherwise(F.timestamp_diff("SECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col("o_orderdate"))).alias("time"),
    ).write.json(items_path)
    return scans.stories(t.spark, ids_path, items_path, 20).select("title", "link", "summary", "source", "published", "feed_pos")


def _stories(t: Tables) -> DataFrame:
    """Most liked documents as stories of one run."""
    ids = first_rows(t.documents.withColumn("run", F.lit("r")), ["run"], [F.desc("n_chars"), F.asc("doc_id")], 2 * PER_SOURCE, rank="_rank")
    items = t.documents.select(
        F.col("doc_id").alias("id"), F.get(F.split("text", "\n"), F.lit(0)).alias("title"),
        F.lit(None).cast("string").alias("url"), F.col("n_chars").alias("score"),
        F.lit(None).cast("bigint").alias("descendants"), F.lit(0).cast("bigint").alias("time"),
    )
    return scans.story_articles(ids.select((F.col("_rank") - 1).alias("pos"), F.col("doc_id").alias("id")), items, 2 * PER_SOURCE)


@query
def src3_union(t: Tables) -> DataFrame:
    """All feeds, one of them under the name of the story feed, plus the stories."""
    renamed = F.when(F.col("source") == "src5", A.STORY_FEED).otherwise(F.col("source"))
    feeds = A.intake(t.feed_items().withColumn("source", renamed), AS_OF, PER_SOURCE)
    return A.union_sources(feeds, _stories(t)).select("title", "link", "source", "published", "feed_ord", "feed_pos")


@query
def src4_feed_health(t: Tables) -> DataFrame:
    """Health out of the fetch log and the landed snapshots; some feeds were never fetched."""
    landed = _snapshots(t)
    status = t.feeds().filter("source <> 'src12'").select(
        "source", F.when(F.col("source") == "src4", 503).when(F.col("source") == "src9", 404).otherwise(200).alias("status"))
    states = _stored(t, scans.of_feeds(scans.feed_states(landed), t.feeds()), "feed-states")
    return A.feed_health(t.feeds(), scans.fetch_log(landed, status), states.filter("state <> 'lost'"), states.filter("state <> 'whole'"))


@query
def src5_state_import(t: Tables) -> DataFrame:
    """Rows of every map of legacy JSON documents, some of them corrupt and some entries no objects."""
    entry = F.to_json(F.struct(
        F.col("title"), F.col("link"), F.col("source"), F.lit("2024-01-25T06:00:00").alias("sent_at"),
        F.lit("2024-01-26T06:00:00").alias("fetched_at"), F.col("link").alias("subject")))
    quoted = F.concat(F.lit('"'), F.col("article_key"), F.lit('"'))
    rows = t.articles().select(
        F.when(F.col("feed_pos") % 10 == 7, "{broken")
        .when(F.col("feed_pos") % 10 == 8, '{"last_cleanup":null}')
        .otherwise(F.concat(
            F.lit('{"sent_articles":{'), quoted, F.lit(":"), entry, F.lit(',"none":7},"reddit_thread_details":{'), quoted, F.lit(":"), entry,
            F.lit('},"web_sweep":['), entry, F.lit(',3],"web_sweep_meta":{"last_run_date":"2024-01-27","last_batch":"b"}}')))
        .alias("document"))
    sent, threads = scans.state_documents(rows), scans.thread_documents(rows)
    return (
        sent.select(F.lit("sent").alias("kind"), F.col("article_key").alias("key"), "title", F.col("sent_at").alias("at"))
        .unionByName(threads.select(F.lit("thread").alias("kind"), F.col("url").alias("key"), "title", F.col("fetched_at").alias("at")))
        .unionByName(scans.signal_documents(rows).select(F.lit("signal").alias("kind"), F.md5("subject").alias("key"), F.lit("").alias("title"), F.lit(None).cast("timestamp_ntz").alias("at")))
        .unionByName(scans.run_stamps(rows).select(F.lit("stamp").alias("kind"), F.col("last_run_date").alias("key"), F.lit("").alias("title"), F.lit(None).cast("timestamp_ntz").alias("at")))
    )


@query
def src6_payload_entries(t: Tables) -> DataFrame:
    entries = G.payload_entries(t.payloads())
    return entries.select("batch", "lane", "payload_seq", "pos", G.V.is_object(F.col("entry")).alias("is_object"))


@query
def src7_pages(t: Tables) -> DataFrame:
    return scans.pages(t.spark, f"{t.dir}/pages.parquet").select("page_id", "url", F.length("html").cast("bigint").alias("n_chars"))


@query
def src8_file_listing(t: Tables) -> DataFrame:
    """The documents written by source, and what the listing of that folder shows."""
    path = scratch_path(t.spark, "listed")
    t.documents.select("doc_id", "source").write.partitionBy("source").parquet(path)
    files = scans.file_listing(t.spark, path, "*.parquet")
    return files.groupBy("folder").agg((F.min("length") > 0).alias("filled"))


# ---------------------------------------------------------------- sinks


def _stored(t: Tables, rows: DataFrame, name: str) -> DataFrame:
    """A state table as it stands: written once, then read by every use."""
    path = scratch_path(t.spark, name)
    rows.write.parquet(path)
    return t.spark.read.schema(rows.schema).parquet(path)


def _recent_sent(t: Tables) -> DataFrame:
    return _stored(t, t.recent_sent(), "sent")


@query
def snk1_mark_sent(t: Tables) -> DataFrame:
    """A batch of half of the articles; the rest of the history stays as it was."""
    return S.mark_sent(t.sent(), t.articles().filter(F.col("feed_pos") % 2 == 1), AS_OF)


def _digest(new: DataFrame) -> DataFrame:
    return new.groupBy("source").agg(F.count("*").alias("n_new"))


@query
def snk2_commit(t: Tables) -> DataFrame:
    """Three runs, each with a sweep: one commits, the next is not delivered and leaves no trace, the last sees the first only."""
    log = StateLog(t.spark, scratch_path(t.spark, "state"))
    rows = _stored(t, t.todays(), "todays")
    signals = _signal_table(t)
    even, old = F.col("feed_ord") % 2 == 0, F.col("batch") < "2024-01-22"
    run_daily(log, rows.filter(even), 1, AS_OF, _digest, signals=signals.filter(old))
    run_daily(log, rows, 2, AS_OF, _digest, deliver=lambda published: False, signals=signals)
    run_daily(log, rows, 3, AS_OF, _digest, signals=signals.filter(~old))
    sent = log.read("sent", schemas.SENT, 4).select("run", F.lit("sent").alias("kind"), F.col("article_key").alias("key"))
    swept = log.read("signals", schemas.SIGNAL, 4).select("run", F.lit("signal").alias("kind"), F.col("id").alias("key"))
    fresh = log.read("fresh", schemas.SIGNAL, 4).select("run", F.lit("fresh").alias("kind"), F.col("id").alias("key"))
    return sent.unionByName(swept).unionByName(fresh).groupBy("run", "kind", "key").agg(F.count("*").alias("n"))


@query
def snk3_history_write(t: Tables) -> DataFrame:
    """Two sweeps written to the signal log, read back as the rolling history."""
    log = StateLog(t.spark, scratch_path(t.spark, "sweep"))
    signals = t.signals()
    old = F.col("batch") < "2024-01-22"
    run_sweep_merge(log, signals.filter(old), 1, SWEEP_AS_OF)
    run_sweep_merge(log, signals.filter(~old), 2, SWEEP_AS_OF)
    return signal_history(log, 3, SWEEP_AS_OF).select("id", "batch", "date", "lane", "severity", "summary")


@query
def snk4_publish(t: Tables) -> DataFrame:
    """Digest documents written by day and read back."""
    path = scratch_path(t.spark, "digests")
    _rendered(t).withColumn("digest_date", F.lit(AS_OF[:10])).write.partitionBy("digest_date").parquet(path)
    return t.spark.read.parquet(path).select("lang", "part_no", F.md5("html").alias("html_md5"), "n_articles", F.col("digest_date").cast("string").alias("digest_date"))


# ---------------------------------------------------------------- filters and projections


@query
def flt1_recent(t: Tables) -> DataFrame:
    return A.recent(t.articles(), AS_OF).select("article_key", "source", "published", "feed_pos")


@query
def flt2_published(t: Tables) -> DataFrame:
    at = A.published_at(F.col("published"), F.col("updated"))
    return t.feed_items().select("doc_id", at.alias("published"))


@query
def flt3_summary(t: Tables) -> DataFrame:
    return t.feed_items().select("doc_id", A.article_summary(F.col("summary"), F.col("description")).alias("summary"))


@query
def flt4_thread_articles(t: Tables) -> DataFrame:
    return A.thread_articles(t.articles()).select("article_key", "link", "source", "feed_pos")


@query
def flt5_grounded(t: Tables) -> DataFrame:
    rows = G.grounded(G.entry_fields(G.payload_entries(t.payloads())))
    return rows.select("payload_seq", "pos", "subject", "summary", "source_url")


@query
def flt6_lane_selection(t: Tables) -> DataFrame:
    return G.select_lanes(t.payloads(), ["competitor", "launches"]).groupBy("lane").agg(F.count("*").alias("n_payloads"))


def _run_stats(t: Tables) -> DataFrame:
    """Per day: new, thread, buildable and built counts."""
    day = F.coalesce(F.date_format("published", "yyyy-MM-dd"), F.lit("undated"))
    a = t.articles().withColumn("run", day)
    thread = F.contains("link", F.lit("reddit.com")).cast("int")
    all_rows = a.select("run", F.lit(0).alias("new"), thread.alias("thread"), F.lit(0).alias("built"))
    new = A.not_sent(a, _recent_sent(t)).select("run", F.lit(1).alias("new"), F.lit(0).alias("thread"), thread.alias("built"))
    return all_rows.unionByName(new).groupBy("run").agg(
        F.sum("new").alias("n_new"), F.sum("thread").alias("n_threads"),
        F.sum("thread").alias("n_to_build"), F.sum("built").alias("n_built"))


@query
def flt7_alerts(t: Tables) -> DataFrame:
    """Alerts of every day from the first to the one after the last, of days without any article and of undated articles too."""
    counts = _stored(t, _run_stats(t), "run-stats")
    return R.alerts(R.run_stats(R.calendar(counts, after=1), counts))


@query
def prj1_article_key(t: Tables) -> DataFrame:
    return t.articles().select("article_key", "feed_pos")


@query
def prj2_signal_id(t: Tables) -> DataFrame:
    fields = G.entry_fields(G.payload_entries(t.payloads()))
    return fields.select("payload_seq", "pos", content_key(F.col("subject"), F.col("source_url")).alias("id"))


@query
def prj3_signal_dimensions(t: Tables) -> DataFrame:
    return t.signals().groupBy("batch", "lane", "topic", "topic_label").agg(F.count("*").alias("n_signals"))


# ---------------------------------------------------------------- joins


@query
def jn1_not_sent(t: Tables) -> DataFrame:
    return A.not_sent(t.articles(), _recent_sent(t)).select(*ARTICLE_COLUMNS)


@query
def jn2_skip_report(t: Tables) -> DataFrame:
    return A.skip_report(t.articles(), _recent_sent(t))


@query
def jn3_uncached_threads(t: Tables) -> DataFrame:
    return S.uncached(t.articles(), _stored(t, t.threads(), "threads")).select("article_key", "link", "feed_pos")


def _signal_table(t: Tables) -> DataFrame:
    """Signals as the stored history they are: written once, then read by every use."""
    return _stored(t, t.signals(), "signals")


@query
def jn4_fresh_signals(t: Tables) -> DataFrame:
    signals = _signal_table(t)
    current, prior = signals.filter(F.col("batch") == LAST_BATCH), signals.filter(F.col("batch") < LAST_BATCH)
    state = F.when(F.col("is_repeat"), "repeat").otherwise("fresh")
    return G.mark_repeats(current, prior).select("id", "lane", "subject", state.alias("state"))


@query
def jn5_nearest_bucket(t: Tables) -> DataFrame:
    name = F.concat("p_name", F.lit(":"), F.col("p_size").cast("string"), F.lit("b"))
    return t.part.select("p_partkey", C.timeout_for(F.when(F.col("p_size") == 33, F.col("p_name")).otherwise(name)).alias("timeout"))


@query
def jn5_nearest_row(t: Tables) -> DataFrame:
    """The order whose total is closest to the price of each line item: a bucket table that grows with the data."""
    price = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", price.alias("price"))
    return C.nearest_in(lines, "price", t.orders, "o_totalprice", "o_orderkey", F.lit(-1).cast("bigint"), "near_orderkey")


@query
def jn6_lookups(t: Tables) -> DataFrame:
    raw = F.when(F.col("event_type") == "error", "act_now").when(F.col("event_type") == "purchase", "notable").otherwise(F.col("event_type"))
    voices = F.struct(F.lit("voice-a").alias("alex"), F.lit("voice-s").alias("sam"))
    who = F.when(F.col("user_id") % 3 == 0, "Sam").when(F.col("user_id") % 3 == 1, "Alex").otherwise("Guest")
    return t.events.select(
        "event_id", G.severity_rank(raw).alias("rank"), G.severity_badge(raw).alias("badge"), P.voice_of(who, voices).alias("voice"))


@query
def jn7_rule_match(t: Tables) -> DataFrame:
    """Rules as a table: equi-join on words."""
    rules = t.spark.createDataFrame([(r.tier, r.topic, r.term) for r in RULES], "tier INT, topic STRING, term STRING")
    rows = t.articles().withColumn("row_id", F.col("feed_pos"))
    return U.match_rules(rows, rules).select("row_id", "article_key", "topic", "tier", "n_hits")


# ---------------------------------------------------------------- aggregates


@query
def agg1_rows_per_source(t: Tables) -> DataFrame:
    return A.rows_per_source(t.feeds(), A.intake(t.feed_items(), AS_OF, PER_SOURCE))


@query
def agg2_severity_counts(t: Tables) -> DataFrame:
    return G.severity_counts(t.signals())


@query
def agg3_sweep_funnel(t: Tables) -> DataFrame:
    return G.funnel(t.payloads())


@query
def agg4_overflow(t: Tables) -> DataFrame:
    return G.overflow(t.signals())


FAMILIES = ["brand#1", "Brand#2", "BRAND#25", "widget", "nothing"]


@query
def agg5_latest_per_family(t: Tables) -> DataFrame:
    p = F.col("p_partkey")
    created = F.when(p % 7 != 0, F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("timestamp_ntz"))
    entries = t.part.select(
        F.concat("p_brand", F.lit("-"), p.cast("string")).alias("id"),
        F.when(F.contains("p_brand", F.lit("25")), F.lit(None)).otherwise(created).alias("created"))
    return C.latest_per_family(entries, FAMILIES)


@query
def agg6_article_blocks(t: Tables) -> DataFrame:
    rows = A.intake(t.feed_items(), AS_OF, PER_SOURCE).withColumn("digest", F.lit("daily"))
    return D.article_blocks(rows, ["digest"])


@query
def agg7_history_size(t: Tables) -> DataFrame:
    return S.history_size(t.recent_sent())


@query
def agg8_error_counts(t: Tables) -> DataFrame:
    return R.error_counts(R.classify(t.api_errors()))


# ---------------------------------------------------------------- windows


@query
def win1_source_topk(t: Tables) -> DataFrame:
    return t.todays().select(*ARTICLE_COLUMNS)


@query
def win2_first_per_subject(t: Tables) -> DataFrame:
    rows = G.first_per_subject(G.grounded(G.entry_fields(G.payload_entries(t.payloads()))))
    return rows.select("batch", "lane", "payload_seq", "pos", "subject", "signal_type")


@query
def win3_transcript_segments(t: Tables) -> DataFrame:
    """Segments of conversations, straight from their turn rows."""
    label = F.when(F.col("role") == "user", "Alex: ").when(F.col("role") == "assistant", "Sam: ").otherwise("")
    turns = t.conversations.select("conv_id", "turn", F.concat(label, F.col("text")).alias("line"))
    return P.transcript_segments(turns, "conv_id", "turn", "line")


@query
def win4_label_islands(t: Tables) -> DataFrame:
    rows = G.label_islands(G.ranked(t.signals(), 60))
    return rows.select("batch", "item_no", "island", "topic_label", "severity", "id")


@query
def win5_list_state(t: Tables) -> DataFrame:
    return X.list_state(t.markdown(), "doc_id").select("doc_id", "line_no", "in_list", F.md5("line").alias("line_md5"))


INTRO_MS, OUTRO_MS = 8000, 12000


@query
def win6_timeline(t: Tables) -> DataFrame:
    return P.timeline(t.segments(), intro_ms=INTRO_MS)


@query
def win6_episode_length(t: Tables) -> DataFrame:
    return P.episode_length(P.timeline(t.segments(), intro_ms=INTRO_MS), intro_ms=INTRO_MS, outro_ms=OUTRO_MS)


# ---------------------------------------------------------------- order and limits


@query
def top1_ranked_signals(t: Tables) -> DataFrame:
    return G.ranked(t.signals()).select("batch", "item_no", "severity", "topic_label", "id")


@query
def top2_first_threads(t: Tables) -> DataFrame:
    run = t.articles().withColumn("run", F.lit(0))
    return S.uncached_threads(run, t.threads(), ["run"]).select("article_key", "link", "feed_ord", "feed_pos")


def _topic_digests(t: Tables) -> DataFrame:
    """Digest documents made of the lines of a document."""
    def item(line, i):
        return (
            F.when(i % 3 == 0, F.concat(F.lit('<li><strong><a href="https://example.com">'), line, F.lit("</a></strong> (x)<br>y</li>")))
            .when(i % 3 == 1, F.concat(F.lit("<li><strong>"), line, F.lit("</strong> - z</li>")))
            .otherwise(F.concat(F.lit("<li>"), line, F.lit("</li>"))))

    heading = F.get(F.array(*[F.lit(h) for h in ("🔥 Top <em>Priority</em>", "Laptops", "Other news", "High PRIORITY")]), (F.col("doc_id") % 4).cast("int"))
    items = F.array_join(F.transform(F.split("text", "\n"), item), "\n")
    return t.documents.select("doc_id", F.concat(
        F.lit("<h1>Digest</h1><h2>First</h2><ul><li><a>skip me please</a></li></ul><h2>"), heading,
        F.lit("</h2>\n<ul>\n"), items, F.lit("\n</ul><h2>Last "), F.when(F.col("doc_id") % 4 != 2, "top").otherwise("words"), F.lit("</h2><ul><li><strong>never</strong></li></ul>")).alias("html"))


@query
def top3_lead_topics(t: Tables) -> DataFrame:
    """First topics of a digest's lead section."""
    return X.topics(_topic_digests(t), "doc_id")


@query
def txt4_sibling_lists(t: Tables) -> DataFrame:
    """Topics where heading and list are wrapped: only a list with the heading's parent is its list, nested items count."""
    links = F.concat(F.lit("<ul>"), F.array_join(F.transform(
        F.split("text", "\n"), lambda line: F.concat(F.lit('<li><a href="u">'), line, F.lit("</a></li>"))), "\n"), F.lit("</ul>"))
    html = (
        F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("<div><h2>Top</h2></div>"), links))
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("<h2>Top</h2><div>"), links, F.lit("</div>")))
        .otherwise(F.concat(F.lit("<section><h2>Top</h2><p>Intro<br></p></p><ul><li>all"), links, F.lit("</li></ul></section>"))))
    return X.topics(t.documents.select("doc_id", html.alias("html")), "doc_id")


@query
def top4_story_ids(t: Tables) -> DataFrame:
    ids = t.conversations.select(F.col("conv_id").alias("run"), F.col("turn").alias("pos"), F.length("text").alias("id"))
    return ids.filter(F.col("pos") < 3)


@query
def srt1_display_order(t: Tables) -> DataFrame:
    return G.display_order(t.signals()).select("id", "batch", "lane", "severity")


# ---------------------------------------------------------------- sets and upserts


@query
def set1_bag_union(t: Tables) -> DataFrame:
    rows = t.todays()
    fresh, again = rows.filter(F.col("published").isNull()), rows.filter(F.col("published").isNotNull())
    return fresh.unionByName(again).unionByName(fresh).select("article_key", "source", "feed_pos")


@query
def set2_add_threads(t: Tables) -> DataFrame:
    rows = S.add_threads(t.threads(), t.articles(), AS_OF)
    return rows.select("url", "title", "selftext", "subreddit", "created_utc", "fetched_at", F.size("top_comments").alias("n_comments_kept"))


@query
def set3_ordered_distinct(t: Tables) -> DataFrame:
    order = F.array(F.when(F.col("p_size") % 3 == 0, "").otherwise(F.col("p_type")), F.col("p_brand"), F.col("p_type"), F.col("p_name"), F.col("p_brand"))
    return t.part.select("p_partkey", F.array_join(ordered_distinct(order), ">").alias("fallbacks"))


@query
def sig5_merge_signals(t: Tables) -> DataFrame:
    signals = _signal_table(t)
    old = F.col("batch") < "2024-01-22"
    merged = S.merge_signals(signals.filter(old), signals.filter(~old), SWEEP_AS_OF)
    return merged.select("id", "batch", "date", "lane", "severity", "summary", F.col("first_seen.seq.payload_seq").alias("first_seq"))


@query
def ret1_retained_sent(t: Tables) -> DataFrame:
    return t.recent_sent().select("article_key", "source", "sent_at")


@query
def ret2_retained_threads(t: Tables) -> DataFrame:
    return S.retained(t.threads(), "fetched_at", AS_OF).select("url", "title", "fetched_at")


@query
def ret3_expired_audio(t: Tables) -> DataFrame:
    name = F.when(F.col("o_custkey") % 9 == 0, F.concat(F.lit("digest-v"), F.col("o_custkey").cast("string"), F.lit(".mp3"))).otherwise(
        F.concat(F.lit("digest-"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".mp3")))
    files = t.orders.select("o_orderkey", name.alias("name"))
    return S.expired_audio(files, "1996-06-15 08:30:00").groupBy("name", "file_date", "status").agg(F.count("*").alias("n_files"))


@query
def ret4_expired_logs(t: Tables) -> DataFrame:
    name = F.when(F.col("event_type") == "view", "digest.log").when(F.col("event_type") == "click", "other.log.1").otherwise(F.concat(F.lit("digest.log."), F.col("event_id").cast("string")))
    files = t.events.select(name.alias("name"), F.col("ts").alias("modified"))
    return S.expired_logs(files, "digest.log", "2024-02-10 00:00:00", 30)


@query
def rdt1_threads(t: Tables) -> DataFrame:
    built = S.build_threads(A.thread_articles(t.articles()), AS_OF)
    return built.select("url", "title", "selftext", "subreddit", "created_utc", "score")


# ---------------------------------------------------------------- signals


@query
def sig1_normalize(t: Tables) -> DataFrame:
    names = [c for c in schemas.SIGNAL.fieldNames() if c != "seq"]
    return t.signals().select(*names, F.col("seq.payload_seq").alias("payload_seq"), F.col("seq.pos").alias("pos"))


@query
def sig2_section(t: Tables) -> DataFrame:
    """Sections of all batches: what earlier batches reported is counted, not listed."""
    signals, counts = G.sweep(t.payloads(), t.lanes())
    marked = G.mark_prior_batches(_stored(t, signals, "signals"))
    errors = counts.filter(F.col("n_failed") > 0)
    return G.render_sections(marked.filter("NOT is_repeat"), marked.filter("is_repeat"), errors)


@query
def sig3_sweep_due(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    last = F.when(k % 25 == 0, F.lit(None)).when(k % 31 == 0, "garbage").otherwise(
        F.date_format(F.date_sub(F.lit("2024-01-30").cast("date"), (k % 12).cast("int")), "yyyy-MM-dd"))
    day = F.get(F.array(*[F.lit(d) for d in ("monday", " Tuesday ", "friday")]), (k % 3).cast("int"))
    return t.customer.select("c_custkey", G.sweep_due(last, AS_OF, day, k % 50 == 7).alias("due"))


# ---------------------------------------------------------------- documents


@query
def txt1_page_text(t: Tables) -> DataFrame:
    return X.page_text(t.pages).select("page_id", "text")


@query
def txt2_reasoning(t: Tables) -> DataFrame:
    text = F.concat(F.lit("  <think>a\nb</think>\n "), F.col("text"), F.when(F.col("turn") % 2 == 0, "<think>x</think>  tail").otherwise(" <think>open"))
    return t.conversations.select("conv_id", "turn", strip_reasoning(text).alias("text"))


@query
def txt3_markdown(t: Tables) -> DataFrame:
    return X.digest_html(t.markdown()).select("doc_id", "html")


@query
def txt4_page_topics(t: Tables) -> DataFrame:
    return X.topics(t.pages, "page_id")


@query
def txt5_script_segments(t: Tables) -> DataFrame:
    segments, _ = P.parse_scripts(t.scripts(), "doc_id")
    return segments


@query
def txt5_script_errors(t: Tables) -> DataFrame:
    _, errors = P.parse_scripts(t.scripts(), "doc_id")
    return errors


@query
def txt6_length_budget(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(length_budget(F.col("text"), sample=True)).alias("sample_md5"), F.md5(length_budget(F.col("text"))).alias("full_md5"))


def _replies(t: Tables) -> DataFrame:
    """Block replies: a turn framed by reasoning and tool blocks; some turns carry no text."""
    def block(kind, text):
        return F.struct(F.lit(kind).alias("type"), text.alias("text"))

    none = F.lit(None).cast("string")
    body = F.when(F.col("turn") % 7 == 3, F.lit("  ")).otherwise(F.col("text"))
    return t.conversations.select("conv_id", "turn", F.array(
        block("thinking", F.lit("hidden")), block("text", body), block("tool_use", none),
        block("other", F.lit(" ")), block("redacted_thinking", F.lit("hidden"))).alias("blocks"))


@query
def txt7_reply_text(t: Tables) -> DataFrame:
    texts, empty = X.reply_text(_replies(t))
    return texts.select("conv_id", "turn", "text").unionByName(empty.select("conv_id", "turn", F.lit("(no text)").alias("text")))


@query
def txt8_parse_size(t: Tables) -> DataFrame:
    name = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("m"), F.col("p_size").cast("string"), F.lit(".5B:latest"))).when(
        F.col("p_partkey") % 4 == 1, F.concat(F.lit("m9b:"), F.col("p_size").cast("string"), F.lit("b-q4"))).otherwise(F.col("p_name"))
    return t.part.select("p_partkey", parse_size(name).alias("size_b"))


TEMPLATE = "Reader: {reader}\n\nARTICLES:\n{articles}\n---\nPick the best."


@query
def txt9_prompts(t: Tables) -> DataFrame:
    blocks = D.article_blocks(t.todays().withColumn("edition", F.when(F.col("feed_ord") < 10, "a").otherwise("b")), ["edition"])
    return D.prompts(blocks, TEMPLATE, reader="Alex").select("edition", F.md5("prompt").alias("prompt_md5"), "n_articles")


LANE_TEMPLATE = "{framing}\nOn {today}, look into {key}: {brief}\nReport about {target} findings."


@query
def txt9_lane_prompts(t: Tables) -> DataFrame:
    """Assignment texts of one lane per part."""
    k = F.col("p_partkey")
    lanes = t.part.select(
        k.cast("string").alias("key"), F.col("p_brand").alias("topic"), F.col("p_name").alias("topic_label"),
        F.when(k % 3 != 0, F.col("p_brand")).alias("framing"), F.col("p_type").alias("brief"),
        F.when(k % 5 != 0, F.col("p_size")).alias("target_signals"), F.when(k % 2 == 0, F.col("p_name")).alias("extra_rules"))
    return G.lane_prompts(lanes, SWEEP_AS_OF, LANE_TEMPLATE)


@query
def err1_classify(t: Tables) -> DataFrame:
    rows = R.classify(t.api_errors())
    return rows.select("event_id", "error_type", "transient", "model_missing", "label")


@query
def err2_suggest_action(t: Tables) -> DataFrame:
    return t.api_errors().select("event_id", R.suggest_action(F.col("message")).alias("suggest_action"))


@query
def hsh1_daily_voice(t: Tables) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    pool = P.VOICE_POOLS["elevenlabs_male"]
    voice = P.daily_voice(pool, day, F.col("o_orderpriority"))
    return t.orders.select("o_orderkey", P.voice_index(day, F.col("o_orderpriority"), 7).alias("idx7"), voice["name"].alias("name"))


@query
def hsh2_pinned_voices(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    day = F.concat(F.lit("day-"), k.cast("string"))
    voices = P.host_voices(day, "edge_male", "edge_female", F.when(k % 2 == 0, "pin-a").otherwise(""), F.when(k % 3 == 0, "pin-s"))
    return t.customer.select("c_custkey", voices["alex"].alias("alex"), voices["sam"].alias("sam"))


# ---------------------------------------------------------------- curation


def _tagged(t: Tables) -> DataFrame:
    return U.tag(t.articles(), RULES)


@query
def int1_topics(t: Tables) -> DataFrame:
    rows = _tagged(t).select("feed_pos", F.explode("topics").alias("x"))
    return rows.select("feed_pos", F.col("x.topic").alias("topic"), F.col("x.tier").alias("tier"), F.col("x.n_hits").alias("n_hits"))


@query
def int2_score(t: Tables) -> DataFrame:
    return U.score(_tagged(t)).select("feed_pos", "best_tier", "lead_topic", "n_hits")


@query
def int3_must_watch(t: Tables) -> DataFrame:
    return U.score(_tagged(t)).filter("must_watch").select("article_key", "feed_pos", "source", "n_hits")


def _scored(t: Tables) -> DataFrame:
    return U.score(U.tag(U.exclude(t.articles(), STRICT, RULES), RULES, SKIP))


@query
def int4_excluded(t: Tables) -> DataFrame:
    return _scored(t).select("feed_pos", F.size("topics").alias("n_topics"), "best_tier", "n_hits")


@query
def int5_best_per_story(t: Tables) -> DataFrame:
    """Best article of every story; the label quality settles ties of rules."""
    quality = t.labels.select(F.col("doc_id").alias("feed_pos"), "quality")
    rated = U.score(_tagged(t)).join(quality, "feed_pos", "left")
    return U.best_per_story(rated, quality="quality").select("story_key", "feed_pos", "title", "best_tier")


@query
def int5_near_stories(t: Tables) -> DataFrame:
    """Articles and the story they tell, near copies of title and summary together."""
    return U.near_stories(t.articles().withColumn("row_id", F.col("feed_pos")))


def _chosen(t: Tables) -> DataFrame:
    """Selection per language edition."""
    langs = t.documents.select(F.col("doc_id").alias("feed_pos"), "lang")
    best = U.best_per_story(_scored(t).join(langs, "feed_pos"), ["lang"])
    return U.apply_quotas(U.route(best), ["lang"])


@query
def int6_sections(t: Tables) -> DataFrame:
    return U.route(_scored(t)).select("feed_pos", "section", "section_ord", "lead_topic")


@query
def int7_selection(t: Tables) -> DataFrame:
    return _chosen(t).select("lang", "section", "feed_pos", "must_watch", "best_tier", "n_hits")


@query
def int8_companies(t: Tables) -> DataFrame:
    return U.mentions(t.articles(), COMPANIES, ["source"])


@query
def int9_opportunities(t: Tables) -> DataFrame:
    return U.opportunities(t.announcements(), F.col("text"))


def _rendered(t: Tables) -> DataFrame:
    return D.render(_chosen(t), ["lang"], F.lit(AS_OF[:10]))


@query
def int10_digest(t: Tables) -> DataFrame:
    return _rendered(t)


# ---------------------------------------------------------------- streaming


#: Drops that land one after the other, each taken in by a tick of its own.
DROPS = 3


def _ticks(t: Tables, rows: DataFrame, drop: F.Column, name: str, tick: Callable[[DataFrame, str], None]) -> None:
    """Land one drop, run the job, land the next: the job goes on where it stopped."""
    path, checkpoint = scratch_path(t.spark, name), scratch_path(t.spark, f"{name}-checkpoint")
    for i in range(DROPS):
        rows.filter(drop == i).write.mode("append").parquet(path)
        tick(jobs.landed(t.spark, path, rows.schema), checkpoint)


def _turn() -> F.Column:
    return F.pmod("feed_pos", F.lit(DROPS))


@query
def str1_ingest(t: Tables) -> DataFrame:
    """Items taken in from landed files over several ticks, exactly once."""
    items, out = t.feed_items().select("source", "title", "link", "feed_pos"), scratch_path(t.spark, "ingested")
    _ticks(t, items, _turn(), "landed", lambda stream, checkpoint: jobs.ingest(stream, out, checkpoint))
    return t.spark.read.schema(items.schema).parquet(out).select("source", "title", "link", "feed_pos")


@query
def str2_recent(t: Tables) -> DataFrame:
    """Recent rows and the run that took them in."""
    out = scratch_path(t.spark, "recent")
    _ticks(t, t.articles(), _turn(), "drops", lambda stream, checkpoint: jobs.ingest_recent(stream, out, checkpoint, AS_OF))
    return t.spark.read.parquet(out).select("article_key", "source", "published", "feed_pos", F.col("run").cast("bigint").alias("run"))


@query
def str3_exact_dedup(t: Tables) -> DataFrame:
    """Daily runs over landed drops: every key and the run that delivered it."""
    log = StateLog(t.spark, scratch_path(t.spark, "log"))
    _ticks(t, t.articles(), _turn(), "drops", lambda stream, checkpoint: jobs.daily_stream(stream, log, checkpoint, lambda _: AS_OF, _digest))
    return log.read("sent", schemas.SENT, 2**31).select("article_key", "run")


@query
def str4_bounded_dedup(t: Tables) -> DataFrame:
    items = t.events.select(
        content_key(F.col("event_type"), F.col("user_id").cast("string")).alias("article_key"),
        F.col("ts").cast("timestamp").alias("ts"))
    path, out = scratch_path(t.spark, "events"), scratch_path(t.spark, "unique")
    items.write.parquet(path)
    jobs.dedup_within(jobs.landed(t.spark, path, items.schema), out, scratch_path(t.spark, "unique-checkpoint"), "ts", "60 days")
    return t.spark.read.parquet(out).select("article_key")


@query
def str5_thread_state(t: Tables) -> DataFrame:
    """Threads of landed drops, inserted once per link by the run that saw it first."""
    log = StateLog(t.spark, scratch_path(t.spark, "threads"))
    _ticks(t, t.articles(), _turn(), "drops", lambda stream, checkpoint: jobs.threads_stream(stream, log, checkpoint, lambda _: AS_OF))
    return log.read("threads", schemas.THREAD, 2**31).select("url", "title", "subreddit", "run")


@query
def str6_signal_state(t: Tables) -> DataFrame:
    """Sweeps landed week by week, merged tick by tick; the final rolling history."""
    log = StateLog(t.spark, scratch_path(t.spark, "signals"))
    drop = F.when(F.col("batch") < "2024-01-15", 0).when(F.col("batch") < LAST_BATCH, 1).otherwise(2)
    _ticks(t, _signal_table(t), drop, "weeks", lambda stream, checkpoint: jobs.sweep_stream(stream, log, checkpoint, SWEEP_AS_OF))
    return signal_history(log, 2**31, SWEEP_AS_OF).select("id", "batch", "date", "lane", "severity")


@query
def str5_keyed_threads(t: Tables) -> DataFrame:
    """Every link lands in up to three drops, three and eight days after the first: let in, refused, back after seven days."""
    landing = F.filter(F.array(*[F.lit(i) for i in range(DROPS)]), lambda i: F.pmod(F.bit_count("feed_pos") + i * (F.col("feed_pos") % 5), F.lit(3)) != 1)
    days = F.get(F.array(F.lit(0), F.lit(3), F.lit(8)), F.col("drop"))
    rows = t.articles().withColumn("drop", F.explode(landing))
    rows = rows.withColumn("seen_at", F.timestamp_add("DAY", days, F.lit(AS_OF).cast("timestamp")))
    out = scratch_path(t.spark, "keyed-threads")
    _ticks(t, rows, F.col("drop"), "keyed", lambda stream, checkpoint: keyed.keyed_threads(stream, out, checkpoint, "seen_at"))
    return t.spark.read.schema(schemas.THREAD).parquet(out).select("url", "title", "subreddit", F.date_format("fetched_at", "yyyy-MM-dd").alias("day"))


@query
def str6_keyed_signals(t: Tables) -> DataFrame:
    """Every signal and sweep that reported it: was it reported within 45 days before."""
    out = scratch_path(t.spark, "keyed-signals")
    drop = F.when(F.col("batch") < "2024-01-15", 0).when(F.col("batch") < LAST_BATCH, 1).otherwise(2)
    rows = _signal_table(t).withColumn("swept_at", F.col("batch").cast("timestamp"))
    _ticks(t, rows, drop, "keyed-weeks", lambda stream, checkpoint: keyed.keyed_signals(stream, out, checkpoint, "swept_at"))
    return t.spark.read.parquet(out).select("id", "batch", "lane", "severity", "is_repeat")


@query
def str7_daily_counts(t: Tables) -> DataFrame:
    """Rows per day and source of closed days."""
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("source"))
    path, out = scratch_path(t.spark, "stream"), scratch_path(t.spark, "counts")
    rows.write.parquet(path)
    jobs.daily_counts(jobs.landed(t.spark, path, rows.schema), out, scratch_path(t.spark, "counts-checkpoint"), "ts")
    counts = t.spark.read.parquet(out)
    return counts.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "source", "n_rows")


@query
def str7_silent_sources(t: Tables) -> DataFrame:
    """Source and day pairs without rows, next to a source that never reports."""
    day = F.date_format("ts", "yyyy-MM-dd")
    counts = t.events.groupBy(day.alias("day"), F.col("event_type").alias("source")).agg(F.count("*").alias("n_rows"))
    return jobs.silent_sources(counts, ["click", "view", "silent"])


@query
def str7_closed_days(t: Tables) -> DataFrame:
    """Three drops with gaps: every closed day of every expected feed, each once, with an alert where it had no rows."""
    rows = t.events.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("source"), F.col("user_id"))
    # One day without any row, and a feed that pauses for two days.
    day = F.dayofmonth("ts")
    rows = rows.filter((day != 9) & ~((F.col("source") == "click") & day.between(14, 15)))
    feeds = t.spark.createDataFrame([("click",), ("view",), ("silent",)], "source STRING")
    log = StateLog(t.spark, scratch_path(t.spark, "days"))
    drop = F.when(day < 8, 0).when(day < 16, 1).otherwise(2)
    _ticks(t, rows, drop, "day-drops", lambda stream, checkpoint: days.closing_days(stream, log, checkpoint, feeds, "ts"))
    return days.closed_days(log).select(F.date_format("date", "yyyy-MM-dd").alias("day"), "source", "n_rows", "alert")


def flagship(t: Tables) -> DataFrame:
    """Today's new articles per source: scan, windowed top-k, retention, anti join, count."""
    new = A.not_sent(t.todays(), t.recent_sent())
    return A.rows_per_source(t.feeds(), new)


QUERIES["flagship_new_per_source"] = lambda spark, sf_dir: flagship(Tables(spark, sf_dir))
