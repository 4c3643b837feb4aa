"""Readers for landed feeds, stories, pages, payloads, state tables and file listings."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import variants as V
from ..functions.html import WINDOWS, entity_table, unescape
from ..functions.text import html_escape
from ..functions.times import from_epoch
from ..operators.articles import STORY_FEED_ORD, STORY_SOURCE
from ..plans.ordered import once

# Names keep their prefix, so that <media:title> or <atom:link> never stands for the plain element.
_LINK = T.ArrayType(schemas.shape("_VALUE _href _rel"))
_ENTRY = schemas.shape(
    "title description summary content content:encoded pubDate published updated dc:date", link=_LINK)
_PERMISSIVE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"}


#: Charsets of one byte per character that are read as Windows-1252, their common superset.
_ONE_BYTE = ("iso-8859-1", "iso8859-1", "latin-1", "latin1", "windows-1252", "cp1252", "us-ascii", "ascii", "iso-8859-15")
_CDATA = r"(?s)<!\[CDATA\[(.*?)\]\]>"
_FIELDS = ("title", "description", "summary", "content", "content:encoded", "pubDate", "published", "updated", "dc:date")


def decoded(content: Column) -> Column:
    """Text of a file by its declared charset, else as UTF-8 if it is that, else as Windows-1252."""
    bytes_ = F.decode(content, "ISO-8859-1")
    declared = F.lower(F.regexp_extract(F.left(bytes_, F.lit(200)), r"""^\s*<\?xml[^>]*?encoding\s*=\s*["']([A-Za-z0-9._-]+)""", 1))
    one_byte = F.translate(bytes_, "".join(map(chr, range(128, 160))), WINDOWS)
    text = content.cast("string")
    return F.when(declared.isin(*_ONE_BYTE) | ~F.is_valid_utf8(text), one_byte).otherwise(F.ltrim(text, F.lit("\ufeff")))


def plain_markup(rows: DataFrame) -> DataFrame:
    """``body`` as markup that an XML parser takes: CDATA as escaped text, no comments, names of characters resolved, bare ampersands escaped.

    Every step is a column of its own: an expression that names a text more than once would make it anew each time.
    """
    body = F.col("body")
    pieces = F.zip_with(F.split(body, _CDATA), F.regexp_extract_all(body, F.lit(_CDATA), F.lit(1)), lambda x, c: F.concat(x, F.coalesce(html_escape(c), F.lit(""))))
    flat = F.regexp_replace(F.when(F.contains(body, F.lit("<![CDATA[")), F.array_join(pieces, "")).otherwise(body), r"(?s)<!--.*?-->", "")

    def reference(after: Column) -> Column:
        name = F.regexp_extract(after, r"^([A-Za-z][A-Za-z0-9]*);", 1)
        known = F.try_element_at(entity_table(), name)
        return (
            F.when(after.rlike(r"^(?:amp|lt|gt|quot|apos|#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6});"), F.concat(F.lit("&"), after))
            .when(known.isNotNull(), F.concat(known, F.substr(after, F.length(name) + 2)))
            .otherwise(F.concat(F.lit("&amp;"), after)))

    rows = once(rows, "_flat", flat).drop("body")
    resolved = F.array_join(F.transform(F.split("_flat", "&"), lambda x, i: F.when(i == 0, x).otherwise(reference(x))), "")
    rows = once(rows, "_text", F.when(F.contains("_flat", F.lit("&")), resolved).otherwise(F.col("_flat"))).drop("_flat")
    # A feed whose root has a prefix uses it for its own elements.
    rows = once(rows, "_prefix", F.regexp_extract("_text", r"<([A-Za-z_][\w.-]*):feed[\s>]", 1))
    prefix, text = F.col("_prefix"), F.col("_text")
    own = F.when(prefix != "", F.regexp_replace(text, F.concat(F.lit(r"(</?)\Q"), prefix, F.lit(r"\E:")), F.lit("$1"))).otherwise(text)
    return once(rows, "body", own).drop("_text", "_prefix")


def snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Feed snapshots as served, one row per file: ``landed``, ``body``, ``malformed``.

    A snapshot is one response of one feed and small, so a file is read whole.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    read = files.select(F.col("_metadata.file_path").alias("landed"), decoded(F.col("content")).alias("body"))
    broken = F.from_xml("body", schemas.shape("_broken"), _PERMISSIVE)["_broken"].isNotNull()
    return read.select("landed", "body", broken.alias("malformed"))


def _items(snapshots: DataFrame) -> DataFrame:
    """Every item of the snapshots with its fields ``_e`` and its ``state``: whole, recovered or lost.

    The text is cut before each start of an item, so a broken item ends where the next
    begins. One that does not parse gives the elements that are closed.
    """
    cut = F.filter(F.split("body", r"(?=<(?:item|entry)[\s>])"), lambda x: x.rlike(r"^<(?:item|entry)[\s>]"))
    rows = plain_markup(snapshots.select("landed", "body")).select("landed", F.posexplode(cut).alias("feed_pos", "_piece"))
    # The expression is written twice in the plan otherwise.
    rows = once(rows, "_xml", F.regexp_extract("_piece", r"(?s)^<(item|entry)(?=[\s>]).*?</\1\s*>", 0))
    shape = T.StructType([*_ENTRY.fields, *schemas.shape("_broken").fields])
    rows = once(rows, "_p", F.from_xml(F.nullif("_xml", F.lit("")), shape, _PERMISSIVE))
    whole = F.col("_p").isNotNull() & F.col("_p._broken").isNull()
    tag = lambda name: F.regexp_extract("_piece", rf"(?s)<{name}(?:\s[^>]*)?>(.*?)</{name}\s*>", 1)
    href = F.regexp_extract("_piece", r"""<link(?![^>]*rel\s*=\s*["'](?!alternate))[^>]*href\s*=\s*["']([^"']*)""", 1)
    rows = once(rows, "_cut", F.when(~whole, F.struct(*[tag(n).alias(n) for n in (*_FIELDS, "link")], href.alias("href"))))
    raw = F.col("_cut")
    rows = once(rows, "_closed", F.when(~whole, F.struct(
        *[F.btrim(unescape(raw[n])).alias(n) for n in (*_FIELDS, "link")], unescape(raw["href"]).alias("href"))))
    closed = lambda name: F.nullif(F.col("_closed")[name], F.lit(""))
    # An address is kept as written, an empty one counts as none.
    href = F.when(raw["href"] != "", F.col("_closed")["href"])
    link = F.struct(closed("link").alias("_VALUE"), href.alias("_href"), F.lit(None).cast("string").alias("_rel"))
    salvaged = F.struct(*[closed(n).alias(n) for n in _FIELDS], F.array(link).alias("link"), F.lit(None).cast("string").alias("_broken"))
    rows = once(rows, "_e", F.when(whole, F.col("_p")).otherwise(salvaged))
    some = F.coalesce(F.col("_e.title"), F.get("_e.link", F.lit(0))["_VALUE"], F.get("_e.link", F.lit(0))["_href"]).isNotNull()
    return rows.withColumn("state", F.when(F.col("_p").isNotNull() & F.col("_p._broken").isNull(), "whole").when(some, "recovered").otherwise("lost"))


def feed_errors(snapshots: DataFrame) -> DataFrame:
    """Items that did not parse, with what became of them: ``landed, feed_pos, state, xml``."""
    return _items(snapshots).filter("state <> 'whole'").select("landed", F.col("feed_pos").cast("bigint").alias("feed_pos"), "state", F.col("_piece").alias("xml"))


def feed_states(snapshots: DataFrame) -> DataFrame:
    """What became of every item, without its text: ``landed, state``. Counts of entries and of errors come from one parse of it."""
    return _items(snapshots).select("landed", "state")


def feed_entries(snapshots: DataFrame) -> DataFrame:
    """Raw items of RSS, RDF and Atom snapshots with their position in the file.

    Items are cut out of the text before they are parsed, so a malformed snapshot
    gives the items it holds. Of an item that is broken inside the closed elements
    count; only one without a title and a link gives no row (``feed_errors`` has it).
    """
    rows = _items(snapshots).filter("state <> 'lost'")
    target = lambda x: F.coalesce(F.nullif(F.btrim(x["_VALUE"]), F.lit("")), x["_href"])
    # Of several links the first that leads to the page itself.
    own = F.filter("_e.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return rows.select(
        "_e.title", target(F.get(own, F.lit(0))).alias("link"),
        "_e.summary", F.coalesce("_e.description", F.when(F.col("_e.summary").isNull(), F.coalesce("_e.content", F.col("_e.`content:encoded`")))).alias("description"),
        F.coalesce("_e.pubDate", "_e.published", F.col("_e.`dc:date`")).alias("published"), "_e.updated",
        F.col("feed_pos").cast("bigint").alias("feed_pos"), "landed",
    )


def feed_name(landed: Column) -> Column:
    """The feed of a file, from the folder ``source=<name>`` it landed in.

    Folder names are escaped when written and again when shown as a path.
    """
    folder = F.regexp_extract(landed, r"/source=([^/]+)/", 1)
    for _ in range(2):
        folder = F.url_decode(F.replace(folder, F.lit("+"), F.lit("%2B")))
    return folder


def of_feeds(items: DataFrame, feeds: DataFrame) -> DataFrame:
    """Name the feed of each item and give its place in the registry."""
    named = items.withColumn("source", feed_name(F.col("landed"))).drop("landed")
    return named.join(feeds.select("source", "feed_ord"), "source")


def fetch_log(snapshots: DataFrame, statuses: DataFrame) -> DataFrame:
    """``source, status, malformed`` per fetched feed: HTTP status as logged, form as scanned."""
    form = snapshots.groupBy(feed_name(F.col("landed")).alias("source")).agg(F.bool_or("malformed").alias("malformed"))
    return statuses.join(form, "source", "left").select("source", "status", F.coalesce("malformed", F.lit(False)).alias("malformed"))


def stories(spark: SparkSession, ids_path: str, items_path: str, n: int) -> DataFrame:
    """Top-n story ids (``run, pos, id``) joined to their items."""
    ids = spark.read.schema(schemas.STORY_RANK).json(ids_path)
    items = spark.read.schema(schemas.STORY).json(items_path)
    return story_articles(ids, items, n)


def story_articles(ids: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """Article rows of the first n ids; items without a title drop out, age does not matter."""
    chosen = ids.filter(F.col("pos") < n)
    kept = items.filter(F.coalesce("title", F.lit("")) != "")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("string")
    return chosen.join(kept, "id").select(
        "title",
        F.coalesce("url", F.concat(F.lit("https://news.ycombinator.com/item?id="), F.col("id").cast("string"))).alias("link"),
        F.concat(F.lit("Score: "), count("score"), F.lit(" | Comments: "), count("descendants")).alias("summary"),
        F.lit(STORY_SOURCE).alias("source"),
        from_epoch(F.nullif(F.col("time"), F.lit(0))).alias("published"),
        F.lit(STORY_FEED_ORD).alias("feed_ord"),
        F.col("pos").cast("bigint").alias("feed_pos"),
    )


def state_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A state table; one that was never written is empty.

    A file that cannot be read fails the job: taking it for an empty history would
    send everything again.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _document_entries(documents: DataFrame, column: str, name: str, entry: str) -> DataFrame:
    """Key and object of every entry of one map of JSON state documents.

    A corrupt document counts as empty, and so does an entry that is no object.
    """
    entries = F.try_variant_get(F.try_parse_json(column), f"$.{name}", "map<string, variant>")
    rows = documents.select(F.explode(entries).alias("key", "_v"))
    return rows.filter(V.is_object(F.col("_v"))).select("key", F.try_variant_get("_v", "$", entry).alias("_e"))


def state_documents(documents: DataFrame, column: str = "document") -> DataFrame:
    """Sent rows out of JSON state documents."""
    rows = _document_entries(documents, column, "sent_articles", "struct<title: string, link: string, source: string, sent_at: string>")
    return rows.select(
        F.col("key").alias("article_key"), "_e.title", "_e.link", "_e.source",
        F.col("_e.sent_at").try_cast("timestamp_ntz").alias("sent_at"),
    )


def thread_documents(documents: DataFrame, column: str = "document") -> DataFrame:
    """Thread cache rows out of JSON state documents."""
    rows = _document_entries(
        documents, column, "reddit_thread_details",
        "struct<title: string, selftext: string, author: string, score: int, num_comments: int, subreddit: string, "
        "created_utc: double, top_comments: array<string>, fetched_at: string>")
    return rows.select(
        F.col("key").alias("url"), "_e.title", "_e.selftext", "_e.author", "_e.score", "_e.num_comments", "_e.subreddit",
        "_e.created_utc", "_e.top_comments", F.col("_e.fetched_at").try_cast("timestamp_ntz").alias("fetched_at"),
    )


def signal_documents(documents: DataFrame, column: str = "document") -> DataFrame:
    """Signal history rows out of JSON state documents; ``seq`` is the place in the list."""
    signals = F.try_variant_get(F.try_parse_json(column), "$.web_sweep", "array<variant>")
    rows = documents.select(F.posexplode(signals).alias("pos", "_v")).filter(V.is_object(F.col("_v")))
    names = [n for n in schemas.SIGNAL.fieldNames() if n not in ("seq", "metrics")]
    return rows.select(
        *[F.coalesce(F.try_variant_get("_v", f"$.{n}", "string"), F.lit("")).alias(n) for n in names],
        F.coalesce(F.to_json(F.try_variant_get("_v", "$.metrics", "variant")), F.lit("{}")).alias("metrics"),
        F.struct(F.lit(0).cast("bigint").alias("payload_seq"), F.col("pos").alias("pos")).alias("seq"),
    ).select(*schemas.SIGNAL.fieldNames())


def run_stamps(documents: DataFrame, column: str = "document") -> DataFrame:
    """Day of the last sweep out of JSON state documents."""
    day = F.try_variant_get(F.try_parse_json(column), "$.web_sweep_meta.last_run_date", "string")
    return documents.select(day.alias("last_run_date")).filter(F.col("last_run_date").isNotNull())


def pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def file_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Names, folders, times and sizes under a folder. File contents are never read."""
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true").load(path)
    )
    return files.select(
        F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
        F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder"),
        F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.col("modificationTime").cast("timestamp_ntz")
        ).alias("modified"),
        "length",
    )
