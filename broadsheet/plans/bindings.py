"""Views that give the test tables the shapes the operators read.

Every view covers its whole table and is built row by row, so a binding never
adds a shuffle except where a keyed state table is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import articles as A
from ..operators import signals as G
from ..operators import state as S
from ..operators.curation import Rule
from ..sources.registry import literal_table
from .ordered import last_wins, once

AS_OF = "2024-01-30 00:00:00"
SWEEP_AS_OF = "2024-03-01 00:00:00"
PER_SOURCE = 10
SOURCES = [f"src{i}" for i in range(20)]
LAST_BATCH = "2024-01-29"

# Rules over words that occur in the documents.
RULES = [
    Rule(0, "must-watch", "thanedble"), Rule(0, "must-watch", "onwhtien"),
    Rule(1, "ai", "that"), Rule(1, "ai", "with the"), Rule(1, "jobs", "license"),
    Rule(2, "robotics", "this"), Rule(2, "longevity", "from"),
    Rule(3, "social", "was"), Rule(3, "climate", "avec"),
    Rule(4, "finance", "und"), Rule(4, "legal", "para"), Rule(4, "space", "dans"),
    Rule(4, "global", "el"), Rule(4, "other", "of"),
]
STRICT = ["thth", "chschie"]
SKIP = {"finance": ["zu der"], "ai": ["rewh"]}
COMPANIES = [
    ("Anea", "anea"), ("Thor", "thor"), ("Thor", "thorth"), ("Only", "only"), ("Ververein", "ver"), ("Leaux", "leaux"),
]

LANES = [
    ("competitor", "ventures", "Competitive Landscape", "We make an example product.", "Moves by competitors.", 5, None),
    ("market-pricing", "ventures", "Market & Pricing", "We make an example product.", "Price signals.", 4, "Name the currency."),
]


class Tables:
    """The test tables and the shapes derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def feeds(self, extra: tuple[str, ...] = ("silent",)) -> DataFrame:
        rows = [(i, s, f"https://example.com/{s}/feed", "test", "feed") for i, s in enumerate([*SOURCES, *extra])]
        return literal_table(self.spark, rows, schemas.FEED)

    def lanes(self) -> DataFrame:
        return literal_table(self.spark, LANES, schemas.LANE)

    def feed_items(self) -> DataFrame:
        """Raw feed items, one per document, with dates in the styles feeds use."""
        text, src = F.col("text"), F.col("source")
        thread = src.isin("src3", "src7")
        link = F.when(
            thread, F.concat(F.lit("https://www.reddit.com/r/"), src, F.lit("/comments/"), F.md5(text))
        ).otherwise(F.concat(F.lit("https://example.com/"), F.col("lang"), F.lit("/"), F.md5(text)))
        body = F.when(
            thread,
            F.concat(F.lit("<p>"), text, F.lit("</p> submitted by <a href=\"/u\">/u/"), src, F.lit("</a> [link] [comments]")),
        ).otherwise(text)
        doc = F.col("doc_id")
        hours = F.expr("((doc_id div 20) * 31 + doc_id) % 72")
        when = F.when(doc % 11 != 0, F.timestamp_add("HOUR", -hours.cast("int"), F.lit(AS_OF).cast("timestamp_ntz")))
        mail = F.concat(F.date_format(when, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
        zulu = F.concat(F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
        two = F.timestamp_add("HOUR", F.lit(2), when)
        east = F.concat(F.date_format(two, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
        five = F.timestamp_add("HOUR", F.lit(-5), when)
        west = F.concat(F.date_format(five, "dd MMM yyyy HH:mm:ss"), F.lit(" -0500"))
        style = doc % 4
        return self.documents.select(
            "doc_id", "lang", F.get(F.split("text", "\n"), F.lit(0)).alias("title"), link.alias("link"),
            F.when(doc % 5 == 0, F.lit(None)).when(doc % 7 == 0, "").otherwise(body).alias("summary"),
            body.alias("description"),
            F.when(style == 0, mail).when(style == 1, zulu).when(style == 3, "soon").alias("published"),
            F.when(style == 2, east).when(style == 3, west).alias("updated"),
            "source", F.substring("source", 4, 9).cast("int").alias("feed_ord"), doc.alias("feed_pos"),
        )

    def articles(self) -> DataFrame:
        """Every item as an article, keyed."""
        items = self.feed_items()
        rows = A.items_to_articles(items)
        return A.with_article_key(rows)

    def todays(self) -> DataFrame:
        """What a run takes in: the per-source top-k."""
        return A.with_article_key(A.intake(self.feed_items(), AS_OF, PER_SOURCE))

    def sent(self) -> DataFrame:
        """Sent history: the documents labelled as good, one row per key."""
        good = self.labels.filter(F.col("quality") == 1).select("doc_id")
        items = self.feed_items().join(good, "doc_id", "left_semi")
        rows = A.with_article_key(A.items_to_articles(items))
        at = F.timestamp_add("DAY", -(F.length("summary") % 14).cast("int"), F.lit(AS_OF).cast("timestamp_ntz"))
        dated = rows.select("article_key", "title", "link", "source", at.alias("sent_at"), "feed_ord", "feed_pos")
        return last_wins(dated, ["article_key"], F.struct("sent_at", "feed_ord", "feed_pos")).drop("feed_ord", "feed_pos")

    def recent_sent(self) -> DataFrame:
        return S.retained(self.sent(), "sent_at", AS_OF)

    def threads(self) -> DataFrame:
        """Thread cache: labelled thread articles, one row per link."""
        known = self.labels.select("doc_id")
        items = self.feed_items().join(known, "doc_id", "left_semi")
        rows = A.thread_articles(A.items_to_articles(items))
        latest = last_wins(rows, ["link"], F.struct("feed_ord", "feed_pos"))
        built = S.build_threads(latest, AS_OF)
        age = (F.length("title") % 10).cast("int")
        return built.withColumn("fetched_at", F.timestamp_add("DAY", -age, F.col("fetched_at")))

    def payloads(self) -> DataFrame:
        """One sweep payload per event, some of them broken in the ways payloads break."""
        e, u, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
        ts = F.col("ts")

        def text(c) -> F.Column:
            return F.concat(F.lit('"'), c, F.lit('"'))

        name = F.concat(F.lit("User "), u.cast("string"), F.lit(" #"), (e % 20).cast("string"))
        url = F.concat(F.lit("example.com/u/"), u.cast("string"))
        day = F.date_format(ts, "yyyy-MM-dd")
        fields = {
            "subject": F.when(e % 19 == 0, u.cast("string")).otherwise(text(F.when(e % 2 == 0, name).otherwise(F.concat(F.lit(" "), name)))),
            "signal_type": text(F.when(kind == "view", "").otherwise(kind)),
            "summary": text(F.when(e % 13 == 0, "  ").otherwise(F.concat(kind, F.lit(" <event> & 'more'")))),
            "relevance": text(F.when(e % 3 == 0, "").otherwise(F.lit("Worth a look"))),
            "source_name": F.when(e % 4 == 0, "null").otherwise(text(F.concat(F.lit("Site "), (u % 5).cast("string")))),
            "source_url": text(
                F.when(e % 7 == 0, F.concat(F.lit("ftp://"), url)).when(e % 7 == 1, F.concat(F.lit(" HTTPS://"), url))
                .otherwise(F.concat(F.lit("https://"), url))
            ),
            "severity": text(
                F.when(kind == "error", "act_now").when(kind == "purchase", "notable").when(kind == "signup", "info")
                .otherwise("urgent")
            ),
            "observed_at": text(F.when(e % 5 == 0, "last week").otherwise(day)),
            "metrics": F.when(e % 17 == 0, text(F.replace("props", F.lit('"'), F.lit("'")))).otherwise(F.col("props")),
            "entity": text(F.concat(F.lit("Entity "), (u % 10).cast("string"))),
        }

        def entry(values: dict) -> F.Column:
            parts = []
            for i, (k, v) in enumerate(values.items()):
                parts += [F.lit(("," if i else "{") + f'"{k}":'), v]
            return F.concat(*parts, F.lit("}"))

        # Both entries are written once and have columns of their own: a copy of them per shape makes
        # the code of a row longer than the 8,000 bytes up to which the JVM compiles a method.
        # Parsing costs far more than the event itself, so events are dealt out before, however they are stored; to a
        # number that adaptive execution leaves as it is, for by their few bytes it would join them to one task a core.
        tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 4 * self.spark.sparkContext.defaultParallelism)
        events = self.events.select("event_id", "ts", "user_id", "event_type", "props").repartition(tasks, "event_id")
        rows = once(events, "_first", entry(fields))
        rows = once(rows, "_again", entry({
            **fields, "summary": F.lit('"seen again"'),
            "subject": F.when(e % 19 == 0, u.cast("string")).otherwise(text(F.upper(name))),
        }))
        shape = e % 23
        before = (
            F.when(shape == 5, '{"signals":[7,"x",null,').when(shape == 17, "[").when(shape == 21, '{"signals":{"a":').otherwise('{"signals":['))
        after = (
            F.when(shape == 5, "]}").when(shape == 17, "]").when(shape == 21, "}}").otherwise(F.concat(F.lit(","), "_again", F.lit("]}"))))
        payload = (
            F.when(shape == 11, '{"signals":null}').when(shape == 19, "{bad").otherwise(F.concat(before, "_first", after)))
        lanes = F.array(F.lit("competitor"), F.lit("market-pricing"), F.lit("launches"))
        return rows.select(
            F.date_format(F.date_trunc("week", ts), "yyyy-MM-dd").alias("batch"),
            F.get(lanes, ((u + e) % 3).cast("int")).alias("lane"),
            e.alias("payload_seq"), day.alias("date"), payload.alias("payload"),
        )

    def signals(self) -> DataFrame:
        return G.normalize_signals(self.payloads(), self.lanes())

    def scripts(self) -> DataFrame:
        """One script per document: its lines, labelled in turn and in the ways labels vary."""
        label = (
            lambda line, i: F.when(i % 5 == 1, F.concat(F.lit("Alex: "), line))
            .when(i % 5 == 3, F.concat(F.lit("  SAM :"), line))
            .when((i % 5 == 4) & (i % 2 == 0), F.concat(F.lit("sam: "), line))
            .when(i % 7 == 5, F.lit("Alex:"))
            .otherwise(line)
        )
        return self.documents.select(
            "doc_id", F.array_join(F.transform(F.split("text", "\n"), label), "\n").alias("script")
        )

    def markdown(self) -> DataFrame:
        """One markdown reply per document, with the constructs replies use."""
        mark = (
            lambda line, i: F.when(i % 9 == 0, F.concat(F.lit("## "), line))
            .when(i % 9 == 1, F.concat(F.lit("- **bold** "), line))
            .when(i % 9 == 2, F.concat(F.lit("- [link](https://example.com/x) "), line))
            .when(i % 9 == 3, F.lit(""))
            .when(i % 9 == 4, F.concat(F.lit("  - "), line))
            .when(i % 9 == 5, F.concat(F.lit("<li>"), line, F.lit("</li>")))
            .when(i % 9 == 6, F.concat(F.lit("# "), line))
            .when(i % 9 == 7, F.lit("---"))
            .otherwise(line)
        )
        body = F.array_join(F.transform(F.split("text", "\n"), mark), "\n")
        doc = F.col("doc_id")
        return self.documents.select(
            "doc_id",
            F.when(doc % 6 == 0, F.concat(F.lit("```html\n<h1>Digest</h1>\n"), body, F.lit("\n```")))
            .when(doc % 6 == 1, F.concat(F.lit("```html\n"), body, F.lit("\n```\n")))
            .otherwise(body).alias("content"),
        )

    def segments(self) -> DataFrame:
        """Spoken segments of conversations: a turn is a segment of its conversation."""
        host = F.when(F.col("role") == "assistant", "Sam").otherwise("Alex")
        length = (F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1) * 400
        return self.conversations.select(
            F.col("conv_id").alias("episode"), F.col("turn").alias("idx"), host.alias("speaker"),
            length.cast("bigint").alias("dur_ms"),
        )

    def api_errors(self) -> DataFrame:
        """Error events as service errors."""
        e = F.col("event_id")
        status = F.get(F.array(*[F.lit(s) for s in (200, 400, 401, 404, 429, 500, 502, 503, 529)]), (e % 9).cast("int"))
        types = F.get(
            F.array(*[F.lit(s) for s in ("overloaded_error", "rate_limit_error", "api_error", "invalid_request_error")]),
            (e % 5).cast("int"),
        )
        kind = F.when(e % 5 < 4, types)
        body = (
            F.when(kind.isNull(), '{"type":"error"}')
            .when(e % 2 == 0, F.concat(F.lit('{"type":"error","error":{"type":"'), F.upper(kind), F.lit('"}}')))
            .otherwise(F.concat(F.lit('{"type":"'), kind, F.lit('"}')))
        )
        message = (
            F.when(e % 4 == 0, "Your credit balance is low").when(e % 4 == 1, "model: NOT_FOUND")
            .when(e % 4 == 2, "could not generate").otherwise("Overloaded")
        )
        return self.events.filter(F.col("event_type") == "error").select(
            "event_id", status.alias("status_code"), body.alias("body"), message.alias("message")
        )

    def announcements(self) -> DataFrame:
        """Customers as company announcements."""
        name, segment = F.col("c_name"), F.col("c_mktsegment")
        amount = F.floor(F.abs("c_acctbal")).cast("bigint").cast("string")
        text = (
            F.when(segment == "BUILDING", F.concat(name, F.lit(" raises $"), amount, F.lit("M in Series B funding")))
            .when(segment == "AUTOMOBILE", F.concat(name, F.lit(" is hiring engineers")))
            .when(segment == "MACHINERY", F.concat(name, F.lit(" announces layoffs after $"), amount, F.lit("M loss")))
            .when(segment == "HOUSEHOLD", F.concat(name, F.lit(" appoints new CEO")))
            .otherwise(F.concat(name, F.lit(" had a quiet week")))
        )
        return self.customer.select("c_custkey", text.alias("text"))
