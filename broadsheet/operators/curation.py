"""Selection rules of a digest: interests, exclusions, same story, sections, caps.

Rule tables given as Python lists are part of the job and become literals, so
tagging is an expression inside the row. A rule table of any other size goes
through ``match_rules``, an equi-join on words.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip
from ..plans.graph import connected
from ..plans.ordered import first_rows, once
from ..session import settle

MUST_WATCH = 0
DIGEST_CAP = 30
MIN_SECTION_ITEMS = 2
MIN_COMPANIES = 2


@dataclass(frozen=True)
class Rule:
    """One term of a topic. Tier 0 is must-watch, higher tiers matter less."""

    tier: int
    topic: str
    term: str


@dataclass(frozen=True)
class Section:
    """A digest section, its heading, the topics it shows and its cap (None: no own cap)."""

    name: str
    heading: str
    topics: tuple[str, ...]
    cap: int | None = None


# Sections in digest order with their upper quotas.
SECTIONS = (
    Section("top", "🔥 Top Priority", ("must-watch",), 6),
    Section("ventures", "🚀 My Ventures & Competitive Radar", ("ventures",)),
    Section("jobs", "💼 Job Radar", ("jobs",)),
    Section("companies", "🏢 Companies to Watch", ("companies",)),
    Section("ai", "🤖 AI & Robotics", ("ai", "agents", "robotics")),
    Section("health", "🧬 Health & Longevity", ("longevity", "biomedical")),
    Section("automotive", "🚗 Automotive Tech", ("automotive",)),
    Section("social", "🌐 Social & Web3", ("social", "web3")),
    Section("climate", "🌍 Climate Tech", ("climate",)),
    Section("finance", "📊 Finance & Fintech Radar", ("finance",), 6),
    Section("regulatory", "⚖️ Regulatory & Legal Radar", ("legal",), 4),
    Section("global", "🌏 Global News Quick Hits", ("global",), 5),
    Section("usa", "🇺🇸 USA News Quick Hits", ("usa", "policy"), 5),
    Section("local", "📍 Local News", ("local",), 4),
    Section("watching", "📺 Worth Watching", ("entertainment", "space")),
    Section("quick", "⚡ Quick Hits", ("other",), 5),
)


def words(text: Column) -> Column:
    """Lowered words of a text; anything but letters and digits separates."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def word_line(text: Column) -> Column:
    """Words of a text on one line, each with a blank on both sides.

    Made once per row; every term is then found by plain substring search.
    """
    return F.concat(F.lit(" "), F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "  "), F.lit(" "))


def term_count(line: Column, terms: Sequence[str]) -> Column:
    """How often the terms occur in a ``word_line``, as whole words, ignoring case.

    A term of several words matches across any run of separators.
    """
    total = F.lit(0)
    for term in terms:
        needle = " " + "  ".join(w for w in re.split(r"[\W_]+", term.lower()) if w) + " "
        gone = F.length(line) - F.length(F.replace(line, F.lit(needle), F.lit("")))
        total = total + F.floor(gone / F.lit(len(needle)))
    return total.cast("bigint")


def article_text(title: Column, summary: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit("\n"), F.coalesce(summary, F.lit("")))


#: Salts that a first word of a rule table is spread over.
SPREAD = 16


def _with_line(articles: DataFrame) -> DataFrame:
    return once(articles, "_line", word_line(article_text(F.col("title"), F.col("summary"))))


def tag(
    articles: DataFrame, rules: Sequence[Rule], skip: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Add ``topics``: ``array<struct<topic, tier, n_hits>>`` of the topics an article touches.

    ``skip`` holds terms that take a single topic away from an article; the
    must-watch topic is never taken away.
    """
    line = F.col("_line")
    groups: dict[tuple[str, int], list[str]] = {}
    for rule in rules:
        groups.setdefault((rule.topic, rule.tier), []).append(rule.term)

    def hits(topic: str, tier: int, terms: list[str]) -> Column:
        n = term_count(line, terms)
        unwanted = (skip or {}).get(topic)
        if unwanted and tier != MUST_WATCH:
            return F.when(term_count(line, unwanted) == 0, n).otherwise(F.lit(0).cast("bigint"))
        return n

    found = F.array(*[
        F.struct(F.lit(topic).alias("topic"), F.lit(tier).alias("tier"), hits(topic, tier, terms).alias("n_hits"))
        for (topic, tier), terms in groups.items()
    ])
    return once(_with_line(articles), "topics", F.filter(found, lambda t: t["n_hits"] > 0)).drop("_line")


def exclude(articles: DataFrame, strict: Sequence[str], rules: Sequence[Rule] = ()) -> DataFrame:
    """Drop articles with a strictly excluded term, unless a must-watch rule claims them.

    Works on the text alone, so it runs before tagging and before any shuffle.
    """
    watched = [r.term for r in rules if r.tier == MUST_WATCH]
    line = F.col("_line")
    keep = term_count(line, strict) == 0
    if watched:
        keep = keep | (term_count(line, watched) > 0)
    return _with_line(articles).filter(keep).drop("_line")


def match_rules(articles: DataFrame, rules: DataFrame) -> DataFrame:
    """Hits per article and topic for a rule table of any size (``tier, topic, term``).

    Every word of an article meets the rules that start with it in an equi-join;
    longer terms then compare their remaining words. Words that start no rule are
    left out before anything else, equal spans of an article are counted first, and
    both sides of the join are spread over ``SPREAD`` salts of the first word, so a
    common word does not end in one task. Articles need a unique ``row_id``.
    """
    keyed = rules.withColumn("_words", words(F.col("term"))).filter(F.size("_words") > 0)
    keyed = keyed.withColumn("_first", F.get("_words", F.lit(0)))
    longest = keyed.agg(F.max(F.size("_words"))).first()[0] or 1
    starts = keyed.select("_first").distinct()
    split = articles.select("row_id", "article_key", words(article_text(F.col("title"), F.col("summary"))).alias("_w"))
    salt = F.pmod(F.xxhash64("row_id"), F.lit(SPREAD)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1)))
    # The words behind each position travel along only as far as the longest term.
    spans = split.select(
        "row_id", "article_key", salt.alias("_salt"),
        F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w"), F.lit(1))),
                              lambda i: F.slice(F.col("_w"), i, longest))).alias("_span"),
    ).filter(F.size("_span") > 0).withColumn("_first", F.get("_span", F.lit(0)))
    near = spans.join(starts.withColumn("_salt", salts), ["_first", "_salt"], "left_semi")
    counted = near.groupBy("_first", "_salt", "row_id", "article_key", "_span").agg(F.count("*").alias("_n"))
    hits = counted.join(keyed.withColumn("_salt", salts), ["_first", "_salt"]).filter(
        F.slice("_span", F.lit(1), F.size("_words")) == F.col("_words")
    )
    return hits.groupBy("row_id", "article_key", "topic", "tier").agg(F.sum("_n").alias("n_hits"))


def score(tagged: DataFrame) -> DataFrame:
    """Add best tier (null without a topic), total hits and the leading topic."""
    topics = F.col("topics")
    best = F.array_min(F.transform(
        topics, lambda t: F.struct(t["tier"].alias("tier"), (-t["n_hits"]).alias("neg"), t["topic"].alias("topic"))
    ))
    scored = tagged.withColumns({
        "_best": best,
        "n_hits": F.aggregate(topics, F.lit(0).cast("bigint"), lambda a, t: a + t["n_hits"]),
    })
    return scored.withColumns({
        "best_tier": F.col("_best.tier"),
        "lead_topic": F.col("_best.topic"),
        "must_watch": F.coalesce(F.col("_best.tier") == MUST_WATCH, F.lit(False)),
    }).drop("_best")


def story_key(title: Column) -> Column:
    """Same words in any order and case make the same story."""
    return F.md5(F.array_join(F.array_sort(F.array_distinct(words(title))), " "))


def priority_order() -> list[Column]:
    """Best first: tier, hits, newest, then key so that ties are settled."""
    return [
        F.asc_nulls_last("best_tier"), F.desc("n_hits"), F.desc_nulls_last("published"), F.asc("article_key"),
        F.asc("feed_ord"), F.asc("feed_pos"),
    ]


def best_per_story(scored: DataFrame, digest: Sequence[str] = (), quality: str | None = None) -> DataFrame:
    """One article per story: the best by tier, hits, optional quality, age, key.

    A story covered by most of the input still reduces inside each map task.
    """
    order = priority_order()
    if quality:
        order.insert(2, F.desc_nulls_last(quality))
    keyed = scored.withColumn("story_key", story_key(F.col("title")))
    return first_rows(keyed, [*digest, "story_key"], order, 1)


def route(scored: DataFrame, sections: Sequence[Section] = SECTIONS) -> DataFrame:
    """Add section and its position by leading topic; articles without a section go."""
    places = F.create_map(*[F.lit(x) for i, s in enumerate(sections) for topic in s.topics for x in (topic, i)])
    names = F.array(*[F.lit(s.name) for s in sections])
    placed = scored.withColumn("section_ord", F.try_element_at(places, F.col("lead_topic")))
    return placed.filter(F.col("section_ord").isNotNull()).withColumn("section", F.get(names, F.col("section_ord")))


def apply_quotas(
    routed: DataFrame, digest: Sequence[str], sections: Sequence[Section] = SECTIONS,
    min_items: int = MIN_SECTION_ITEMS, total: int = DIGEST_CAP,
) -> DataFrame:
    """Section caps, then sections that are too thin go, then the cap of the whole digest.

    Must-watch articles are put on top of the caps: they take nobody's place and
    never fall to a rule. Each ranking keeps a bounded head per map task.
    """
    regular = routed.filter(~F.col("must_watch"))
    head = first_rows(
        regular, [*digest, "section"], priority_order(), max([s.cap or total for s in sections]), rank="_place"
    )
    caps = F.array(*[F.lit(s.cap or total) for s in sections])
    cap = F.get(caps, F.col("section_ord"))
    capped = head.filter(F.col("_place") <= cap).drop("_place")
    filled = capped.groupBy(*digest, "section").agg(F.count("*").alias("_n")).filter(F.col("_n") >= min_items)
    kept = capped.join(filled.drop("_n"), [*digest, "section"], "left_semi")
    chosen = first_rows(kept, digest, priority_order(), total)
    return chosen.unionByName(routed.filter("must_watch"))


def mentions(articles: DataFrame, entities: Sequence[tuple[str, str]], digest: Sequence[str]) -> DataFrame:
    """Mentions per digest and entity, for digests that name enough different ones.

    ``entities`` are pairs of canonical name and term.
    """
    names: dict[str, list[str]] = {}
    for name, term in entities:
        names.setdefault(name, []).append(term)
    present = F.filter(
        F.array(*[F.when(term_count(F.col("_line"), terms) > 0, F.lit(n)) for n, terms in names.items()]),
        lambda n: n.isNotNull(),
    )
    rows = _with_line(articles).select(*digest, F.explode(present).alias("entity"))
    counts = rows.groupBy(*digest, "entity").agg(F.count("*").alias("n_articles"))
    wide = counts.groupBy(*digest).agg(F.count("*").alias("_n")).filter(F.col("_n") >= MIN_COMPANIES)
    return counts.join(wide.drop("_n"), list(digest), "left_semi")


# Patterns of opportunity signals, tried on lowered text.
OPPORTUNITY = {
    "funding": r"\b(?:funding|raises|raised|seed round|series [a-f])\b",
    "hiring": r"\b(?:hiring|is hiring|open roles|job openings)\b",
    "layoffs": r"\b(?:layoffs?|lays off|laid off|hiring freeze|job cuts)\b",
    "executive": r"\b(?:appoints|names new|steps down|new (?:ceo|cto|cfo|coo)|joins as)\b",
}
AMOUNT = r"\$[0-9][0-9.,]*\s?(?:million|billion|[MB])\b"
STAGE = r"\b(?:Series [A-F]|[Ss]eed|[Pp]re-[Ss]eed)\b"


def opportunities(articles: DataFrame, text: Column) -> DataFrame:
    """Flags per kind of opportunity, with the first amount and stage of a funding text.

    Rows without any flag go.
    """
    lowered = F.lower(text)
    flagged = articles.withColumns({f"is_{k}": lowered.rlike(p) for k, p in OPPORTUNITY.items()})
    funding = F.col("is_funding")
    found = F.lit(False)
    for k in OPPORTUNITY:
        found = found | F.col(f"is_{k}")
    return flagged.withColumns({
        "amount": F.when(funding, F.regexp_extract(text, AMOUNT, 0)).otherwise(""),
        "stage": F.when(funding, strip(F.regexp_extract(text, STAGE, 0))).otherwise(""),
    }).filter(found)


# Share of words that two articles of one story have in common.
STORY_PERCENT = 60


def near_stories(articles: DataFrame, row_id: str = "row_id", percent: int = STORY_PERCENT) -> DataFrame:
    """``row_id, story_id``: articles that tell the same story get the smallest row id among them.

    Two articles are linked if the words of title and summary agree by ``percent``; links
    run on over whole groups. None is lost: with words ordered from the rarest, two sets
    that agree so far share a word among the first ``n - ceil(n * percent / 100) + 1`` of
    each, and the places of a shared word bound what may follow it.

    Equal sets count once. Sets that share such a word first meet the smallest of them,
    which joins groups of close copies without their pairs; after that only pairs across
    components that are still apart are compared. Articles without a word are a story of
    their own.
    """
    text = article_text(F.col("title"), F.col("summary"))
    rows = settle(articles.select(F.col(row_id).alias("row_id"), F.array_sort(F.array_distinct(words(text))).alias("w")), "story-words")
    sets = settle(rows.filter(F.size("w") > 0).groupBy("w").agg(F.min("row_id").alias("id")).withColumn("n", F.size("w")), "story-sets")
    entries = settle(_rare_words(sets, percent), "story-prefixes")
    side = lambda rows, c, *more: rows.select("word", *[F.col(x).alias(f"{x}_{c}") for x in ("id", "n", "place", *SIGNATURE, *more)])
    near = lambda pairs: pairs.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()
    leads = entries.groupBy("word").agg(F.min(F.struct("id", "n", "place", *SIGNATURE)).alias("e"), F.count("*").alias("k")).filter("k > 1").select("word", "e.*")
    stars = near(side(leads, "a").join(side(entries, "b"), "word").filter((F.col("id_a") != F.col("id_b")) & _may_agree(percent)))
    first = settle(_linked(stars, sets, percent), "story-links")
    groups = connected(first)

    placed = entries.join(groups.withColumnRenamed("node", "id"), "id", "left").withColumn("comp", F.coalesce("component", "id")).drop("component")
    apart = placed.groupBy("word").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high").select("word")
    still = settle(placed.join(apart, "word", "left_semi"), "story-apart")
    across = near(side(still, "a", "comp").join(side(still, "b", "comp"), "word").filter(
        (F.col("id_a") < F.col("id_b")) & (F.col("comp_a") != F.col("comp_b")) & _may_agree(percent)))
    second = settle(_linked(across, sets, percent), "story-links")
    groups = connected(first.unionByName(second))
    named = sets.select("w", "id").join(groups.withColumnRenamed("node", "id"), "id", "left").select("w", F.coalesce("component", "id").alias("story_id"))
    return rows.join(named, "w", "left").select("row_id", F.coalesce("story_id", "row_id").alias("story_id"))


#: Columns of a set's signature: bits by the checksums of its words, 64 in each.
SIGNATURE = [f"bits{i}" for i in range(4)]


def _rare_words(sets: DataFrame, percent: int) -> DataFrame:
    """id, n, place, word, signature: of each set the rarest words, one of which a set that agrees by ``percent`` must share."""
    each = sets.select("id", "n", F.explode("w").alias("word"))
    counts = each.groupBy("word").agg(F.count("*").alias("k")).withColumn("h", F.pmod(F.xxhash64("word"), F.lit(64 * len(SIGNATURE))).cast("int"))
    bit = F.expr("shiftleft(1L, h % 64)")
    signature = [F.coalesce(F.bit_or(F.when(F.floor(F.col("h") / 64) == i, bit)), F.lit(0)).cast("bigint").alias(c) for i, c in enumerate(SIGNATURE)]
    ordered = each.join(counts, "word").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("k", "word"))).alias("o"), *signature)
    length = (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).cast("int")
    return ordered.select("id", "n", F.posexplode(F.slice("o", F.lit(1), length)).alias("place", "e"), *SIGNATURE).select(
        "id", "n", (F.col("place") + 1).alias("place"), "e.word", *SIGNATURE)


def _may_agree(percent: int) -> Column:
    """Can the sets a and b agree, if this word is the first they share? No pair that agrees is ruled out.

    Before the places of the word nothing is shared, and every bit that one signature
    has and the other has not is a word of one set that the other lacks.
    """
    def lacking(one: str, other: str) -> Column:
        return sum((F.bit_count(F.col(f"{c}_{one}").bitwiseAND(F.bitwise_not(f"{c}_{other}"))) for c in SIGNATURE), F.lit(0))

    most = F.least(
        1 + F.col("n_a") - F.col("place_a"), 1 + F.col("n_b") - F.col("place_b"),
        F.col("n_a") - lacking("a", "b"), F.col("n_b") - lacking("b", "a"))
    return most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of sets that agree by ``percent``."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("w").alias(f"w_{c}"), F.col("n").alias(f"n_{c}"))
    common = F.size(F.array_intersect("w_a", "w_b"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return joined.filter(common * 100 >= (F.col("n_a") + F.col("n_b") - common) * percent).select("a", "b")
