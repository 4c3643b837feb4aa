"""DuckDB SQL that states what each query must return, written from the contract."""

from __future__ import annotations

from ..functions.text import WHITESPACE
from .bindings import COMPANIES, LANES, RULES, SKIP, SOURCES, STRICT
from ..operators.curation import SECTIONS, STORY_PERCENT
from ..operators.scripts import VOICE_POOLS

ORACLES: dict[str, str] = {}

WS = WHITESPACE.replace("'", "''")


def strip(x: str) -> str:
    return f"trim({x}, '{WS}')"


def key(a: str, b: str) -> str:
    return f"md5(lower({strip(a)}) || '|' || lower({strip(b)}))"


CTE: dict[str, str] = {}

CTE["items"] = """
  SELECT doc_id, lang, text, source, CAST(substr(source, 4) AS INTEGER) AS feed_ord, doc_id AS feed_pos,
    split_part(text, chr(10), 1) AS title,
    CASE WHEN source IN ('src3', 'src7') THEN 'https://www.reddit.com/r/' || source || '/comments/' || md5(text)
         ELSE 'https://example.com/' || lang || '/' || md5(text) END AS link,
    CASE WHEN source IN ('src3', 'src7')
         THEN '<p>' || text || '</p> submitted by <a href="/u">/u/' || source || '</a> [link] [comments]'
         ELSE text END AS body,
    CASE WHEN doc_id % 11 <> 0
         THEN TIMESTAMP '2024-01-30 00:00:00' - to_hours(CAST(((doc_id // 20) * 31 + doc_id) % 72 AS INTEGER)) END AS published
  FROM documents"""
CTE["articles"] = f"""
  SELECT title, link, left(CASE WHEN doc_id % 5 <> 0 AND doc_id % 7 = 0 THEN '' ELSE body END, 500) AS summary,
    source, published, feed_ord, feed_pos, lang, {key('title', 'link')} AS article_key
  FROM items"""
CTE["todays"] = """
  SELECT * FROM (
    SELECT * FROM (SELECT * FROM articles QUALIFY row_number() OVER (PARTITION BY source ORDER BY feed_pos) <= 20)
    WHERE published IS NULL OR published >= TIMESTAMP '2024-01-29 00:00:00')
  QUALIFY row_number() OVER (PARTITION BY source ORDER BY feed_pos) <= 10"""
CTE["sent"] = """
  SELECT article_key, title, link, source, sent_at FROM (
    SELECT a.*, TIMESTAMP '2024-01-30 00:00:00' - to_days(CAST(length(summary) % 14 AS INTEGER)) AS sent_at
    FROM articles a JOIN labels l ON l.doc_id = a.feed_pos WHERE l.quality = 1)
  QUALIFY row_number() OVER (PARTITION BY article_key ORDER BY sent_at DESC, feed_ord DESC, feed_pos DESC) = 1"""
CTE["recent_sent"] = "SELECT * FROM sent WHERE sent_at > TIMESTAMP '2024-01-23 00:00:00'"


def _selftext(x: str) -> str:
    nodes = (
        f"list_filter(list_transform(string_split_regex({x}, '</?[a-zA-Z][^>]*>'), lambda n: {strip('n')}), lambda n: n <> '')"
    )
    flat = strip(f"array_to_string({nodes}, ' ')")
    return f"left({strip(f'''regexp_replace({flat}, '[ \\n\\t]*submitted by[ \\n\\t]*/u/[^ \\n\\t]+.*$', '')''')}, 2000)"


CTE["built"] = f"""
  SELECT link AS url, title, {_selftext('summary')} AS selftext, regexp_extract(link, 'reddit\\.com/r/([^/]+)/', 1) AS subreddit,
    CAST(coalesce(epoch(published), 0) AS DOUBLE) AS created_utc, CAST(0 AS INTEGER) AS score, feed_ord, feed_pos, article_key
  FROM articles WHERE contains(link, 'reddit.com')"""
CTE["threads"] = """
  SELECT b.*, TIMESTAMP '2024-01-30 00:00:00' - to_days(CAST(length(title) % 10 AS INTEGER)) AS fetched_at
  FROM built b JOIN labels l ON l.doc_id = b.feed_pos
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY feed_ord DESC, feed_pos DESC) = 1"""
CTE["uncached"] = """
  SELECT * FROM articles WHERE contains(link, 'reddit.com') AND link NOT IN (SELECT url FROM threads)"""

# Sweep entries straight from the events, without any JSON.
CTE["base_entries"] = """
  SELECT event_id, user_id, event_type, ts, strftime(date_trunc('week', ts), '%Y-%m-%d') AS batch,
    strftime(ts, '%Y-%m-%d') AS date, ['competitor', 'market-pricing', 'launches'][(user_id + event_id) % 3 + 1] AS lane,
    CASE WHEN event_id % 19 = 0 THEN '' ELSE 'User ' || user_id || ' #' || event_id % 20 END AS subject,
    CASE WHEN event_type = 'view' THEN '' ELSE event_type END AS signal_type,
    CASE WHEN event_id % 13 = 0 THEN '' ELSE event_type || ' <event> & ''more''' END AS summary,
    CASE WHEN event_id % 3 = 0 THEN '' ELSE 'Worth a look' END AS relevance,
    CASE WHEN event_id % 4 = 0 THEN '' ELSE 'Site ' || user_id % 5 END AS source_name,
    CASE event_id % 7 WHEN 0 THEN 'ftp://' WHEN 1 THEN 'HTTPS://' ELSE 'https://' END || 'example.com/u/' || user_id AS source_url,
    CASE event_type WHEN 'error' THEN 'act_now' WHEN 'purchase' THEN 'notable' ELSE 'info' END AS severity,
    CASE WHEN event_id % 5 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS observed_at,
    CASE WHEN event_id % 17 = 0 THEN '{}' ELSE replace(props, ' ', '') END AS metrics,
    'Entity ' || user_id % 10 AS entity, event_id % 23 AS shape
  FROM events"""
CTE["entries"] = """
  SELECT * EXCLUDE (shape), event_id AS payload_seq, CASE WHEN shape = 5 THEN 3 ELSE 0 END AS pos
  FROM base_entries WHERE shape NOT IN (11, 17, 19, 21)
  UNION ALL
  SELECT * EXCLUDE (shape) REPLACE (upper(subject) AS subject, 'seen again' AS summary), event_id, 1
  FROM base_entries WHERE shape NOT IN (5, 11, 17, 19, 21)"""
CTE["grounded"] = "SELECT * FROM entries WHERE subject <> '' AND summary <> '' AND source_url NOT LIKE 'ftp%'"
CTE["kept"] = """
  SELECT * FROM grounded
  QUALIFY row_number() OVER (PARTITION BY batch, lane, lower(subject || '|' || signal_type) ORDER BY payload_seq, pos) = 1"""
CTE["lanes"] = "SELECT * FROM (VALUES " + ", ".join(
    f"('{k}', '{topic}', '{label}')" for k, topic, label, *_ in LANES) + ") v(key, topic, topic_label)"
CTE["signals"] = f"""
  SELECT {key('subject', 'source_url')} AS id, batch, date, lane, coalesce(topic, 'general') AS topic,
    coalesce(topic_label, 'Web Sweep') AS topic_label,
    CASE WHEN signal_type = '' THEN 'observation' ELSE signal_type END AS signal_type,
    subject, summary, relevance, source_name, source_url, observed_at, metrics, severity, entity, '' AS role, '' AS bucket,
    payload_seq, CAST(pos AS INTEGER) AS pos,
    CASE severity WHEN 'act_now' THEN 0 WHEN 'notable' THEN 1 ELSE 2 END AS rank
  FROM kept LEFT JOIN lanes ON lane = key"""
CTE["ranked"] = """
  SELECT *, CAST(row_number() OVER (PARTITION BY batch ORDER BY rank, topic_label, payload_seq, pos) AS INTEGER) AS item_no
  FROM signals"""
CTE["failures"] = """
  SELECT batch, lane, count(*) AS n_payloads, count(*) FILTER (WHERE shape IN (11, 19)) AS n_failed,
    sum(CASE WHEN shape IN (11, 17, 19) THEN 0 WHEN shape = 5 THEN 4 WHEN shape = 21 THEN 1 ELSE 2 END) AS n_raw
  FROM base_entries GROUP BY batch, lane"""

DEPENDS = {
    "items": [], "articles": ["items"], "todays": ["articles"], "sent": ["articles"], "recent_sent": ["sent"],
    "built": ["articles"], "threads": ["built"], "uncached": ["articles", "threads"],
    "base_entries": [], "entries": ["base_entries"], "grounded": ["entries"], "kept": ["grounded"], "lanes": [],
    "signals": ["kept", "lanes"], "ranked": ["signals"], "failures": ["base_entries"],
}


def _need(names: list[str], seen: list[str]) -> list[str]:
    for n in names:
        if n not in seen:
            _need(DEPENDS[n], seen)
            seen.append(n)
    return seen


def oracle(name: str, needs: str, sql: str, **extra: str) -> None:
    """Register a statement; ``needs`` names the shared views, ``extra`` adds its own."""
    views = [(n, CTE[n]) for n in _need(needs.split(), [])] + list(extra.items())
    head = "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in views) + "\n" if views else ""
    ORACLES[name] = head + sql


def define(name: str, needs: str, sql: str) -> None:
    CTE[name] = sql
    DEPENDS[name] = needs.split()


# ---------------------------------------------------------------- sources and sinks
oracle("src1_feed_items", "articles items", """
SELECT a.title, a.link, a.source, a.published, a.feed_ord,
  row_number() OVER (PARTITION BY a.source, a.feed_pos // 2000 ORDER BY a.feed_pos) - 1 AS feed_pos,
  CAST(length(left(i.body, 500)) AS INTEGER) AS n_summary
FROM articles a JOIN items i ON a.feed_pos = i.feed_pos""")
oracle("src2_stories", "", """
SELECT 'Story ' || o_orderkey AS title,
  CASE WHEN o_orderkey % 3 <> 0 THEN 'https://example.com/' || o_orderkey
       ELSE 'https://news.ycombinator.com/item?id=' || o_orderkey END AS link,
  'Score: ' || CASE WHEN o_orderkey % 4 <> 0 THEN CAST(trunc(o_totalprice) AS BIGINT) ELSE 0 END || ' | Comments: ' || o_custkey AS summary,
  'Hacker News (Top)' AS source,
  CASE WHEN o_orderkey % 6 <> 0 THEN date_trunc('second', o_orderdate) END AS published, rn - 1 AS feed_pos
FROM (SELECT *, row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders)
WHERE rn <= 20 AND o_orderkey % 10 NOT IN (0, 1)""")
oracle("src3_union", "todays", """
SELECT title, link, source, published, feed_ord, feed_pos FROM todays WHERE source <> 'src5'
UNION ALL
SELECT title, 'https://news.ycombinator.com/item?id=' || doc_id, 'Hacker News (Top)', NULL, 2147483647, rn - 1
FROM (SELECT doc_id, split_part(text, chr(10), 1) AS title, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS rn FROM documents)
WHERE rn <= 20 AND title <> ''""")
# The story rows carry their score in the summary only, which the query leaves out.
oracle("src4_feed_health", "", """
SELECT f.source,
  CASE WHEN f.source = 'src12' THEN 'not_fetched' WHEN f.source IN ('src4', 'src9') THEN 'http_error'
       WHEN count(d.doc_id) = 0 THEN 'empty'
       WHEN f.source <> 'silent' AND TRY_CAST(substr(f.source, 4) AS INTEGER) % 4 IN (0, 3) THEN 'malformed_kept' ELSE 'ok' END AS health,
  CASE WHEN f.source IN ('src4', 'src9', 'src12') THEN 0 ELSE count(d.doc_id) END AS n_rows,
  CASE WHEN f.source <> 'silent' AND TRY_CAST(substr(f.source, 4) AS INTEGER) % 4 = 3 THEN count(DISTINCT d.doc_id // 2000) ELSE 0 END AS n_lost,
  CASE WHEN f.source <> 'silent' AND TRY_CAST(substr(f.source, 4) AS INTEGER) % 4 = 3 THEN count(d.doc_id) ELSE 0 END AS n_recovered
FROM feeds f LEFT JOIN documents d ON d.source = f.source GROUP BY f.source""",
       feeds="SELECT unnest([" + ", ".join(f"'{s}'" for s in [*SOURCES, "silent"]) + "]) AS source")
oracle("src5_state_import", "articles", """
SELECT kind, CASE kind WHEN 'stamp' THEN '2024-01-27' WHEN 'signal' THEN md5(link) ELSE article_key END AS key,
  CASE WHEN kind IN ('sent', 'thread') THEN title ELSE '' END AS title,
  CASE kind WHEN 'sent' THEN TIMESTAMP '2024-01-25 06:00:00' WHEN 'thread' THEN TIMESTAMP '2024-01-26 06:00:00' END AS at
FROM articles, (SELECT unnest(['sent', 'thread', 'signal', 'stamp']) AS kind) WHERE feed_pos % 10 NOT IN (7, 8)""")
oracle("src6_payload_entries", "base_entries", """
SELECT batch, lane, event_id AS payload_seq, CAST(pos AS INTEGER) AS pos, pos = 3 OR shape <> 5 AS is_object
FROM (SELECT *, unnest(CASE WHEN shape = 5 THEN [0, 1, 2, 3] WHEN shape IN (11, 17, 19, 21) THEN [] ELSE [0, 1] END) AS pos FROM base_entries)""")
oracle("src8_file_listing", "", "SELECT DISTINCT 'source=' || source AS folder, true AS filled FROM documents")
oracle("src7_pages", "", "SELECT page_id, url, length(html) AS n_chars FROM pages")
oracle("snk1_mark_sent", "sent articles", """
SELECT article_key, title, link, source, TIMESTAMP '2024-01-30 00:00:00' AS sent_at FROM articles
WHERE feed_pos % 2 = 1
QUALIFY row_number() OVER (PARTITION BY article_key ORDER BY feed_ord DESC, feed_pos DESC) = 1
UNION ALL
SELECT * FROM sent WHERE article_key NOT IN (SELECT article_key FROM articles WHERE feed_pos % 2 = 1)""")
oracle("snk2_commit", "todays signals", """
SELECT DISTINCT run, 'sent' AS kind, article_key AS key, 1::BIGINT AS n FROM (
  SELECT 1::BIGINT AS run, article_key FROM todays WHERE feed_ord % 2 = 0
  UNION ALL
  SELECT 3, article_key FROM todays WHERE article_key NOT IN (SELECT article_key FROM todays WHERE feed_ord % 2 = 0))
UNION ALL
SELECT CASE WHEN batch < '2024-01-22' THEN 1 ELSE 3 END, 'signal', id, count(*) FROM signals GROUP BY ALL
UNION ALL
SELECT CASE WHEN batch < '2024-01-22' THEN 1 ELSE 3 END, 'fresh', id, count(*) FROM signals
WHERE batch < '2024-01-22' OR id NOT IN (SELECT id FROM signals WHERE batch < '2024-01-22') GROUP BY ALL""")
define("rolled", "signals", """
  SELECT * FROM (SELECT *, min(payload_seq) OVER (PARTITION BY id) AS first_seq FROM signals)
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY batch >= '2024-01-22' DESC, payload_seq DESC, pos DESC) = 1""")
oracle("snk3_history_write", "rolled", "SELECT id, batch, date, lane, severity, summary FROM rolled WHERE date >= '2024-01-16'")
oracle("sig5_merge_signals", "rolled", """
SELECT id, batch, date, lane, severity, summary, first_seq FROM rolled WHERE date >= '2024-01-16'""")

# ---------------------------------------------------------------- filters and projections
oracle("flt1_recent", "articles", """
SELECT article_key, source, published, feed_pos FROM articles WHERE published IS NULL OR NOT published < TIMESTAMP '2024-01-29 00:00:00'""")
oracle("flt2_published", "items", "SELECT doc_id, published FROM items")
oracle("flt3_summary", "articles", "SELECT feed_pos AS doc_id, summary FROM articles")
oracle("flt4_thread_articles", "articles", "SELECT article_key, link, source, feed_pos FROM articles WHERE source IN ('src3', 'src7')")
oracle("flt5_grounded", "grounded", "SELECT payload_seq, CAST(pos AS INTEGER) AS pos, subject, summary, source_url FROM grounded")
oracle("flt6_lane_selection", "base_entries", """
SELECT lane, count(*) AS n_payloads FROM base_entries WHERE lane <> 'market-pricing' GROUP BY lane""")
oracle("flt7_alerts", "articles recent_sent", """
SELECT run, 'no new articles' AS alert FROM stats WHERE n_new = 0
UNION ALL SELECT run, 'no thread articles' FROM stats WHERE n_threads = 0
UNION ALL SELECT run, 'no threads built' FROM stats WHERE n_threads > 0 AND n_built = 0""", runs="""
  SELECT coalesce(strftime(published, '%Y-%m-%d'), 'undated') AS run, source IN ('src3', 'src7') AS thread,
    article_key NOT IN (SELECT article_key FROM recent_sent) AS new FROM articles""", stats="""
  SELECT run, count(*) FILTER (WHERE new) AS n_new, count(*) FILTER (WHERE thread) AS n_threads,
    count(*) FILTER (WHERE new AND thread) AS n_built
  FROM (SELECT strftime(unnest(generate_series(min(published)::DATE::TIMESTAMP, max(published)::DATE::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY)), '%Y-%m-%d') AS run FROM articles)
  FULL JOIN runs USING (run) GROUP BY run""")
oracle("prj1_article_key", "articles", "SELECT article_key, feed_pos FROM articles")
oracle("prj2_signal_id", "entries", f"""
SELECT payload_seq, CAST(pos AS INTEGER) AS pos, {key('subject', 'source_url')} AS id FROM entries
UNION ALL
SELECT event_id, CAST(unnest([0, 1, 2]) AS INTEGER), md5('|') FROM base_entries WHERE shape = 5""")
oracle("prj3_signal_dimensions", "signals", """
SELECT batch, lane, topic, topic_label, count(*) AS n_signals FROM signals GROUP BY ALL""")

# ---------------------------------------------------------------- joins
oracle("jn1_not_sent", "articles recent_sent", """
SELECT article_key, title, link, source, published, feed_pos FROM articles a
WHERE NOT EXISTS (SELECT 1 FROM recent_sent s WHERE s.article_key = a.article_key)""")
oracle("jn2_skip_report", "articles recent_sent", """
SELECT article_key, left(title, 50) AS title, source FROM articles WHERE article_key IN (SELECT article_key FROM recent_sent)""")
oracle("jn3_uncached_threads", "uncached", "SELECT article_key, link, feed_pos FROM uncached")
oracle("jn4_fresh_signals", "signals", """
SELECT id, lane, subject, CASE WHEN id IN (SELECT id FROM signals WHERE batch < '2024-01-29') THEN 'repeat' ELSE 'fresh' END AS state
FROM signals WHERE batch = '2024-01-29'""")
oracle("jn5_nearest_bucket", "", """
SELECT p_partkey, CAST(CASE WHEN p_size = 33 THEN 600 WHEN p_size <= 11 THEN 600 WHEN p_size <= 22 THEN 900 ELSE 1200 END AS INTEGER) AS timeout FROM part""")
oracle("jn5_nearest_row", "", """
SELECT l.l_orderkey, l.l_linenumber, l.price, coalesce(CASE WHEN b.at IS NULL OR a.at - l.price < l.price - b.at THEN a.k ELSE b.k END, -1) AS near_orderkey
FROM lines l ASOF LEFT JOIN marks b ON l.price >= b.at ASOF LEFT JOIN marks a ON l.price <= a.at""",
       lines="SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN l_extendedprice END AS price FROM lineitem",
       marks="SELECT o_totalprice AS at, min(o_orderkey) AS k FROM orders GROUP BY 1")
oracle("jn6_lookups", "", """
SELECT event_id, CAST(CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 ELSE 2 END AS INTEGER) AS rank,
  CASE event_type WHEN 'error' THEN '🔴' WHEN 'purchase' THEN '🟡' ELSE '▫️' END AS badge,
  CASE WHEN user_id % 3 = 0 THEN 'voice-s' ELSE 'voice-a' END AS voice FROM events""")

# ---------------------------------------------------------------- interest rules
_TOKENS = r"list_filter(regexp_split_to_array(lower({x}), '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def tokens(x: str) -> str:
    return _TOKENS.format(x=x)


def spaced(x: str) -> str:
    return f"' ' || array_to_string({tokens(x)}, '  ') || ' '"


def hits(norm: str, term: str) -> str:
    needle = " " + "  ".join(term.lower().split()) + " "
    return f"((length({norm}) - length(replace({norm}, '{needle}', ''))) // {len(needle)})"


def any_hits(norm: str, terms) -> str:
    return "(" + " + ".join(hits(norm, t) for t in terms) + ")"


define("normed", "articles", f"SELECT *, {spaced('title || chr(10) || summary')} AS norm FROM articles")
_topic_terms: dict[tuple[str, int], list[str]] = {}
for _r in RULES:
    _topic_terms.setdefault((_r.topic, _r.tier), []).append(_r.term)
define("topics", "normed", "\n  UNION ALL\n".join(
    f"  SELECT feed_pos, article_key, '{topic}' AS topic, {tier} AS tier, CAST({any_hits('norm', terms)} AS BIGINT) AS n_hits "
    f"FROM normed WHERE {any_hits('norm', terms)} > 0" for (topic, tier), terms in _topic_terms.items()))


def _scores(topics: str) -> str:
    return f"""
  SELECT a.*, best_tier, lead_topic, coalesce(t.n_hits, 0) AS n_hits, coalesce(must_watch, false) AS must_watch, coalesce(n_topics, 0) AS n_topics
  FROM normed a LEFT JOIN (
    SELECT feed_pos, CAST(min(tier) AS INTEGER) AS best_tier, arg_min(topic, (tier, -n_hits, topic)) AS lead_topic,
      CAST(sum(n_hits) AS BIGINT) AS n_hits, bool_or(tier = 0) AS must_watch, count(*) AS n_topics
    FROM {topics} GROUP BY feed_pos) t ON a.feed_pos = t.feed_pos"""


define("rated", "normed topics", _scores("topics"))
_skips = " OR ".join(
    f"(t.topic = '{topic}' AND {any_hits('a.norm', terms)} > 0)" for topic, terms in SKIP.items())
define("kept_topics", "normed topics", f"""
  SELECT t.* FROM topics t JOIN normed a ON a.feed_pos = t.feed_pos WHERE NOT (t.tier > 0 AND ({_skips}))""")
define("survivors", "normed kept_topics", f"""
  SELECT * FROM ({_scores('kept_topics')}) WHERE must_watch OR {any_hits('norm', STRICT)} = 0""")
define("stories", "survivors", f"""
  SELECT *, md5(array_to_string(list_sort(list_distinct({tokens('title')})), ' ')) AS story_key FROM survivors""")

_PRIORITY = "best_tier ASC NULLS LAST, n_hits DESC, published DESC NULLS LAST, article_key, feed_ord, feed_pos"
_place = "CASE " + " ".join(
    "WHEN lead_topic IN (" + ", ".join(f"'{t}'" for t in s.topics) + f") THEN {i}" for i, s in enumerate(SECTIONS)) + " END"
_names = "[" + ", ".join(f"'{s.name}'" for s in SECTIONS) + "]"
_caps = "[" + ", ".join(str(s.cap or 30) for s in SECTIONS) + "]"
_heads = "[" + ", ".join(f"'{s.heading}'" for s in SECTIONS) + "]"

oracle("jn7_rule_match", "topics", "SELECT feed_pos AS row_id, article_key, topic, CAST(tier AS INTEGER) AS tier, n_hits FROM topics")
oracle("int1_topics", "topics", "SELECT feed_pos, topic, CAST(tier AS INTEGER) AS tier, n_hits FROM topics")
oracle("int2_score", "rated", "SELECT feed_pos, best_tier, lead_topic, n_hits FROM rated")
oracle("int3_must_watch", "rated", "SELECT article_key, feed_pos, source, n_hits FROM rated WHERE must_watch")
oracle("int4_excluded", "survivors", "SELECT feed_pos, CAST(n_topics AS INTEGER) AS n_topics, best_tier, n_hits FROM survivors")
oracle("int5_best_per_story", "rated", f"""
SELECT story_key, feed_pos, title, best_tier FROM (
  SELECT r.*, md5(array_to_string(list_sort(list_distinct({tokens('title')})), ' ')) AS story_key, quality
  FROM rated r LEFT JOIN labels l ON l.doc_id = r.feed_pos)
QUALIFY row_number() OVER (PARTITION BY story_key ORDER BY best_tier ASC NULLS LAST, n_hits DESC, quality DESC NULLS LAST,
  published DESC NULLS LAST, article_key, feed_ord, feed_pos) = 1""")
oracle("int6_sections", "survivors", f"""
SELECT feed_pos, {_names}[{_place} + 1] AS section, CAST({_place} AS INTEGER) AS section_ord, lead_topic
FROM survivors WHERE {_place} IS NOT NULL""")
define("routed", "stories", f"""
  SELECT *, {_place} AS section_ord, {_names}[{_place} + 1] AS section FROM (
    SELECT * FROM stories QUALIFY row_number() OVER (PARTITION BY lang, story_key ORDER BY {_PRIORITY}) = 1)
  WHERE {_place} IS NOT NULL""")
define("chosen", "routed", f"""
  SELECT * FROM (
    SELECT * FROM (
      SELECT * FROM routed WHERE NOT must_watch
      QUALIFY row_number() OVER (PARTITION BY lang, section ORDER BY {_PRIORITY}) <= {_caps}[section_ord + 1])
    QUALIFY count(*) OVER (PARTITION BY lang, section) >= 2)
  QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_PRIORITY}) <= 30
  UNION ALL
  SELECT * FROM routed WHERE must_watch""")
oracle("int7_selection", "chosen", "SELECT lang, section, feed_pos, must_watch, best_tier, n_hits FROM chosen")
_company: dict[str, list[str]] = {}
for _name, _term in COMPANIES:
    _company.setdefault(_name, []).append(_term)
oracle("int8_companies", "normed", """
SELECT source, entity, count(*) AS n_articles FROM found GROUP BY source, entity
QUALIFY count(*) OVER (PARTITION BY source) >= 2""", found="\n  UNION ALL\n".join(
    f"  SELECT source, '{n}' AS entity FROM normed WHERE {any_hits('norm', terms)} > 0" for n, terms in _company.items()))
oracle("int9_opportunities", "", """
SELECT c_custkey, c_name || CASE c_mktsegment WHEN 'BUILDING' THEN ' raises $' || amt || 'M in Series B funding'
    WHEN 'AUTOMOBILE' THEN ' is hiring engineers' WHEN 'MACHINERY' THEN ' announces layoffs after $' || amt || 'M loss'
    ELSE ' appoints new CEO' END AS text,
  c_mktsegment = 'BUILDING' AS is_funding, c_mktsegment = 'AUTOMOBILE' AS is_hiring, c_mktsegment = 'MACHINERY' AS is_layoffs,
  c_mktsegment = 'HOUSEHOLD' AS is_executive,
  CASE WHEN c_mktsegment = 'BUILDING' THEN '$' || amt || 'M' ELSE '' END AS amount,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'Series B' ELSE '' END AS stage
FROM (SELECT *, CAST(floor(abs(c_acctbal)) AS BIGINT) AS amt FROM customer)
WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')""")


def esc(x: str) -> str:
    return (f"replace(replace(replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
            f"'\"', '&quot;'), '''', '&#x27;')")


define("digests", "chosen", f"""
  SELECT lang, part_no, CASE WHEN part_no > 0 THEN '' ELSE '<h1>🗞️ Daily News Digest</h1>' || chr(10) || '<p>Good morning! Here''s your personalized news for 2024-01-30.</p>'
      || chr(10) || chr(10) END || string_agg(part, chr(10) || chr(10) ORDER BY section_ord) AS html,
    CAST(sum(c) AS BIGINT) AS n_articles
  FROM (
    SELECT lang, part_no, section_ord, count(*) AS c,
      '<h2>' || {esc(f'{_heads}[section_ord + 1]')} || '</h2>' || chr(10) || '<ul>' || chr(10) || string_agg(
        '  <li>' || chr(10) || '    <strong><a href="' || {esc('link')} || '">' || {esc('title')} || '</a></strong> (' || {esc('source')}
        || ')<br>' || chr(10) || '    ' || {esc('summary')} || chr(10) || '  </li>', chr(10) ORDER BY {_PRIORITY})
        || chr(10) || '</ul>' AS part
    FROM (SELECT *, CAST((row_number() OVER (PARTITION BY lang ORDER BY section_ord, {_PRIORITY}) - 1) // 200 AS INTEGER) AS part_no FROM chosen)
    GROUP BY lang, part_no, section_ord)
  GROUP BY lang, part_no""")
oracle("int5_near_stories", "articles", f"""
SELECT s.row_id, coalesce(low.story_id, s.row_id) AS story_id FROM sets s LEFT JOIN low ON low.node = s.row_id""", sets="""
  SELECT feed_pos AS row_id, list_distinct(list_filter(string_split_regex(lower(title || chr(10) || summary), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS w FROM articles""",
       links=f"""
  SELECT a, b FROM (
    SELECT x.row_id AS a, y.row_id AS b, len(list_intersect(x.w, y.w)) AS c, len(x.w) + len(y.w) AS n
    FROM sets x JOIN sets y ON x.row_id < y.row_id AND least(len(x.w), len(y.w)) * 100 >= greatest(len(x.w), len(y.w)) * {STORY_PERCENT} AND len(x.w) > 0)
  WHERE c * 100 >= (n - c) * {STORY_PERCENT}""",
       two_way="SELECT a, b FROM links UNION SELECT b, a FROM links",
       reach="SELECT a AS node, a AS seen FROM two_way UNION SELECT r.node, l.b FROM reach r JOIN two_way l ON r.seen = l.a",
       low="SELECT node, min(seen) AS story_id FROM reach GROUP BY node")
ORACLES["int5_near_stories"] = ORACLES["int5_near_stories"].replace("WITH ", "WITH RECURSIVE ", 1)
oracle("int10_digest", "digests", "SELECT lang, part_no, html, n_articles FROM digests")
oracle("snk4_publish", "digests", "SELECT lang, part_no, md5(html) AS html_md5, n_articles, '2024-01-30' AS digest_date FROM digests")

# ---------------------------------------------------------------- aggregates
_FEEDS = "SELECT unnest([" + ", ".join(f"'{s}'" for s in [*SOURCES, "silent"]) + "]) AS source"
oracle("agg1_rows_per_source", "todays", """
SELECT f.source, count(t.source) AS n_rows FROM feeds f LEFT JOIN todays t ON t.source = f.source GROUP BY f.source""", feeds=_FEEDS)
oracle("flagship_new_per_source", "todays recent_sent", """
SELECT f.source, count(t.source) AS n_rows FROM feeds f
LEFT JOIN (SELECT * FROM todays WHERE article_key NOT IN (SELECT article_key FROM recent_sent)) t ON t.source = f.source
GROUP BY f.source""", feeds=_FEEDS)
oracle("agg2_severity_counts", "signals", """
SELECT batch, count(*) FILTER (WHERE severity = 'act_now') AS n_act_now, count(*) FILTER (WHERE severity = 'notable') AS n_notable,
  count(*) FILTER (WHERE severity = 'info') AS n_info, count(*) AS n_total FROM signals GROUP BY batch""")
oracle("agg3_sweep_funnel", "failures signals", """
SELECT f.batch, f.lane, n_payloads, n_failed, CAST(n_raw AS BIGINT) AS n_raw, coalesce(n_kept, 0) AS n_kept FROM failures f
LEFT JOIN (SELECT batch, lane, count(*) AS n_kept FROM signals GROUP BY batch, lane) s ON s.batch = f.batch AND s.lane = f.lane""")
oracle("agg4_overflow", "signals", "SELECT batch, CASE WHEN count(*) > 14 THEN count(*) - 14 ELSE 0 END AS n_more FROM signals GROUP BY batch")
oracle("agg5_latest_per_family", "", """
SELECT f.family, CASE WHEN count(e.created) > 0 THEN arg_max(e.id, (e.created, e.id)) FILTER (WHERE e.created IS NOT NULL) ELSE max(e.id) END AS id
FROM (SELECT unnest(['brand#1', 'Brand#2', 'BRAND#25', 'widget', 'nothing']) AS family) f
LEFT JOIN (SELECT p_brand || '-' || p_partkey AS id,
    CASE WHEN p_partkey % 7 <> 0 AND p_brand NOT LIKE '%25%' THEN DATE '2024-01-01' + p_size END AS created FROM part) e
  ON contains(lower(e.id), lower(f.family)) GROUP BY f.family""")
_BLOCK = ("chr(10) || '---' || chr(10) || 'Article ' || i || ':' || chr(10) || 'Source: ' || source || chr(10) || 'Title: ' || title || chr(10) "
          "|| 'Link: ' || link || chr(10) || 'Summary: ' || summary || chr(10)")
oracle("agg6_article_blocks", "todays", f"""
SELECT 'daily' AS digest, string_agg({_BLOCK}, '' ORDER BY i) AS blocks, count(*) AS n_articles
FROM (SELECT *, row_number() OVER (ORDER BY feed_ord, feed_pos) AS i FROM todays)""")
oracle("txt9_prompts", "todays", f"""
SELECT edition, md5('Reader: Alex' || chr(10) || chr(10) || 'ARTICLES:' || chr(10) || string_agg({_BLOCK}, '' ORDER BY i)
    || chr(10) || '---' || chr(10) || 'Pick the best.') AS prompt_md5, count(*) AS n_articles
FROM (SELECT *, row_number() OVER (PARTITION BY edition ORDER BY feed_ord, feed_pos) AS i
      FROM (SELECT *, CASE WHEN feed_ord < 10 THEN 'a' ELSE 'b' END AS edition FROM todays))
GROUP BY edition""")
oracle("agg7_history_size", "recent_sent", "SELECT count(*) AS n_rows FROM recent_sent")

# ---------------------------------------------------------------- service errors
define("errors", "", """
  SELECT event_id, CASE event_id % 9 WHEN 0 THEN 200 WHEN 1 THEN 400 WHEN 2 THEN 401 WHEN 3 THEN 404 WHEN 4 THEN 429 WHEN 5 THEN 500
      WHEN 6 THEN 502 WHEN 7 THEN 503 ELSE 529 END AS status,
    CASE event_id % 5 WHEN 0 THEN 'overloaded_error' WHEN 1 THEN 'rate_limit_error' WHEN 2 THEN 'api_error'
      WHEN 3 THEN 'invalid_request_error' ELSE '' END AS error_type,
    CASE event_id % 4 WHEN 0 THEN 'credit' WHEN 1 THEN 'missing' WHEN 2 THEN 'generate' ELSE 'overloaded' END AS msg
  FROM events WHERE event_type = 'error'""")
define("classified", "errors", """
  SELECT event_id, error_type,
    status IN (429, 500, 502, 503, 529) OR error_type IN ('overloaded_error', 'rate_limit_error', 'api_error') OR msg = 'overloaded' AS transient,
    status = 404 OR (status = 400 AND msg = 'missing') AS model_missing,
    CASE WHEN status = 429 THEN 'rate limit exceeded' WHEN status = 401 THEN 'authentication failed'
      WHEN status = 400 AND msg = 'credit' THEN 'credits exhausted' WHEN status = 400 THEN 'request error'
      WHEN error_type = 'overloaded_error' OR status = 529 THEN 'overloaded' WHEN error_type = 'rate_limit_error' THEN 'rate limited'
      ELSE 'api error' END AS label
  FROM errors""")
oracle("err1_classify", "classified", "SELECT event_id, error_type, transient, model_missing, label FROM classified")
oracle("agg8_error_counts", "classified", """
SELECT label, count(*) AS n_events, count(*) FILTER (WHERE transient) AS n_transient, count(*) FILTER (WHERE model_missing) AS n_model_missing
FROM classified GROUP BY label""")
oracle("err2_suggest_action", "errors", "SELECT event_id, msg IN ('credit', 'generate') AS suggest_action FROM errors")

# ---------------------------------------------------------------- windows, order, sets
oracle("win1_source_topk", "todays", "SELECT article_key, title, link, source, published, feed_pos FROM todays")
oracle("win2_first_per_subject", "kept", "SELECT batch, lane, payload_seq, CAST(pos AS INTEGER) AS pos, subject, signal_type FROM kept")
_TURN = "CASE role WHEN 'user' THEN 'Alex: ' WHEN 'assistant' THEN 'Sam: ' ELSE '' END || text"


def _segmented(lines: str, doc: str, order: str) -> str:
    """Gaps and islands over stripped, non-blank lines."""
    return f"""
  SELECT {doc}, seg, max(CASE WHEN label THEN CASE WHEN lower(line[1]) = 'a' THEN 'Alex' ELSE 'Sam' END END) AS speaker,
    string_agg(CASE WHEN label THEN {strip("regexp_replace(line, '(?i)^(alex|sam)[ ]*:', '')")} ELSE line END, ' ' ORDER BY {order}) AS dialogue,
    count(*) AS n_lines
  FROM (SELECT *, sum(CASE WHEN label THEN 1 ELSE 0 END) OVER (PARTITION BY {doc} ORDER BY {order}) AS seg
        FROM (SELECT *, regexp_matches(line, '^(?i)(alex|sam)\\s*:\\s*(.+)') AS label FROM ({lines}) WHERE line <> ''))
  WHERE seg > 0 GROUP BY {doc}, seg"""


oracle("win3_transcript_segments", "", "SELECT conv_id, CAST(seg AS BIGINT) AS seg_no, speaker, dialogue, n_lines FROM segs", segs=_segmented(
    f"SELECT conv_id, turn, unnest(range(1, len(parts) + 1)) AS no, {strip('unnest(parts)')} AS line "
    f"FROM (SELECT conv_id, turn, string_split({_TURN}, chr(10)) AS parts FROM conversations)", "conv_id", "turn, no"))
oracle("win4_label_islands", "ranked", """
SELECT batch, item_no, CAST(sum(s) OVER (PARTITION BY batch ORDER BY item_no) AS INTEGER) AS island, topic_label, severity, id
FROM (SELECT *, CASE WHEN topic_label IS DISTINCT FROM lag(topic_label) OVER (PARTITION BY batch ORDER BY item_no) THEN 1 ELSE 0 END AS s
      FROM ranked WHERE item_no <= 60)""")
define("talk", "", """
  SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN 'Sam' ELSE 'Alex' END AS speaker,
    CAST(len(string_split(text, ' ')) * 400 AS BIGINT) AS dur FROM conversations""")
define("timed", "talk", """
  SELECT conv_id AS episode, turn AS idx, speaker, dur AS dur_ms, CAST(pause AS BIGINT) AS pause_ms,
    CAST(sum(dur + pause) OVER (PARTITION BY conv_id ORDER BY turn) + 7000 AS BIGINT) AS end_ms
  FROM (SELECT *, CASE WHEN speaker <> lag(speaker) OVER (PARTITION BY conv_id ORDER BY turn) THEN 300 ELSE 0 END AS pause FROM talk)""")
oracle("win6_timeline", "timed", "SELECT episode, idx, speaker, dur_ms, pause_ms, end_ms - dur_ms AS start_ms, end_ms FROM timed")
oracle("win6_episode_length", "timed", """
SELECT episode, CAST(sum(dur_ms) + sum(pause_ms) + 8000 + 12000 - 2000 AS BIGINT) AS total_ms, count(*) AS n_segments FROM timed GROUP BY episode""")
oracle("top1_ranked_signals", "ranked", "SELECT batch, item_no, severity, topic_label, id FROM ranked WHERE item_no <= 14")
oracle("top2_first_threads", "uncached", """
SELECT article_key, link, feed_ord, feed_pos FROM uncached ORDER BY feed_ord, feed_pos LIMIT 20""")
oracle("top4_story_ids", "", "SELECT conv_id AS run, turn AS pos, CAST(length(text) AS INTEGER) AS id FROM conversations WHERE turn < 3")
oracle("srt1_display_order", "signals", "SELECT id, batch, lane, severity FROM signals ORDER BY rank, payload_seq, pos")
oracle("set1_bag_union", "todays", """
SELECT article_key, source, feed_pos FROM todays UNION ALL SELECT article_key, source, feed_pos FROM todays WHERE published IS NULL""")
oracle("set2_add_threads", "threads built uncached", """
SELECT url, title, selftext, subreddit, created_utc, fetched_at, CAST(0 AS INTEGER) AS n_comments_kept FROM threads
UNION ALL
SELECT url, title, selftext, subreddit, created_utc, TIMESTAMP '2024-01-30 00:00:00', 0 FROM (
  SELECT b.* FROM built b JOIN (SELECT feed_pos FROM uncached ORDER BY feed_ord, feed_pos LIMIT 20) u ON u.feed_pos = b.feed_pos
  QUALIFY row_number() OVER (PARTITION BY url ORDER BY b.feed_ord DESC, b.feed_pos DESC) = 1)""")
oracle("set3_ordered_distinct", "", """
SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN p_brand || '>' || p_type || '>' || p_name
  ELSE p_type || '>' || p_brand || '>' || p_name END AS fallbacks FROM part""")
oracle("ret1_retained_sent", "sent", "SELECT article_key, source, sent_at FROM sent WHERE sent_at > TIMESTAMP '2024-01-23 00:00:00'")
oracle("ret2_retained_threads", "threads", "SELECT url, title, fetched_at FROM threads WHERE fetched_at > TIMESTAMP '2024-01-23 00:00:00'")
oracle("ret3_expired_audio", "", """
SELECT name, file_date, CASE WHEN file_date IS NULL THEN 'unreadable' WHEN file_date <= DATE '1996-06-05' THEN 'expired' ELSE 'kept' END AS status,
  count(*) AS n_files
FROM (SELECT CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS file_date,
        CASE WHEN o_custkey % 9 = 0 THEN 'digest-v' || o_custkey ELSE 'digest-' || strftime(o_orderdate, '%Y-%m-%d') END || '.mp3' AS name FROM orders)
WHERE file_date IS DISTINCT FROM DATE '1996-06-15' GROUP BY ALL""")
oracle("ret4_expired_logs", "", """
SELECT 'digest.log.' || event_id AS name, ts AS modified FROM events
WHERE event_type NOT IN ('view', 'click') AND ts < TIMESTAMP '2024-01-11 00:00:00'""")
oracle("rdt1_threads", "built", "SELECT url, title, selftext, subreddit, created_utc, score FROM built")

# ---------------------------------------------------------------- signals
oracle("sig1_normalize", "signals", "SELECT * EXCLUDE (rank) FROM signals")
_ITEM = (
    "'<li>' || CASE severity WHEN 'act_now' THEN '🔴' WHEN 'notable' THEN '🟡' ELSE '▫️' END || ' <strong>' || " + esc("subject")
    + " || '</strong> (' || " + esc("lane") + " || '): ' || " + esc("summary")
    + " || CASE WHEN relevance <> '' THEN ' — <em>' || " + esc("relevance") + " || '</em>' ELSE '' END || ' <a href=\"' || "
    + esc("source_url") + " || '\">' || " + esc("CASE WHEN source_name = '' THEN 'source' ELSE source_name END") + " || '</a></li>'")
define("marked", "signals", """
  SELECT *, batch > min(batch) OVER (PARTITION BY id) AS is_repeat FROM signals""")
define("ranked_fresh", "marked", """
  SELECT *, CAST(row_number() OVER (PARTITION BY batch ORDER BY rank, topic_label, payload_seq, pos) AS INTEGER) AS item_no
  FROM marked WHERE NOT is_repeat""")
oracle("sig2_section", "ranked_fresh failures", f"""
SELECT c.batch, '<h2>🔎 Weekly Web Sweep</h2>' || chr(10) || coalesce(list || chr(10), '') || '<p><em>' || {esc(
    "'act_now ' || a || ' · notable ' || b || ' · info ' || i || ' · batch ' || left(c.batch, 8) "
    "|| CASE WHEN n_more > 0 THEN ' · +' || n_more || ' more in history' ELSE '' END "
    "|| CASE WHEN n_rep > 0 THEN ' · ' || n_rep || ' repeat(s) from prior weeks suppressed' ELSE '' END "
    "|| CASE WHEN n_err > 0 THEN ' · ' || n_err || ' lane(s) failed' ELSE '' END")} || '</em></p>' AS html, n_more
FROM (SELECT batch, count(*) FILTER (WHERE severity = 'act_now' AND NOT is_repeat) AS a,
        count(*) FILTER (WHERE severity = 'notable' AND NOT is_repeat) AS b, count(*) FILTER (WHERE severity = 'info' AND NOT is_repeat) AS i,
        count(*) FILTER (WHERE is_repeat) AS n_rep, greatest(count(*) FILTER (WHERE NOT is_repeat) - 14, 0) AS n_more FROM marked GROUP BY batch) c
LEFT JOIN groups g ON g.batch = c.batch
LEFT JOIN (SELECT batch, count(*) AS n_err FROM failures WHERE n_failed > 0 GROUP BY batch) e ON e.batch = c.batch""",
       islands="""
  SELECT *, sum(s) OVER (PARTITION BY batch ORDER BY item_no) AS island FROM (
    SELECT *, CASE WHEN topic_label IS DISTINCT FROM lag(topic_label) OVER (PARTITION BY batch ORDER BY item_no) THEN 1 ELSE 0 END AS s
    FROM ranked_fresh WHERE item_no <= 14)""",
       groups=f"""
  SELECT batch, string_agg(block, chr(10) ORDER BY island) AS list FROM (
    SELECT batch, island, '<h3>' || {esc('any_value(topic_label)')} || '</h3>' || chr(10) || '<ul>' || chr(10)
      || string_agg({_ITEM}, chr(10) ORDER BY item_no) || chr(10) || '</ul>' AS block FROM islands GROUP BY batch, island)
  GROUP BY batch""")
oracle("sig3_sweep_due", "", """
SELECT c_custkey, CASE WHEN c_custkey % 50 = 7 THEN true WHEN c_custkey % 25 = 0 OR c_custkey % 31 = 0 THEN true
  WHEN c_custkey % 12 = 0 THEN false WHEN c_custkey % 3 = 1 THEN true ELSE c_custkey % 12 >= 8 END AS due FROM customer""")
oracle("txt9_lane_prompts", "", """
SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_partkey % 3 <> 0 THEN p_brand ELSE '' END || chr(10) || 'On 2024-03-01, look into '
  || p_partkey || ': ' || p_type || chr(10) || 'Report about ' || CASE WHEN p_partkey % 5 <> 0 THEN p_size ELSE 5 END || ' findings.'
  || CASE WHEN p_partkey % 2 = 0 THEN chr(10) || chr(10) || p_name ELSE '' END AS prompt FROM part""")

# ---------------------------------------------------------------- documents
_TAGS = r"(?is)<script[^>]*>.*?</script\s*>|<style[^>]*>.*?</style\s*>|<!--.*?-->|<!?/?[a-z][^>]*>"


def nodes(x: str) -> str:
    decoded = "n"
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        decoded = f"regexp_replace({decoded}, '&{name};?', '{char}', 'g')"
    return (f"list_filter(list_transform(string_split_regex({x}, '{_TAGS}'), lambda n: {strip(decoded)}), lambda n: n <> '')")


oracle("txt1_page_text", "", f"""
SELECT page_id, {strip(rf"regexp_replace(array_to_string({nodes('html')}, chr(10)), '\n{{3,}}', chr(10) || chr(10), 'g')")} AS text FROM pages""")
oracle("txt2_reasoning", "", f"""
SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN regexp_replace(text, '^\\s+', '') || 'tail'
  ELSE regexp_replace(text, '^\\s+', '') || ' <think>open' END AS text FROM conversations""")
oracle("txt4_page_topics", "", f"""
SELECT page_id, CAST(unnest(range(0, len(t))) AS INTEGER) AS pos, unnest(t) AS topic FROM (
  SELECT page_id, list_filter(list_transform(regexp_extract_all(html, '(?is)<a\\b[^>]*href[^>]*>(.*?)</a\\s*>', 1),
    lambda a: array_to_string({nodes('a')}, '')), lambda x: length(x) > 10)[1:5] AS t FROM pages)""")
_L = "list_transform(string_split(text, chr(10)), lambda l: " + strip("l") + ")"
oracle("top3_lead_topics", "", f"""
SELECT doc_id, CAST(unnest(range(0, len(t))) AS INTEGER) AS pos, unnest(t) AS topic FROM (
  SELECT doc_id, CASE WHEN doc_id % 4 <> 2
    THEN list_filter(list_transform(l, lambda x, i: CASE WHEN (i - 1) % 3 < 2 THEN x END), lambda x: x IS NOT NULL)[1:5]
    ELSE list_filter(list_transform(l, lambda x, i: CASE WHEN (i - 1) % 3 = 0 THEN x END), lambda x: length(x) > 10)[1:5] END AS t
  FROM (SELECT doc_id, {_L} AS l FROM documents))""")
oracle("txt4_sibling_lists", "", f"""
SELECT doc_id, CAST(unnest(range(0, len(t))) AS INTEGER) AS pos, unnest(t) AS topic FROM (
  SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN list_concat(l[1:1], l)[1:5] ELSE list_filter(l, lambda x: length(x) > 10)[1:5] END AS t
  FROM (SELECT doc_id, {_L} AS l FROM documents))""")
_SCRIPT_LINE = """CASE WHEN i % 5 = 1 THEN 'Alex: ' || l WHEN i % 5 = 3 THEN '  SAM :' || l WHEN i % 5 = 4 AND i % 2 = 0 THEN 'sam: ' || l
  WHEN i % 7 = 5 THEN 'Alex:' ELSE l END"""
_SCRIPT_LINES = (
    f"SELECT doc_id, i, {strip(_SCRIPT_LINE)} AS line FROM (SELECT doc_id, unnest(range(0, len(p))) AS i, unnest(p) AS l "
    "FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents))")
oracle("txt5_script_segments", "", "SELECT doc_id, CAST(seg - 1 AS INTEGER) AS seg_idx, speaker, dialogue FROM segs",
       segs=_segmented(_SCRIPT_LINES, "doc_id", "i"))
oracle("txt5_script_errors", "", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM segs)",
       segs=_segmented(_SCRIPT_LINES, "doc_id", "i"))
oracle("txt6_length_budget", "", """
SELECT doc_id, md5(CASE WHEN length(text) > 4000 THEN left(text, 4000) || chr(10) || chr(10) || '[Content truncated for length]' ELSE text END) AS sample_md5,
  md5(CASE WHEN length(text) > 40000 THEN left(text, 40000) || chr(10) || chr(10) || '[Content truncated for length]' ELSE text END) AS full_md5
FROM documents""")
oracle("txt7_reply_text", "", f"""
SELECT conv_id, turn, CASE WHEN turn % 7 = 3 THEN '(no text)' ELSE {strip('text')} END AS text FROM conversations""")
oracle("txt8_parse_size", "", """
SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN p_size + 0.5 WHEN 1 THEN p_size END AS DOUBLE) AS size_b FROM part""")

# Markdown: every step as SQL; the italic step is a scan over the pieces between stars.
_MARK = """CASE i % 9 WHEN 0 THEN '## ' || l WHEN 1 THEN '- **bold** ' || l WHEN 2 THEN '- [link](https://example.com/x) ' || l WHEN 3 THEN ''
    WHEN 4 THEN '  - ' || l WHEN 5 THEN '<li>' || l || '</li>' WHEN 6 THEN '# ' || l WHEN 7 THEN '---' ELSE l END"""
define("md_raw", "", f"""
  SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN '```html' || chr(10) || '<h1>Digest</h1>' || chr(10) || b || chr(10) || '```'
    WHEN 1 THEN '```html' || chr(10) || b || chr(10) || '```' || chr(10) ELSE b END AS c
  FROM (SELECT doc_id, array_to_string(list_transform(string_split(text, chr(10)), lambda l, n: {_MARK.replace('i % 9', '(n - 1) % 9')}), chr(10)) AS b
        FROM documents)""")
define("md_clean", "md_raw", f"""
  SELECT doc_id, {strip(r"regexp_replace(regexp_replace(c, '(?m)^```html\s*\n?', '', 'g'), '(?m)\n?```\s*$', '', 'g')")} AS c FROM md_raw""")
_BOLD = r"regexp_replace({x}, '\*\*(.+?)\*\*', '<strong>\1</strong>', 'g')"
_LINK = r"""regexp_replace({x}, '\[([^\]]+)\]\(([^)]+)\)', '<a href="\2">\1</a>', 'g')"""
define("md_bold", "md_clean", f"""
  SELECT doc_id, {_BOLD.format(x=r"regexp_replace(regexp_replace(regexp_replace(c, '(?m)^### (.+)$', '<h3>\1</h3>', 'g'), '(?m)^## (.+)$', '<h2>\1</h2>', 'g'), '(?m)^# (.+)$', '<h1>\1</h1>', 'g')")} AS c
  FROM md_clean WHERE NOT starts_with(c, '<h1>')""")
define("md_stars", "md_bold", """
  SELECT doc_id, p, [{'m': false, 'p': p[1]}] || list_transform(p[2:], lambda x, k: {'m': k < len(p) - 1 AND x <> ''
      AND right(p[k], 1) NOT IN (':', '/') AND left(coalesce(p[k + 2], ''), 1) <> '/', 'p': x}) AS q
  FROM (SELECT doc_id, string_split(c, '*') AS p FROM md_bold)""")
define("md_inline", "md_stars", f"""
  SELECT doc_id, regexp_replace({_LINK.format(x='''list_reduce(q, lambda a, x: {'m': NOT a.m AND x.m, 'p': a.p || CASE WHEN a.m THEN '</em>' WHEN x.m THEN '<em>' ELSE '*' END || x.p}).p''')},
    '(?m)^---+$', '<hr>', 'g') AS c FROM md_stars""")
define("md_lines", "md_inline", f"""
  SELECT *, starts_with(s, '- ') OR starts_with(s, '* ') AS bullet
  FROM (SELECT doc_id, i, l, {strip('l')} AS s FROM (
    SELECT doc_id, unnest(range(0, len(p))) AS i, unnest(p) AS l FROM (SELECT doc_id, string_split(c, chr(10)) AS p FROM md_inline)))""")
define("md_states", "md_lines", """
  SELECT *, coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i), 0) = 1 AS now_in,
    coalesce(last_value(mark IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 1 AS was_in
  FROM (SELECT *, CASE WHEN bullet THEN 1 WHEN s <> '' AND NOT starts_with(s, '<li') THEN 0 END AS mark FROM md_lines)""")
oracle("txt3_markdown", "md_states md_clean", f"""
SELECT doc_id, {_LINK.format(x=_BOLD.format(x='c'))} AS html FROM md_clean WHERE starts_with(c, '<h1>')
UNION ALL
SELECT doc_id, string_agg(CASE WHEN bullet AND NOT was_in THEN '<ul>' || chr(10) WHEN mark = 0 AND was_in THEN '</ul>' || chr(10) ELSE '' END
    || CASE WHEN bullet THEN '<li>' || substr(s, 3) || '</li>' WHEN s = '' OR starts_with(s, '<') OR ends_with(s, '>') THEN l
       ELSE '<p>' || s || '</p>' END, chr(10) ORDER BY i)
    || CASE WHEN arg_max(now_in, i) THEN chr(10) || '</ul>' ELSE '' END
FROM md_states GROUP BY doc_id""")

# ---------------------------------------------------------------- voices
_D = "md5(strftime(o_orderdate, '%Y-%m-%d') || '-' || o_orderpriority)"


def modulo(digest: str, n: int) -> str:
    """Remainder of a hex digest, one digit at a time."""
    return (f"list_reduce(list_transform(string_split({digest}, ''), lambda h: CAST(strpos('0123456789abcdef', h) - 1 AS BIGINT)), "
            f"lambda a, d: (a * 16 + d) % {n}, CAST(0 AS BIGINT))")


def pool(name: str, part: int) -> str:
    return "[" + ", ".join(f"'{v[part]}'" for v in VOICE_POOLS[name]) + "]"


oracle("hsh1_daily_voice", "", f"""
SELECT o_orderkey, {modulo(_D, 7)} AS idx7, {pool('elevenlabs_male', 0)}[{modulo(_D, 8)} + 1] AS name FROM orders""")
oracle("hsh2_pinned_voices", "", f"""
SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'pin-a' ELSE {pool('edge_male', 1)}[{modulo("md5('day-' || c_custkey || '-Alex')", 5)} + 1] END AS alex,
  CASE WHEN c_custkey % 6 = 0 THEN 'pin-s' ELSE {pool('edge_female', 1)}[{modulo("md5('day-' || c_custkey || '-Sam')", 3)} + 1] END AS sam FROM customer""")

# ---------------------------------------------------------------- streaming
oracle("str1_ingest", "items", "SELECT source, title, link, feed_pos FROM items")
oracle("str2_recent", "articles", """
SELECT article_key, source, published, feed_pos, feed_pos % 3 AS run FROM articles
WHERE published IS NULL OR published >= TIMESTAMP '2024-01-29 00:00:00'""")
oracle("str3_exact_dedup", "articles", "SELECT article_key, min(feed_pos % 3) AS run FROM articles GROUP BY article_key")
oracle("str4_bounded_dedup", "", f"SELECT DISTINCT {key('event_type', 'CAST(user_id AS VARCHAR)')} AS article_key FROM events")
oracle("str5_thread_state", "articles", """
SELECT link AS url, title, source AS subreddit, feed_pos % 3 AS run FROM articles WHERE source IN ('src3', 'src7')
QUALIFY row_number() OVER (PARTITION BY link ORDER BY feed_pos % 3, feed_ord DESC, feed_pos DESC) = 1""")
oracle("str6_signal_state", "signals", """
SELECT id, batch, date, lane, severity FROM (
  SELECT * FROM signals QUALIFY row_number() OVER (PARTITION BY id ORDER BY
    CASE WHEN batch < '2024-01-15' THEN 0 WHEN batch < '2024-01-29' THEN 1 ELSE 2 END DESC, payload_seq DESC, pos DESC) = 1)
WHERE date >= '2024-01-16'""")
oracle("str5_keyed_threads", "", """
SELECT link AS url, title, source AS subreddit, strftime(DATE '2024-01-30' + CAST(d AS INTEGER), '%Y-%m-%d') AS day
FROM landed JOIN stays USING (link, d) QUALIFY row_number() OVER (PARTITION BY link, d ORDER BY feed_ord DESC, feed_pos DESC) = 1""",
       items=CTE["items"], articles=CTE["articles"],
       landed="""
  SELECT * FROM (SELECT *, i, [0, 3, 8][i + 1] AS d FROM articles, (SELECT unnest([0, 1, 2]) AS i) WHERE source IN ('src3', 'src7'))
  WHERE (bit_count(feed_pos) + i * (feed_pos % 5)) % 3 <> 1""",
       first_stays="SELECT link, min(d) AS d FROM landed GROUP BY link",
       later_stays="SELECT link, min(l.d) AS d FROM landed l JOIN first_stays f USING (link) WHERE l.d - f.d >= 7 GROUP BY link",
       stays="SELECT * FROM first_stays UNION ALL SELECT * FROM later_stays")
oracle("str6_keyed_signals", "signals", """
SELECT id, batch, lane, severity, coalesce(date_diff('day', CAST(lag(batch) OVER (PARTITION BY id ORDER BY batch) AS DATE), CAST(batch AS DATE)) <= 45, false) AS is_repeat
FROM (SELECT * FROM signals QUALIFY row_number() OVER (PARTITION BY id, batch ORDER BY payload_seq DESC, pos DESC) = 1)""")
oracle("str7_silent_sources", "", """
SELECT day, source FROM (
  SELECT strftime(unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)), '%Y-%m-%d') AS day FROM events),
  (SELECT unnest(['click', 'view', 'silent']) AS source)
EXCEPT SELECT strftime(ts, '%Y-%m-%d'), event_type FROM events""")
oracle("str7_closed_days", "", """
SELECT day, source, CAST(sum(n) AS BIGINT) AS n_rows, CASE WHEN sum(n) = 0 THEN 'no articles' END AS alert FROM (
  SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS source, 1 AS n FROM kept
  UNION ALL SELECT strftime(d, '%Y-%m-%d'), source, 0
  FROM (SELECT unnest(generate_series(date_trunc('day', min(ts)), date_trunc('day', max(ts)), INTERVAL 1 DAY)) AS d FROM kept), (SELECT unnest(['click', 'view', 'silent']) AS source))
WHERE CAST(day AS DATE) + INTERVAL 2 DAY <= (SELECT max(ts) FROM kept) GROUP BY ALL""",
       kept="""
  SELECT * FROM events WHERE day(ts) <> 9 AND NOT (event_type = 'click' AND day(ts) BETWEEN 14 AND 15)""")
oracle("str7_daily_counts", "", """
SELECT strftime(ts, '%Y-%m-%d') AS day, event_type AS source, count(*) AS n_rows FROM events
WHERE date_trunc('day', ts) + INTERVAL 2 DAY <= (SELECT max(ts) FROM events) GROUP BY ALL""")
oracle("win5_list_state", "md_states md_clean", """
SELECT doc_id, CAST(i AS INTEGER) AS line_no, now_in AS in_list, md5(l) AS line_md5 FROM md_states""")
