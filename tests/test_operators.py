"""Operator contracts on small inputs with hand-derived results, one test per trap."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from broadsheet import schemas
from broadsheet.functions.text import content_key
from broadsheet.operators import articles as A
from broadsheet.operators import catalogs as C
from broadsheet.operators import curation as U
from broadsheet.operators import digest as D
from broadsheet.operators import scripts as P
from broadsheet.operators import signals as G
from broadsheet.operators import state as S
from broadsheet.operators import triage as R
from broadsheet.plans import ordered, skew
from broadsheet.sources import scans
from broadsheet.sources.registry import FEEDS, feed_table, literal_table

AS_OF = "2024-01-30 00:00:00"
NOW = dt.datetime(2024, 1, 30)


def ago(**kw):
    return NOW - dt.timedelta(**kw)


def articles(spark, rows):
    """Rows of (title, link, source, published, feed_pos)."""
    full = [(t, l, "", s, p, 0, i) for t, l, s, p, i in rows]
    return A.with_article_key(spark.createDataFrame(full, schemas.ARTICLE))


def test_topk_takes_2k_then_recency_then_k(spark):
    rows = [(f"t{i}", f"l{i}", "a", ago(days=9) if i < 3 else ago(hours=1), i) for i in range(6)]
    rows += [("u0", "m", "b", None, 0), ("u1", "m", "b", ago(days=1), 1), ("u2", "m", "b", ago(days=1, seconds=1), 2)]
    got = sorted((r["source"], r["feed_pos"]) for r in A.top_per_source(articles(spark, rows), AS_OF, 2).collect())
    # a: only positions 0-3 are looked at; b: undated and boundary rows stay.
    assert got == [("a", 3), ("b", 0), ("b", 1)]


def test_field_defaults(spark):
    items = spark.createDataFrame(
        [(None, None, None, "d" * 600, None, "2024-01-29T00:00:00Z", "s", 0, 1), ("t", "l", "", "x", "soon", None, "s", 0, 2)],
        "title STRING, link STRING, summary STRING, description STRING, published STRING, updated STRING, source STRING, feed_ord INT, feed_pos BIGINT")
    a, b = sorted(A.items_to_articles(items).collect(), key=lambda r: r["feed_pos"])
    assert (a["title"], a["link"], len(a["summary"]), a["published"]) == ("No title", "", 500, dt.datetime(2024, 1, 29))
    assert (b["summary"], b["published"]) == ("", None)


def test_anti_and_semi_cover_the_input_and_keep_duplicates(spark):
    rng = random.Random(1)
    rows = [(f"t{0 if rng.random() < .4 else rng.randint(0, 9)}", "l", "s", None, i) for i in range(200)]
    df = articles(spark, rows)
    sent = df.filter(F.col("title").isin("t0", "t3", "t4")).select("article_key").distinct()
    new, old = A.not_sent(df, sent), A.already_sent(df, sent)
    assert sorted(r["feed_pos"] for r in new.collect() + old.collect()) == list(range(200))
    assert {r["title"] for r in old.collect()} <= {"t0", "t3", "t4"}
    assert not {r["title"] for r in new.collect()} & {"t0", "t3", "t4"}
    marked = skew.mark_members(df, sent, "article_key", "hit")
    assert sorted(r["feed_pos"] for r in marked.filter("hit").collect()) == sorted(r["feed_pos"] for r in old.collect())


def test_mark_sent_last_wins_over_batch_and_history(spark):
    batch = articles(spark, [("T", "l", "s1", None, 1), (" t", "L ", "s2", None, 2), ("n", "l", "s1", None, 3)])
    key = batch.first()["article_key"]
    history = spark.createDataFrame([(key, "old", "l", "s0", ago(days=3)), ("k", "x", "y", "z", ago(days=6))], schemas.SENT)
    got = {r["article_key"]: (r["source"], r["sent_at"]) for r in S.mark_sent(history, batch, AS_OF).collect()}
    assert got[key] == ("s2", NOW) and got["k"] == ("z", ago(days=6)) and len(got) == 3


def test_retention_is_strict_and_drops_missing(spark):
    sent = spark.createDataFrame(
        [("a", "", "", "", ago(days=7)), ("b", "", "", "", ago(days=6, hours=23)), ("c", "", "", "", None)], schemas.SENT)
    assert [r["article_key"] for r in S.retained(sent, "sent_at", AS_OF).collect()] == ["b"]


def test_threads_duplicates_take_places_last_wins_cached_stay(spark):
    u = "https://www.reddit.com/r/x/"
    rows = [("a", u + "1", "s", None, 1), ("b", u + "1", "s", ago(hours=1), 2), ("c", u + "2", "s", None, 3),
            ("d", u + "3", "s", None, 4), ("e", "https://other", "s", None, 5), ("f", u + "0", "s", None, 0)]
    old = S.build_threads(articles(spark, [("old", u + "0", "s", None, 0)]), "2024-01-29 00:00:00")
    got = {r["url"]: r for r in S.add_threads(old, articles(spark, rows), AS_OF, n=3).collect()}
    assert {k[-1]: v["title"] for k, v in got.items()} == {"0": "old", "1": "b", "2": "c"}
    assert got[u + "1"]["created_utc"] == (ago(hours=1) - dt.datetime(1970, 1, 1)).total_seconds()
    assert (got[u + "2"]["subreddit"], got[u + "2"]["created_utc"], got[u + "0"]["fetched_at"]) == ("x", 0.0, ago(days=1))


def test_selftext_trailer(spark):
    df = spark.createDataFrame([("<p>Hello <b>you</b></p> submitted by <a>/u/me</a> [link] [comments]",), (None,)], "s STRING")
    assert [r[0] for r in df.select(S.selftext(F.col("s"))).collect()] == ["Hello you", ""]


def payloads(spark, rows, batch="b"):
    return spark.createDataFrame(
        [(batch, lane, i, "2024-01-30", p if isinstance(p, str) else json.dumps(p)) for i, (lane, p) in enumerate(rows)],
        "batch STRING, lane STRING, payload_seq BIGINT, date STRING, payload STRING")


def signal(**kw):
    return {"subject": "S", "summary": "x", "source_url": "https://e/1", "signal_type": "t", "severity": "act_now", **kw}


def lanes(spark):
    return literal_table(spark, [("a", "top", "Label", "", "", 5, None)], schemas.LANE)


def test_normalize_signals(spark):
    rows = [
        ("a", {"signals": [
            signal(summary=" "), signal(subject="s", severity="loud", metrics=[1], observed_at="last week!"),
            signal(), 7, None, "x", signal(subject=5), signal(source_url="ftp://e"),
            signal(subject=" U ", signal_type="", source_url=" HTTPS://E ", observed_at="2024-1", metrics={"k": 1.5}, entity=3)]}),
        ("b", {"signals": [signal()]}), ("a", {"signals": None}), ("a", {"signals": {"k": signal()}}), ("a", [signal()]), ("a", "{bad"), ("a", {}),
    ]
    got = sorted(G.normalize_signals(payloads(spark, rows), lanes(spark)).collect(), key=lambda r: r["seq"])
    assert [(r["lane"], r["subject"], r["signal_type"], r["severity"], r["metrics"], r["observed_at"]) for r in got] == [
        ("a", "s", "t", "info", "{}", "last week!"), ("a", "U", "observation", "act_now", '{"k":1.5}', ""), ("b", "S", "t", "act_now", "{}", "")]
    assert [r["topic_label"] for r in got] == ["Label", "Label", "Web Sweep"] and got[1]["entity"] == ""
    funnel = {r["lane"]: r.asDict() for r in G.funnel(payloads(spark, rows)).collect()}
    assert (funnel["a"]["n_raw"], funnel["a"]["n_kept"], funnel["a"]["n_failed"]) == (10, 2, 2)

    # One parse gives the same signals and the same counts.
    signals, counts = G.sweep(payloads(spark, rows), lanes(spark))
    assert sorted(signals.collect(), key=lambda r: r["seq"]) == got and signals.columns == G.normalize_signals(payloads(spark, rows), lanes(spark)).columns
    assert {r["lane"]: r.asDict() for r in counts.collect()} == funnel
    assert "parse_json" not in signals._jdf.queryExecution().executedPlan().toString() + counts._jdf.queryExecution().executedPlan().toString()


def test_signal_id_equals_article_key(spark):
    s = G.normalize_signals(payloads(spark, [("a", {"signals": [signal()]})]), lanes(spark)).first()
    assert s["id"] == spark.range(1).select(content_key(F.lit(" s"), F.lit("HTTPS://e/1"))).first()[0]


def flat(spark, rows):
    """Signals of (batch, pos, severity, label, id, date)."""
    base = {c: "" for c in schemas.SIGNAL.fieldNames()}
    data = [{**base, "batch": b, "severity": sev, "topic_label": label, "id": i, "date": d, "subject": i, "lane": "l&", "summary": "<s>",
             "seq": (0, p)} for b, p, sev, label, i, d in rows]
    return spark.createDataFrame([tuple(d[c] for c in schemas.SIGNAL.fieldNames()) for d in data], schemas.SIGNAL)


def test_islands_recur_across_severities(spark):
    rows = [("b", 1, "info", "A", "1", ""), ("b", 2, "act_now", "B", "2", ""), ("b", 3, "act_now", "A", "3", ""), ("b", 4, "notable", "B", "4", ""), ("b", 5, "info", "A", "5", "")]
    got = G.label_islands(G.ranked(flat(spark, rows))).orderBy("item_no").collect()
    assert [(r["id"], r["island"]) for r in got] == [("3", 1), ("2", 2), ("4", 2), ("1", 3), ("5", 3)]


def test_section_counts_cover_all_and_repeats_alone_still_render(spark):
    rows = [("b", i, "info", "A", str(i), "") for i in range(16)]
    none = flat(spark, []).select("batch")
    only = spark.createDataFrame([("c",), ("c",)], "batch STRING")
    got = {r["batch"]: r["html"] for r in G.render_sections(flat(spark, rows), only, none).collect()}
    assert got["b"].count("<li>") == 14 and got["b"].count("<h3>") == 1
    assert got["b"].endswith("<p><em>act_now 0 · notable 0 · info 16 · batch b · +2 more in history</em></p>")
    assert "(l&amp;): &lt;s&gt;" in got["b"] and '">source</a>' in got["b"]
    assert got["c"] == ("<h2>🔎 Weekly Web Sweep</h2>\n<p><em>act_now 0 · notable 0 · info 0 · batch c · "
                        "2 repeat(s) from prior weeks suppressed</em></p>")


def test_signal_merge_is_last_wins_inclusive_and_idempotent(spark):
    history = flat(spark, [("o", 0, "info", "A", "x", "2024-01-01"), ("o", 1, "info", "A", "y", "2023-12-16"), ("o", 2, "info", "A", "z", "2023-12-15"), ("o", 3, "info", "A", "", "2024-01-29")])
    batch = flat(spark, [("n", 0, "notable", "B", "z", "2024-01-30"), ("n", 1, "info", "A", "", "2024-01-30"), ("n", 2, "act_now", "A", "z", "2024-01-30")])
    once = S.merge_signals(history, batch, AS_OF)
    got = [(r["id"], r["severity"]) for r in once.orderBy("first_seen").collect()]
    assert got == [("x", "info"), ("y", "info"), ("z", "act_now")]
    twice = S.merge_signals(once.drop("first_seen"), batch, AS_OF)
    assert sorted(map(str, twice.drop("first_seen").collect())) == sorted(map(str, once.drop("first_seen").collect()))


def test_sweep_due_decisions(spark):
    rows = [("2024-01-30", "tuesday", True), ("2024-01-30", "tuesday", False), (None, "monday", False), ("junk", "monday", False),
            ("2024-01-29", " TUESDAY ", False), ("2024-01-22", "monday", False), ("2024-01-23", "monday", False), ("2024-02-20", "monday", False)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, last STRING, day STRING, force BOOLEAN")
    got = df.select("i", G.sweep_due(F.col("last"), AS_OF, F.col("day"), F.col("force")).alias("due")).orderBy("i").collect()
    assert [r["due"] for r in got] == [True, False, True, True, True, True, False, False]


def test_audio_and_log_retention(spark):
    names = ["digest-2024-01-20.mp3", "digest-2024-01-21.mp3", "digest-2024-01-30.mp3", "digest-x.mp3", "other-2020-01-01.mp3", "digest-2024-1-2.mp3"]
    files = spark.createDataFrame([(n,) for n in names], "name STRING")
    got = {r["name"]: r["status"] for r in S.expired_audio(files, "2024-01-30 09:00:00").collect()}
    assert got == {names[0]: "expired", names[1]: "kept", names[3]: "unreadable", names[5]: "expired"}
    logs = spark.createDataFrame([("d.log", ago(days=99)), ("d.log.1", ago(days=31)), ("d.log.2", ago(days=30)), ("e.log.1", ago(days=99))], "name STRING, modified TIMESTAMP_NTZ")
    assert [r["name"] for r in S.expired_logs(logs, "d.log", AS_OF, 30).collect()] == ["d.log.1"]
    assert S.expired_logs(logs, "d.log", AS_OF, 0).count() == 0


def test_scripts(spark):
    text = "lost\nAlex: hi\n\n  more \nAlex:\nsam : yo\nSAM: again\nBob: no"
    df = spark.createDataFrame([(1, text), (2, "nothing\nAlex:")], "doc_id BIGINT, script STRING")
    segments, errors = P.parse_scripts(df, "doc_id")
    assert [(r["speaker"], r["dialogue"]) for r in segments.orderBy("seg_idx").collect()] == [
        ("Alex", "hi more Alex:"), ("Sam", "yo"), ("Sam", "again Bob: no")]
    assert [r["doc_id"] for r in errors.collect()] == [2]


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_transcript_rows_equal_script_text(spark, chunk):
    rng = random.Random(5)
    lines = [rng.choice(["Alex: a b", "Sam: c", "more", "", " Alex:", "x\nSam: y\nz"]) for _ in range(40)]
    turns = spark.createDataFrame([(1, i, line) for i, line in enumerate(lines)], "doc_id BIGINT, turn BIGINT, line STRING")
    script = spark.createDataFrame([(1, "\n".join(lines))], "doc_id BIGINT, script STRING")
    want = [(r["speaker"], r["dialogue"]) for r in P.parse_scripts(script, "doc_id")[0].orderBy("seg_idx").collect()]
    got = P.transcript_segments(turns, "doc_id", "turn", "line", chunk=chunk).orderBy("seg_no").collect()
    assert [(r["speaker"], r["dialogue"]) for r in got] == want


@pytest.mark.parametrize("chunk", [1, 2, 100])
def test_timeline(spark, chunk):
    rows = [("e", 0, "Alex", 1000), ("e", 1, "Alex", 500), ("e", 2, "Sam", 200), ("e", 3, "Alex", 100), ("f", 0, "Sam", 50)]
    df = spark.createDataFrame(rows, "episode STRING, idx BIGINT, speaker STRING, dur_ms BIGINT")
    timed = P.timeline(df, intro_ms=5000, chunk=chunk)
    got = [(r["episode"], r["start_ms"], r["end_ms"], r["pause_ms"]) for r in timed.orderBy("episode", "idx").collect()]
    assert got == [("e", 4000, 5000, 0), ("e", 5000, 5500, 0), ("e", 5800, 6000, 300), ("e", 6300, 6400, 300), ("f", 4000, 4050, 0)]
    total = {r["episode"]: r["total_ms"] for r in P.episode_length(timed, intro_ms=5000, outro_ms=3000).collect()}
    assert total == {"e": 1800 + 600 + 6000, "f": 6050}


def test_voice_pins_need_both(spark):
    df = spark.createDataFrame([("p", "q"), ("p", ""), (None, "q")], "a STRING, s STRING")
    v = P.host_voices(F.lit("2024-01-30"), "edge_male", "edge_female", F.col("a"), F.col("s"))
    got = [r[0] for r in df.select(v["alex"]).collect()]
    assert got[0] == "p" and got[1] == got[2] != "p"


def test_latest_per_family(spark):
    rows = [("m-a-1", None), ("m-A-2", NOW), ("m-a-3", NOW), ("m-a-9", None), ("m-b-1", None), ("m-b-2", None), (None, NOW)]
    df = spark.createDataFrame(rows, "id STRING, created TIMESTAMP_NTZ")
    got = {r["family"]: r["id"] for r in C.latest_per_family(df, ["a", "B", "c"]).collect()}
    assert got == {"a": "m-a-3", "B": "m-b-2", "c": None}


def test_nearest_bucket_ties_go_down(spark):
    df = spark.createDataFrame([(x,) for x in ("m:11b", "m:22b", "m:23b", "m", "m:400b", "m:1.5b")], "n STRING")
    assert [r[0] for r in df.select(C.timeout_for(F.col("n"))).collect()] == [600, 900, 1200, 600, 1200, 600]


def test_error_triage(spark):
    rows = [
        (200, '{"error":{"type":"Overloaded_Error"}}', "", "overloaded", True), (429, None, "", "rate limit exceeded", True),
        (401, "{}", "", "authentication failed", False), (400, "[]", "Credit low", "credits exhausted", False),
        (400, '{"type":"error"}', "model x not_found", "request error", False), (None, '{"type":"rate_limit_error"}', "", "rate limited", True),
        (418, '{"error":"x","type":"teapot"}', "was RATE_LIMITed", "api error", True), (529, "{bad", "", "overloaded", True),
    ]
    df = spark.createDataFrame([(i, s, b, m) for i, (s, b, m, *_) in enumerate(rows)], "i INT, status_code INT, body STRING, message STRING")
    got = R.classify(df).orderBy("i").collect()
    assert [(r["label"], r["transient"]) for r in got] == [r[3:] for r in rows]
    assert [r["i"] for r in got if r["model_missing"]] == [4] and [r["i"] for r in got if r["suggest_action"]] == [3, 6]


def test_alerts(spark):
    df = spark.createDataFrame([("a", 0, 1, 1, 1), ("b", 1, 0, 0, 0), ("c", 1, 1, 2, 0), ("d", 1, 1, 0, 0)], "run STRING, n_new INT, n_threads INT, n_to_build INT, n_built INT")
    assert sorted(map(tuple, R.alerts(df).collect())) == [("a", "no new articles"), ("b", "no thread articles"), ("c", "no threads built")]


RULES = [U.Rule(0, "must-watch", "Acme AI"), U.Rule(1, "ai", "agent"), U.Rule(9, "finance", "bank")]


def test_tagging_whole_words_and_phrases(spark):
    df = articles(spark, [("Acme, AI: agent agents AGENT", "l1", "s", None, 1), ("acme aim", "l2", "s", None, 2), ("Bank-bank bank", "l3", "s", None, 3)])
    tagged = {r["feed_pos"]: {t["topic"]: t["n_hits"] for t in r["topics"]} for r in U.tag(df, RULES).collect()}
    assert tagged == {1: {"must-watch": 1, "ai": 2}, 2: {}, 3: {"finance": 3}}
    rules = spark.createDataFrame([(r.tier, r.topic, r.term) for r in RULES], "tier INT, topic STRING, term STRING")
    joined = U.match_rules(df.withColumn("row_id", F.col("feed_pos")), rules).collect()
    assert sorted((r["row_id"], r["topic"], r["n_hits"]) for r in joined) == [(1, "ai", 2), (1, "must-watch", 1), (3, "finance", 3)]


def test_exclusion_spares_must_watch(spark):
    df = articles(spark, [("acme ai gossip", "1", "s", None, 1), ("agent gossip", "2", "s", None, 2), ("bank hype agent", "3", "s", None, 3)])
    kept = U.tag(U.exclude(df, ["gossip"], RULES), RULES, {"finance": ["hype"]})
    assert {r["feed_pos"]: [t["topic"] for t in r["topics"]] for r in kept.collect()} == {1: ["must-watch"], 3: ["ai"]}


def test_quotas_thin_sections_and_additional_must_watch(spark):
    rows = [(f"bank {'bank ' * i}", f"l{i}", "s", None, i) for i in range(9)] + [("agent", "x", "s", None, 50)] + [(f"acme ai {i}", f"m{i}", "s", None, 60 + i) for i in range(8)]
    routed = U.route(U.score(U.tag(articles(spark, rows), RULES))).withColumn("d", F.lit(1))
    got = {}
    for r in U.apply_quotas(routed, ["d"]).collect():
        got.setdefault(r["section"], []).append(r["feed_pos"])
    assert sorted(got["finance"]) == [3, 4, 5, 6, 7, 8] and "ai" not in got and len(got["top"]) == 8
    few = U.apply_quotas(routed, ["d"], total=2).collect()
    assert sorted(r["feed_pos"] for r in few if not r["must_watch"]) == [7, 8] and sum(r["must_watch"] for r in few) == 8


def test_same_story_keeps_the_best(spark):
    df = articles(spark, [("Big AGENT news!", "1", "a", ago(hours=5), 1), ("news: agent, big", "2", "b", ago(hours=1), 2), ("other", "3", "a", None, 3)])
    got = U.best_per_story(U.score(U.tag(df, RULES))).collect()
    assert sorted(r["feed_pos"] for r in got) == [2, 3]


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_chunked_running_totals_match_brute_force(spark, chunk):
    rng = random.Random(chunk)
    rows = [(g, i, rng.randint(0, 9)) for g in "ab" for i in rng.sample(range(100), 30)]
    df = spark.createDataFrame(rows, "g STRING, i BIGINT, v BIGINT")
    got = {(r["g"], r["i"]): r["t"] for r in ordered.running_totals(df, ["g"], "i", {"t": F.col("v")}, chunk=chunk).collect()}
    assert got == {(g, i): sum(w for h, j, w in rows if h == g and j <= i) for g, i, _ in rows}
    before = {(r["g"], r["i"]): r["p"] for r in ordered.previous_value(df, ["g"], "i", "v", "p", chunk=chunk).collect()}
    assert before == {(g, i): max(((j, w) for h, j, w in rows if h == g and j < i), default=(0, None))[1] for g, i, _ in rows}


def test_feed_registry_and_zero_counts(spark):
    assert sum(map(len, FEEDS.values())) == 52
    feeds = feed_table(spark)
    got = A.rows_per_source(feeds, articles(spark, [("t", "l", "NASA", None, 1), ("t", "l", "unknown", None, 1)]))
    counts = {r["source"]: r["n_rows"] for r in got.collect()}
    assert len(counts) == 52 and counts["NASA"] == 1 and counts["Reuters"] == 0


def test_story_scan(spark, tmp_path):
    (tmp_path / "ids.json").write_text("\n".join(json.dumps({"run": "r", "pos": p, "id": i}) for p, i in enumerate([7, 8, 9, 10, 11])))
    items = [{"id": 7, "title": "a", "url": "u", "score": 3, "descendants": 2, "time": 1704067200}, {"id": 8, "title": "b", "time": 0}, {"id": 9, "title": ""}, {"id": 10}, {"id": 11, "title": "late"}]
    (tmp_path / "items.json").write_text("\n".join(map(json.dumps, items)))
    got = scans.stories(spark, str(tmp_path / "ids.json"), str(tmp_path / "items.json"), 4).orderBy("feed_pos").collect()
    assert [(r["title"], r["link"], r["summary"], r["published"]) for r in got] == [
        ("a", "u", "Score: 3 | Comments: 2", dt.datetime(2024, 1, 1)),
        ("b", "https://news.ycombinator.com/item?id=8", "Score: 0 | Comments: 0", None)]


def test_feed_scans(spark, tmp_path):
    nasa, verge, nature = (tmp_path / f"source={n}" for n in ("NASA", "The%20Verge", "Nature%20News"))
    for d in (nasa, verge, nature):
        d.mkdir(parents=True)
    (nasa / "f.xml").write_text(
        '<rss xmlns:media="m" xmlns:atom="a"><channel><title>c</title><item><title><![CDATA[A & B]]></title><media:title>photo</media:title><link>l1</link>'
        '<atom:link href="self"/><description>d</description><media:description>x</media:description>'
        "<pubDate>Mon, 29 Jan 2024 10:00:00 +0000 (UTC)</pubDate></item><item><description>e</description></item></channel></rss>")
    (nasa / "empty.xml").write_text("<rss><channel><title>none</title></channel></rss>")
    (verge / "f.xml").write_text(
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title type="html">T</title><link rel="enclosure" href="file"/><link rel="alternate" href="l2"/>'
        '<content type="html">&lt;p&gt;body&lt;/p&gt;</content><updated>2024-01-29T12:00:00+02:00</updated></entry></feed>')
    (nature / "f.xml").write_text('<rdf:RDF xmlns:rdf="r"><channel/><item rdf:about="u"><title>N</title><link>l3</link><dc:date>2024-01-29T10:00:00Z</dc:date></item></rdf:RDF>')
    (nature / "cut.xml").write_text("<rss><channel><item><title>kept</title><link>l4</link></item><item><title>lost</ti")
    landed = scans.snapshots(spark, str(tmp_path))
    rows = scans.of_feeds(scans.feed_entries(landed), feed_table(spark))
    got = sorted((r["source"], r["title"], r["link"], r["summary"], r["published"] is not None) for r in A.items_to_articles(rows).collect())
    assert got == [
        ("NASA", "A & B", "l1", "d", True), ("NASA", "No title", "", "e", False), ("Nature News", "N", "l3", "", True),
        ("Nature News", "kept", "l4", "", False), ("The Verge", "T", "l2", "<p>body</p>", True)]
    statuses = spark.createDataFrame([("NASA", 200), ("Nature News", 200), ("The Verge", 500)], "source STRING, status INT")
    health = {r["source"]: (r["health"], r["n_rows"]) for r in A.feed_health(feed_table(spark), scans.fetch_log(landed, statuses), rows).collect()}
    assert (health["NASA"], health["Nature News"], health["The Verge"], health["Reuters"]) == (("ok", 2), ("malformed_kept", 2), ("http_error", 0), ("not_fetched", 0))


def test_feeds_as_they_come(spark, tmp_path):
    """What XML does not allow costs no item, and what is lost is counted."""
    folder = tmp_path / "source=NASA"
    folder.mkdir()
    item = lambda title, more="": f"<item><title>{title}</title><link>l</link>{more}</item>"
    files = {
        "references": "<rss><channel>" + item("a&nbsp;b") + item("AT&T &amp; Q&A; &#233;") + item("c &eacute;") + "</channel></rss>",
        "cdata": "<rss><channel>" + item("<![CDATA[code </item> tail &nbsp; <b>]]>") + item("next") + "<!-- <item><title>no</title></item> --></channel></rss>",
        "prefix": '<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:entry><a:title>P</a:title><a:link href="l"/></a:entry></a:feed>',
        "inside": "<rss><channel>" + item("open", "<p><b>x</p>") + "<item><title>no end</title><link>l</link><desc" + item("after") + "<item><b>nothing</item>" + item("last") + "<item><titl",
    }
    for name, text in files.items():
        (folder / f"{name}.xml").write_text(text, encoding="utf-8")
    (folder / "latin.xml").write_bytes(b'<?xml version="1.0" encoding="ISO-8859-1"?><rss><channel>' + item("caf\u00e9 \x93").encode("latin-1") + b"</channel></rss>")
    (folder / "undeclared.xml").write_bytes(b"<rss><channel>" + item("na\u00efve").encode("latin-1") + b"</channel></rss>")
    (folder / "bom.xml").write_bytes(b"\xef\xbb\xbf" + ("<rss><channel>" + item("漢") + "</channel></rss>").encode())
    landed = scans.snapshots(spark, str(tmp_path))
    got = {}
    for r in scans.feed_entries(landed).orderBy("feed_pos").collect():
        assert r["link"] == "l"
        got.setdefault(r["landed"].rsplit("/", 1)[1][:-4], []).append(r["title"])
    assert got == {
        "references": ["a\xa0b", "AT&T & Q&A; é", "c é"], "cdata": ["code </item> tail &nbsp; <b>", "next"], "prefix": ["P"],
        "inside": ["open", "no end", "after", "last"], "latin": ["café “"], "undeclared": ["naïve"], "bom": ["漢"]}
    errors = sorted((r["landed"].rsplit("/", 1)[1][:-4], r["feed_pos"], r["state"]) for r in scans.feed_errors(landed).collect())
    assert errors == [("inside", 0, "recovered"), ("inside", 1, "recovered"), ("inside", 3, "lost"), ("inside", 5, "lost")]
    health = A.feed_health(feed_table(spark), scans.fetch_log(landed, spark.createDataFrame([("NASA", 200)], "source STRING, status INT")),
                           scans.of_feeds(scans.feed_entries(landed), feed_table(spark)), scans.of_feeds(scans.feed_errors(landed), feed_table(spark)))
    assert tuple(health.filter("source = 'NASA'").first())[1:] == ("malformed_kept", 13, 2, 2)


def test_dates_with_comments_and_zone_names(spark):
    texts = ["Mon, 29 Jan 2024 10:00:00 +0000 (UTC)", "Mon, 29 Jan 2024 11:00:00 CET", "Mon, 29 Jan 2024 12:00:00 CEST"]
    rows = spark.createDataFrame([(t,) for t in texts], "t STRING").select(A.published_at(F.col("t"), F.lit(None).cast("string")).alias("d")).collect()
    assert {r["d"] for r in rows} == {dt.datetime(2024, 1, 29, 10)}


def test_missing_state_is_empty_and_unreadable_state_fails(spark, tmp_path):
    assert scans.state_table(spark, str(tmp_path / "none"), schemas.SENT).count() == 0
    good = spark.createDataFrame([("k", "t", "l", "s", dt.datetime(2024, 1, 29))], schemas.SENT)
    good.write.parquet(str(tmp_path / "sent" / "run=2"))
    (tmp_path / "sent" / "run=1").mkdir()
    (tmp_path / "sent" / "run=1" / "part-0.parquet").write_text("not parquet at all, just text")
    with pytest.raises(Exception, match="FAILED_READ_FILE|CANNOT_READ|not a Parquet"):
        scans.state_table(spark, str(tmp_path / "sent"), schemas.SENT).collect()


def test_state_documents(spark):
    document = ('{"sent_articles":{"k":{"title":"t","link":"l","source":"s","sent_at":"2024-01-29T00:00:00+00:00"},"odd":3},'
                '"reddit_thread_details":{"u":{"title":"t","score":4}},"web_sweep":[{"id":"i","severity":"info"},"x"],"web_sweep_meta":{"last_run_date":"2024-01-27"}}')
    docs = spark.createDataFrame([("{bad",), (document,), ("{}",)], "document STRING")
    assert [(r["article_key"], r["title"]) for r in scans.state_documents(docs).collect()] == [("k", "t")]
    assert [(r["url"], r["score"]) for r in scans.thread_documents(docs).collect()] == [("u", 4)]
    assert [(r["id"], r["severity"], r["lane"]) for r in scans.signal_documents(docs).collect()] == [("i", "info", "")]
    assert [r["last_run_date"] for r in scans.run_stamps(docs).collect()] == ["2024-01-27"]


def test_runs_without_rows_alert(spark):
    runs = spark.createDataFrame([("a",), ("b",)], "run STRING")
    counts = spark.createDataFrame([("a", 1, 1, 1, 1)], "run STRING, n_new INT, n_threads INT, n_to_build INT, n_built INT")
    got = sorted((r["run"], r["alert"]) for r in R.alerts(R.run_stats(runs, counts)).collect())
    assert got == [("b", "no new articles"), ("b", "no thread articles")]


def test_long_digests_come_in_parts(spark):
    rows = spark.range(20_000).select(
        F.lit("d").alias("lang"), F.concat(F.lit("t"), F.col("id")).alias("title"), F.lit("l").alias("link"), F.lit("s").alias("source"), F.lit("").alias("summary"),
        F.lit(0).alias("section_ord"), F.lit(True).alias("must_watch"), F.lit(0).alias("best_tier"), F.lit(1).cast("bigint").alias("n_hits"),
        F.lit(0).alias("feed_ord"), F.col("id").alias("feed_pos"), F.col("id").cast("string").alias("article_key"), F.lit(None).cast("timestamp_ntz").alias("published"))
    got = D.render(rows, ["lang"], F.lit("today")).selectExpr("part_no", "n_articles", "length(html) AS n", "html LIKE '<h1>%' AS first").collect()
    assert sorted(r["part_no"] for r in got) == list(range(100))
    assert {r["n_articles"] for r in got} == {200} and [r["part_no"] for r in got if r["first"]] == [0]


def test_file_listing(spark, tmp_path):
    for n in ("d.log", "d.log.1", "x.txt"):
        (tmp_path / n).write_text("12345")
    got = {r["name"]: r["length"] for r in scans.file_listing(spark, str(tmp_path), "d.log*").collect()}
    assert got == {"d.log": 5, "d.log.1": 5}
