"""Each stage of the pipeline, on its own input, against a plain program."""

import inspect
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_mixing import targets
from test_near_dedup import brute
from test_pii import plain
from test_tokens import check_packed

import corpus_pipeline
from broadsheet.llm import mixing
from broadsheet.llm.frames import settle, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "taken", "_row"]


@pytest.fixture(scope="module")
def steps(spark):
    """What goes into each stage and what comes out of the last."""
    real = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    odd = [(9001, None, None, "s", None), (9002, "", "en", None, 0), (9003, "12 34", "en", "s", 5), (9004, "the", "en", None, 3),
           (None, "the last one of all", "en", "s", 19), real[3], real[3], (real[3][0], real[5][1], "en", "s", 1), (9005, real[7][1], "en", "z", 1)]
    rows = [(*r, 1, "x") for r in real + odd]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, taken int, _row string")
    out = [settle(docs, "in")]
    for name, stage in corpus_pipeline.STAGES:
        out.append(settle(stage(spark, out[-1], "/root/testdata/sf0.001"), name))
    return out


def texts(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["keep_known_languages", "drop_near_duplicates", "redact_personal_data", "mix_sources", "pack_sequences"]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for _, f in corpus_pipeline.STAGES)
    assert corpus_pipeline.ORACLE_SQL is None


def test_columns_stay(steps):
    assert all(df.columns == COLUMNS for df in steps[:-1])


def test_language_stage_keeps_what_has_letters(steps):
    want = [(i, t) for i, t in texts(steps[0]) if t and any(c.isalpha() for c in t)]
    assert Counter(texts(steps[1])) == Counter(want)


def test_near_duplicate_stage_keeps_one_of_each_group(steps):
    rows = sorted(texts(steps[1]), key=lambda r: (r[0] is None, r[0]))
    places = brute([(n, t) for n, (_, t) in enumerate(rows)], 80)
    want = Counter(rows[n][0] for n, _, group, kept in places if kept)
    assert Counter(i for i, _ in texts(steps[2])) == want


def test_personal_data_stage(steps):
    before = {(r.doc_id, r.source): r.text for r in steps[2].collect()}
    after = steps[3].collect()
    assert len(after) == steps[2].count()
    for r in after:
        assert plain(r.text) == []
        if not plain(before[r.doc_id, r.source]) and "[" not in r.text:
            assert r.text == before[r.doc_id, r.source]
    changed = [r for r in after if r.text != before[r.doc_id, r.source]]
    assert changed and all(r.n_chars == len(r.text) for r in changed)


def test_mixing_stage(steps):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    rows = steps[3].collect()
    per = Counter()
    for r in rows:
        per[r.source] += size(r.text)
    want, got, largest = targets(per), Counter(), Counter()
    for r in rows:
        largest[r.source] = max(largest[r.source], size(r.text))
    for r in steps[4].collect():
        got[r.source] += size(r.text)
    for s, t in want.items():
        assert abs(got[s] - t) <= largest[s] / 2 + 1
    copies = Counter(r.doc_id for r in steps[4].collect())
    taken = {r.row.doc_id: (r.taken, r.size) for r in mixing.mix(steps[3], keep_row=True).collect()}
    assert all(abs(copies[i] * n - t) <= n / 2 for i, (t, n) in taken.items() if i != 3)


def test_packing_stage(steps):
    rows = steps[5].collect()
    docs = dict(texts(steps[4]))
    copies = Counter(i for i, _ in texts(steps[4]))
    once, seen = [], Counter()
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.piece)):
        seen[r.doc_id, r.piece] += 1
        if seen[r.doc_id, r.piece] == 1:
            once.append(r)
    assert all(n == copies[i] for (i, _), n in seen.items() if i != 3)  # two texts share that id
    single = {i: t for i, t in docs.items()}
    assert {r.doc_id for r in once} == set(single)
    sequences = Counter()
    for r in rows:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048
    assert len(sequences) <= -(-sum(sequences.values()) // 2048) + 1
    if all(n == 1 for n in copies.values()):
        check_packed(rows, docs, 2048)


def test_empty_input(spark, steps):
    docs = steps[0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.collect() == []


def test_texts_stay_where_no_row_has_a_language(spark, steps):
    docs = steps[0].withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.keep_known_languages(spark, docs, "")
    assert Counter(texts(got)) == Counter(texts(steps[1]))


def test_noise_goes_and_languages_stay(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    noise = ["x9f8a7e6b5 zqzqzq 0000 qqqq kj2h34 0x8f zzxq " * 12, "aGVsbG8gd29ybGQgYmFzZTY0IHN0cmluZw==" * 20, "qqqq zzzz xxxx kkkk jjwq vvxz " * 20]
    both = docs.unionByName(spark.createDataFrame([(-1 - i, t, None, "s", len(t)) for i, t in enumerate(noise)], docs.schema))
    kept = corpus_pipeline.keep_known_languages(spark, both, "")
    assert kept.filter("doc_id < 0").count() <= 1
    assert kept.filter("doc_id >= 0").count() >= 0.995 * docs.filter(F.col("text").rlike(r"\p{L}")).count()


def test_near_duplicate_stage_joins_at_80(spark):
    from broadsheet.llm import near_dedup
    words = [f"w{i}" for i in range(504)]
    # 500 shingles; a new word at one end of a run of changed words leaves 0.82 in common.
    other = words[:459] + [f"v{i}" for i in range(45)]
    share = 455 / (2 * 500 - 455)
    assert 0.8 <= share < 0.85
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(other))], "doc_id bigint, text string")
    assert near_dedup.representatives(docs, 80).count() == 1 and near_dedup.representatives(docs, 85).count() == 2
