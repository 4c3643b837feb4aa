"""Toxic passages whose words stand elsewhere in the text as well."""

import random

from broadsheet.llm import toxicity

BAD = ["vile", "rotten", "awful", "nasty", "foul"]
MODEL = toxicity.Model(dict.fromkeys(BAD, 2.5), toxicity.DRIFT, decay=2.0, level=-1.0, slope=1.0, intercept=-4.0)


def significant(text):
    return [(a, b) for a, b, s in MODEL.segments(text) if MODEL.evidence(len(text), [s]) > 0]


def test_a_late_passage_stands_behind_scattered_early_uses():
    words = ["calm"] * 3000
    for i, w in enumerate(BAD):
        words[100 + 400 * i] = w
    late = 2900
    assert significant(" ".join(words)) == []
    words[late:late + len(BAD)] = BAD
    assert significant(" ".join(words)) == [(late, late + len(BAD))]
    assert MODEL.score(len(" ".join(words)), MODEL.segments(" ".join(words))) > 0.7


def test_every_passage_of_one_vocabulary_is_found():
    r, words, want = random.Random(5), [], []
    for _ in range(4):
        words += ["calm"] * 200
        want.append((len(words), len(words) + len(BAD)))
        words += r.sample(BAD, len(BAD))
    assert significant(" ".join(words)) == want


def test_uses_inside_a_passage_add_up():
    (once,), (thrice,) = MODEL.segments("calm Vile! calm"), MODEL.segments("calm vile vile, VILE calm")
    assert once == (1, 2, 2.5) and thrice == (1, 4, 7.5)


def test_passages_are_counted_by_the_query_function(spark):
    text = " ".join([*BAD, *["calm"] * 300, *BAD])
    docs = spark.createDataFrame([(1, text), (2, "calm"), (3, None)], "doc_id bigint, text string")
    assert {x.doc_id: len(x.passages) for x in toxicity.score(docs, MODEL).collect()} == {1: 2, 2: 0, 3: 0}
