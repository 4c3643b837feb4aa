"""Language identification, licence rules and toxic passages."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import language_id, licenses, toxicity

EN = "the and of that with from have this there which would about people".split()
DE = "der und die nicht ist das mit für über straße können wäre schön".split()


def texts(r, n):
    out = []
    for i in range(n):
        words = (EN, DE)[i % 2]
        out.append((i, " ".join(r.choice(words) for _ in range(r.randint(3, 200))), ("en", "de")[i % 2], 0.5))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    rows = texts(random.Random(2), 300)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score double")
    held = language_id.held_out(language_id.F.col("doc_id"), 4, 2)
    return docs, language_id.fit(docs.filter(~held), sample=80)


def test_language_accuracy_on_held_out_rows(trained):
    docs, net = trained
    held = language_id.held_out(language_id.F.col("doc_id"), 4, 2)
    got = language_id.identify(docs.filter(held), net).join(docs.drop("score"), "doc_id").collect()
    assert len(got) > 40
    assert sum(x.lang == x.lang_pred for x in got) / len(got) > 0.97
    assert all(0 <= x.score <= 1 for x in got)


def test_folded_tables_give_the_network(trained):
    _, net = trained
    x = np.random.default_rng(0).integers(0, 256, (40, language_id.WINDOW)).astype(np.uint8)
    h, _ = net.responses(x)
    assert np.allclose(net.softmax(h), language_id.Folded(net).probabilities(x, 7), atol=1e-4)


def test_gradients_are_those_of_the_loss(trained):
    _, net = trained
    r = np.random.default_rng(1)
    x, y = r.integers(97, 122, (6, language_id.WINDOW)).astype(np.uint8), np.array([0, 1, 0, 1, 1, 0])
    net = language_id.Network(net.languages, *[
        v.astype(float) if isinstance(v, np.ndarray) else [a.astype(float) for a in v]
        for v in (net.embedding, net.filters, net.offsets, net.dense, net.bias)])
    loss = lambda: -np.log(net.softmax(net.responses(x)[0])[np.arange(6), y] + 1e-300).mean()
    for p, g in zip(net.parameters(), net.gradients(x, y)):
        for at in list(np.ndindex(p.shape))[:: max(1, p.size // 5)]:
            kept, e = p[at], 1e-6
            p[at] = kept + e
            up = loss()
            p[at] = kept - e
            down = loss()
            p[at] = kept
            assert abs((up - down) / (2 * e) - g[at]) < 1e-4


def test_language_edge_cases(spark, trained):
    _, net = trained
    rows = [(1, None), (2, ""), (3, "12 34 .. ²"), (4, "the and of"), (4, "the and of"), (5, "über die straße " * 20000), (None, "the")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((x.doc_id or 0, x.lang_pred, x.score > 0) for x in language_id.identify(docs, net).collect())
    assert got == [(0, "en", True), (1, "und", False), (2, "und", False), (3, "und", False), (4, "en", True), (4, "en", True), (5, "de", True)]
    assert language_id.identify(docs.limit(0), net).collect() == []
    assert {x.lang_pred for x in language_id.identify(docs, None).collect()} == {"und"}
    assert language_id.fit(spark.createDataFrame([], "doc_id bigint, text string, lang string")) is None


def test_licenses(spark):
    rows = [
        (1, "Foo bar.\nLicensed under the Apache License, Version 2.0.\nMore text."),
        (2, "Intro. Released under the MIT License. This work is licensed under the GNU General Public License, version 3."),
        (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.\n"
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
            "The software is provided \"as is\", without warranty of any kind."),
        (4, None), (5, ""), (6, "This licence talk names no licence."), (7, "ALL RIGHTS RESERVED!"), (7, "ALL RIGHTS RESERVED!"),
        (8, "x " * 50000 + ". Licensed under CC BY-NC 4.0."),
    ]
    got = sorted((x.doc_id, x.sentence_ids, x.licenses) for x in licenses.scan(
        spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("licenses", licenses.F.lit(1))).collect())
    assert got == [
        (1, "apache-ref", "Apache-2.0"), (2, "mit-ref|gpl3-ref", "MIT,GPL-3.0"), (3, "mit-grant|mit-notice|mit-warranty", "MIT"),
        (4, "", ""), (5, "", ""), (6, "", ""), (7, "reserved", "proprietary"), (7, "reserved", "proprietary"), (8, "ccbync-ref", "CC-BY-NC-4.0")]


def test_license_rules_prefer_the_longest(spark):
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."
    docs = spark.createDataFrame([(1, text + " Unknown words stand here. " + text)], "doc_id bigint, text string")
    assert licenses.scan(docs).first().licenses == "MIT"
    assert licenses.scan(docs.limit(0)).collect() == []
    import re

    assert all(re.search(licenses.ANCHORS, s) for s in licenses.SENTENCES)
    assert [len(r[0]) for r in licenses.RULES] == sorted((len(r[0]) for r in licenses.RULES), reverse=True)


def brute_segments(values):
    """Best segment first, then the same to its left and right."""
    best = (0.0, 0, 0)
    for i in range(len(values)):
        for j in range(i + 1, len(values) + 1):
            s = sum(values[i:j])
            if s > best[0] + 1e-9 or (abs(s - best[0]) <= 1e-9 and s > 1e-9 and j - i < best[2] - best[1]):
                best = (s, i, j)
    if best[0] <= 1e-9:
        return []
    _, i, j = best
    left, right = brute_segments(values[:i]), brute_segments(values[j:])
    return left + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in right]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1.37, 2.11, 3.71]), max_size=25))
def test_maximal_segments(values):
    v = np.array(values, float)
    got = toxicity.maximal_segments(np.flatnonzero(v), v[v != 0], 0.61)
    want = brute_segments([x or -0.61 for x in values])
    assert [(a, b, round(s, 6)) for a, b, s in got] == [(a, b, round(s, 6)) for a, b, s in want]


def test_toxic_passages(spark):
    r = random.Random(4)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(3))
    bad = ["vile", "rotten", "awful", "nasty"]
    rows, labels = [], []
    for i in range(600):
        words = [word() for _ in range(r.randint(5, 300))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(4):
                words.insert(r.randint(0, len(words)), r.choice(bad) + "!")
        rows.append((i, " ".join(words), 0))
        if i % 4:
            labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score int")
    model = toxicity.fit(docs, spark.createDataFrame(labels + labels[:5] + [(None, 1), (3, None)], "doc_id bigint, toxic int"))
    assert set(model.weights) >= set(bad)
    got = {x.doc_id: x for x in toxicity.score(docs, model).collect()}
    unseen = [i for i in range(600) if i % 4 == 0]
    assert sum(got[i].predicted == (i % 6 == 0) for i in unseen) / len(unseen) > 0.95
    assert all((len(got[i].passages) > 0) >= got[i].predicted for i in got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "vile rotten awful nasty"), (3, "vile rotten awful nasty"), (4, "a b " * 50000)], "doc_id bigint, text string")
    assert sorted((x.doc_id, x.predicted) for x in toxicity.score(odd, model).collect()) == [(1, 0), (2, 0), (3, 1), (3, 1), (4, 0)]
    assert toxicity.score(odd.limit(0), model).collect() == []
    assert {x.score for x in toxicity.score(odd, None).collect()} == {0.0}
    assert toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int")) is None
