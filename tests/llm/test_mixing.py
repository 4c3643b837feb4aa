"""Mixing against a plain program."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

from broadsheet.llm import mixing


def targets(sizes):
    """Share again and again until no source is above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    fixed, left = {}, 1.5 * sum(sizes.values())
    while True:
        open_ = [s for s in names if s not in fixed]
        total = sum(weight[s] for s in open_)
        got = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if got[s] > 2 * sizes[s]]
        if not over:
            return {**fixed, **got}
        for s in over:
            fixed[s] = 2 * sizes[s]
            left -= fixed[s]


def rows():
    out = [(i, "w " * (i * 37 % 50), f"s{i % 7}", 0) for i in range(400)]
    out += [(1000 + i, "é x y z", "hot", 0) for i in range(500)]
    out += [(2000, None, None, 0), (2001, "a b c", None, 0), (2002, "", "empty", 0), (7, "dup dup", "s0", 0), (None, "n n", "s1", 0)]
    return out


def test_mix(spark):
    data = rows()
    docs = spark.createDataFrame(data, "doc_id bigint, text string, source string, target int")
    got = mixing.mix(docs).collect()
    assert len(got) == len(data)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    per = defaultdict(int)
    for _, t, s, _ in data:
        per[s] += size(t)
    want = targets(per)
    assert Counter((x.doc_id, x.size, x.source_size, round(x.target, 6)) for x in got) == Counter(
        (i, size(t), per[s], round(want[s], 6)) for i, t, s, _ in data)
    source = {(i, size(t)): s for i, t, s, _ in data}
    taken = Counter()
    for x in got:
        assert 0 <= x.taken <= 2 * x.size
        assert (x.taken > 0) == (x.position is not None)
        assert x.position is None or 0 <= x.position <= 1
        taken[source[x.doc_id, x.size]] += x.taken
    for s, t in want.items():
        assert t - 1 <= taken[s] <= t
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs).collect()))


def test_positions_invert_the_schedule(spark):
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, source string, target int")
    for x in mixing.mix(docs).filter("position is not null").collect():
        tilts = [t for t in mixing.TILTS
                 if abs(((1 - t) * x.position + t * x.position**2) * x.target - round(((1 - t) * x.position + t * x.position**2) * x.target)) < 1e-6]
        assert tilts  # the words due by then are a whole number under the source's schedule


def test_mixed_documents(spark):
    docs = spark.createDataFrame(rows(), "doc_id bigint, text string, source string, size int").withColumnRenamed("size", "target")
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    n = Counter((x.doc_id, x.text) for x in got.collect())
    for x in mixing.mix(docs, keep_row=True).collect():
        assert abs(n[x.row.doc_id, x.row.text] * x.size - x.taken) <= x.size / 2
    assert mixing.mixed_documents(docs.limit(0)).collect() == []
    assert mixing.mix(docs.limit(0)).collect() == []


@pytest.mark.parametrize("texts", [["", None], ["only words here"]])
def test_few_rows(spark, texts):
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id bigint, text string, source string")
    got = mixing.mix(docs).collect()
    assert all(x.taken == int(1.5 * x.size) for x in got)


def test_digest(spark):
    got = spark.range(1).select(mixing._digest(mixing.F.lit(12)).alias("d")).first().d
    assert got == int(hashlib.md5(b"12:mix").hexdigest()[:15], 16)
