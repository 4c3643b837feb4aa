"""Exact search against every inner product."""

import math
import random

from broadsheet.llm import topk_search


def brute(rows, k):
    valid = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
             if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q in {(i, tuple(v)) for i, v in valid if i % 3 == 0}:
        best = sorted((-sum(a * b for a, b in zip(q[1], v)), i) for i, v in valid if i != q[0])[:k]
        out |= {(q[0], n, i, -s) for n, (s, i) in enumerate(best, 1)}
    return sorted(out)


def test_search(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CANDIDATES", 16)
    monkeypatch.setattr(topk_search, "QUERIES", 5)
    r = random.Random(1)
    rows = [(i, [r.choice([0.0, 0.0, r.uniform(-2, 2)]) for _ in range(8)]) for i in range(90)]
    rows += [(100 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(200, None), (201, [1.0, None]), (202, [float("nan")] * 8), (203, [float("inf")] * 8), (204, []), (205, [1.0, -1.0]), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    rows = [tuple(x) for x in df.collect()]
    v = topk_search.quantised(df.withColumn("id", topk_search.F.lit("x")).withColumn("score", topk_search.F.lit(0)))
    got = sorted(tuple(x) for x in topk_search.search(v, v.filter("id % 3 = 0"), 4).collect())
    assert got == brute(rows, 4)


def test_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0]), (3, [2.0])], "vec_id bigint, embedding array<float>")
    v = topk_search.quantised(df)
    assert sorted(tuple(x) for x in topk_search.search(v, v, 10).collect()) == [(0, 1, 3, 1024 * 2048), (3, 1, 0, 1024 * 2048)]
    assert topk_search.search(v.limit(0), v.limit(0)).collect() == []
    assert topk_search.search(v.limit(0), v).collect() == []


def test_queries_travel_once_per_shard(spark, monkeypatch):
    """Shards of several blocks give the same rows, and fewer copies of query blocks."""
    monkeypatch.setattr(topk_search, "CANDIDATES", 4)
    monkeypatch.setattr(topk_search, "QUERIES", 3)
    r = random.Random(2)
    rows = [(i, [float(r.randint(-3, 3)) for _ in range(4)]) for i in range(120)]
    v = topk_search.quantised(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    for shard, least, most in ((1, 30, 10**6), (4, 8, 30), (64, 1, 7)):
        monkeypatch.setattr(topk_search, "SHARD", shard)
        out = topk_search.search(v, v.filter("id % 3 = 0"), 3)
        assert sorted(tuple(x) for x in out.collect()) == brute(rows, 3)
        assert least <= topk_search.shards_of(30) <= most
    # 100 million candidates in blocks of 512: queries travel 64 times less often than blocks are many.
    assert topk_search.shards_of(195_313) == 3_052 and topk_search.shards_of(100) == 10 and topk_search.shards_of(0) == 1
