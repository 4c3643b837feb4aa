"""Near-duplicates against all pairs of full sets."""

import random
import re

import numpy as np
import pytest

from broadsheet.llm import near_dedup as nd


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows, percent):
    sets = [brute_set(t) for _, t in rows]
    low = [i for i, _ in rows]
    pairs = []
    for a in range(len(rows)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                pairs.append((a, b))
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return sorted((i, len(s), c, i == c) for (i, _), s, c in zip(rows, sets, low))


def corpus(r, families=12, size=30):
    vocabulary = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for _ in range(families):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 20, 80, 200]))]
        rate = r.choice([0.0, 0.004, 0.01, 0.02, 0.04])
        for _ in range(size):
            copy = [r.choice(vocabulary) if r.random() < rate else w for w in base]
            rows.append((n, r.choice([" ", "\n", "  "]).join(w.upper() if r.random() < 0.1 else w for w in copy)))
            n += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [8, 512])
def test_deduplicate(spark, monkeypatch, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = corpus(random.Random(block))
    rows += [(9000, None), (9001, ""), (9002, " \t\n"), (9003, "a b"), (9004, "A  b"), (9005, "a b c d e"), (9006, "É é"), (9007, "é é"), (9008, "b a"), (9009, "\xa0x")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, n_shingles int")
    got = sorted((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in nd.deduplicate(df).collect())
    assert got == brute(rows, 85)


def test_repeated_rows_null_ids_and_empty_tables(spark):
    long = " ".join(f"v{i}" for i in range(30000))
    rows = [(5, "p q r s t u"), (5, "p q r s t u"), (None, "p q r s t u"), (None, "only here"), (7, long), (6, long + " z"), (8, "p q r s t u"), (5, "other words"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted(((x.doc_id or -1, x.n_shingles, x.component_id, x.kept) for x in nd.deduplicate(df).collect()), key=str)
    assert got == sorted([(5, 2, 5, True), (5, 2, 5, True), (-1, 2, 5, False), (-1, 1, None, True), (7, 29996, 6, False), (6, 29997, 6, True), (8, 2, 5, False), (5, 1, 5, True), (-1, 0, None, True)], key=str)
    assert nd.deduplicate(df.limit(0)).collect() == []


def test_estimates(spark):
    r = np.random.default_rng(1)
    inside = 0
    for _ in range(200):
        a = r.integers(0, 1 << 63, 300, dtype=np.uint64)
        b = np.concatenate([a[:276], r.integers(0, 1 << 63, 24, dtype=np.uint64)])  # similarity 276 / 324
        sig = [np.frombuffer(nd.signature(nd.minima(np.unique(x))), np.uint64) for x in (a, b)]
        n = int(nd.equal_fields(*sig))
        low = [nd.minima(np.unique(x)) for x in (a, b)]
        low = [(m ^ (m >> np.uint32(15))) & np.uint32(15) for m in low]
        assert n == (low[0] == low[1]).sum()
        df = spark.createDataFrame([(sig[0].view(np.int64).tolist(), sig[1].view(np.int64).tolist())], "x array<bigint>, y array<bigint>") if _ < 2 else None
        if df is not None:
            assert df.select(nd._equal_fields("x", "y").alias("n")).first().n == n
        inside += n >= nd.least_equal(0.85)
    assert inside == 200
    assert nd.least_equal(0.85) > nd.MINIMA * 0.65
