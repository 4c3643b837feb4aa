"""The multi-index against all pairs."""

import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from broadsheet.llm import components, embedding_dedup


def brute(rows, cosine):
    ok = [(i, label, np.array(v, np.float32).astype(float)) for i, label, v in rows
          if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links, low = {}, {i: i for i, _, _ in rows if i is not None}
    pairs = []
    for n, (i, la, a) in enumerate(ok):
        for j, lb, b in ok[:n]:
            if la == lb and len(a) == len(b) and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= cosine:
                links[i], links[j] = links.get(i, 0) + 1, links.get(j, 0) + 1
                pairs.append((i, j))
    for _ in rows:
        for i, j in pairs:
            low[i] = low[j] = min(low[i], low[j])
    return sorted(((i or -1), links.get(i, 0), low.get(i, -1), i is None or low[i] == i) for i, _, _ in rows)


def test_deduplicate(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "MEMBERS", 20)
    monkeypatch.setattr(embedding_dedup, "VISITORS", 30)
    r = np.random.default_rng(2)
    rows = [(i, int(i % 3), r.standard_normal(16).tolist()) for i in range(150)]
    for i in range(150, 330):
        base = np.array(rows[r.integers(0, 12)][2])
        rows.append((i, int(r.integers(0, 3)), (base + r.standard_normal(16) * r.choice([0, 0.1, 0.25, 0.3])).tolist()))
    rows += [(400, 1, None), (401, 1, [0.0] * 16), (402, 1, [float("nan")] * 16), (403, None, rows[0][2]), (404, 1, [None, 1.0]), (405, 1, []),
             (406, 1, [1.0]), (407, 1, [2.0]), (None, 0, rows[0][2])]
    df = spark.createDataFrame([(*x, 1) for x in rows], "vec_id bigint, label int, embedding array<float>, n_links int")
    got = sorted((x.vec_id or -1, x.n_links, x.component_id if x.component_id is not None else -1, x.kept)
                 for x in embedding_dedup.deduplicate(df).collect())
    assert got == brute(rows, 0.93)


def test_few_rows(spark):
    df = spark.createDataFrame([(5, 1, [1.0, 2.0]), (7, 1, [1.0, 2.0]), (5, 1, [1.0, 2.0])], "vec_id bigint, label int, embedding array<float>")
    got = sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in embedding_dedup.deduplicate(df).collect())
    assert got == [(5, 2, 5, True), (5, 2, 5, True), (7, 2, 5, False)]
    assert embedding_dedup.deduplicate(df.limit(0)).collect() == []


def test_traversal_is_in_order():
    r = np.random.default_rng(3)
    d1, d2 = r.random(7), r.random(5)
    cells = list(embedding_dedup.multi_sequence(d1, d2))
    assert len({c[:2] for c in cells}) == 35
    assert [c[2] for c in cells] == sorted(c[2] for c in cells)
    x = r.standard_normal((300, 12))
    index = embedding_dedup.fit_index(x, 0.93)
    for v, cells in zip(x[:50], index.visits(embedding_dedup.unit(x[:50]))):
        u = v / np.linalg.norm(v)
        grid = np.add.outer(((index.first - u[:6])**2).sum(1), ((index.second - u[6:])**2).sum(1)).ravel()
        assert cells[0] == grid.argmin()
        assert sorted(cells) == np.flatnonzero(grid - grid.min() <= index.margin).tolist()
        assert (np.diff(grid[cells]) >= -1e-12).all()


def test_grid_grows_with_the_table(spark):
    """A larger table gets more words, and its vectors are compared with a smaller share at the same recall."""
    r = np.random.default_rng(9)
    x = embedding_dedup.unit(r.standard_normal((8_192, 32)))  # without clusters, whose size would bound the share
    noise = r.standard_normal(x.shape)
    near = 0.93 * x + math.sqrt(1 - 0.93**2) * embedding_dedup.unit(noise - (noise * x).sum(1, keepdims=True) * x)
    shares = []
    for vectors in (10_000, 1_000_000):
        index = embedding_dedup.fit_index(x, 0.93, embedding_dedup.words_for(vectors, len(x)))
        assert (index.met(x, near) <= index.margin).mean() > 0.999
        cells = index.visits(x[:1000])
        members = np.bincount([c[0] for c in index.visits(x)], minlength=len(index.first) * len(index.second)) / len(x)
        shares.append(np.mean([members[c].sum() for c in cells]))
    assert embedding_dedup.words_for(10_000, 8_192) == 8 and embedding_dedup.words_for(10**9, 8_192) == 256
    assert shares[1] < shares[0] / 4


def test_text_labels_and_a_large_grid(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LENGTHS", 1)
    r = np.random.default_rng(3)
    rows = [(i, "ab"[i % 2], r.standard_normal(12).tolist()) for i in range(400)]
    rows += [(i, "ab"[i % 2], (np.array(rows[i % 50][2]) + 0.2 * r.standard_normal(12)).tolist()) for i in range(400, 600)]
    rows += [(i, "a", [1.0, float(i % 3)]) for i in range(600, 612)]
    df = spark.createDataFrame(rows, "vec_id bigint, label string, embedding array<double>")
    got = sorted((x.vec_id or -1, x.n_links, x.component_id, x.kept) for x in embedding_dedup.deduplicate(df, words=40).collect())
    assert got == brute(rows, 0.93)


def test_recall_at_the_threshold():
    r = np.random.default_rng(4)
    x = embedding_dedup.unit(r.standard_normal((4000, 64)))
    index = embedding_dedup.fit_index(x[:1000], 0.93)
    noise = r.standard_normal(x.shape)
    noise = embedding_dedup.unit(noise - (noise * x).sum(1, keepdims=True) * x)
    assert (index.met(x, 0.93 * x + math.sqrt(1 - 0.93**2) * noise) <= index.margin).mean() > 0.995


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 15), st.integers(0, 15)), max_size=20))
def test_forest(links):
    a, b = np.array([x for x, _ in links], int), np.array([y for _, y in links], int)
    want = list(range(16))
    for _ in range(16):
        for x, y in links:
            want[x] = want[y] = min(want[x], want[y])
    assert components.forest(16, a, b).tolist() == want


def test_connected(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95), (95, 100), (7, 7)]
    got = {x.node: x.component for x in components.connected(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}
    assert components.connected(spark.createDataFrame([], "a bigint, b bigint")).collect() == []
