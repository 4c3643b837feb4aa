"""Clusters against plain whole-number arithmetic."""

from hashlib import sha256
from math import floor, isfinite

import numpy as np
import pytest

from broadsheet.llm import centroids as C

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def plain(rows, clusters=16, rounds=3, dimensions=64):
    kept = [(i, [floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dimensions and all(x is not None and isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "~", r[1]))
    centre = [r[1] for r in order[:clusters]]

    def assign():
        out = []
        for _, q in kept:
            d = [sum((a - b) ** 2 for a, b in zip(q, c)) for c in centre]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        owners = assign()
        for c in range(len(centre)):
            mine = [q for (_, q), (o, _) in zip(kept, owners) if o == c]
            if mine:
                centre[c] = [sum(col) // len(mine) for col in zip(*mine)]
    owners = assign()
    per = [sum(d for o, d in owners if o == c) for c in range(len(centre))]
    return sorted(((r[0] is None, r[0] or 0), o, d, per[o], sum(per), sha256(",".join(map(str, centre[o])).encode()).hexdigest())
                  for r, (o, d) in zip(kept, owners))


def found(df):
    return sorted(((r.vec_id is None, r.vec_id or 0), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def rows(n, seed=3):
    r = np.random.default_rng(seed)
    base = r.standard_normal((12, 64))
    out = [(i, (base[i % 12] + 0.3 * r.standard_normal(64)).tolist(), 1) for i in range(n)]
    bad = [None, [], [1.0] * 63, [1.0] * 65, [float("nan")] + [0.0] * 63, [float("inf")] + [0.0] * 63, [None] + [0.0] * 63]
    out += [(5000 + i, v, None) for i, v in enumerate(bad)]
    out += [(6000, [0.0] * 64, 1), (6000, [0.0] * 64, 1), (6000, [-0.5] * 64, 1), (None, [0.25] * 64, 1)]
    return out + [(7000 + i, out[0][1], 0) for i in range(n // 2)]


def test_clusters(spark):
    data = rows(300)
    df = spark.createDataFrame([(*r, "x", 1) for r in data], SCHEMA + ", q string, cluster int").repartition(3)
    assert found(C.report(df)) == plain(data)


def test_few_vectors_and_none(spark):
    data = [(i, [float(i)] * 64, 0) for i in range(5)] + [(9, [1.0] * 64, 0)]
    assert found(C.report(spark.createDataFrame(data, SCHEMA))) == plain(data)
    assert C.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert C.report(spark.createDataFrame([(1, None, 1)], SCHEMA)).count() == 0


@pytest.mark.parametrize("k, dimensions, leaf", [(1, 3, 1), (2, 2, 1), (16, 2, 2), (200, 2, 4), (200, 3, 1), (64, 64, 8)])
def test_tree_equals_scan_with_ties(k, dimensions, leaf):
    r = np.random.default_rng(k)
    # A small grid makes many equal distances and equal centroids.
    centre = r.integers(-4, 5, (k, dimensions)).astype(np.int64)
    x = r.integers(-6, 7, (700, dimensions)).astype(np.int64)
    owner, distance, _ = C.nearest(x, centre, C.plant(centre, leaf))
    every = C.squared(x, centre)
    assert (distance == every.min(1)).all() and (owner == every.argmin(1)).all()


def test_far_values_stay_exact():
    centre = np.array([[C.LARGEST] * 64, [C.LARGEST - 1] + [C.LARGEST] * 63, [-C.LARGEST] * 64], np.int64)
    x = np.array([[C.LARGEST - 1] + [C.LARGEST] * 63, [-C.LARGEST] * 64], np.int64)
    owner, distance, _ = C.nearest(x, centre, C.plant(centre, 1))
    assert owner.tolist() == [1, 2] and distance.tolist() == [0, 0]


def test_bounds_leave_centroids_out():
    r = np.random.default_rng(1)
    centre = r.integers(-1000, 1000, (256, 2)).astype(np.int64)
    x = r.integers(-1000, 1000, (500, 2)).astype(np.int64)
    _, _, measured = C.nearest(x, centre, C.plant(centre))
    assert measured < 0.25 * len(x) * len(centre)
