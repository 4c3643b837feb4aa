"""Centroid clustering of integer vectors through a vantage-point tree over the centroids.

Components are whole numbers, so distances, sums and means are exact and a rerun
gives the same clusters. In each round a tree over the centroids is made on the
driver and broadcast. A vector descends it best first: the open node with the least
lower bound comes next, the vantage point's distance bounds what lies inside and
outside its shell, and a node is left out only if its bound is above the best
distance so far (an equal bound is still visited, because an equally near centroid of
a smaller number may be in it). At leaves, and for vantage points, squared distances
are whole numbers. All vectors of a slice take their steps together, each along its own
queue. Sums per cluster are made in the tasks, so a round shuffles one row per cluster
and task, and the driver holds the centroids alone: clusters times dimensions.

Vectors that are null, of another length, or hold a null or non-finite component are
left out. Components beyond 2**26 times the scale's inverse count as the bound, so that
every distance fits a long. Rows may repeat and each is a vector; among equal ids the
lesser components start first, null ids start last. With fewer vectors than clusters
each starts one. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.frames import map_batches, map_stream, settle, slices
from broadsheet.session import passing_scratch

DIMENSIONS = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
#: Centroids in a leaf of the tree.
LEAF = 2
LARGEST = 1 << 26
#: Share by which lower bounds are eased, far above the rounding of square roots.
EASE = 1e-9


@dataclass
class Node:
    members: list[int]  # of a leaf: centroid numbers; else the vantage point
    inside: int = -1
    outside: int = -1
    # Least and greatest distance to the vantage point inside and outside its shell.
    shells: list[tuple[float, float]] = field(default_factory=list)


def plant(centroids: np.ndarray, leaf: int = LEAF) -> list[Node]:
    """Nodes of the tree, the root first. The vantage point is the member whose distances spread most."""
    nodes: list[Node] = []

    def build(members: np.ndarray) -> int:
        at = len(nodes)
        nodes.append(Node(members.tolist()))
        if len(members) <= leaf:
            return at
        between = squared(centroids[members], centroids[members])
        spread = np.sqrt(between.astype(np.float64)).std(1)
        vantage = int(spread.argmax())
        rest = np.delete(np.arange(len(members)), vantage)
        order = rest[np.argsort(between[vantage, rest], kind="stable")]
        halves = order[:-(-len(order) // 2)], order[-(-len(order) // 2):]
        far = np.sqrt(between[vantage].astype(np.float64))
        node = nodes[at]
        node.members = [int(members[vantage])]
        node.shells = [(float(far[h].min()), float(far[h].max())) if len(h) else (np.inf, np.inf) for h in halves]
        node.inside = build(members[halves[0]])
        if len(halves[1]):
            node.outside = build(members[halves[1]])
        return at

    build(np.arange(len(centroids)))
    return nodes


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole vectors."""
    out = np.empty((len(x), len(y)), np.int64)
    for j, row in enumerate(y):
        d = x - row
        out[:, j] = np.einsum("nd,nd->n", d, d)
    return out


def nearest(x: np.ndarray, centroids: np.ndarray, nodes: list[Node]) -> tuple[np.ndarray, np.ndarray, int]:
    """Number of the nearest centroid of each vector, the squared distance, and how many distances were measured."""
    n = len(x)
    best, owner = np.full(n, np.iinfo(np.int64).max), np.full(n, len(centroids))
    bound = np.full((n, len(nodes)), np.inf)
    bound[:, 0] = 0.0
    open_rows, measured = np.arange(n), 0
    while len(open_rows):
        queue = bound[open_rows]
        first = queue.argmin(1)
        least = queue[np.arange(len(first)), first]
        # Inclusive: a node whose bound equals the best distance may hold a tie of a smaller number.
        going = np.isfinite(least) & (least <= np.sqrt(best[open_rows].astype(np.float64)))
        open_rows, first = open_rows[going], first[going]
        for k in np.unique(first):
            rows, node = open_rows[first == k], nodes[k]
            bound[rows, k] = np.inf
            d2 = squared(x[rows], centroids[node.members])
            measured += d2.size
            for j, c in enumerate(node.members):
                nearer = (d2[:, j] < best[rows]) | ((d2[:, j] == best[rows]) & (c < owner[rows]))
                best[rows[nearer]], owner[rows[nearer]] = d2[nearer, j], c
            if node.inside >= 0:
                d = np.sqrt(d2[:, 0].astype(np.float64))
                for child, (low, high) in zip((node.inside, node.outside), node.shells):
                    if child >= 0:
                        bound[rows, child] = np.maximum(0.0, np.maximum(d - high, low - d) - EASE * (d + high))
    return owner, best, measured


def whole(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """vec_id and the whole components ``q`` of the vectors that take part."""
    x = F.col(column)
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    part = F.coalesce((F.size(x) == dimensions) & good, F.lit(False))
    limit = float(LARGEST)
    q = F.transform(x, lambda v: F.greatest(F.lit(-limit), F.least(F.lit(limit), F.floor(v.cast("double") * scale).cast("double"))).cast("int"))
    return vectors.filter(part).select(F.col(key).alias("vec_id"), q.alias("q"))


def start_key(vec_id: Column, seed: int = 1) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), vec_id.cast("string")).cast("binary"), 256)


def _matrix(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch.column("q").flatten().to_numpy().astype(np.int64).reshape(batch.num_rows, dimensions)


@dataclass
class Search:
    """What a round broadcasts."""

    centroids: np.ndarray
    nodes: list[Node]


def _round(kept: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: floors of exact means; those without a vector stay."""
    dimensions = centroids.shape[1]
    shared = kept.sparkSession.sparkContext.broadcast(Search(centroids, plant(centroids)))
    arrow = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])

    def run(batches):
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros(centroids.shape, np.int64)
        for batch in slices(batches):
            if batch.num_rows:
                x = _matrix(batch, dimensions)
                owner, _, _ = nearest(x, shared.value.centroids, shared.value.nodes)
                counts += np.bincount(owner, minlength=len(counts))
                np.add.at(sums, owner, x)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(counts[used]), pa.array(sums[used].tolist(), pa.list_(pa.int64()))], schema=arrow)

    partial = map_stream(kept, run, "cluster int, n bigint, sums array<bigint>")
    # One row per cluster and task; the driver gets one row per cluster.
    total = partial.groupBy("cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(dimensions)]).alias("sums"))
    out = centroids.copy()
    for r in total.collect():
        out[r.cluster] = [s // r.n for s in r.sums]
    shared.unpersist()
    return out


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, seed: int = 1
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance of every vector that takes part, settled, and the final centroids."""
    kept = settle(whole(vectors, dimensions, scale), "whole")
    first = kept.orderBy(start_key(F.col("vec_id"), seed).asc_nulls_last(), "q").limit(clusters).collect()
    centroids = np.array([r.q for r in first], np.int64).reshape(len(first), dimensions)
    if not first:
        return kept.selectExpr("vec_id", "0 AS cluster", "0L AS distance"), centroids
    for _ in range(rounds):
        centroids = _round(kept, centroids)
    shared = vectors.sparkSession.sparkContext.broadcast(Search(centroids, plant(centroids)))

    def assign(batch):
        owner, distance, _ = nearest(_matrix(batch, dimensions), shared.value.centroids, shared.value.nodes)
        return {"vec_id": batch.column("vec_id"), "cluster": owner, "distance": distance}

    return settle(map_batches(kept, assign, "vec_id bigint, cluster int, distance bigint"), "assigned"), centroids


def report(vectors: DataFrame, **parameters) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 per vector that takes part."""
    spark = vectors.sparkSession
    with passing_scratch(spark) as keep:
        assigned, centroids = cluster(vectors, **parameters)
        if not len(centroids):
            return spark.createDataFrame([], "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
        per = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
        keep(assigned)
    digests = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(c, s, sum(per.values()), digests[c]) for c, s in sorted(per.items())]
    # One row per cluster.
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(known), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
