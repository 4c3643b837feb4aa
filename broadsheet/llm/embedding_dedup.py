"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in two halves. A codebook per half, fitted on a bounded
sample, gives a grid of cells: the products of both codebooks. The codebooks grow
with the largest label, so that a cell keeps some hundred of its vectors. Every vector is
indexed in its own cell and visits cells by the multi-sequence traversal of the two
sorted codebooks, in the order of their summed squared distances, until the extra
distance passes a margin. The margin is fitted so that pairs at
the threshold itself are met with the target recall; closer pairs are met more
surely. A pair is met if either side visits the other's cell, is handled in one
cell only, and counts as a link by its cosine in double precision.

Equal vectors are collapsed first. The visitors and members of a cell are dealt
into blocks of bounded size. A block gives counts and a spanning forest of its
links, never the links themselves.

Vectors that are null, zero, hold null or non-finite components, or have no label
or no id link with nothing. Rows that share an id count as one node. Only vectors
of equal length link. Labels of any type that casts to a string do. An empty table gives an empty table. Extra columns are
ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.components import connected, forest
from broadsheet.llm.frames import map_batches, settle, ship
from broadsheet.session import passing_scratch

#: Vectors that codebooks and margin are fitted on, their bytes, and the target.
SAMPLE = 8_192
SAMPLE_BYTES = 64 << 20
RECALL = 0.9999
#: Words per codebook: the least, up to how many vectors of a label, and the most per vector of the sample.
WORDS = 8
FEW = 16_384
FITTED = 32
#: Lengths that get codebooks of their own, the most frequent first; vectors of others share one cell of their length.
LENGTHS = 64
MEMBERS = 2_048
VISITORS = 8_192


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    r = np.random.default_rng(5)
    words = x[r.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = ((words**2).sum(1) - 2 * x @ words.T).argmin(1)
        for w in range(len(words)):
            if (own := x[near == w]).size:
                words[w] = own.mean(0)
    return words


def multi_sequence(d1: np.ndarray, d2: np.ndarray) -> Iterator[tuple[int, int, float]]:
    """Cells of the product grid in the order of ``d1[i] + d2[j]``, one after the other."""
    o1, o2 = np.argsort(d1, kind="stable"), np.argsort(d2, kind="stable")
    heap, seen = [(d1[o1[0]] + d2[o2[0]], 0, 0)], {(0, 0)}
    while heap:
        total, i, j = heapq.heappop(heap)
        yield int(o1[i]), int(o2[j]), float(total)
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(o1) and b < len(o2) and (a, b) not in seen:
                seen.add((a, b))
                heapq.heappush(heap, (d1[o1[a]] + d2[o2[b]], a, b))


@dataclass
class Index:
    first: np.ndarray
    second: np.ndarray
    margin: float = 0.0

    def extra(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per half, vector and word the squared distance beyond that of the nearest word."""
        out = []
        for half, words in zip(np.split(x, [self.first.shape[1]], axis=1), (self.first, self.second)):
            d = (words**2).sum(1) - 2 * half @ words.T
            out.append(d - d.min(1, keepdims=True))
        return out[0], out[1]

    def visits(self, x: np.ndarray) -> list[list[int]]:
        """Cells that the traversal reaches before it passes the margin; a vector's own is the first."""
        return [[i * len(self.second) + j for i, j, _ in takewhile(lambda c: c[2] <= self.margin, multi_sequence(a, b))]
                for a, b in zip(*self.extra(x))]

    def met(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Extra distance at which the pair is met from the better side."""
        a, b = self.extra(x), self.extra(y)
        rows = np.arange(len(x))
        reach = lambda p, q: sum(d[rows, e.argmin(1)] for d, e in zip(p, q))
        return np.minimum(reach(a, b), reach(b, a))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def words_for(vectors: int, sample: int) -> int:
    """Words per codebook, so that a cell keeps its share of a label of that many vectors."""
    return int(max(WORDS, min(sample // FITTED, WORDS * (vectors / FEW) ** 0.5)))


def fit_index(sample: np.ndarray, cosine: float, words: int = WORDS, recall: float = RECALL) -> Index:
    """Codebooks on the sample's halves, and the margin from pairs at the threshold itself."""
    x = unit(sample.astype(np.float64))
    half = x.shape[1] // 2
    index = Index(kmeans(x[:, :half], words), kmeans(x[:, half:], words))
    r = np.random.default_rng(6)
    base = np.repeat(x, max(1, 40_000 // len(x)), axis=0)
    noise = r.standard_normal(base.shape)
    noise = noise - (noise * base).sum(1, keepdims=True) * base
    if base.shape[1] > 1:
        near = cosine * base + np.sqrt(max(0.0, 1 - cosine**2)) * unit(noise)
        index.margin = float(np.quantile(index.met(base, near), recall)) + 1e-9
    return index


ASSIGNED = "id bigint, copies bigint, label string, vec binary, own int, cells array<int>"


def usable() -> Column:
    """Whether a row can link at all; never null."""
    good = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    return named & F.coalesce(good & some, F.lit(False))


def _block(rows: pa.Table, cosine: float) -> dict:
    """Counts and a spanning forest of the links between visitors and members of a block."""
    member = rows.column("member").to_numpy()
    ids, copies, own = (rows.column(c).to_numpy() for c in ("id", "copies", "own"))
    cells = rows.column("cells").combine_chunks()
    lengths = np.diff(cells.offsets.to_numpy())
    x = np.frombuffer(b"".join(rows.column("vec").to_pylist()), np.float64).reshape(len(ids), -1)
    m, v = np.flatnonzero(member), np.flatnonzero(~member)
    # Which row visits which cell, as ascending numbers.
    flat = cells.flatten().to_numpy().astype(np.int64)
    grid = int(max(flat.max(initial=0), own.max())) + 1
    visited = np.sort(np.repeat(np.arange(len(ids)), lengths) * grid + flat)
    a, b = [], []
    for at in range(0, len(v), 512):
        part = v[at:at + 512]
        p, q = np.nonzero(x[part] @ x[m].T >= cosine)
        p, q = part[p], m[q]
        # The cell that handles a pair: the one only one side visits, else the greater id's.
        wanted = q * grid + own[p]
        place = np.minimum(np.searchsorted(visited, wanted), len(visited) - 1)
        keep = (ids[p] != ids[q]) & ((visited[place] != wanted) | (ids[p] < ids[q]))
        a.append(p[keep])
        b.append(q[keep])
    a, b = np.concatenate(a or [np.array([], int)]), np.concatenate(b or [np.array([], int)])
    n = np.bincount(a, copies[b], len(ids)).astype(np.int64) + np.bincount(b, copies[a], len(ids)).astype(np.int64)
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), int)
    place[order] = np.arange(len(ids))
    low = order[forest(len(ids), place[a], place[b])[place]]
    linked = np.flatnonzero(n)
    return {"id": ids[linked], "n": n[linked], "low": ids[low[linked]]}


def deduplicate(vectors: DataFrame, cosine: float = 0.93, words: int | None = None, sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row. ``words`` per codebook follow the table unless given."""
    with passing_scratch(vectors.sparkSession) as keep:
        return keep(settle(_linked(vectors, cosine, words, sample, recall), "near-vectors"))


def _indexes(distinct: DataFrame, cosine: float, words: int | None, sample: int, recall: float) -> dict[int, Index]:
    """An index per frequent length, from a sample that is bounded in rows and bytes."""
    size = F.size("embedding")
    lengths = (
        distinct.groupBy("label", size.alias("size")).agg(F.count(F.lit(1)).alias("n")).groupBy("size").agg(F.max("n").alias("n"))
        .orderBy(F.desc("n"), "size").limit(LENGTHS).collect()
    )
    indexes = {}
    for r in lengths:
        rows = max(1, min(sample, SAMPLE_BYTES // (8 * r["size"])))
        drawn = distinct.filter(size == r["size"]).orderBy(F.xxhash64(F.lit("index"), "id"), "id").select("embedding").limit(rows)
        flat = drawn.toArrow().column("embedding").combine_chunks().flatten().to_numpy().astype(np.float64)
        x = flat.reshape(-1, r["size"])
        indexes[r["size"]] = fit_index(x, cosine, words or words_for(r["n"], len(x)), recall)
    return indexes


def _linked(vectors: DataFrame, cosine: float, words: int | None, sample: int, recall: float) -> DataFrame:
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.select("vec_id", "label", "embedding")
    keys = [F.xxhash64(F.lit(s), "label", "embedding").alias(f"k{s}") for s in (1, 2)]
    distinct = settle(
        rows.filter(usable()).groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")), "vectors")
    indexes = _indexes(distinct, cosine, words, sample, recall)
    shared = spark.sparkContext.broadcast(indexes)  # the codebooks

    def assign(batch):
        lists = batch.column("embedding")
        n = len(lists)
        own, cells, data = np.zeros(n, np.int32), [[0]] * n, [b""] * n
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy().astype(np.float64)
        starts = np.cumsum(lengths) - lengths
        for length in np.unique(lengths):
            chosen = np.flatnonzero(lengths == length)
            x = unit(flat[starts[chosen][:, None] + np.arange(length)])
            index = shared.value.get(int(length))
            if index is not None:
                for i, seen in zip(chosen, index.visits(x)):
                    own[i], cells[i] = seen[0], seen
            for i, v in zip(chosen, x):
                data[i] = v.tobytes()
        return {"id": batch.column("id"), "copies": batch.column("copies"), "label": batch.column("label"), "vec": data, "own": own, "cells": cells}

    named = distinct.withColumn("label", F.col("label").cast("string"))
    assigned = settle(map_batches(named, assign, ASSIGNED), "index")
    # Lengths never mix: they are part of the cell's key.
    space = ["label", F.length("vec").alias("size")]
    visits = assigned.select(*space, F.explode("cells").alias("cell")).groupBy("label", "size", "cell").agg(F.count(F.lit(1)).alias("v"))
    owned = assigned.groupBy(*space, F.col("own").alias("cell")).agg(F.count(F.lit(1)).alias("m"))
    blocks = owned.join(visits, ["label", "size", "cell"]).select(
        "label", "size", "cell", F.ceil(F.col("m") / MEMBERS).cast("int").alias("s"), F.ceil(F.col("v") / VISITORS).cast("int").alias("r"))
    kept = ["id", "copies", "label", "vec", "own", "cells", F.length("vec").alias("size")]
    deal = lambda n: F.pmod(F.xxhash64("id"), n).cast("int")
    each = lambda n: F.sequence(F.lit(0), n - 1)
    member = (
        assigned.select(*kept, F.col("own").alias("cell"), F.lit(True).alias("member")).join(blocks, ["label", "size", "cell"])
        .withColumn("s", deal(F.col("s"))).withColumn("r", F.explode(each(F.col("r"))))
    )
    visitor = (
        assigned.select(*kept, F.explode("cells").alias("cell"), F.lit(False).alias("member")).join(blocks, ["label", "size", "cell"])
        .withColumn("r", deal(F.col("r"))).withColumn("s", F.explode(each(F.col("s"))))
    )
    schema = "id bigint, n bigint, low bigint"

    def block(rows: pa.Table) -> pa.Table:
        return pa.table(_block(rows, cosine), schema=pa.schema([(c, pa.int64()) for c in ("id", "n", "low")]))

    both = member.unionByName(visitor)
    linked = settle(both.groupBy("label", "size", "cell", "s", "r").applyInArrow(block, schema), "linked")
    counts = linked.groupBy("id").agg(F.sum("n").alias("n"))
    groups = connected(linked.select(F.col("id").alias("a"), F.col("low").alias("b")))
    nodes = (
        distinct.select(*keys, "id", "copies").join(counts, "id", "left")
        .join(groups.withColumnRenamed("node", "id"), "id", "left")
        .select("k1", "k2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    keyed = rows.select("vec_id", usable().alias("_usable"), *keys)
    out = keyed.filter("_usable").join(nodes, ["k1", "k2"], "left").unionByName(keyed.filter("NOT _usable"), allowMissingColumns=True)
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.cast("bigint").alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
