"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Candidates and queries are packed into blocks of bounded size while they stream.
A shard is a bounded number of candidate blocks, and query blocks travel once per shard.
There every block of queries meets every block of candidates, by an equi-join on the shard
number that keeps one shard's candidates, one after the other. In a pair of blocks the candidates are turned into postings, one list of
(row, weight) per component; each query row scatters its components times the
postings into a dense array of scores. A partition selection keeps the k best of
the block for each query, and a ranked window, limited before its shuffle, merges
the blocks. Only k rows per query and block leave a task.

Scores are 64-bit integers and exact while they fit. Vectors that are null, hold
null or non-finite components, or have no id take no part. Shorter vectors count
as padded with zeros; empty vectors score 0. Equal scores go to the smaller id.
Rows that share an id are searched together and never match each other; repeated
equal query rows count once. Fewer than k candidates give fewer rows, an empty
table none. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.frames import map_stream, settle
from broadsheet.plans.ordered import first_rows

CANDIDATES = 512
QUERIES = 128
#: Candidate blocks a shard holds at most; queries travel once per shard.
SHARD = 64
SCALE = 1024


def quantised(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """id and integer components of the vectors that take part."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.filter(F.col(id_col).isNotNull() & F.col(vector).isNotNull() & finite)
        .select(F.col(id_col).alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("bigint")).alias("v"))
    )


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    lengths = np.diff(vectors.offsets.to_numpy())
    out = np.zeros((len(vectors), max(lengths, default=0)), np.int64)
    flat = vectors.flatten().to_numpy()
    out[np.arange(out.shape[1]) < lengths[:, None]] = flat
    return out


def blocks(vectors: DataFrame, size: int) -> DataFrame:
    """Rows (block, ids, values) of at most ``size`` vectors each."""
    schema = "block bigint, ids binary, vals binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                m = _matrix(part.column("v"))
                ids = part.column("id").to_numpy().astype(np.int64)
                yield pa.RecordBatch.from_pydict({"block": pa.array([block], pa.int64()), "ids": [ids.tobytes()], "vals": [m.tobytes()]})
                block += 1

    return map_stream(vectors, run, schema)


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of all candidates for each query row, one component at a time."""
    scores = np.zeros((len(queries), len(candidates)), np.int64)
    for term in range(min(queries.shape[1], candidates.shape[1])):
        weights = candidates[:, term]
        asked = np.flatnonzero(queries[:, term])
        posted = np.flatnonzero(weights)
        if len(asked) == len(queries) and len(posted) == len(candidates):
            scores += np.outer(queries[:, term], weights)
        elif len(asked) and len(posted):
            scores[np.ix_(asked, posted)] += np.outer(queries[asked, term], weights[posted])
    return scores


def select(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k best candidates; equal scores go to the smaller id."""
    at = np.flatnonzero(ids != own)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def shards_of(n_blocks: int) -> int:
    """Shards for a table: each holds the square root of all blocks, so that small tables are spread too, up to its bound."""
    return max(1, math.ceil(n_blocks / max(1, min(SHARD, math.isqrt(n_blocks)))))


def search(candidates: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of ``candidates`` (id, v) per query (id, v)."""
    stored = settle(blocks(candidates, CANDIDATES), "candidate-blocks")
    shards = shards_of(stored.count())
    shard: Column = F.pmod(F.xxhash64("block"), F.lit(shards))
    left = blocks(queries.distinct(), QUERIES).select(
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(shards - 1).cast("bigint"))).alias("shard"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"))
    pairs = left.join(stored.select(shard.alias("shard"), "ids", "vals"), "shard").drop("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                q_ids, q, c_ids, c = (np.frombuffer(batch.column(n)[row].as_buffer(), np.int64) for n in ("q_ids", "q_vals", "ids", "vals"))
                scores = accumulate(q.reshape(len(q_ids), -1), c.reshape(len(c_ids), -1))
                best = [select(s, c_ids, own, k) for s, own in zip(scores, q_ids)]
                n = [len(b) for b in best]
                yield pa.RecordBatch.from_pydict({
                    "query_id": np.repeat(q_ids, n), "vec_id": np.concatenate([c_ids[b] for b in best]),
                    "score": np.concatenate([s[b] for s, b in zip(scores, best)])})

    found = map_stream(pairs, run, "query_id bigint, vec_id bigint, score bigint")
    ranked = first_rows(found, ["query_id"], [F.col("score").desc(), F.col("vec_id")], k, rank="rank")
    return ranked.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
