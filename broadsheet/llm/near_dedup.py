"""Near-duplicate texts by b-bit MinHash.

A text's set holds its distinct shingles of five words. Of many hash minima over
the set the low bits are kept, packed into a signature; runs of whole minima make
the keys of bands. Texts that share a band are candidates, the share of equal
low-bit fields, counted by bit operations and corrected for chance collisions,
estimates their similarity, and what may reach the threshold is confirmed on the
full sets.

Equal sets are collapsed first. Two rounds find all links without emitting the
pairs of a group. In the first each set meets the smallest set of each of its
bands, which joins large groups of close copies in one step. In the second only
bands that still hold several components matter: their members are dealt into
blocks of bounded size, pairs are compared inside a task, and the task gives the
clusters of sets whose estimates allow a link across components. The full sets of
these clusters are then compared in a task, skipping pairs that are joined already.
Bands are compared in order, so that each pair is looked at in its first common
band alone.

A text without words, or null, has no set: 0 shingles, linked with nothing. With
fewer than five words the whole sequence is its one shingle. Rows that repeat, share
an id or have none are rows of their own; a group's id is its smallest, and null
where no row has one, whose rows then count as kept. An empty table gives an empty
table. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.components import connected, forest
from broadsheet.llm.frames import map_batches, settle, ship
from broadsheet.session import passing_scratch

WORDS = 5
#: Bands of ROWS minima: at similarity 0.85 a pair shares none in fewer than one of a million cases.
BANDS = 25
ROWS = 5
#: Minima of a band for thresholds below 85 %: 32 bands, at 0.8 missed by one pair in ten millions.
LOW_ROWS = 4
MINIMA = 128
BITS = 4
#: Standard errors below the threshold at which an estimate still counts.
SLACK = 5.0
#: Sets compared with each other in one task.
BLOCK = 512

_draw = np.random.default_rng(20)
MULTIPLIERS = _draw.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
SHIFTS = _draw.integers(0, 1 << 32, MINIMA, dtype=np.uint64).astype(np.uint32)
PLACES = _draw.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        out = self[word] = xxhash.xxh64_intdigest(word)
        return out


_HASHES = _WordHashes()


def shingles(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text in UTF-8."""
    # Both methods of bytes know ASCII only: A-Z, and the six white-space characters.
    words = np.fromiter(map(_HASHES.__getitem__, (text or b"").lower().split()), np.uint64)
    n = len(words) - WORDS + 1
    if n < 1:
        words = np.append(words, np.uint64(len(words)))[: len(words) + (len(words) > 0)]
        n = min(1, len(words))
        spread = [(words * PLACES[: len(words)]).sum(keepdims=True)] if n else []
    else:
        spread = [words[i:i + n] * PLACES[i] for i in range(WORDS)]
    if not n:
        return np.array([], np.uint64)
    h = sum(spread)
    h = (h ^ (h >> np.uint64(29))) * MIX
    return np.unique(h ^ (h >> np.uint64(32)))


def minima(s: np.ndarray) -> np.ndarray:
    """One minimum per hash function, the functions being maps of the upper 32 bits."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(out, (x[at:at + 2048, None] * MULTIPLIERS + SHIFTS).min(0), out=out)
    return out


def signature(m: np.ndarray) -> bytes:
    """The low BITS bits of every minimum, packed."""
    mixed = m ^ (m >> np.uint32(15))
    low = (mixed & np.uint32((1 << BITS) - 1)).astype(np.uint8).reshape(-1, 8 // BITS)
    return (low << (np.arange(8 // BITS, dtype=np.uint8) * BITS)).sum(1, dtype=np.uint8).tobytes()


def band_keys(m: np.ndarray, rows: int = ROWS) -> list[int]:
    bands = len(m) // rows
    raw = m[: bands * rows].reshape(bands, rows)
    return [xxhash.xxh64_intdigest(raw[b].tobytes(), seed=b) - (1 << 63) for b in range(bands)]


def band_rows(percent: int) -> int:
    return ROWS if percent >= 85 else LOW_ROWS


def least_equal(similarity: float) -> int:
    """Equal fields from which on a pair may reach ``similarity``.

    Fields are equal where the minima are, or by chance in one of 2^BITS others.
    """
    chance = 2.0**-BITS
    p = similarity + (1 - similarity) * chance
    return int(np.floor(MINIMA * p - SLACK * np.sqrt(MINIMA * p * (1 - p))))


# Field values that hold a bit, for words of 64 bits.
FIELDS = int("0001" * 16, 2)


def equal_fields(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal fields of packed signatures (rows of 64-bit words), by counting bits."""
    x = a ^ b
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return MINIMA - np.bitwise_count(x & np.uint64(FIELDS)).sum(-1, dtype=np.int32)


def _equal_fields(a: str, b: str) -> Column:
    """The same over two arrays of longs, in the JVM."""
    def unequal(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        z = z.bitwiseOR(F.shiftrightunsigned(z, 2))
        z = z.bitwiseOR(F.shiftrightunsigned(z, 1))
        return F.bit_count(z.bitwiseAND(F.lit(FIELDS).cast("bigint")))

    n = MINIMA * BITS // 64
    total = F.lit(0)
    for i in range(n):
        total = total + unequal(F.col(a)[i], F.col(b)[i])
    return F.lit(MINIMA) - total


def similar(a: int, b: int, common: int, percent: int) -> bool:
    return 100 * common >= percent * (a + b - common)


# A text is found again by its id and a digest: ids may repeat and be null.
HANDLE = ["doc_id", "digest"]


def _documents(docs: DataFrame) -> DataFrame:
    data = F.col("text").cast("binary")
    return docs.select("doc_id", F.xxhash64(data).alias("digest"), data.alias("data"))


def sketch(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """Per row: size and 128-bit digest of the set, its signature and its band keys."""
    schema = "doc_id bigint, digest bigint, n_shingles bigint, set_id binary, sig array<bigint>, bands array<bigint>"

    def make(batch):
        out = {c: [] for c in ("n_shingles", "set_id", "sig", "bands")}
        for data in batch.column("data").to_pylist():
            s = shingles(data)
            out["n_shingles"].append(len(s))
            out["set_id"].append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            m = minima(s) if len(s) else None
            out["sig"].append(np.frombuffer(signature(m), np.int64) if len(s) else None)
            out["bands"].append(band_keys(m, rows) if len(s) else None)
        return out | {c: batch.column(c) for c in HANDLE}

    return map_batches(_documents(docs), make, schema)


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, set for each ``wanted`` (node, w_id, w_digest) row."""
    keyed = _documents(docs).select(F.coalesce("doc_id", F.lit(0)).alias("w_id"), F.col("digest").alias("w_digest"), "data")
    found = keyed.join(wanted, ["w_id", "w_digest"])

    def make(batch):
        return {"node": batch.column("node"), "set": [shingles(d).tobytes() for d in batch.column("data").to_pylist()]}

    # Rows that repeat id and text give the same set more than once.
    return map_batches(found.select("node", "data"), make, "node bigint, set binary").dropDuplicates(["node"])


def _confirm(percent: int) -> Callable:
    def make(batch):
        keep = []
        for a, b in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            keep.append(similar(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True)), percent))
        a, b = (np.asarray(batch.column(c)) for c in ("a", "b"))
        return {"a": a[keep], "b": b[keep]}

    return make


def _clusters(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Clusters of a block's sets that estimates allow to be linked across components."""
    least, schema = least_equal(percent / 100), pa.schema([(c, pa.int64()) for c in ("node", "cluster", "group", "cell")])

    def make(rows: pa.Table) -> pa.Table:
        node, comp, size, band, part = (rows.column(c).to_numpy() for c in ("node", "comp", "n_shingles", "band", "part"))
        sig = rows.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(node), -1)
        keys = rows.column("bands").combine_chunks().flatten().to_numpy().reshape(len(node), -1)[:, : int(band[0])]
        left, right = rows.column("s")[0].as_py(), rows.column("r")[0].as_py()
        i, j = np.flatnonzero(part == left), np.flatnonzero(part == right)
        a, b = [], []
        for at in range(0, len(i), 64):
            p = i[at:at + 64]
            ok = (comp[p, None] != comp[j]) & (np.minimum(size[p, None], size[j]) * 100 >= percent * np.maximum(size[p, None], size[j]))
            if left == right:
                ok &= p[:, None] < j
            x, y = np.nonzero(ok)
            x, y = p[x], j[y]
            near = equal_fields(sig[x], sig[y]) >= least
            x, y = x[near], y[near]
            first = ~(keys[x] == keys[y]).any(1)
            a.append(x[first])
            b.append(y[first])
        a, b = np.concatenate(a), np.concatenate(b)
        label = forest(len(node), a, b)
        used = np.unique(np.concatenate([a, b]))
        key = int(xxhash.xxh64_intdigest(f"{rows.column('key')[0]}:{band[0]}:{left}:{right}".encode()) >> 1)
        return pa.table({"node": node[used], "cluster": label[used], "group": comp[used], "cell": np.full(len(used), key, np.int64)}, schema=schema)

    return make


def _links(percent: int) -> Callable[[pa.Table], pa.Table]:
    """A spanning forest of the links between a cluster's sets, beyond components known before."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def make(rows: pa.Table) -> pa.Table:
        node, group = rows.column("node").to_numpy(), rows.column("group").to_numpy()
        sets = [np.frombuffer(s, np.uint64) for s in rows.column("set").to_pylist()]
        root = {g: g for g in set(group.tolist())}

        def find(g: int) -> int:
            while root[g] != g:
                root[g] = root[root[g]]
                g = root[g]
            return g

        # Sets by shared hashes: one sort gives every set's places in a common numbering.
        flat = np.unique(np.concatenate(sets), return_inverse=True)[1]
        ends = np.cumsum([len(s) for s in sets])
        held = np.zeros(int(flat.max()) + 1, bool)
        size = np.array([len(s) for s in sets])
        a, b = [], []
        for x in range(1, len(sets)):
            mine = flat[ends[x] - size[x]:ends[x]]
            held[mine] = True
            common = np.add.reduceat(held[flat[: ends[x - 1]]].astype(np.int32), ends[:x] - size[:x])
            held[mine] = False
            for y in np.flatnonzero(100 * common >= percent * (size[x] + size[:x] - common)):
                p, q = find(group[x]), find(group[y])
                if p != q:
                    root[max(p, q)] = min(p, q)
                    a.append(node[x])
                    b.append(node[y])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())}, schema=schema)

    return make


def grouped(docs: DataFrame, percent: int) -> DataFrame:
    """doc_id, digest, n_shingles, set_id, group, component_id per row; null where there is no set or id."""
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    sketched = settle(sketch(docs, band_rows(percent)), "sketches")
    # One node per distinct set, with one row to find its text again by.
    place = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)).alias("w_id"), F.col("digest").alias("w_digest"))
    sets = settle(
        sketched.filter("set_id IS NOT NULL").groupBy("set_id").agg(
            F.min("doc_id").alias("least_id"), F.min(place).alias("place"), F.first("n_shingles").alias("n_shingles"),
            F.first("sig").alias("sig"), F.first("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id()), "sets")
    entries = sets.select("node", F.posexplode("bands").alias("band", "key"))
    shared = entries.groupBy("key").agg(F.min("node").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    shared = settle(entries.join(shared, "key"), "shared-bands")

    # First round: every set and the smallest of each of its bands.
    pairs = shared.filter("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    side = lambda c: sets.select(F.col("node").alias(c), F.col("sig").alias(f"sig_{c}"), F.col("n_shingles").alias(f"n_{c}"))
    sized = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    likely = pairs.join(side("a"), "a").join(side("b"), "b").filter(sized & (_equal_fields("sig_a", "sig_b") >= least_equal(percent / 100)))
    likely = settle(likely.select("a", "b"), "likely")

    # One pass over the texts fetches the full set of every node that shares a band.
    needed = shared.select("node").distinct()
    handles = sets.select("node", "place.w_id", "place.w_digest").join(needed, "node", "left_semi")
    held = settle(full_sets(docs, handles), "full-sets")
    both = likely.join(held.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a").join(
        held.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    first = settle(map_batches(both, _confirm(percent), "a bigint, b bigint"), "links-first")
    groups = connected(first)

    # Second round: bands that still hold more than one component.
    placed = shared.select("node", "key", "band").join(groups, "node", "left").select("node", "key", "band", F.coalesce("component", "node").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("n")).filter("low <> high")
    mixed = mixed.select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    members = placed.join(mixed, "key").join(sets.select("node", "n_shingles", "sig", "bands"), "node")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda o: F.struct(F.least(o, F.col("part")).alias("s"), F.greatest(o, F.col("part")).alias("r")))
    dealt = members.withColumn("part", part).withColumn("cell", F.explode(others)).select(
        "key", "band", "node", "comp", "n_shingles", "sig", "bands", "part", "cell.s", "cell.r")
    clusters = dealt.groupBy("key", "s", "r").applyInArrow(_clusters(percent), "node bigint, cluster bigint, group bigint, cell bigint")
    clusters = settle(clusters, "clusters")
    compared = clusters.join(held, "node")
    second = compared.groupBy("cell", "cluster").applyInArrow(_links(percent), "a bigint, b bigint")
    second = settle(second, "links-second")
    groups = connected(first.union(second))

    named = sets.select("set_id", "node", "least_id").join(groups, "node", "left").withColumn("group", F.coalesce("component", "node"))
    ids = named.groupBy("group").agg(F.min("least_id").alias("component_id"))
    named = named.join(ids, "group").select("set_id", "group", "component_id")
    return sketched.select("doc_id", "digest", "n_shingles", "set_id").join(named, "set_id", "left")


def deduplicate(docs: DataFrame, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row; links from ``percent`` % similarity."""
    with passing_scratch(docs.sparkSession) as keep:
        component = F.when(F.col("set_id").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return keep(settle(grouped(docs, percent).select(
            "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept")), "near-dups"))


def representatives(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of ``docs`` per group, that of the smallest id; texts without words are all kept.

    Of rows that repeat id and text one stays. Rows without an id stand back behind
    those with one.
    """
    place = F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0)).alias("_near_id"), F.col("digest").alias("_near_digest"))
    with passing_scratch(docs.sparkSession) as keep:
        rows = grouped(docs, percent).filter("set_id IS NOT NULL")
        kept = keep(settle(rows.groupBy("group").agg(F.min(place).alias("p")).select("p._near_id", "p._near_digest"), "kept"))
    keyed = docs.withColumns({"_near_id": F.coalesce("doc_id", F.lit(0)), "_near_digest": F.xxhash64(F.col("text").cast("binary"))})
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    # Already dealt and sorted by the two columns, so dropping repeats costs no shuffle.
    chosen = keyed.filter(worded).join(kept, ["_near_id", "_near_digest"], "left_semi").dropDuplicates(["_near_id", "_near_digest"])
    return chosen.unionByName(keyed.filter(~worded)).select(*docs.columns)
