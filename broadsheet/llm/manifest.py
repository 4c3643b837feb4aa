"""Merkle manifest of a dataset, with proofs made from a few stored levels.

Every row is a leaf: the digest of its encoded fields. The leaves of a source, in
the order of their ids, are hashed in runs of ``FAN`` until one node is left, the
subroot; the subroots, in the order of their sources, likewise give the root.

Only every ``STEP``-th level is stored. The nodes of a stored level are dealt in
aligned subtrees of ``FAN ** STEP``; a task folds one subtree and stores its top
alone. A proof needs the levels between as well: for each aligned subtree a task
makes them again from the stored nodes below, gives every node its siblings up to
the subtree's top, followed by the siblings above, and lets the rest go. Levels are
descended from the root, so that what is above is at hand. Tasks hold one subtree and
one path at a time, whatever the size of a source.

Places of leaves come from one sort by ranges of (source, id) that is written once;
counts per range give each leaf its number, so no source is ever in one task.

Null fields are encoded as such; empty and very long texts are like any other. Null
ids come first in their source, a null source first of all. Rows that share an id are
ordered by their leaf, equal rows are interchangeable and each is answered. An empty
table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from broadsheet.llm.frames import settle, ship
from broadsheet.session import passing_scratch

FAN = 16
#: Levels from one stored level to the next.
STEP = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(data: bytes) -> bytes:
    return sha256(data).hexdigest().encode()


def encoded(value: Column) -> Column:
    """A field as its byte count and its text, null as a dash."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


def numbered(rows: DataFrame, tree: str, order: Sequence[Column]) -> DataFrame:
    """Rows with their place ``n`` in their tree and the tree's size ``total``, written once.

    The random last key lets equal rows be dealt to several ranges.
    """
    keys = [F.col(tree), *order, F.rand(13)]
    at = F.monotonically_increasing_id()
    laid = settle(
        rows.repartitionByRange(*keys).sortWithinPartitions(*keys[:-1]).select("*", at.alias("_at"), F.spark_partition_id().alias("_part")), "laid")
    spans = laid.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    every = Window.partitionBy(tree)
    before = every.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        tree, "_part", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"), F.sum("_rows").over(every).alias("total"))
    placed = laid.join(spans, [tree, "_part"])
    return settle(placed.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("n"), "total"), "numbered")


def regrown(nodes: list[bytes], total: int, step: int) -> list[list[bytes]]:
    """The levels of an aligned subtree over ``nodes``; a tree that fits into it ends at its root."""
    levels = [nodes]
    while len(levels) <= step and not (total <= FAN**step and len(levels[-1]) == 1):
        low = levels[-1]
        levels.append([digest(b"".join(low[i:i + FAN])) for i in range(0, len(low), FAN)])
    return levels


def siblings(levels: list[list[bytes]], i: int) -> tuple[list[bytes], list[bytes]]:
    """What stands left and right of node ``i`` and of those above it, in their runs, below the subtree's top."""
    left, right = [], []
    for level in levels[:-1]:
        first = i // FAN * FAN
        left.append(b"".join(level[first:i]))
        right.append(b"".join(level[i + 1:first + FAN]))
        i //= FAN
    return left, right


def folded(node: bytes, left: Sequence[bytes], right: Sequence[bytes]) -> bytes:
    """The root that a node and the siblings along its path give."""
    for a, b in zip(left, right):
        node = digest(a + node + b)
    return node


@dataclass
class Forest:
    """Stored levels (tree, n, total, digest), lowest first, and the root of each tree with the stored level below it."""

    levels: list[DataFrame]
    roots: DataFrame  # tree, level, digest
    step: int


def _in_order(rows: pa.Table) -> tuple[pa.Table, list[bytes]]:
    rows = rows.sort_by("n")
    return rows, [d.encode() for d in rows.column("digest").to_pylist()]


def _block(step: int) -> Column:
    return F.floor(F.col("n") / F.lit(FAN**step)).cast("bigint").alias("block")


def grow(leaves: DataFrame, step: int = STEP) -> Forest:
    """Store every ``step``-th level over numbered leaves (tree, n, total, digest)."""
    ship(leaves.sparkSession)
    schema = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("total", pa.int64()), ("digest", pa.string()), ("done", pa.bool_())])

    def top(key: tuple, rows: pa.Table) -> pa.Table:
        total = rows.column("total")[0].as_py()
        levels = regrown(_in_order(rows)[1], total, step)
        done = total <= FAN**step
        return pa.table([[key[0].as_py()], [key[1].as_py()], [-(-total // FAN**step)], [levels[-1][0].decode()], [done]], schema=schema)

    levels, roots = [leaves], None
    while True:
        nodes = levels[-1].select("tree", "n", "total", "digest")
        up = settle(nodes.groupBy("tree", _block(step)).applyInArrow(top, "tree string, n bigint, total bigint, digest string, done boolean"), "merkle")
        ended = up.filter("done").select("tree", F.lit(len(levels) - 1).alias("level"), "digest")
        roots = ended if roots is None else roots.unionAll(ended)
        rest = up.filter("NOT done").drop("done")
        if rest.isEmpty():
            return Forest(levels, roots, step)
        levels.append(rest)


def descend(forest: Forest, tops: DataFrame) -> DataFrame:
    """Paths above the aligned subtrees of the lowest stored level: tree, block, subroot, left, right.

    ``tops`` has the path above each tree's root: tree, level, subroot, left, right.
    """
    step = forest.step
    names = ["tree", "block", "subroot", "left", "right"]
    schema = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("subroot", pa.string()), ("left", pa.list_(pa.string())), ("right", pa.list_(pa.string()))])

    def paths(nodes: pa.Table, above: pa.Table) -> pa.Table:
        total = nodes.column("total")[0].as_py() if nodes.num_rows else 0
        out: dict[str, list] = {c: [] for c in names}
        if total:
            nodes, digests = _in_order(nodes)
            levels = regrown(digests, total, step)
            up = above.to_pylist()[0]
            for i, n in enumerate(nodes.column("n").to_pylist()):
                left, right = siblings(levels, i)
                out["block"].append(n)
                out["left"].append([x.decode() for x in left] + up["left"])
                out["right"].append([x.decode() for x in right] + up["right"])
            out["tree"], out["subroot"] = [up["tree"]] * len(digests), [up["subroot"]] * len(digests)
        return pa.table(out, schema=schema)

    above = None
    for level in reversed(range(len(forest.levels))):
        here = tops.filter(F.col("level") == level).withColumn("block", F.lit(0).cast("bigint")).select(*names)
        above = here if above is None else above.unionAll(here)
        if level:
            nodes = forest.levels[level].withColumn("block", _block(step))
            above = settle(
                nodes.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
                .applyInArrow(paths, "tree string, block bigint, subroot string, left array<string>, right array<string>"), "paths")
    return above


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, key: str = "doc_id", tree: str = "source", step: int = STEP) -> tuple[DataFrame, Forest, Forest, str]:
    """Numbered leaves, the forest of the sources, the tree over their subroots, and the root.

    Leaves keep the key and the source's place among the trees: tree, n, total, digest, doc_id.
    """
    leaves = numbered(
        docs.select(encoded(F.col(tree)).alias("tree"), F.col(key).alias("doc_id"), leaf([F.col(f) for f in fields]).alias("digest"), *_tampered(fields, key)),
        "tree", [F.col("doc_id").asc_nulls_first(), F.col("digest")])
    sources = grow(leaves, step)
    value = F.when(F.col("of") != "-", F.expr("substr(of, instr(of, ':') + 1)"))
    ordered = numbered(
        sources.roots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "level", "digest"), "tree", [value.asc_nulls_first()])
    top = grow(ordered, step)
    root = top.roots.first()
    return leaves, sources, top, root.digest if root else digest(b"").decode()


def _tampered(fields: Sequence[str], key: str) -> list[Column]:
    """The leaf of a row whose text's capitals were made small, for every fifth key by checksum."""
    chosen = F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0
    changed = leaf([F.translate(F.col(f), UPPER, LOWER) if f == "text" else F.col(f) for f in fields])
    return [F.when(chosen, changed).alias("tampered")]


def audit(docs: DataFrame, step: int = STEP) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every row."""
    with passing_scratch(docs.sparkSession) as keep:
        leaves, sources, top, root = manifest(docs, step=step)
        none = F.array().cast("array<string>")
        start = top.roots.select("tree", "level", F.col("digest").alias("subroot"), none.alias("left"), none.alias("right"))
        # From the root to the subroots, and on to the leaves' subtrees.
        subroots = top.levels[0].withColumn("block", _block(step))
        tops = settle(_emit(subroots, descend(top, start), step, _handed_on, "tree string, level int, subroot string, left array<string>, right array<string>"), "tops")
        paths = descend(sources, tops)
        proven = _emit(
            leaves.withColumn("block", _block(step)), paths, step, _proven,
            "doc_id bigint, leaf string, subroot string, proof_sha256 string, folded_root string")
        return keep(settle(proven.select(
            "doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root",
            (F.col("folded_root") == root).alias("verified")), "audited"))


def _emit(nodes: DataFrame, paths: DataFrame, step: int, make: Callable[[pa.Table, list[list[bytes]], dict], dict], schema: str) -> DataFrame:
    """``make`` over each aligned subtree of a lowest level, with its regrown levels and the path above it."""
    ship(nodes.sparkSession)
    types = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "array<string>": pa.list_(pa.string())}
    arrow = pa.schema([(name, types[kind]) for name, kind in (c.split(" ") for c in schema.split(", "))])

    def run(rows: pa.Table, above: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return arrow.empty_table()
        rows, digests = _in_order(rows)
        levels = regrown(digests, rows.column("total")[0].as_py(), step)
        return pa.table(make(rows, levels, above.to_pylist()[0]), schema=arrow)

    return nodes.groupBy("tree", "block").cogroup(paths.groupBy("tree", "block")).applyInArrow(run, schema)


def _handed_on(rows: pa.Table, levels: list[list[bytes]], above: dict) -> dict:
    """The path above each source's root."""
    both = [siblings(levels, i) for i in range(rows.num_rows)]
    return {
        "tree": rows.column("of"), "level": rows.column("level"), "subroot": rows.column("digest"),
        "left": [[x.decode() for x in left] + above["left"] for left, _ in both],
        "right": [[x.decode() for x in right] + above["right"] for _, right in both],
    }


def _proven(rows: pa.Table, levels: list[list[bytes]], above: dict) -> dict:
    """Digest of each leaf's siblings, and the root that they give with the leaf or its tampered form."""
    up_left, up_right = ([x.encode() for x in above[side]] for side in ("left", "right"))
    rest = b"".join(a + b for a, b in zip(up_left, up_right))
    proofs, roots = [], []
    for i, changed in enumerate(rows.column("tampered").to_pylist()):
        left, right = siblings(levels, i)
        proofs.append(digest(b"".join(a + b for a, b in zip(left, right)) + rest).decode())
        roots.append(folded(changed.encode() if changed else levels[0][i], left + up_left, right + up_right).decode())
    return {
        "doc_id": rows.column("doc_id"), "leaf": rows.column("digest"), "subroot": [above["subroot"]] * rows.num_rows,
        "proof_sha256": proofs, "folded_root": roots,
    }
