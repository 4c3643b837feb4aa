"""Best-fit packing with a swap-based local search.

Documents become pieces of at most ``capacity`` tokens; only longer documents are
cut. Pieces are dealt evenly into groups of bounded size, each group is packed by
best fit decreasing, and then the emptiest bin is worked on: a document moves out
to another bin, or is exchanged for one or two smaller ones there, or two of its
documents for one. Every accepted step moves tokens from the emptiest bin to a
fuller one, so the sum of squared fills rises, until that bin is empty and is
dropped, or no step is left. A group that has reached ceil(tokens / capacity) bins
is left alone.

Only piece lengths travel; token ids stay in the task that made them.

Null and empty texts give one piece, the end mark alone. Repeated rows are packed
each for itself. An empty table gives an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from broadsheet.llm import wordbpe
from broadsheet.llm.frames import map_batches, map_stream, settle

CAPACITY = 2048
#: Pieces packed together; a group leaves at most about one bin that is not full.
GROUP = 40_000
#: Emptiest bins that the search tries to empty before it gives a group up.
VICTIMS = 8
END = b"\0\0\0\0"

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Bins:
    """Bins of (length, item) kept sorted, indexed by free space."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.items: list[list[tuple[int, int]]] = []
        self.free: list[int] = []
        self.by_free: dict[int, list[int]] = {}
        self.mask = 0  # bit f: a bin with f free tokens exists

    def _enter(self, b: int) -> None:
        f = self.free[b]
        self.by_free.setdefault(f, []).append(b)
        self.mask |= 1 << f

    def _leave(self, b: int) -> None:
        f = self.free[b]
        left = self.by_free[f]
        left.remove(b)
        if not left:
            self.mask ^= 1 << f

    def best(self, length: int) -> int | None:
        """A bin with the least free space that still takes ``length``."""
        fits = self.mask >> length
        if not fits:
            return None
        return self.by_free[length + (fits & -fits).bit_length() - 1][-1]

    def open(self) -> int:
        self.items.append([])
        self.free.append(self.capacity)
        self._enter(len(self.free) - 1)
        return len(self.free) - 1

    def change(self, b: int, add=(), drop=()) -> None:
        self._leave(b)
        for x in drop:
            self.items[b].remove(x)
        for x in add:
            insort(self.items[b], x)
        self.free[b] += sum(x[0] for x in drop) - sum(x[0] for x in add)
        self._enter(b)

    def retire(self, b: int) -> None:
        self._leave(b)


def pack(lengths: list[int], capacity: int = CAPACITY, victims: int = VICTIMS) -> list[list[int]]:
    """Indexes of ``lengths`` per bin; no length may exceed ``capacity``."""
    bins = _Bins(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        b = bins.best(lengths[i])
        bins.change(bins.open() if b is None else b, add=[(lengths[i], i)])
    live = set(range(len(bins.free)))
    least = -(-sum(lengths) // capacity)
    given_up: set[int] = set()
    while len(live) > least and len(given_up) < victims:
        open_bins = [b for b in live if bins.free[b] and b not in given_up]
        if len(open_bins) < 2:
            break
        victim = max(open_bins, key=lambda b: (bins.free[b], -b))
        targets = [b for b in live if bins.free[b] and b != victim]
        while bins.items[victim] and (step := _step(bins, victim, targets)):
            b, out, back = step
            bins.change(victim, add=back, drop=out)
            bins.change(b, add=out, drop=back)
        if bins.items[victim]:
            given_up.add(victim)
        else:
            bins.retire(victim)
            live.discard(victim)
            given_up.clear()
    return [[i for _, i in bins.items[b]] for b in sorted(live)]


def _step(bins: _Bins, victim: int, targets: list[int]):
    """The best move or exchange out of ``victim``: (bin, documents out, documents back)."""
    mine = bins.items[victim]
    fill = bins.capacity - bins.free[victim]
    best, gain = None, 0
    pairs = [(x[0] + y[0], x, y) for k, x in enumerate(mine[:40]) for y in mine[k + 1:40]]
    for b in targets:
        room = bins.free[b]
        # A step that moves d tokens raises the squared fills if d > fill(victim) - fill(b).
        lead = max(0, fill - (bins.capacity - room))
        if room <= gain or room <= lead:
            continue
        theirs = bins.items[b]
        for x in mine:
            if x[0] <= room:
                if x[0] > max(gain, lead):
                    best, gain = (b, [x], []), x[0]
                continue
            k = bisect_left(theirs, (x[0] - room, -1))
            if k < len(theirs) and x[0] - theirs[k][0] > max(gain, lead):
                best, gain = (b, [x], [theirs[k]]), x[0] - theirs[k][0]
            # Two smaller documents back for one.
            low = x[0] - room
            for y in theirs[:bisect_right(theirs, (x[0], 1 << 62))][:40]:
                k = bisect_left(theirs, (low - y[0], -1))
                while k < len(theirs) and theirs[k] == y:
                    k += 1
                if k < len(theirs):
                    d = x[0] - y[0] - theirs[k][0]
                    if max(gain, lead) < d <= room:
                        best, gain = (b, [x], [y, theirs[k]]), d
        for total, x, y in pairs:
            if total > room:
                k = bisect_left(theirs, (total - room, -1))
                if k < len(theirs) and total - theirs[k][0] > max(gain, lead):
                    best, gain = (b, [x, y], [theirs[k]]), total - theirs[k][0]
    return best


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: place in the document, length and checksum of its ids."""
    path = tokenizer or wordbpe.default_path()

    def run(batch):
        encoder = wordbpe.encoder(path)
        out = {"doc_id": [], "piece": [], "start": [], "length": [], "ids_crc32": []}
        step = 4 * capacity
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            ids = encoder.encode(text) + END
            for piece, at in enumerate(range(0, len(ids), step)):
                part = ids[at:at + step]
                out["doc_id"].append(doc)
                out["piece"].append(piece)
                out["start"].append(at // 4)
                out["length"].append(len(part) // 4)
                out["ids_crc32"].append(zlib.crc32(part))
        return out

    return map_batches(docs.select("doc_id", "text"), run, PIECES)


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, group: int = GROUP
) -> DataFrame:
    """Pieces of all documents with their sequence and their offset in it."""
    pieces = settle(cut_pieces(docs, tokenizer, capacity), "pieces")
    groups = max(1, -(-pieces.count() // group))
    schema = PIECES + ", sequence_id bigint, offset bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        held: list[pa.RecordBatch] = []
        rows = 0

        def packed():
            nonlocal first
            t = pa.Table.from_batches(held).sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending")])
            lengths = t.column("length").to_numpy()
            sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
            for k, members in enumerate(pack(lengths.tolist(), capacity)):
                sequence[members] = first + k
                offset[members] = np.cumsum(lengths[members]) - lengths[members]
            first += len(lengths)
            t = t.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))
            return t.combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= 2 * group:
                yield from packed()
                held, rows = [], 0
        if rows:
            yield from packed()

    # Dealt out in turn: groups are even whatever the documents are.
    return map_stream(pieces.repartition(groups), run, schema)
