"""Language-model scores by a probabilistic suffix tree over the symbols of words.

The tokens of a text are its lower-cased words and one end. They are spelled out as
symbols, bytes with one blank between words and one end symbol, so a text's
probability is that of its symbols. Contexts of up to ``DEPTH`` symbols predict the
next one. They are grown level by level over all training texts: a context is counted
with what follows it if it stands in at least ``LEAST`` places and in the share
``SHARE`` of all places, which bounds a level to ``1 / SHARE`` contexts whatever the
corpus. A context is kept if its next symbols diverge from those of the context without its
first symbol: the likelihood ratio must pass a chi-squared test and the divergence per
place a least value. Suffixes of kept contexts are kept. The distribution of a context
is smoothed by that of its suffix, down to single symbols counted with one more each;
the more different symbols follow a context, the more the suffix weighs. A symbol is scored in the
longest kept suffix of what stands before it.

A pass over the texts counts two levels: tasks follow the contexts known so far, sum in
arrays and send one row per context and next symbol; the driver gets the sums of these
levels, bounded as above, and holds only the pairs of a context and a symbol that occur. The last pass scores the texts and cuts its input into
blocks. The words of a block, each once, fetch their counts over the whole corpus by a
shuffle and come back to the block, so the base score needs neither a broadcast
vocabulary nor a row per token. Words meet by 64 bits of a hash.

Null texts are empty; an empty text is one end. Texts are worked on whole, in pieces
cut at white space. Rows may repeat and each is answered; a null id counts as a training
row. Without a training text every symbol is equally likely. An empty table gives an
empty table. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.frames import map_stream, settle, slices
from broadsheet.llm.language_id import held_out
from broadsheet.session import passing_scratch

DEPTH = 8
#: Share of all places, and places, that a context must stand in.
SHARE = 1 / 200_000
LEAST = 16
#: Divergence in nats per place, and the normal quantile of the test, that keep a context.
DIVERGENCE = 0.02
QUANTILE = 3.0
END = 10
SYMBOLS = 256
#: Contexts whose counts the driver has as a table of all symbols at a time.
ROWS = 1 << 12
#: Bytes of a piece of a text, symbols that are worked on at a time, tokens and bytes of a block.
PIECE = 1 << 16
CHUNK = 1 << 16
BLOCK_TOKENS = 1 << 20
BLOCK_BYTES = 1 << 23

#: Capitals to small letters, white space to blanks.
SPELLED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\x09\x0A\x0B\x0C\x0D", b"abcdefghijklmnopqrstuvwxyz     ")


def pieces(text: str | None, size: int = PIECE) -> Iterator[bytes]:
    """A text in lower case in pieces of about ``size`` bytes, each of words and blanks. All but the first start with a blank."""
    data = (text or "").encode("utf-8", "surrogatepass").translate(SPELLED)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + size)
        end = end if end >= 0 else len(data)
        if piece := data[at:end].rstrip(b" "):
            yield piece
        at = end


def single_blanks(data: bytes, before: int = END) -> np.ndarray:
    """Symbols with one blank between words and none at the ends of texts; ``before`` is what stood last."""
    symbols = np.frombuffer(data, np.uint8)
    blank = symbols == 32
    idle = np.empty(len(symbols), bool)
    idle[:1] = before in (32, END)
    idle[1:] = blank[:-1] | (symbols[:-1] == END)
    symbols = symbols[~(blank & idle)]
    last = np.empty(len(symbols), bool)
    last[-1:] = False
    last[:-1] = symbols[1:] == END
    return symbols[~(last & (symbols == 32))]


def runs(texts: Iterable[str | None], depth: int, size: int = CHUNK) -> Iterator[tuple[np.ndarray, int]]:
    """Symbols of the texts end to end, in runs; the first few of a run are only the context of the next."""
    parts, held = [], 0
    lead = np.zeros(0, np.uint8)

    def run() -> np.ndarray:
        return np.concatenate([lead, single_blanks(b"".join(parts), lead[-1] if len(lead) else END)])

    for text in texts:
        for piece in pieces(text):
            parts.append(piece)
            held += len(piece)
            if held >= size:
                symbols = run()
                yield symbols, len(lead)
                parts, held, lead = [], 0, symbols[-depth:]
        parts.append(b"\n")
        held += 1
    if parts:
        yield run(), len(lead)


@dataclass
class Trie:
    """Contexts by level; those of a level are numbered by their prefix and last symbol."""

    code: np.ndarray  # of each byte; bytes not seen in training share the last one
    width: int
    #: Per level from 1: number of the context by the prefix's number and the last symbol's code; the
    #: number after the last stands for none.
    steps: list[np.ndarray] = field(default_factory=list)
    sizes: list[int] = field(default_factory=lambda: [1])

    def __getstate__(self) -> tuple:
        # What is broadcast: a prefix and a symbol per context, not the tables of all symbols.
        levels = [np.nonzero(step[:-1] < size) for step, size in zip(self.steps, self.sizes[1:])]
        return self.code, self.width, [(prefixes.astype(np.int32), codes.astype(np.int16)) for prefixes, codes in levels]

    def __setstate__(self, state: tuple) -> None:
        self.code, self.width, levels = state
        self.steps, self.sizes = [], [1]
        for prefixes, codes in levels:
            self.add(prefixes, codes)

    def contexts(self, symbols: np.ndarray) -> Iterator[np.ndarray]:
        """For each level from 1: the number of the context before each symbol."""
        code = self.code.take(symbols[:-1])
        now = np.zeros(len(symbols), np.int64)
        for level, step in enumerate(self.steps, 1):
            after = np.empty(len(symbols), np.int64)
            after[:1] = self.sizes[level]
            now = now[:-1] * self.width
            now += code
            after[1:] = step.ravel().take(now, mode="clip")
            now = after
            yield now

    def add(self, prefixes: np.ndarray, codes: np.ndarray) -> None:
        """Another level, of the contexts that end a context of the last level by a symbol."""
        step = np.full((self.sizes[-1] + 1, self.width), len(prefixes), np.int32)
        step[prefixes, codes] = np.arange(len(prefixes))
        self.steps.append(step)
        self.sizes.append(len(prefixes))


@dataclass
class Counts:
    """How often each symbol follows each context of a level; pairs that never stand together take no room."""

    keys: np.ndarray  # number of the context by the width, and the symbol's code; ascending
    n: np.ndarray
    width: int

    @classmethod
    def of(cls, table: np.ndarray) -> Counts:
        keys = np.flatnonzero(table)
        return cls(keys, table.ravel()[keys], table.shape[1])

    def rows(self, contexts: np.ndarray) -> np.ndarray:
        """The counts of some contexts as a table."""
        first, end = (np.searchsorted(self.keys, c * self.width) for c in (contexts, contexts + 1))
        many = end - first
        row = np.repeat(np.arange(len(contexts)), many)
        at = np.arange(len(row)) + np.repeat(first - (np.cumsum(many) - many), many)
        table = np.zeros((len(contexts), self.width), np.int64)
        table[row, self.keys[at] % self.width] = self.n[at]
        return table

    def only(self, contexts: np.ndarray, size: int) -> Counts:
        """Some of ``size`` contexts, named in ascending order and numbered anew."""
        number = np.full(size, -1)
        number[contexts] = np.arange(len(contexts))
        number = number[self.keys // self.width]
        known = number >= 0
        return Counts(number[known] * self.width + self.keys[known] % self.width, self.n[known], self.width)


@dataclass
class Model:
    trie: Trie
    #: Per level from 0: the row of the longest kept suffix of each context, and -1 for none.
    rows: list[np.ndarray]
    logs: np.ndarray  # log10 of the next symbol by row and code

    def scores(self, symbols: np.ndarray) -> np.ndarray:
        """log10 of each symbol's chance after what stands before it."""
        row = np.zeros(len(symbols), np.int64)
        for level, context in enumerate(self.trie.contexts(symbols), 1):
            own = self.rows[level].take(context, mode="clip")
            np.copyto(row, own, where=own >= 0)
        return self.logs.ravel().take(row * self.trie.width + self.trie.code[symbols])


def _sums(docs: DataFrame, find: Callable[[np.ndarray, int], tuple[np.ndarray, int]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each key stands in what ``find`` makes of all texts: keys of a run, and how many there can be. Ascending."""
    arrow = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches):
        total = None
        for symbols, lead in runs((t for batch in slices(batches) for t in batch.column("text").to_pylist()), depth):
            keys, size = find(symbols, lead)
            # A task reads far fewer symbols than 32 bits count.
            total = np.zeros(size, np.uint32) if total is None else total
            np.add.at(total, keys, np.uint32(1))
        if total is not None:
            used = np.flatnonzero(total)
            for at in range(0, len(used), 1 << 16):
                part = used[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part], pa.int64())], schema=arrow)

    found = map_stream(docs.select("text"), run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    order = np.argsort(found.column("key").to_numpy())
    return found.column("key").to_numpy()[order], found.column("n").to_numpy()[order]


def _pairs(symbols: np.ndarray, lead: int) -> tuple[np.ndarray, int]:
    """Keys of single symbols, behind those of symbols with the one before them."""
    before, after = symbols[:-1].astype(np.int64), symbols[1:].astype(np.int64)
    pairs = (before * SYMBOLS + after)[max(0, lead - 1):]
    return np.concatenate([pairs, SYMBOLS * SYMBOLS + symbols[lead:].astype(np.int64)]), SYMBOLS * (SYMBOLS + 1)


def _levels(shared: Broadcast, first: int):
    """Keys of the contexts of a broadcast trie from level ``first`` on with the next symbol's code, level by level."""

    def find(symbols: np.ndarray, lead: int) -> tuple[np.ndarray, int]:
        trie = shared.value
        keys, before = [], 0
        for level, now in enumerate(trie.contexts(symbols), 1):
            if level >= first:
                known = np.flatnonzero(now[lead:] < trie.sizes[level]) + lead
                keys.append(before + now[known] * trie.width + trie.code[symbols[known]])
                before += trie.sizes[level] * trie.width
        return np.concatenate(keys), before

    return find


def fit(docs: DataFrame, depth: int = DEPTH, share: float = SHARE, least: int = LEAST, divergence: float = DIVERGENCE, quantile: float = QUANTILE) -> Model:
    """Grow the tree over all ``docs`` (text), keep what diverges, smooth.

    Counts of a level tell the contexts of the next. A pass counts these and, one level
    deeper, all that can be frequent: contexts whose first and last symbols but one are.
    """
    keys, n = _sums(docs, _pairs, 1)
    pairs = np.zeros(SYMBOLS * (SYMBOLS + 1), np.int64)
    pairs[keys] = n
    single = pairs[SYMBOLS * SYMBOLS:]
    seen = np.flatnonzero(single)
    code = np.full(SYMBOLS, len(seen), np.int64)
    code[seen] = np.arange(len(seen))
    trie = Trie(code, len(seen) + 1)
    counts = [Counts.of(np.append(single[seen], 0)[None, :])]
    bound = max(least, math.ceil(share * int(single.sum())))

    def grow() -> int:
        """Add the next level; a text ends at its end symbol, which is never part of a context."""
        prefixes, codes = np.divmod(counts[-1].keys, trie.width)
        often = (counts[-1].n >= bound) & (codes != code[END])
        trie.add(prefixes[often], codes[often])
        return trie.sizes[-1]

    if depth and grow():
        table = np.zeros((trie.sizes[1], trie.width), np.int64)
        table[:, :-1] = pairs[:SYMBOLS * SYMBOLS].reshape(SYMBOLS, SYMBOLS)[seen[np.nonzero(trie.steps[0][0] < trie.sizes[1])[0]]][:, seen]
        counts.append(Counts.of(table))
    while trie.sizes[-1] and len(trie.steps) < depth and grow():
        level = len(trie.steps)
        ahead = Trie(trie.code, trie.width, list(trie.steps), list(trie.sizes))
        if level < depth:
            ahead.add(*np.nonzero(trie.steps[-1][suffixes(trie)[-1]] < trie.sizes[-1]))
        shared = docs.sparkSession.sparkContext.broadcast(ahead)  # at most 1 / share contexts a level, and their next symbols
        keys, n = _sums(docs, _levels(shared, level), depth)
        shared.destroy()
        own = int(np.searchsorted(keys, trie.sizes[level] * trie.width))
        counts.append(Counts(keys[:own], n[:own], trie.width))
        if level < depth and grow():
            # The deeper contexts that are frequent indeed.
            chosen = ahead.steps[-1][np.nonzero(trie.steps[-1][:-1] < trie.sizes[-1])]
            deeper = Counts(keys[own:] - trie.sizes[level] * trie.width, n[own:], trie.width)
            counts.append(deeper.only(chosen, ahead.sizes[-1]))
    return smoothed(trie, counts, divergence, quantile)


def suffixes(trie: Trie) -> list[np.ndarray]:
    """Per level from 1: the number, one level up, of each context without its first symbol."""
    out = [np.zeros(trie.sizes[1], np.int64)] if trie.steps else []
    for level in range(2, len(trie.steps) + 1):
        step, above = trie.steps[level - 1], trie.steps[level - 2]
        prefixes, codes = np.nonzero(step[:-1] < trie.sizes[level])
        suffix = np.empty(trie.sizes[level], np.int64)
        suffix[step[prefixes, codes]] = above[out[-1][prefixes], codes]
        out.append(suffix)
    return out


def diverging(table: np.ndarray, base: np.ndarray, divergence: float, quantile: float) -> np.ndarray:
    """Which rows of counts are not drawn from the distribution of their row of ``base``."""
    n, m = (np.maximum(t.sum(1, keepdims=True), 1) for t in (table, base))
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(table > 0, table * np.log((table / n) / (base / m)), 0.0).sum(1)
    free = np.maximum((base > 0).sum(1) - 1, 1)
    spread = 2 / (9 * free)
    # The chi-squared quantile by the cube of a normal one.
    needed = free * (1 - spread + quantile * np.sqrt(spread)) ** 3
    return (2 * gain >= needed) & (gain >= divergence * n[:, 0])


def smoothed(trie: Trie, counts: list[Counts], divergence: float, quantile: float) -> Model:
    """Kept contexts, and the distribution of each after that of its suffix. Tables of all symbols are made of some contexts at a time."""
    shorter = suffixes(trie)

    def some(level: int) -> Iterator[np.ndarray]:
        for at in range(0, trie.sizes[level], ROWS):
            yield np.arange(at, min(at + ROWS, trie.sizes[level]))

    keep = [np.ones(1, bool)]
    for level in range(1, len(counts)):
        keep.append(np.zeros(trie.sizes[level], bool))
        for part in some(level):
            keep[level][part] = diverging(counts[level].rows(part), counts[level - 1].rows(shorter[level - 1][part]), divergence, quantile)
    for level in range(len(keep) - 1, 0, -1):
        keep[level - 1][shorter[level - 1][keep[level]]] = True
    # One more of each of all symbols; the last column is any one of those not seen.
    single = counts[0].rows(np.zeros(1, np.int64))
    chances = (single + 1) / (single.sum() + SYMBOLS)
    rows, logs = [np.array([0, -1])], [np.log10(chances).astype(np.float32)]
    at = 1
    for level in range(1, len(keep)):
        suffix, here = shorter[level - 1], np.empty((trie.sizes[level], trie.width))
        for part in some(level):
            table, below, own = counts[level].rows(part), chances[suffix[part]], keep[level][part]
            weight = np.maximum((table > 0).sum(1, keepdims=True), 1)
            here[part] = np.where(own[:, None], (table + weight * below) / (table.sum(1, keepdims=True) + weight), below)
            logs.append(np.log10(here[part[own]]).astype(np.float32))
        place = np.where(keep[level], at + np.cumsum(keep[level]) - 1, rows[-1][suffix])
        at += int(keep[level].sum())
        chances = here
        rows.append(np.append(place, -1))
    # A last level without a context has no counts.
    rows += [np.array([-1])] * (len(trie.steps) + 1 - len(rows))
    return Model(trie, rows, np.concatenate(logs))


@dataclass
class Block:
    """What a task has read since it last sent a block on."""

    words: defaultdict[bytes, int] = field(default_factory=lambda: defaultdict(count().__next__))  # places by first use
    parts: list[tuple] = field(default_factory=list)  # row, doc_id, held out, ids, symbols
    tokens: int = 0
    bytes: int = 0


PART = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, score double, ids binary"
WORD = "word bigint, place int, train bigint"


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


def _blocks(shared: Broadcast):
    """Scored parts of texts with their words as places in the block, and the block's words."""
    arrow = pa.schema([
        ("block", pa.int64()), ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("score", pa.float64()),
        ("ids", pa.binary()), ("word", pa.int64()), ("place", pa.int32()), ("train", pa.int64())])

    def sent(block: Block, number: int, lead: bytes) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        depth = max(1, len(model.trie.steps))
        sums, at = [], 0
        while at < len(block.parts):
            # As many parts at a time as make a run of symbols.
            size, end = 0, at
            while end < len(block.parts) and size < CHUNK:
                size += len(block.parts[end][4])
                end += 1
            data = b"".join([lead, *[p[4] for p in block.parts[at:end]]])
            found = model.scores(np.frombuffer(data, np.uint8))[len(lead):]
            starts = np.cumsum([0, *[len(p[4]) for p in block.parts[at:end - 1]]])
            sums.append(np.add.reduceat(found, starts, dtype=np.float64))
            lead, at = data[-depth:], end
        ids = [p[3] for p in block.parts]
        training = [i for i, p in zip(ids, block.parts) if not p[2]]
        train = np.bincount(np.concatenate(training), minlength=len(block.words)) if training else np.zeros(len(block.words), np.int64)
        columns = {
            "row": [p[0] for p in block.parts], "doc_id": [p[1] for p in block.parts], "held_out": [p[2] for p in block.parts],
            "n_tokens": [len(i) for i in ids], "score": np.concatenate(sums), "ids": [i.tobytes() for i in ids]}
        yield _batch(arrow, len(ids), columns | {"block": np.full(len(ids), number)})
        words = list(block.words)
        for at in range(0, len(words), 1 << 16):
            some = words[at:at + (1 << 16)]
            yield _batch(arrow, len(some), {
                "block": np.full(len(some), number), "word": [word_key(w) for w in some], "place": np.arange(at, at + len(some), dtype=np.int32),
                "train": train[at:at + len(some)]})

    def run(batches):
        first = TaskContext.get().partitionId() << 40
        row, number, block, lead = first, first, Block(), b""
        for batch in slices(batches):
            for doc_id, held, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
                between = b""
                for piece in pieces(text):
                    words = piece.split()
                    ids = np.fromiter(map(block.words.__getitem__, words), np.int32, len(words))
                    block.parts.append((row, doc_id, held, ids, between + b" ".join(words)))
                    between = b" "
                    block.tokens += len(ids)
                    block.bytes += len(block.parts[-1][4])
                    if block.tokens >= BLOCK_TOKENS or block.bytes >= BLOCK_BYTES:
                        yield from sent(block, number, lead)
                        lead = (lead + block.parts[-1][4])[-max(1, len(shared.value.trie.steps)):]
                        number, block = number + 1, Block()
                # The end is the empty word: no word is empty.
                block.parts.append((row, doc_id, held, np.array([block.words[b""]], np.int32), b"\n"))
                row += 1
        if block.parts:
            yield from sent(block, number, lead)

    return run


def _batch(schema: pa.Schema, n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def score(docs: DataFrame, model: Model, held: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # at most 1 / SHARE contexts a level
    with passing_scratch(spark) as keep:
        made = settle(map_stream(docs.select("doc_id", held.alias("held_out"), "text"), _blocks(shared), f"block bigint, {PART}, {WORD}"), "blocks")
        shared.destroy()  # what the tasks made of it is written
        words = made.filter(F.col("word").isNotNull())
        counts = settle(words.groupBy("word").agg(F.sum("train").alias("c")), "word-counts")
        size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
        total, all_ = size.n, size.n + size.v + 1
        fetched = words.select(F.col("block").alias("of"), "word", "place").join(counts, "word").select("of", "place", "c")
        parts = made.filter(F.col("row").isNotNull()).select("block", *[c.split(" ")[0] for c in PART.split(", ")])
        arrow = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                           ("base_score", pa.float64()), ("score", pa.float64())])

        def summed(parts: pa.Table, found: pa.Table) -> pa.Table:
            c = np.zeros(found.num_rows, np.int64)
            c[found.column("place").to_numpy()] = found.column("c").to_numpy()
            logs, known = np.log10((c + 1) / all_), c > 0
            ids = [np.frombuffer(b, np.int32) for b in parts.column("ids").to_pylist()]
            return pa.table({
                **{name: parts.column(name) for name in ("row", "doc_id", "held_out", "n_tokens")},
                "n_known": [int(known[i].sum()) for i in ids], "base_score": [float(logs[i].sum()) for i in ids], "score": parts.column("score")}, schema=arrow)

        scored = parts.groupBy("block").cogroup(fetched.groupBy("of")).applyInArrow(
            summed, "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double")
        # A text's parts come together again.
        whole = scored.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("held_out").alias("held_out"),
            *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
        return keep(settle(whole.select(
            "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score"), "scored"))


def evaluate(docs: DataFrame, parts: int = 7, part: int = 2, **growing) -> DataFrame:
    """Scores of all rows by a tree over those whose id's checksum is not ``part`` modulo ``parts``."""
    held = F.coalesce(held_out(F.col("doc_id"), parts, part), F.lit(False))
    return score(docs, fit(docs.filter(~held), **growing), held)
