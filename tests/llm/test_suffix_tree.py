"""Suffix-tree scores against a plain tree of strings."""

import math
import pickle
import re
import tracemalloc
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from broadsheet.llm import suffix_tree as S

SCHEMA = "doc_id bigint, text string, lang string"
PARAMETERS = {"depth": 4, "share": 1 / 400, "least": 6, "divergence": 0.02, "quantile": 1.0}


def words(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())


def held(i):
    return i is not None and crc32(str(i).encode()) % 7 == 2


class Tree:
    """Counts of every context in a dictionary; kept contexts by the same tests."""

    def __init__(self, texts, depth, share, least, divergence, quantile):
        spelled = [b" ".join(words(t)) + b"\n" for t in texts]
        self.after = defaultdict(Counter)
        for s in spelled:
            for i in range(len(s)):
                for d in range(min(i, depth) + 1):
                    self.after[s[i - d:i]][s[i]] += 1
        places = sum(map(len, spelled))
        bound = max(least, math.ceil(share * places))
        grown = {c for c, n in self.after.items() if c and sum(n.values()) >= bound}
        self.kept = {b""}
        for c in grown:
            if self.diverges(self.after[c], self.after[c[1:]], divergence, quantile):
                self.kept |= {c[k:] for k in range(len(c))}
        self.depth, self.places = depth, places

    @staticmethod
    def diverges(own, base, divergence, quantile):
        n, m = sum(own.values()), sum(base.values())
        gain = sum(c * math.log(c / n / (base[a] / m)) for a, c in own.items())
        free = max(1, len(base) - 1)
        spread = 2 / (9 * free)
        return 2 * gain >= free * (1 - spread + quantile * math.sqrt(spread)) ** 3 and gain >= divergence * n

    def chance(self, context, a):
        if not context:
            return (self.after[b""][a] + 1) / (self.places + 256)
        own = self.after[context]
        return (own[a] + len(own) * self.chance(context[1:], a)) / (sum(own.values()) + len(own))

    def score(self, text):
        s, out = b" ".join(words(text)) + b"\n", 0.0
        for i in range(len(s)):
            context = s[max(0, i - self.depth):i]
            while context not in self.kept:
                context = context[1:]
            out += math.log10(self.chance(context, s[i]))
        return out


def plain(rows, **parameters):
    training = [t for i, t, *_ in rows if not held(i)]
    tree = Tree(training, **parameters)
    counts = Counter(w for t in training for w in [*words(t), b""])
    total = sum(counts.values())
    out = []
    for i, t, *_ in rows:
        tokens = [*words(t), b""]
        base = sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in tokens)
        out.append((i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), total, base, tree.score(t)))
    return out


def same(df, want):
    got = [tuple(r) for r in df.collect()]
    assert len(got) == len(want)
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:5], round(r[5], 3))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-5)


def rows():
    r = np.random.default_rng(5)
    some = ["the", "then", "there", "other", "Über", "naïve", "banana", "bandana", "x1"]
    out = [(i, " ".join(r.choice(some, int(r.integers(1, 40)))), "en") for i in range(150)]
    out += [(200 + i, "Copy of one text\tagain\nand again", "en") for i in range(60)]
    return out + [(400, None, None), (401, "", ""), (402, " \t\n", "en"), (3, "the the", "en"), (3, "the the", "en"), (None, "no id", "en"),
                  (403, "ZZ € unseen 漢字", "de"), (404, "word\x0bword\x0cword    ", "de"), (405, "y" * 3000, "en")]


def test_scores(spark):
    data = rows()
    df = spark.createDataFrame([(*r, 1, "x") for r in data], SCHEMA + ", n_tokens int, block string").repartition(3)
    same(S.evaluate(df, **PARAMETERS), plain(data, **PARAMETERS))


def test_pieces_and_blocks_change_nothing(spark, monkeypatch):
    """Small pieces, runs and blocks: texts are cut, scored in parts and put together again."""
    data = rows()[:40] + [(900, "the banana " * 400, "en"), (901, "there " * 300, "en"), (900, "the banana " * 400, "en")]
    model = S.fit(spark.createDataFrame([r for r in data if not held(r[0])], SCHEMA), **PARAMETERS)
    want = plain(data, **PARAMETERS)
    # Sizes are read when a task runs, in this process as well as in workers, so the driver's functions are tried here.
    monkeypatch.setattr(S, "PIECE", 50)
    for text in ("the banana " * 400, "a", "", None, "y" * 500 + " z", " \t lead", "end \n " + " " * 300, " " * 300 + "x" + " " * 300 + "z\n\n"):
        assert [w for p in S.pieces(text, 50) for w in p.split()] == words(text)
        whole = b"".join(d.tobytes()[lead:] for d, lead in S.runs([text, "x y", text], 4, 64))
        assert whole == b"".join(b" ".join(words(t)) + b"\n" for t in (text, "x y", text))
    symbols = np.frombuffer((" ".join(["the banana"] * 400) + "\n").encode(), np.uint8)
    at_once = model.scores(symbols).sum(dtype=np.float64)
    cut = sum(model.scores(d)[lead:].sum(dtype=np.float64) for d, lead in S.runs(["the banana " * 400], 4, 64))
    assert cut == pytest.approx(at_once) == pytest.approx(want[40][6], rel=1e-5)


def test_blocks_in_a_task(spark):
    """A task that fills many blocks gives the same sums."""
    data = rows()[:60]

    class Held:
        value = S.fit(spark.createDataFrame([r for r in data if not held(r[0])], SCHEMA), **PARAMETERS)

    from unittest import mock

    import pyarrow as pa
    batch = pa.RecordBatch.from_pydict({"doc_id": [r[0] for r in data], "held_out": [held(r[0]) for r in data], "text": [r[1] for r in data]})
    sums = defaultdict(lambda: [0, 0.0])
    pieces = lambda text: list(S.__dict__["_all_pieces"](text, 30))
    S._all_pieces = S.pieces
    with mock.patch.object(S, "TaskContext") as context, mock.patch.object(S, "BLOCK_TOKENS", 25), mock.patch.object(S, "pieces", pieces):
        context.get.return_value.partitionId.return_value = 0
        made = [r for b in S._blocks(Held)(iter([batch])) for r in b.to_pylist()]
    del S._all_pieces
    assert len({r["block"] for r in made}) > 10
    for r in made:
        if r["row"] is not None:
            sums[r["row"]][0] += r["n_tokens"]
            sums[r["row"]][1] += r["score"]
    for (n, score), w in zip((sums[k] for k in sorted(sums)), plain(data, **PARAMETERS)):
        assert n == w[2] and score == pytest.approx(w[6], rel=1e-5)


def test_chances_sum_to_one(spark):
    model = S.fit(spark.createDataFrame(rows(), SCHEMA), **PARAMETERS)
    chances = 10.0 ** model.logs.astype(np.float64)
    unseen = S.SYMBOLS - (model.trie.width - 1)
    assert np.allclose(chances[:, :-1].sum(1) + unseen * chances[:, -1], 1, atol=1e-5)
    assert len(chances) > 20


def test_model_travels_small(spark):
    model = S.fit(spark.createDataFrame(rows(), SCHEMA), **PARAMETERS)
    again = pickle.loads(pickle.dumps(model.trie))
    assert all((a == b).all() for a, b in zip(model.trie.steps, again.steps)) and again.sizes == model.trie.sizes


def test_nothing_to_learn_from(spark):
    empty = S.evaluate(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0
    only_held = [(i, "some text", "en") for i in range(60) if held(i)]
    same(S.evaluate(spark.createDataFrame(only_held, SCHEMA), **PARAMETERS), plain(only_held, **PARAMETERS))


@pytest.mark.parametrize("longest", [1, 2, 3, 4, 5, 6])
def test_levels_end_anywhere(spark, longest):
    """No context of more than some length is frequent."""
    data = [(i, ("abcdef"[:longest] + " ") * 1 + "q%d" % i, "en") for i in range(40)]
    parameters = PARAMETERS | {"depth": 8, "least": 20}
    same(S.evaluate(spark.createDataFrame(data, SCHEMA), **parameters), plain(data, **parameters))


def test_held_out_texts_are_predicted(spark):
    """Near the base on a small table; that gives every unseen word the same share, however long, and does not sum to one."""
    out = S.evaluate(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    from pyspark.sql import functions as F
    r = out.filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert r[0] > 1.05 * r[1]


def test_driver_holds_pairs_that_occur(spark):
    """Fitting never has the tables of all levels, each context by all symbols, at once."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    tracemalloc.start()
    try:
        model = S.fit(docs, least=8, share=1e-7)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    dense = sum(model.trie.sizes) * model.trie.width * 8
    assert dense > 30e6 and peak < 2 * dense
