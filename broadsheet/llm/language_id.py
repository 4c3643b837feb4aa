"""Language identification by a byte convolutional network.

Bytes of the lower-cased text are embedded, filters of several widths run over
windows of fixed length, the greatest response of each filter in a window is kept,
and a softmax over these gives the window's languages. A text's score is the mean
over all its windows, weighted by their length, so whole texts count. The network
is trained in numpy on the driver, on a bounded sample of labelled rows; for
prediction embedding and filters are folded into tables over byte pairs, which
gives the same responses by look-up.

Null texts and texts without a letter are "und" with score 0, and so is every text
if no labelled row can be learned from. Of equal scores the language first by code
point wins. Rows may repeat and each is answered. An empty table gives an empty
table. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.frames import map_batches, map_stream, slices

WINDOW = 256
WIDTHS = (2, 4, 6)
FILTERS = 16
DIMENSIONS = 8
#: Labelled texts per language that the network learns from, and windows of each.
SAMPLE = 600
WINDOWS_PER_TEXT = 4
UNKNOWN = "und"
# What noise is drawn from.
NOISE_ALPHABETS = (
    b"0123456789abcdef", b"abcdefghijklmnopqrstuvwxyz", b"abcdefghijklmnopqrstuvwxyz0123456789+/=", b"qwxzjkvy", b"0123456789.,:;-", b"(){}[]<>;=&|!+*/abcdefxyz_.",
)
#: Chance of noise from which on a stage rejects a text.
NOISE = 0.9
#: Languages that a network tells apart at most, the most frequent ones.
LANGUAGES = 4_096


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % parts == part


def windows(data: bytes, size: int = WINDOW) -> np.ndarray:
    """Consecutive windows over all bytes, the last one filled up with zeros."""
    n = max(1, -(-len(data) // size))
    return np.frombuffer(data.ljust(n * size, b"\0"), np.uint8).reshape(n, size)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (256, DIMENSIONS)
    filters: list[np.ndarray]  # (width, DIMENSIONS, FILTERS) each
    offsets: list[np.ndarray]  # (FILTERS,) each
    dense: np.ndarray  # (filters of all widths, languages)
    bias: np.ndarray

    def responses(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Greatest response per filter and the place where it stands."""
        tops, places = [], []
        e = self.embedding[x]
        for f, b in zip(self.filters, self.offsets):
            w = len(f)
            patches = sliding_window_view(e, w, axis=1)  # (n, places, DIMENSIONS, w)
            a = patches.transpose(0, 1, 3, 2).reshape(*patches.shape[:2], -1) @ f.reshape(-1, f.shape[2])
            place = a.argmax(1)
            tops.append(np.maximum(np.take_along_axis(a, place[:, None], 1)[:, 0] + b, 0))
            places.append(place)
        return np.concatenate(tops, 1), places

    def softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.dense + self.bias
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.offsets, self.dense, self.bias]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        h, places = self.responses(x)
        d = self.softmax(h)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        g_dense, g_bias = h.T @ d, d.sum(0)
        g_h = (d @ self.dense.T) * (h > 0)
        g_embedding = np.zeros_like(self.embedding)
        g_filters, g_offsets, at = [], [], 0
        for f, place in zip(self.filters, places):
            g = g_h[:, at:at + f.shape[2]]
            at += f.shape[2]
            # Only the bytes under the greatest response of each filter matter.
            under = x[np.arange(len(x))[:, None, None], place[:, :, None] + np.arange(len(f))]
            g_filters.append(np.einsum("nf,nfwd->wdf", g, self.embedding[under]))
            np.add.at(g_embedding, under, g[:, :, None, None] * f.transpose(2, 0, 1)[None])
            g_offsets.append(g.sum(0))
        return [g_embedding, *g_filters, *g_offsets, g_dense, g_bias]


def train(x: np.ndarray, y: np.ndarray, languages: list[str], epochs: int = 6, batch: int = 64, rate: float = 0.01) -> Network:
    """Fit by Adam on windows ``x`` with language numbers ``y``; the same rows give the same network."""
    r = np.random.default_rng(7)
    draw = lambda *shape: (r.standard_normal(shape) * 0.3).astype(np.float32)
    net = Network(
        languages, draw(256, DIMENSIONS), [draw(w, DIMENSIONS, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS], draw(FILTERS * len(WIDTHS), len(languages)), np.zeros(len(languages), np.float32))
    mean = [np.zeros_like(p) for p in net.parameters()]
    square = [np.zeros_like(p) for p in net.parameters()]
    step = 0
    for _ in range(epochs):
        order = r.permutation(len(x))
        for at in range(0, len(x), batch):
            chosen = order[at:at + batch]
            step += 1
            for p, g, m, s in zip(net.parameters(), net.gradients(x[chosen], y[chosen]), mean, square):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


class Folded:
    """The network with embedding and filters folded into tables over byte pairs."""

    def __init__(self, net: Network):
        self.net = net
        self.tables = []
        for f, b in zip(net.filters, net.offsets):
            single = np.einsum("bd,wdf->wbf", net.embedding, f)
            single[0] += b
            self.tables.append([(single[k][:, None, :] + single[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, len(f), 2)])

    def probabilities(self, x: np.ndarray, batch: int = 256) -> np.ndarray:
        return np.concatenate([self._batch(x[at:at + batch]) for at in range(0, len(x), batch)])

    def _batch(self, x: np.ndarray) -> np.ndarray:
        pairs = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        tops = []
        for tables in self.tables:
            places = pairs.shape[1] - 2 * (len(tables) - 1)
            a = np.take(tables[0], pairs[:, :places], axis=0)
            for k, t in enumerate(tables[1:], 1):
                a += np.take(t, pairs[:, 2 * k:2 * k + places], axis=0)
            tops.append(np.maximum(a.max(1), 0))
        return self.net.softmax(np.concatenate(tops, 1))


def noise(windows_: list[bytes], seed: int = 11) -> list[bytes]:
    """As many windows without a language: real ones with their bytes shuffled, and words of drawn letters or digits."""
    r = np.random.default_rng(seed)
    alphabets = [np.frombuffer(a, np.uint8) for a in NOISE_ALPHABETS]
    out = []
    for i, w in enumerate(windows_):
        x = np.frombuffer(w, np.uint8)
        n = max(1, int((x != 0).sum()))
        if i % 2:
            x = r.permutation(x[:n])
        else:
            x = r.choice(alphabets[i // 2 % len(alphabets)], n)
            x[r.random(n) < r.choice([0.0, 0.1, 0.2])] = 32
        out.append(x.astype(np.uint8).tobytes().ljust(len(w), b"\0"))
    return out


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", sample: int = SAMPLE, reject: bool = False) -> Network | None:
    """Train on at most ``sample`` texts per language, those with the least hash of their key.

    With ``reject`` the network has one more class, "und", learned from made noise.
    """
    labelled = docs.filter(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = docs.filter(F.col(label).isNotNull()).groupBy(F.col(label).alias("lang")).count().orderBy(F.desc("count"), "lang").limit(LANGUAGES)
    # Each language's rows below a hash bound chosen to give a little more than the sample.
    draw = F.pmod(F.xxhash64(F.lit("lang"), F.col(key)), F.lit(1 << 30))
    chosen = (
        labelled.select(F.col(label).alias("lang"), F.col(text).alias("text"), draw.alias("draw"))
        # At most LANGUAGES names and counts: the bound of what is broadcast.
        .join(F.broadcast(counts), "lang")
        .filter(F.col("draw") < F.lit(1.25 * sample * (1 << 30)) / F.col("count"))
    )

    def cut(batch):
        out = {"lang": [], "draw": [], "data": []}
        for lang, draw, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "draw", "text"))):
            w = windows(text.lower().encode())
            for i in np.unique(np.linspace(0, len(w) - 1, WINDOWS_PER_TEXT).astype(int)):
                out["lang"].append(lang)
                out["draw"].append(draw)
                out["data"].append(w[i].tobytes())
        return out

    rows = sorted(map(tuple, map_batches(chosen, cut, "lang string, draw bigint, data binary").collect()))
    kept: dict[str, list[bytes]] = {}
    for lang, _, data in rows:
        kept.setdefault(lang, [])
        if len(kept[lang]) < sample * WINDOWS_PER_TEXT:
            kept[lang].append(data)
    if not kept:
        return None
    if reject:
        every = sorted(d for data in kept.values() for d in data)
        kept[UNKNOWN] = noise([every[i] for i in np.linspace(0, len(every) - 1, min(len(every), 2 * sample * WINDOWS_PER_TEXT)).astype(int)])
    languages = sorted(kept)
    x = np.stack([np.frombuffer(d, np.uint8) for lang in languages for d in kept[lang]])
    y = np.repeat(np.arange(len(languages)), [len(kept[lang]) for lang in languages])
    return train(x, y, languages)


def identify(docs: DataFrame, net: Network | None, *extra: Column) -> DataFrame:
    """doc_id, lang_pred, score for every row, and ``extra`` columns passed through as they are."""
    rows = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.col("text")).alias("text"), *extra)
    passed = rows.schema.fields[2:]
    schema = ", ".join(["doc_id bigint", "lang_pred string", "score double", *[f"`{f.name}` {f.dataType.simpleString()}" for f in passed]])
    shared = docs.sparkSession.sparkContext.broadcast(net)  # a few tens of kilobytes

    def run(batch):
        langs, scores = _predict(shared, batch.column("text").to_pylist())
        return {"doc_id": batch.column("doc_id"), **{f.name: batch.column(f.name) for f in passed}, "lang_pred": langs, "score": scores}

    return map_batches(rows, run, schema)


def known(docs: DataFrame, net: Network | None, limit: float = NOISE) -> DataFrame:
    """The rows of ``docs`` with a letter that the network does not hold for noise, with their columns.

    A text goes if its chance of "und" is at least ``limit``; only a network that was fitted
    to reject has that class. Without a network every text with a letter stays.
    """
    lettered = docs.filter(F.col("text").rlike(r"\p{L}"))
    if net is None or UNKNOWN not in net.languages:
        return lettered
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for batch in slices(batches):
            langs, scores = _predict(shared, batch.column("text").to_pylist())
            yield batch.filter(pa.array([x != UNKNOWN or s < limit for x, s in zip(langs, scores)], pa.bool_()))

    return map_stream(lettered, run, docs.schema)


def _predict(shared, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text by a broadcast network; null texts are unknown."""
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if shared.value is not None:
        folded = _folded(shared)
        for part in _parts(texts):
            cut = [windows(texts[i].lower().encode()) for i in part]
            n = np.array([len(w) for w in cut])
            x = np.concatenate(cut)
            weight = np.maximum((x != 0).sum(1), 1)[:, None]
            starts = np.cumsum(n) - n
            p = np.add.reduceat(folded.probabilities(x) * weight, starts) / np.add.reduceat(weight, starts)
            for i, best, row in zip(part, p.argmax(1), p):
                langs[i], scores[i] = folded.net.languages[best], min(1.0, float(row[best]))
    return langs, scores


_FOLDED: dict[int, Folded] = {}


def _folded(shared) -> Folded:
    """The tables of a broadcast network, made once per worker process."""
    key = shared.value.dense.tobytes().__hash__()
    if key not in _FOLDED:
        _FOLDED.clear()
        _FOLDED[key] = Folded(shared.value)
    return _FOLDED[key]


def _parts(texts: list[str | None], most: int = 1 << 20) -> list[list[int]]:
    """Places of the texts that are not null, in runs of about ``most`` characters."""
    out, size = [[]], 0
    for i, t in enumerate(texts):
        if t is not None:
            if size > most:
                out.append([])
                size = 0
            out[-1].append(i)
            size += len(t)
    return [p for p in out if p]
