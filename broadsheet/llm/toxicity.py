"""Toxic passages by maximum-scoring segments of token log-odds.

From labelled texts every token gets a log-odds of toxic against clean, shrunk by
a Dirichlet prior that follows the token's use overall, in units of its standard
error; tokens that are clearly toxic carry their log-odds, all others a small
negative drift. A linear-time scan finds every maximal scoring segment of a text.
How high the best segments of clean texts reach by chance follows an extreme-value
law whose scale and level are fitted on clean labelled texts; a text's segments are
turned into chances by it, the significant ones are added up, and a logistic curve
fitted on labelled texts gives the score.

Null and empty texts have no segment and get the score of that. Without labels of
both kinds every score is 0. Rows may repeat and each is answered; texts that are
labelled more than once count by their greatest label. An empty table gives an
empty table. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.frames import map_batches, settle

#: Labelled texts that the log-odds and the calibration are learned from.
SAMPLE = 20_000
#: Weight of the prior as a share of all counts, and the standard errors that make a token toxic.
PRIOR = 0.1
SIGNIFICANT = 2.5
#: Standard errors taken off a token's log-odds, so that rare tokens count for less.
CAUTION = 1.5
#: Tokens kept; those beyond have the least standing.
LEXICON = 20_000
#: Segments rarer than this by chance in a clean text count as toxic passages.
CHANCE = 0.05
#: Cost of a token that is not clearly toxic.
DRIFT = 0.1
#: Evidence beyond this adds nothing.
MOST = 60.0

EDGES = re.compile(r"^\W+|\W+$")


def token(chunk: str) -> str:
    return EDGES.sub("", chunk)


@dataclass
class Model:
    weights: dict[str, float]
    drift: float
    decay: float = 1.0  # of the extreme-value law
    level: float = 0.0
    slope: float = 0.0
    intercept: float = -20.0
    _cache: dict[str, float] = field(default_factory=dict, repr=False)

    def weight(self, chunk: str) -> float:
        """Weight of a white-space separated chunk, remembered."""
        got = self._cache.get(chunk)
        if got is None:
            if len(self._cache) > 200_000:
                self._cache.clear()
            got = self._cache[chunk] = self.weights.get(token(chunk), 0.0)
        return got

    def segments(self, text: str | None) -> list[tuple[int, int, float]]:
        """Maximal segments: first token, last token + 1, score."""
        if not text:
            return []
        w = np.fromiter(map(self.weight, text.lower().split()), float)
        # Every use counts where it stands: what came earlier in a text takes nothing from a later passage.
        return maximal_segments(np.flatnonzero(w), w[w != 0], self.drift)

    def evidence(self, length: int, scores: Iterable[float]) -> float:
        """Sum over significant segments of how much rarer than chance they are."""
        total = 0.0
        for s in scores:
            log_e = self.level + math.log(1 + length) - self.decay * s
            # The chance of such a segment; its logarithm is log_e itself where it is tiny.
            log_chance = log_e if log_e < -30 else math.log(-math.expm1(-math.exp(min(log_e, 50.0))))
            if log_chance < math.log(CHANCE):
                total += math.log(CHANCE) - log_chance
        return total

    def score(self, length: int, segments: list[tuple[int, int, float]]) -> float:
        z = self.intercept + self.slope * min(self.evidence(length, [s for _, _, s in segments]), MOST)
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def maximal_segments(places: np.ndarray, weights: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments; tokens between ``places`` cost ``drift`` each.

    Each positive token starts a candidate; it joins the nearest earlier candidate
    whose left sum is lower if the right sum grows by it. Linear in the positive
    tokens, since every join removes candidates.
    """
    found: list[tuple[int, int, float, float]] = []  # first, end, sum before, sum after
    lower: list[int] = []  # index of the nearest candidate with a lower sum before
    total, last = 0.0, -1
    for p, w in zip(places.tolist(), weights.tolist()):
        total -= drift * (p - last - 1)
        last = p
        if w <= 0:
            total += w
            continue
        first, end, before = p, p + 1, total
        total += w
        after = total
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= before:
                j = lower[j]
            if j < 0 or found[j][3] >= after:
                break
            first, before = found[j][0], found[j][2]
            del found[j:], lower[j:]
        found.append((first, end, before, after))
        lower.append(j)
    return [(a, b, after - before) for a, b, before, after in found]


def log_odds(counted: DataFrame, lexicon: int = LEXICON) -> dict[str, float]:
    """Log-odds of the clearly toxic tokens, from (token, toxic, clean) counts of texts.

    The row of the empty token holds the numbers of texts.
    """
    both = F.col("toxic") + F.col("clean")
    named = F.col("token") != ""
    n = counted.agg(
        F.sum(F.when(named, F.col("toxic"))).alias("toxic"), F.sum(F.when(named, F.col("clean"))).alias("clean"),
        F.max(F.when(~named, F.col("toxic"))).alias("toxic_texts"), F.max(F.when(~named, F.col("clean"))).alias("clean_texts"),
    ).first()
    if not n.toxic or not n.clean:
        return {}
    # The prior of a token is its share of all counts times the weight of the whole prior.
    a, whole = F.lit(PRIOR) * both, PRIOR * (n.toxic + n.clean)
    y1, y0 = F.col("toxic") + a, F.col("clean") + a
    delta = F.log(y1 / (F.lit(n.toxic + whole) - y1)) - F.log(y0 / (F.lit(n.clean + whole) - y0))
    error = F.sqrt(F.lit(1.0) / y1 + F.lit(1.0) / y0)
    # The share of texts must differ as well: a few long texts hold many odd tokens.
    rarer = F.col("toxic") / n.toxic_texts > F.lit(2.0) * F.col("clean") / n.clean_texts
    found = (
        counted.filter(named & rarer).select("token", (delta - CAUTION * error).alias("weight"), (delta / error).alias("standing"))
        .filter(F.col("standing") >= SIGNIFICANT).orderBy(F.col("standing").desc(), "token").limit(lexicon)
    )
    return {r.token: r.weight for r in found.collect()}


def calibrate(model: Model, rows: list[tuple[int, int, list[float]]]) -> Model:
    """Fit the extreme-value law on clean rows (length, label, segment scores) and the curve on all."""
    high = np.array([max(s) for _, y, s in rows if s and not y])
    least = min(model.weights.values(), default=1.0)
    # The law's scale follows from the spread of the best segments that chance makes in
    # clean texts, its level from how many clean texts have one at all.
    model.decay = 1 / max(float(high.std()) * math.sqrt(6) / math.pi if len(high) > 2 else 0.0, least / 4)
    spent = sum(1.0 + n for n, y, _ in rows if not y) or 1.0
    model.level = math.log((len(high) + 0.5) / spent) + model.decay * least
    x = np.array([min(model.evidence(n, s), MOST) for n, _, s in rows])
    model.slope, model.intercept = _logistic(x, np.array([y for _, y, _ in rows], float))
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    a, b = 0.0, math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((p - y) * x).sum() + ridge * a, (p - y).sum()])
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum()]])
        a, b = np.array([a, b]) - np.linalg.solve(h + np.eye(2) * 1e-6, g).clip(-2, 2)
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, sample: int = SAMPLE) -> Model | None:
    """Learn from at most ``sample`` labelled rows, those with the least hash of their id.

    Three quarters give the log-odds, the rest the calibration. ``allowed`` filters the labels.
    """
    usable = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if allowed is not None:
        usable = usable.filter(allowed)
    usable = usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    drawn = usable.orderBy(F.xxhash64(F.lit("toxic"), "doc_id"), "doc_id").limit(sample)
    # At most ``sample`` pairs of numbers: the bound of what is broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    held = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(4)) == 0
    rows = settle(rows.select("text", "toxic", held.alias("held")), "toxicity-sample")

    def count(batch):
        seen, texts = (Counter(), Counter()), Counter()
        for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            texts[y] += 1
            seen[y].update({token(c) for c in (text or "").lower().split()} - {""})
        tokens = ["", *(seen[0].keys() | seen[1].keys())]
        seen[0][""], seen[1][""] = texts[0], texts[1]
        return {"token": tokens, "toxic": [seen[1][t] for t in tokens], "clean": [seen[0][t] for t in tokens]}

    counts = map_batches(rows.filter("NOT held"), count, "token string, toxic bigint, clean bigint")
    counted = settle(counts.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "toxicity-counts")
    model = Model(log_odds(counted), DRIFT)
    if not model.weights:
        return None

    def measure(batch):
        texts = batch.column("text").to_pylist()
        return {"n": [len(t or "") for t in texts], "toxic": batch.column("toxic"), "scores": [[s for _, _, s in model.segments(t)] for t in texts]}

    measured = map_batches(rows.filter("held"), measure, "n bigint, toxic int, scores array<double>").collect()
    # In one order whatever the partitions are, so that sums come out alike.
    return calibrate(model, sorted((r.n, r.toxic, r.scores) for r in measured))


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7, *extra: Column) -> DataFrame:
    """doc_id, score, predicted, passages for every row, and ``extra`` columns passed through as they are.

    ``passages`` has first token, last token + 1 and score of every significant segment.
    """
    rows = docs.select("doc_id", "text", *extra)
    passed = rows.schema.fields[2:]
    schema = ", ".join([
        "doc_id bigint", "score double", "predicted int", "passages array<struct<first:int,end:int,score:double>>",
        *[f"`{f.name}` {f.dataType.simpleString()}" for f in passed]])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LEXICON tokens

    def run(batch):
        m, texts = shared.value, batch.column("text").to_pylist()
        cut = [m.segments(t) if m else [] for t in texts]
        scores = [m.score(len(t or ""), c) if m else 0.0 for t, c in zip(texts, cut)]
        found = [[x for x in c if m.evidence(len(t), [x[2]]) > 0] for t, c in zip(texts, cut)]
        return {
            "doc_id": batch.column("doc_id"), "score": scores, "predicted": [int(s >= threshold) for s in scores],
            "passages": [[{"first": a, "end": b, "score": s} for a, b, s in p] for p in found],
            **{f.name: batch.column(f.name) for f in passed}}

    return map_batches(rows, run, schema)
