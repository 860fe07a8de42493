"""Toxicity by maximum-scoring segments.

Tokens are weighted by the log-odds of occurring in toxic rather than in other
documents (document counts, so that one document's repetition is one occurrence),
under a Dirichlet prior that follows the pooled counts plus a constant share.  A
token whose log-odds are not significant counts ``-gap``; significant ones count
their log-odds less ``margin``.  One pass over a document finds all
its maximal segments in linear time; a segment's score becomes an extreme-value
surprise, ``lambda * score - log(K * length)``, with lambda from the background
frequencies and K from documents labelled 0.  A document's statistic is the sum
of its segments' positive surprises, and a logistic curve fitted to the training
documents turns it into a probability.

Learned from at most ``sample_docs`` labelled documents, of which every token with
significant log-odds gets its weight.  Null, empty and blank texts have no segment: their score is that of the
statistic 0.  Repeated rows get equal scores.  With fewer than two classes of
labels every score is the share of label 1 (0 without labels); without a token in any labelled
document as well.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_batches

SAMPLE_DOCS = 20_000
CACHE_WORDS = 400_000
#: Signs cut from both ends of a word.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~¡¿«»“”‘’„…–—"


def normal_token(word: str) -> str:
    """Lower case without signs around it; empty if nothing is left."""
    return word.strip(_SIGNS).lower()


def maximal_segments(scores: list[float]) -> list[tuple[float, int, int]]:
    """All maximal-scoring segments (score, start, end) of a sequence, in linear time.

    Kept candidates carry the running totals before and at their end; a new candidate is joined
    with the nearest earlier one that starts lower, if that one ends lower too.
    """
    kept: list[list] = []  # start, end, total before, total at the end, nearest earlier candidate that starts lower
    total = 0.0
    for i, s in enumerate(scores):
        before = total
        total += s
        if s <= 0:
            continue
        start, low = i, before
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= total:
                break
            start, low = kept[j][0], kept[j][2]
            del kept[j:]
            j = len(kept) - 1
        kept.append([start, i + 1, low, total, j])
    return [(high - low, a, b) for a, b, low, high, _ in kept]


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    gap: float
    decay: float = 1.0  #: lambda
    log_k: float = 0.0
    slope: float = 0.0
    offset: float = -np.inf

    def segments(self, scores: np.ndarray) -> list[tuple[float, int, int]]:
        """Maximal segments of token scores; runs of equal sign are joined first, which changes none of them."""
        up = scores > 0
        if not up.any():
            return []
        edges = np.flatnonzero(np.concatenate(([True], up[1:] != up[:-1])))
        bounds = np.append(edges, len(scores))
        return [(s, int(bounds[a]), int(bounds[b])) for s, a, b in maximal_segments(np.add.reduceat(scores, edges).tolist())]

    def surprise(self, segments: list, length: int) -> float:
        cost = self.log_k + np.log(max(length, 1))
        return float(sum(max(0.0, self.decay * s - cost) for s, _, _ in segments))

    def probability(self, statistic: float) -> float:
        if np.isinf(self.offset):
            return float(self.offset > 0)
        return float(1 / (1 + np.exp(-np.clip(self.slope * statistic + self.offset, -500, 500))))


@dataclass
class Scorer:
    """A worker's model with the weights of words met so far."""

    model: ToxicityModel
    cache: dict[str, float] = field(default_factory=dict)

    def token_scores(self, text: str | None) -> np.ndarray:
        words = text.split() if text else []
        cache = self.cache
        try:
            return np.fromiter(map(cache.__getitem__, words), np.float64, len(words))
        except KeyError:
            if len(cache) > CACHE_WORDS:
                cache.clear()
            weights, gap = self.model.weights, self.model.gap
            for w in set(words).difference(cache):
                cache[w] = weights.get(normal_token(w), -gap)
            return np.fromiter(map(cache.__getitem__, words), np.float64, len(words))

    def __call__(self, text: str | None) -> tuple[float, list[tuple[float, int, int]]]:
        """(probability, maximal segments as (score, first word, end))."""
        scores = self.token_scores(text)
        found = self.model.segments(scores)
        return self.model.probability(self.model.surprise(found, len(scores))), found


def log_odds(y1: Column, y0: Column, n1: float, n0: float, prior: float, constant: float) -> tuple[Column, Column]:
    """(log-odds ratio, its z-score) of counts y1 of n1 and y0 of n0 under the Dirichlet prior."""
    a = F.lit(prior / (n1 + n0)) * (y1 + y0) + constant
    in_1, in_0 = y1 + a, y0 + a
    odds = F.log(in_1 / (n1 + prior - y1)) - F.log(in_0 / (n0 + prior - y0))
    return odds, odds / F.sqrt(1 / in_1 + 1 / in_0)


def solve_decay(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(share * exp(lambda * value)) = 1; values must have a negative mean."""
    low, high = 0.0, 1.0
    total = lambda x: float((shares * np.exp(np.clip(x * values, -700, 700))).sum())
    while total(high) < 1 and high < 1e3:
        high *= 2
    for _ in range(80):
        low, high = ((low + high) / 2, high) if total((low + high) / 2) < 1 else (low, (low + high) / 2)
    return high


def fit_logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and offset by Newton steps."""
    a = np.array([0.0, np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))])
    design = np.stack((x, np.ones(len(x))), 1)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ a, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + ridge * np.eye(2), design.T @ (y - p) - ridge * a)
        a += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(a[0]), float(a[1])


def learn(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, prior: float = 1000.0, constant: float = 0.5, least_z: float = 3.0, margin: float = 2.0, gap: float = 0.1) -> ToxicityModel:
    """Fit on the sample_docs labelled documents whose hashed ids are smallest.

    labels holds training rows only; null labels are dropped, repeated ids keep their largest label.
    """
    truth = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    sample = truth.orderBy(F.xxhash64("id"), "id").limit(sample_docs)  # at most sample_docs short rows, so it is broadcast
    # one row for each id, so that repeated rows don't lengthen the sample; written once: the texts are scanned for the sample a single time
    rows = materialize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text")).select("label", "text"), "sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text"):
            found: tuple[Counter, Counter] = (Counter(), Counter())
            for label, text in zip(part.column(part.schema.get_field_index("label")).to_pylist(), texts):
                if text:
                    found[label == 1].update({normal_token(w) for w in set(text.split())})
            tokens = [t for t in {*found[0], *found[1]} if t]
            yield pa.RecordBatch.from_arrays([pa.array(tokens, pa.string()), pa.array([found[1][t] for t in tokens], pa.int64()), pa.array([found[0][t] for t in tokens], pa.int64())], ["token", "toxic", "other"])

    counts = rows.mapInArrow(count, "token string, toxic long, other long").groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    totals = sample.agg(F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("toxic"), F.count("*").alias("n")).first()
    if not totals["toxic"] or totals["toxic"] == totals["n"]:
        return ToxicityModel({}, gap, offset=np.inf if totals["toxic"] else -np.inf)
    sums = counts.agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).first()
    n1, n0 = float(sums["toxic"] or 0), float(sums["other"] or 0)
    if not n1 + n0:  # no labelled document has a token
        return ToxicityModel({}, gap, offset=float(np.log(totals["toxic"] / (totals["n"] - totals["toxic"]))))
    odds, z = log_odds(F.col("toxic"), F.col("other"), n1, n0, prior, constant)
    scored = counts.select("token", "other", odds.alias("odds"), z.alias("z")).where((F.col("z") >= least_z) & (F.col("odds") > margin))
    best = scored.orderBy(F.col("z").desc(), "token").collect()  # significant tokens of the sample
    weights = {r["token"]: float(r["odds"]) - margin for r in best}
    values = np.array([*weights.values(), -gap])
    own = np.array([float(r["other"]) + constant for r in best])
    shares = np.append(own, max(n0 - own.sum(), 1.0))
    shares /= shares.sum()
    decay = solve_decay(values, shares) if weights and (values * shares).sum() < 0 else 1.0
    model = ToxicityModel(weights, gap, decay)
    # K: the location of the clean documents' best segments; then the curve over the statistic
    clean = sorted(r["value"] for r in _measured(rows, model, lambda label, n, segments: _best(decay, n, segments) if n and not label else None).collect())
    log_k = float(np.mean(clean) - 0.5772) if clean else 0.0
    model = ToxicityModel(weights, gap, decay, log_k)
    seen = sorted((r["label"] == 1, r["value"]) for r in _measured(rows, model, lambda label, n, segments: model.surprise(segments, n)).collect())
    slope, offset = fit_logistic(np.array([x for _, x in seen]), np.array([float(label) for label, _ in seen]))
    return ToxicityModel(weights, gap, decay, log_k, slope, offset)


def _best(decay: float, length: int, segments: list) -> float:
    """The best segment's score in units of the surprise; without a segment it is at most the score 0."""
    return float(decay * max((s for s, _, _ in segments), default=0.0) - np.log(length))


def _measured(rows: DataFrame, model: ToxicityModel, of) -> DataFrame:
    """(label, value) of the sample: one number of(label, length, segments) for each document, where it is not None."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part, texts in text_batches(batches, "text"):
            labels = part.column(part.schema.get_field_index("label"))
            values = []
            for label, text in zip(labels.to_pylist(), texts):
                scores = scorer.token_scores(text)
                values.append(of(label == 1, len(scores), model.segments(scores)))
            yield pa.RecordBatch.from_arrays([labels, pa.array(values, pa.float64())], ["label", "value"])

    return rows.mapInArrow(measure, "label int, value double").where("value is not null")


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """The given columns with score and passages (score, first word, end) in place of the text; columns of docs that are named so already are replaced."""
    kept = [f for f in docs.schema.fields if f.name not in (text_col, "score", "passages")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    passage = pa.list_(pa.struct([("score", pa.float64()), ("first_word", pa.int64()), ("end_word", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for part, texts in text_batches(batches, text_col):
            found = [scorer(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.get_field_index(f.name)) for f in kept), pa.array([p for p, _ in found], pa.float64()), pa.array([[{"score": s, "first_word": a, "end_word": b} for s, a, b in ss] for _, ss in found], passage)],
                [*(f.name for f in kept), "score", "passages"],
            )

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double, passages array<struct<score: double, first_word: long, end_word: long>>"]))
