"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its words, word pairs and the
character n-grams of its words (three to five bytes, words between ``<`` and
``>``), all hashed into one table of ``buckets`` rows; a softmax layer follows.
Table and layer are trained by numpy stochastic gradient descent on the driver,
from at most ``sample_docs`` labelled rows; features are hashed on the executors.

The softmax of two classes needs only the difference of their logits, which is
linear in the mean.  So scoring uses the product of table and layer, one number
per bucket, and a word's sum over its features is computed once per worker.

Null, empty and blank texts have no features: their score is that of the bias
alone.  Repeated rows get equal scores.  With fewer than two classes of labels
every score is the share of label 1 (0.5 without labels).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_batches

BUCKETS = 1 << 18
SAMPLE_DOCS = 6000
DIMENSIONS = 8
EPOCHS = 8
#: Words whose feature sums a worker keeps.
CACHE_WORDS = 400_000

_PRIME = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_POWERS = np.cumprod(np.full(4096, 0x100000001B3, np.uint64))


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return ((h ^ (h >> np.uint64(29))) % np.uint64(buckets)).astype(np.int32)


def word_features(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, index of the word) of every feature of the words, and each word's 64-bit hash."""
    data = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint64) + np.uint64(1)
    sizes = np.fromiter((len(w) + 2 for w in words), np.int64, len(words))
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes)
    place = np.arange(len(data)) - starts[owner]
    hashes = np.add.reduceat(data * _POWERS[place % len(_POWERS)] * (np.uint64(1) + (place // len(_POWERS)).astype(np.uint64)), starts) if len(words) else np.zeros(0, np.uint64)
    left = sizes[owner] - place  # bytes from here to the word's end
    found, owners = [_bucket(hashes * _PRIME, buckets)], [np.arange(len(words))]
    h = data
    for n in range(2, 6):
        h = h[:-1] * _PRIME + data[n - 1 :]
        if n >= 3 and len(h):
            inside = left[: len(h)] >= n
            found.append(_bucket(h[inside] + np.uint64(n), buckets))
            owners.append(owner[: len(h)][inside])
    return np.concatenate(found), np.concatenate(owners), hashes


def pair_buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of consecutive words' pairs; every pair of equal words is the same feature."""
    pairs = np.where(hashes[:-1] == hashes[1:], np.uint64(1), hashes[:-1] * _PRIME + hashes[1:] + np.uint64(7))
    return _bucket(pairs, buckets)


def document_features(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text, ascending, and how often each occurs."""
    words = text.encode().split() if text else []
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    place: dict[bytes, int] = {}
    order = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
    found, owners, hashes = word_features(list(place), buckets)
    n = np.bincount(order, minlength=len(place))[owners]
    pairs = pair_buckets(hashes[order], buckets)
    codes, back = np.unique(np.concatenate((found, pairs)), return_inverse=True)
    return codes, np.bincount(back, weights=np.concatenate((n, np.ones(len(pairs)))), minlength=len(codes)).astype(np.int32)


@dataclass(frozen=True)
class QualityModel:
    weights: np.ndarray  #: logit difference of each bucket
    bias: float


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], buckets: int = BUCKETS, dimensions: int = DIMENSIONS, epochs: int = EPOCHS, rate: float = 1.0, batch: int = 16, seed: int = 7) -> QualityModel:
    """Stochastic gradient descent over (label, buckets, counts) rows."""
    labels = np.array([r[0] for r in rows], np.int64)
    share = float(labels.mean()) if len(labels) else 0.5
    if len(set(labels.tolist())) < 2:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return QualityModel(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dimensions, 1 / dimensions, (buckets, dimensions)).astype(np.float32)
    layer = np.zeros((dimensions, 2), np.float32)
    bias = np.log(np.array([1 - share, share], np.float32))
    steps, total = 0, epochs * ((len(rows) + batch - 1) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for at in range(0, len(rows), batch):
            pick = [i for i in order[at : at + batch] if len(rows[i][1])]
            if not pick:
                continue
            pace = np.float32(rate * (1 - steps / total))
            steps += 1
            ids = np.concatenate([rows[i][1] for i in pick])
            n = np.concatenate([rows[i][2] / rows[i][2].sum() for i in pick]).astype(np.float32)
            sizes = np.array([len(rows[i][1]) for i in pick])
            starts = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(table[ids] * n[:, None], starts, axis=0)
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), labels[pick]] -= 1
            back = p @ layer.T
            layer -= pace * (mean.T @ p)
            bias -= pace / len(pick) * p.sum(0)
            change = np.repeat(back, sizes, axis=0) * (n * pace)[:, None]
            for d in range(dimensions):
                np.subtract.at(table[:, d], ids, change[:, d])
    return QualityModel((table @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def learn(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS, buckets: int = BUCKETS) -> QualityModel:
    """Train on the sample_docs labelled documents whose hashed ids are smallest.

    labels holds training rows only; null labels are dropped, repeated ids keep their largest label.
    """
    truth = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    sample = truth.orderBy(F.xxhash64("id"), "id").limit(sample_docs)  # at most sample_docs short rows, so it is broadcast

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text"):
            found = [document_features(t, buckets) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index("id")), part.column(part.schema.get_field_index("label")), pa.array([x.tobytes() for x, _ in found], pa.binary()), pa.array([n.tobytes() for _, n in found], pa.binary())],
                ["id", "label", "buckets", "counts"],
            )

    # one row for each id, so that repeated rows don't lengthen the sample
    texts_of = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(sample), "id").groupBy("id", "label").agg(F.min("text").alias("text"))
    rows = materialize(texts_of.mapInArrow(features, "id long, label int, buckets binary, counts binary"), "quality_rows")
    # partition by partition, and counts in few bytes, so that the driver holds little more than the sample's arrays
    found = []
    for r in rows.toLocalIterator():
        n = np.frombuffer(r["counts"], np.int32)
        n = n.astype(np.min_scalar_type(n.max(initial=0)))
        found.append((r["id"], hashlib.sha256(r["buckets"]).digest(), int(r["label"] == 1), np.frombuffer(r["buckets"], np.int32), n))
    found.sort(key=lambda r: r[:2])
    return train([r[2:] for r in found], buckets)


class _Scorer:
    """A worker's model with the feature sums of words met so far."""

    def __init__(self, model: QualityModel):
        self.model, self.place = model, {}
        self.sums, self.sizes, self.hashes = np.zeros(0), np.zeros(0), np.zeros(0, np.uint64)

    def __call__(self, texts: list[str | None]) -> list[float]:
        weights, buckets = self.model.weights, len(self.model.weights)
        split = [t.encode().split() if t else [] for t in texts]
        if len(self.place) > CACHE_WORDS:
            self.__init__(self.model)
        place = self.place
        new = [w for w in {w for ws in split for w in ws} if w not in place]
        if new:
            found, owners, hashes = word_features(new, buckets)
            self.sums = np.concatenate((self.sums, np.bincount(owners, weights=weights[found], minlength=len(new))))
            self.sizes = np.concatenate((self.sizes, np.bincount(owners, minlength=len(new))))
            self.hashes = np.concatenate((self.hashes, hashes))
            place.update(zip(new, range(len(place), len(place) + len(new))))
        out = []
        for ws in split:
            logit = self.model.bias
            if ws:
                at = np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))
                pairs = pair_buckets(self.hashes[at], buckets)
                logit += (self.sums[at].sum() + weights[pairs].sum(dtype=np.float64)) / (self.sizes[at].sum() + len(pairs))
            out.append(float(1 / (1 + np.exp(-np.clip(logit, -500, 500)))))
        return out


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """The given columns with a score in place of the text; a column of docs that is named so already is replaced."""
    kept = [f for f in docs.schema.fields if f.name not in (text_col, "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _Scorer(shared.value)
        for part, texts in text_batches(batches, text_col):
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(f.name)) for f in kept), pa.array(scorer(texts), pa.float64())], [*(f.name for f in kept), "score"])

    return docs.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "score double"]))
