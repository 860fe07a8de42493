"""Language identification by rank-order n-gram profiles.

A language's profile is its ``top`` most frequent character n-grams (one to three
characters, words padded with a space) in rank order; a document's profile is made
the same way from its whole text.  The out-of-place distance sums, over the
document's n-grams, how far each stands from its place in the language's profile,
with a fixed maximum for n-grams that the profile lacks.  The nearest language wins, ties go to the name that sorts first.

Profiles are learned from a bounded sample: about ``per_language`` documents of
each language, chosen by a hash of the id.

Null text, and text without a letter: ``und`` with score 0.  Rows are judged one by
one, so ties and repeated rows get equal answers.  Without any training row every
document is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_share, text_batches

UNDETERMINED = "und"
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def ngram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams (21 bits a character) of a text, ascending, and their counts."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _letters()[points]
    if not letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points = np.concatenate(([32], np.where(letter, points, 32), [32]))
    keep = np.ones(len(points), bool)
    keep[1:] = (points[1:] != 32) | (points[:-1] != 32)  # runs of other characters are one space
    p = points[keep]
    one = p[p != 32]
    two = (p[:-1] << 21) | p[1:]
    three = (p[:-2] << 42) | (p[1:-1] << 21) | p[2:]
    codes = np.concatenate((one, two, three[p[1:-1] != 32]))
    codes.sort()
    first = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[first], np.diff(np.append(first, len(codes)))


def top_ngrams(codes: np.ndarray, counts: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams in rank order, ties by code."""
    if len(codes) > top:  # codes ascend, so a stable sort keeps ties in code order
        return codes[np.argsort(-counts, kind="stable")[:top]]
    return codes[np.argsort(-counts, kind="stable")]


@dataclass(frozen=True)
class Profiles:
    languages: tuple[str, ...]
    codes: np.ndarray  #: all n-grams of any profile, ascending
    ranks: np.ndarray  #: rank of each n-gram in each language, top where it is absent
    top: int

    def distances(self, text: str | None) -> np.ndarray | None:
        """Out-of-place distance to each language as a share of the maximum; None without letters."""
        own = top_ngrams(*ngram_counts(text), self.top)
        if not len(own) or not self.languages:
            return None
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == own)[:, None], self.ranks[at], self.top)
        places = np.arange(len(own))[:, None]
        away = np.where(ranks == self.top, self.top, np.abs(ranks - places))
        return away.sum(0) / (len(own) * self.top)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """(language, score, margin): score is one less the nearest distance, margin the lead over the next language."""
        away = self.distances(text)
        if away is None:
            return UNDETERMINED, 0.0, 0.0
        best = int(np.argmin(away))
        rest = np.delete(away, best)
        return self.languages[best], float(1 - away[best]), float(rest.min() - away[best]) if len(rest) else 1.0


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", top: int = 300, per_language: int = 2000) -> Profiles:
    """Profiles of each non-null language, from a hashed sample of the given training documents."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return Profiles((), np.zeros(0, np.int64), np.zeros((0, 0), np.int64), top)
    share: Column = F.lit(False)
    for lang, n in sorted(sizes.items()):
        share = share | ((F.col("lang") == lang) & hash_share("id", min(1.0, per_language / n)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, "text"):
            langs = part.column(part.schema.get_field_index("lang")).to_pylist()
            found: dict[str, list] = {}
            for lang, text in zip(langs, texts):
                found.setdefault(lang, []).append(ngram_counts(text))
            for lang, pairs in found.items():
                codes, back = np.unique(np.concatenate([c for c, _ in pairs]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([k for _, k in pairs]), minlength=len(codes)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(n)], ["lang", "code", "n"])

    counts = labelled.where(share).select("lang", "text").mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    # the best of each of 64 shares of the n-grams, then the best of those: no task gets a whole language
    order = (F.col("n").desc(), F.col("code"))
    some = counts.withColumn("bin", F.pmod(F.xxhash64("code"), F.lit(64))).withColumn("r", F.row_number().over(Window.partitionBy("lang", "bin").orderBy(*order))).where(F.col("r") <= top)
    best = some.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("r") <= top).select("lang", "code", "r").collect()
    languages = tuple(sorted(sizes))
    codes = np.unique(np.array([r["code"] for r in best], np.int64))
    ranks = np.full((len(codes), len(languages)), top, np.int64)
    place = {c: i for i, c in enumerate(languages)}
    for r in best:
        ranks[np.searchsorted(codes, r["code"]), place[r["lang"]]] = r["r"] - 1
    return Profiles(languages, codes, ranks, top)


def identify(docs: DataFrame, profiles: Profiles, text_col: str = "text") -> DataFrame:
    """The given columns with lang_pred, score and margin in place of the text; columns of docs that are named so already are replaced."""
    kept = [f for f in docs.schema.fields if f.name not in (text_col, "lang_pred", "score", "margin")]
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, text_col):
            found = [model.value.predict(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(part.schema.get_field_index(f.name)) for f in kept), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.float64())],
                [*(f.name for f in kept), "lang_pred", "score", "margin"],
            )

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "lang_pred string, score double, margin double"])
    return docs.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, profiles: Profiles, text_col: str = "text", least_margin: float = 0.005) -> DataFrame:
    """The rows, all columns, whose language can be told.

    Rejected: text that is null or has no letter, and text whose two nearest languages lie within
    least_margin of each other, as shares of the largest distance.
    """
    model = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_batches(batches, text_col):
            keep = [lang != UNDETERMINED and margin >= least_margin for lang, _, margin in map(model.value.predict, texts)]
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
