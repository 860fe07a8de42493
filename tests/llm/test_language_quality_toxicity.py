"""Classifiers: held-out accuracy, edge cases, and the linear-time segment search."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import langid, quality, queries, toxicity
from millrace.llm.common import fold

from . import brute

TENTH = "/root/testdata/sf0.1"
TRICKY = [(1, None), (2, ""), (3, " \n\t"), (4, "!!! 123"), (5, "und das ist der text " * 20_000), (5, "und das ist der text " * 20_000)]


def tricky(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names clash with results."""
    return spark.createDataFrame(TRICKY, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("lang", F.lit(None).cast("string"))


def auc(labels, scores):
    order = np.unique(scores, return_inverse=True)[1]
    counts = np.bincount(order)
    ranks = (np.cumsum(counts) - (counts - 1) / 2)[order]
    y = np.array(labels)
    return (ranks[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("name, label, least", [("op1_quality", "quality", 0.98), ("op4_toxicity", "toxic", 0.9)])
def test_held_out_scores(spark, name, label, least):
    got = queries.queries()[name](spark, TENTH)
    labels = spark.read.parquet(f"{TENTH}/labels.parquet").select("doc_id", label)
    held = got.where("held_out").join(labels, "doc_id").collect()
    assert auc([r[label] for r in held], [r.score for r in held]) >= least
    assert np.mean([r.predicted == r[label] for r in held]) >= 0.95
    assert got.where("score < 0 or score > 1 or predicted <> cast(score >= 0.7 as int)").count() == 0
    assert got.count() == spark.read.parquet(f"{TENTH}/documents.parquet").count()


def test_language_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    known = brute.profiles([(r.text, r.lang) for r in docs.where(fold("doc_id", 5) != 0).collect()])
    want = {r.doc_id: brute.language(r.text, known)[0] for r in docs.collect()}
    got = {r.doc_id: r.lang_pred for r in queries.op2_language(spark, sf).collect()}
    assert got == want


def test_language_held_out(spark):
    got = queries.op2_language(spark, TENTH).join(spark.read.parquet(f"{TENTH}/documents.parquet").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] >= 0.99


def test_language_edge_cases(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.learn_profiles(docs)
    got = sorted((r.doc_id, r.lang_pred) for r in langid.identify(tricky(spark).select("doc_id", "text"), model).collect())
    assert got == [(1, "und"), (2, "und"), (3, "und"), (4, "und"), (5, "de"), (5, "de")]
    assert langid.keep_identified(tricky(spark), model).count() == 2
    assert langid.identify(tricky(spark).select("doc_id", "text").limit(0), model).count() == 0
    empty = langid.learn_profiles(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(tricky(spark).select("doc_id", "text"), empty).collect()} == {"und"}


def test_quality_edge_cases(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = quality.learn(docs, labels, "quality")
    got = quality.score(tricky(spark).select("doc_id", "text"), model).collect()
    scores = {}
    for r in got:
        scores.setdefault(r.doc_id, set()).add(r.score)
    assert len(got) == 6 and scores[1] == scores[2] == scores[3] and len(scores[5]) == 1
    assert all(0 <= s <= 1 for v in scores.values() for s in v)
    none = quality.learn(docs, labels.limit(0), "quality")
    assert {r.score for r in quality.score(tricky(spark).select("doc_id", "text"), none).collect()} == {0.5}
    broken = labels.unionByName(spark.createDataFrame([(None, 1, 0), (3, None, None)], labels.schema))
    assert quality.learn(docs, broken, "quality").weights.shape == model.weights.shape
    assert quality.learn(docs.limit(0), labels, "quality").weights.any() == False  # noqa: E712


def test_toxicity_edge_cases(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = toxicity.learn(docs, labels, "toxic")
    got = toxicity.score(tricky(spark).select("doc_id", "text"), model).collect()
    assert len(got) == 6 and len({r.score for r in got if r.doc_id < 4}) == 1
    assert {r.score for r in toxicity.score(tricky(spark).select("doc_id", "text"), toxicity.learn(docs, labels.limit(0), "toxic")).collect()} == {0.0}
    toxicity.learn(docs.limit(0), labels, "toxic")


def test_maximal_segments_match_brute_force():
    rng = random.Random(1)

    def split(scores, low, high):
        """The best segment, then those left and right of it: the definition of maximal segments."""
        best = None
        for a in range(low, high):
            total = 0
            for b in range(a, high):
                total += scores[b]
                if total > 0 and (best is None or (total, -(b - a)) > (best[0], -(best[2] - best[1] - 1))):
                    best = (total, a, b + 1)
        return [] if best is None else [*split(scores, low, best[1]), best, *split(scores, best[2], high)]

    for _ in range(300):
        scores = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 100 for _ in range(rng.randrange(0, 14))]
        want = [(a, b) for _, a, b in split(scores, 0, len(scores))]
        assert [(a, b) for _, a, b in toxicity.maximal_segments(scores)] == want
        model = toxicity.ToxicityModel({}, 0.1)
        assert [(a, b) for _, a, b in model.segments(np.array(scores))] == want if scores else True
