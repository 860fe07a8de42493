"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, ranked

from ..oracle import connect, same

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), t) for t in TERM.findall(text or "")]


def brute(docs, items, k=10):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    count, total, df = len(held), sum(c.total() for _, c in held), Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 25 + 75 * c.total() * count // total
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms(text) if c[t])
            if score > 0:
                scored.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scored, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows, name):
    return spark.createDataFrame(rows, f"{name} long, text string")


def test_tables(spark, sf):
    same(queries.op12_ranked_search(spark, sf), connect(sf), queries.oracle_sql()["op12_ranked_search"])


@pytest.mark.parametrize("seed", [1, 2])
def test_shards_and_groups(spark, monkeypatch, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(60)], k=n))
    docs = [(i, text(rng.choice((1, 5, 30, 200)))) for i in range(400)]
    docs += [(1000 + i, docs[3][1]) for i in range(60)]  # copies: ties by id
    items = [(i, text(rng.choice((1, 3, 12)))) for i in range(12)] + [(50, docs[3][1])]
    # groups and shards are cut in the tasks: the sizes are set by a plain run of the group's code, then by Spark
    held = [(i, Counter(terms(t))) for i, t in docs]
    df = Counter(t for _, c in held for t in c)
    number = {t: n for n, t in enumerate(df)}
    count, total = len(held), sum(c.total() for _, c in held)
    import numpy as np

    weights = np.array([math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) for t in number], np.int64)
    asked = [{number[t]: c for t, c in Counter(terms(t)).items() if t in number} for _, t in items]
    rarest = [sorted(q, key=lambda t: -weights[t]) for q in asked]
    monkeypatch.setattr(ranked, "SHARD_DOCS", 32)
    bars, hits = [1] * len(items), []
    for start in range(0, len(held), 150):
        part = held[start : start + 150]
        sizes = np.array([len(c) for _, c in part])
        flat = [np.array(x, np.int64) for x in ([number[t] for _, c in part for t in c], [n for _, c in part for n in c.values()])]
        hits += ranked._Group([i for i, _ in part], [c.total() for _, c in part], sizes, *flat, weights, count, total).search(asked, rarest, bars, 10)
    want = brute(docs, items)
    got = []
    for q, (item, _) in enumerate(items):
        best = sorted((-s, d) for n, d, s in hits if n == q)[:10]
        got += [(item, r, d, -s) for r, (s, d) in enumerate(best, 1)]
    assert sorted(got, key=repr) == want
    assert found(ranked.rank_documents(frame(spark, docs, "doc_id").repartition(3), frame(spark, items, "item_id"))) == want


def test_wand_skips():
    class Seen(list):
        opened = 0

        def __getitem__(self, i):
            Seen.opened += 1
            return super().__getitem__(i)

    docs = list(range(1000))
    lists = [(5, [*docs, ranked._END], Seen([5] * 1000)), (100, [500, 900, ranked._END], Seen([100, 90]))]
    heap = []
    assert ranked.wand(lists, heap, 2, 60) == 95
    assert sorted(heap) == [(95, -900), (105, -500)] and Seen.opened == 4


def test_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_CHARS", 40)
    docs = [(1, "The CAT sat"), (2, "the cat\x00sat the cat"), (3, None), (4, ""), (5, " \n.,!"), (6, "é É x"), (None, "the cat"), (2, "the cat\x00sat the cat"), (7, "x" * 50), (8, "a-b_c 12")]
    items = [(1, "cat"), (2, "CAT cat, the"), (3, None), (4, ""), (5, "?!"), (6, "É x é"), (7, "nowhere"), (None, "sat"), (1, "cat"), (8, "c 12 A")]
    d = frame(spark, docs, "doc_id").withColumns({"item_id": F.lit(9), "rank": F.lit("r"), "score": F.lit(0), "terms": F.lit(1)})
    i = frame(spark, items, "item_id").withColumns({"doc_id": F.lit("d"), "key": F.lit(1)})
    assert found(ranked.rank_documents(d, i)) == brute(docs, items)
    assert ranked.rank_documents(d.limit(0), i).count() == 0
    assert ranked.rank_documents(d, i.limit(0)).count() == 0
    same_names = ranked.rank_documents(d.withColumnRenamed("doc_id", "id").select("id", "text"), i.withColumnRenamed("item_id", "id").select("id", "text"), "id", "text", "id", "text")
    assert found(same_names) == brute(docs, items)


def test_long_texts_in_slices(monkeypatch):
    text = "Ab,c é" * 50 + "d" * 40 + " e"
    whole = [t for s in ranked.term_slices(text.encode()) for t in s]
    monkeypatch.setattr(ranked, "SLICE_CHARS", 7)
    assert [t for s in ranked.term_slices(text.encode()) for t in s] == whole == [t.encode() for t in terms(text)]
