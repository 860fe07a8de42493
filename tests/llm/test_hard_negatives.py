"""Hard negatives against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import negatives, queries

from ..oracle import connect, same


def brute(rows, every=50, positives=5, most=3):
    """rows: distinct (id, label, vector) without nulls."""
    width = max((len(v) for _, _, v in rows), default=0)
    x = [np.array([int(np.floor(256 * float(c))) for c in v] + [0] * (width - len(v)), object) for _, _, v in rows]
    out = set()
    for a, (anchor, label, _) in enumerate(rows):
        if anchor % every:
            continue
        scored = sorted((-int(x[a] @ x[b]), rows[b][0], rows[b][1]) for b in range(len(rows)) if b != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:positives]:
            fits = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:most]
            out |= {(anchor, positive, i, s[1], -p, -s[0]) for i, s in enumerate(fits, 1)}
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def test_tables(spark, sf):
    same(queries.op11_hard_negatives(spark, sf), connect(sf), queries.oracle_sql()["op11_hard_negatives"])


@pytest.mark.parametrize("spread", [0.1, 2.0])
def test_many_lists(spark, monkeypatch, spread):
    for name, value in (("LIST_ROWS", 40), ("CHUNK_ROWS", 30), ("FIRST_ROWS", 60), ("BLOCK", 3)):
        monkeypatch.setattr(negatives, name, value)
    rng = np.random.default_rng(int(spread * 10))
    x = (rng.normal(size=(30, 1, 8)) + spread * rng.normal(size=(30, 30, 8))).reshape(-1, 8).astype(np.float32)
    x[100:300] = x[0]  # a hot vector
    rows = [(i, int(rng.integers(3)), v.tolist()) for i, v in enumerate(x)]
    got = negatives.mine_negatives(frame(spark, rows).repartition(5), every=20)
    assert {tuple(r) for r in got.collect()} == brute(rows, 20)


def test_separated_clusters_open_few_lists(spark, monkeypatch):
    for name, value in (("LIST_ROWS", 20), ("FIRST_ROWS", 40)):
        monkeypatch.setattr(negatives, name, value)
    seen, visits = [], negatives._Search._visits

    def counted(self, *a):
        out = visits(self, *a)
        seen.append((out.count(), len(self.lists.value.counts), a[0].count()))
        return out

    monkeypatch.setattr(negatives._Search, "_visits", counted)
    rng = np.random.default_rng(5)
    x = (rng.normal(size=(40, 1, 8)) + 0.01 * rng.normal(size=(40, 30, 8))).reshape(-1, 8)
    rows = [(i, i % 3, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    assert {tuple(r) for r in negatives.mine_negatives(frame(spark, rows), every=20).collect()} == brute(rows, 20)
    assert all(n < 0.4 * lists * asked for n, lists, asked in seen), seen


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.0]), (2, 2, [0.75, 0.5]), (3, 2, [0.75]), (4, 1, [-1.0, 0.0]), (50, 1, [1.0, 0.0]), (6, 3, []), (7, 3, [0.9, 0.0]), (100, 9, [0.5, 0.5]), (1, 2, [0.5, 0.25])]
    bad = [(None, 1, [1.0, 0.0]), (8, None, [1.0, 0.0]), (9, 1, None), (10, 1, [None, 1.0]), (11, 2, [nan, 1.0]), (150, 1, [inf, 0.0])]
    df = frame(spark, [*good, *bad, good[0], good[2]]).withColumns({"rank": F.lit("x"), "q": F.lit(1), "key": F.lit(2), "ps": F.lit(0)})
    got = [tuple(r) for r in negatives.mine_negatives(df).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(good)
    assert {g[0] for g in got} == {0, 50}
    assert negatives.mine_negatives(df.limit(0)).count() == 0
    assert negatives.mine_negatives(frame(spark, bad)).count() == 0
    assert negatives.mine_negatives(frame(spark, [(0, 1, [1.0])])).count() == 0
    named = df.select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("score"), F.col("embedding").alias("v"))
    assert {tuple(r) for r in negatives.mine_negatives(named, "id", "v", "score").collect()} == set(got)
    big = [(i, i % 2, [2e4 * (i + 1), 3.0]) for i in range(60)]
    assert {tuple(r) for r in negatives.mine_negatives(spark.createDataFrame(big, "vec_id long, label int, embedding array<double>"), every=20).collect()} == brute(big, 20)
    with pytest.raises(ValueError):
        negatives.mine_negatives(frame(spark, [(0, 1, [1e30])]))
