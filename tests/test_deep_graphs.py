"""Searches over deep graphs, against plain searches, in few rounds."""

import random

import pytest

from millrace.operators import graph


def reached(edges, seeds):
    todo, out = list(seeds), set(seeds)
    step = {}
    for a, b in edges:
        step.setdefault(a, []).append(b)
    while todo:
        for b in step.get(todo.pop(), ()):
            if b is not None and b not in out:
                out.add(b)
                todo.append(b)
    return out


def search(spark, edges, seeds):
    got = [r[0] for r in graph.reachable(spark.createDataFrame(edges, "src int, dst int"), spark.createDataFrame([(s,) for s in seeds], "node int")).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rounds, keep = [], graph.reliable
    monkeypatch.setattr(graph, "reliable", lambda df: rounds.append(1) or keep(df))
    n = 10_000
    edges = [(i, i + 1) for i in range(n)] + [(n, n + 10), (n, n + 11), (50_000, 0)]
    assert search(spark, edges, [2500, -1]) == {*range(2500, n + 1), n + 10, n + 11, -1}
    assert len(rounds) < 30


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, monkeypatch, seed):
    monkeypatch.setattr(graph, "SHALLOW", 1)
    rng, edges, at = random.Random(seed), [], 0
    for _ in range(8):  # chains, rings, rings with a way in, combs
        n = rng.choice((2, 5, 9))
        edges += [(at + i, at + i + 1) for i in range(n - 1)]
        edges += [(at + n - 1, at)] if rng.random() < 0.5 else []
        at += n
    edges += [(rng.randrange(at), rng.randrange(at)) for _ in range(6)] + [(3, 3), (4, None), (0, 1), (0, 1)]
    seeds = [rng.randrange(at + 5) for _ in range(3)]
    assert search(spark, edges, seeds) == reached(edges, seeds)


def test_rings_and_seeds_inside(spark, monkeypatch):
    monkeypatch.setattr(graph, "SHALLOW", 1)
    ring = [(i, (i + 1) % 40) for i in range(40)]
    tail = [(100 + i, 101 + i) for i in range(30)]
    back = [(130, 115)]  # a way from the end into the middle of a chain
    assert search(spark, ring + tail + back, [7, 120]) == {*range(40), *range(115, 131)}
    assert search(spark, ring + tail, [120, 105]) == set(range(105, 131))
    assert search(spark, tail, []) == set()
