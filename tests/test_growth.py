"""Work that follows the input: plans that stay small, tables read once, long chunks without a row per second."""

import random

from pyspark.sql import functions as F

from millrace.operators import dedup, graph, ordered


def test_rounds_of_components_keep_the_size_that_plans_estimate(spark):
    ids = list(range(24))
    random.Random(1).shuffle(ids)
    roots = dedup.connected_components(spark.createDataFrame(list(zip(ids, ids[1:])), "a int, b int"))
    assert sorted(map(tuple, roots.collect())) == [(i, 0) for i in range(1, 24)]
    assert len(str(roots._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 60


def test_invalidation_reads_each_state_once(spark):
    reads = spark.sparkContext.accumulator(0)

    def counted(row):
        reads.add(1)
        return row

    now = spark.createDataFrame(spark.sparkContext.parallelize([("a", "2"), ("b", "1"), ("c", "1"), ("e", "1")], 1).map(counted), "id string, fingerprint string")
    old = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")], "id string, fingerprint string")
    edges = spark.createDataFrame([("a", "b"), ("d", "c"), ("x", "e"), ("b", "d")], "parent string, child string")
    got = sorted(map(tuple, graph.invalidated(now, old, edges).collect()))
    assert got == [("a", True), ("b", False), ("c", False), ("e", True)] and reads.value == 4


def test_levels_of_short_and_very_long_chunks(spark):
    rng = random.Random(5)
    spans = [("g", 0.0, 3e9), ("g", -5.5, 0.25), ("g", 7.0, 7.0), ("g", 9.0, 8.0), ("h", 0.0, 1.0), ("g", None, 4.0)]
    spans += [("g", at, at + length) for at, length in ((rng.uniform(-20, 60), rng.choice((0.3, 1.0, 2.0, 3.7, 16.0, 40.0))) for _ in range(30))]
    points = [("g", rng.choice((rng.uniform(-30, 90), float(rng.randrange(-30, 90)))), rng.random()) for _ in range(300)] + [("g", 2.5e9, 1.0), ("g", None, 1.0)]
    got = ordered.drop_quiet(spark.createDataFrame(spans, "g string, s double, e double"), spark.createDataFrame(points, "g string, at double, energy double"), "g", "s", "e", "at", "energy")
    means = {tuple(r)[:3]: r.mean for r in got.withColumn("mean", F.pow(F.lit(10.0), F.col("level") / 10)).collect()}
    assert means.keys() == set(spans)
    for g, s, e in spans:
        inside = [v for k, at, v in points if k == g and s is not None and at is not None and s <= at < e]
        assert means[g, s, e] is None if not inside else abs(means[g, s, e] - sum(inside) / len(inside)) < 1e-6
