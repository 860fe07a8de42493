"""Order-dependent folds over long series: spread over parts, streamed, linear."""

import datetime as dt
import random
import time

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph, ordered


def loop_ema(values, alpha=0.35):
    out, y = [], None
    for v in values:
        y = None if v is None else v if y is None else alpha * v + (1 - alpha) * y
        out.append(y)
    return out


def test_ema_of_series_that_span_many_parts(spark):
    rng = random.Random(5)
    series = {"hot": 900, "a": 1, "b": 7, "z": 40, None: 5}
    data, want = [], {}
    for g, n in series.items():
        values = [None if rng.random() < 0.02 else rng.uniform(-5, 5) for _ in range(n)]
        data += [(g, i, v) for i, v in enumerate(values)]
        want |= {(g, i): y for i, y in enumerate(loop_ema(values))}
    rng.shuffle(data)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps the small parts apart
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {(r.g, r.i): r.smoothed for r in ordered.ema(spark.createDataFrame(data, "g string, i int, v double"), "g", "i", "v").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got.keys() == want.keys()
    assert all((got[k] is None) == (want[k] is None) for k in want)
    assert all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want if want[k] is not None)


def test_ema_twice_in_one_result(spark):
    df = spark.createDataFrame([("a", i, float(i)) for i in range(50)], "g string, i int, v double")
    one = ordered.ema(df, "g", "i", "v")
    both = one.unionByName(ordered.ema(df.withColumn("g", F.lit("b")), "g", "i", "v"))
    want = loop_ema([float(i) for i in range(50)])
    assert [r.smoothed for r in both.where("g = 'b'").orderBy("i").collect()] == pytest.approx(want)


def test_empty_and_timestamp_series(spark):
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    df = spark.createDataFrame([(1, at, 2.0)], "g int, t timestamp, v double")
    assert [(r.t, r.smoothed) for r in ordered.ema(df, "g", "t", "v").collect()] == [(at, 2.0)]
    assert ordered.ema(df.limit(0), "g", "t", "v").count() == 0
    assert ordered.scene_segments(df.select("g", "v", F.lit(9.0).alias("d")).limit(0), "g", "v", "d", 1.0, 3.0).count() == 0
    assert ordered.word_chunks(df.select("g", "t", "v", F.lit(" a").alias("w")).limit(0), "g", "t", "v", "v", "w").count() == 0


def test_scene_without_inner_cuts_or_duration(spark):
    df = spark.createDataFrame([(1, None, 6.0), (2, 1.0, None), (3, 0.5, 6.0)], "g int, c double, d double")
    got = sorted(map(tuple, ordered.scene_segments(df, "g", "c", "d", 2.0, 8.0).collect()))
    assert got == [(1, 0.0, 6.0), (3, 0.0, 6.0)]


def test_long_series_take_linear_time(spark):
    """A fold that copied its result at each step would need minutes for one series of 200,000 rows."""
    n = 200_000
    one = spark.range(n).select(F.lit(1).alias("g"), "id", (F.col("id") * 3.0).alias("c"), F.lit(n * 3.0).alias("d"), F.lit(" w").alias("w"))
    began = time.monotonic()
    assert ordered.scene_segments(one, "g", "c", "d", 2.0, 8.0).count() == n
    assert ordered.word_chunks(one.select("g", "id", "c", (F.col("c") + 1.0).alias("e"), "w"), "g", "id", "c", "e", "w").count() == n // 3 + 1
    assert ordered.ema(one, "g", "id", "c").count() == n
    assert ordered.assign_tracks(one.select("g", "id", F.lit(0).alias("i"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), "g", "id", "i", "x", "y", 0.2).where("track = 0").count() == n
    assert time.monotonic() - began < 60


def test_long_chain_of_dependencies(spark):
    edges = spark.range(20).select(F.col("id").alias("parent"), (F.col("id") + 1).alias("child"))
    got = graph.reachable(edges, spark.createDataFrame([(3,)], "node long"), "parent", "child")
    assert sorted(r.node for r in got.collect()) == list(range(3, 21))


def test_pause_markers(spark):
    df = spark.createDataFrame([(1, "[pause:2s]a [pause: 1.5] b"), (2, "none"), (3, None), (4, "x[pause:z]")], "id int, text string")
    got = sorted(map(tuple, ordered.pause_markers(df, ["id"], "text").collect()))
    assert got == [(1, 0, 2.0, 0), (1, 1, 1.5, 12)]


def test_quiet_chunks_go_and_silent_segments_stay_whole(spark):
    chunks = spark.createDataFrame([("a", 0.2, 2.0, "loud"), ("a", 3.0, 4.0, "quiet"), ("b", 0.0, 1.0, "unheard")], "g string, start double, end double, text string")
    blocks = spark.createDataFrame([("a", t / 10, 1.0 if t < 20 else 1e-9) for t in range(50)], "g string, at double, energy double")
    got = {r.text: r.level for r in ordered.drop_quiet(chunks, blocks, "g", "start", "end", "at", "energy").collect()}
    assert got.keys() == {"loud", "unheard"} and got["unheard"] is None and abs(got["loud"]) < 1e-6
    segments = spark.createDataFrame([("s", 0.0, 2.0, " x "), ("t", 1.0, 3.0, " y "), ("u", 1.0, 1.2, "z")], "g string, s double, e double, w string")
    words = spark.createDataFrame([("s", 0.0, 1.0, " x"), ("t", 1.0, 2.0, " ")], "g string, s double, e double, w string")
    assert [tuple(r) for r in ordered.whole_segments(segments, words, "g", "s", "e", "w").collect()] == [("t", 0.95, 3.05, "y")]


def test_gaps_and_keyframes_of_a_long_series(spark):
    n, began = 200_000, time.perf_counter()
    rows = spark.range(n).select(F.lit(0).alias("g"), F.col("id").alias("i"), F.when(F.col("id") % 1000 == 500, F.col("id") * 2.0).alias("v"))
    got = ordered.fill_gaps(rows, "g", "i", "v").agg(F.max(F.abs(F.col("filled") - F.greatest(F.lit(1000.0), F.least(F.lit(2.0 * (n - 500)), F.col("i") * 2.0)))), F.count("filled")).first()
    assert got[0] < 1e-6 and got[1] == n
    at = ordered.interpolate_at(rows.where("v is not null"), rows.select("g", "i"), "g", "i", "v", "i")
    got = at.agg(F.max(F.abs(F.col("v") - F.greatest(F.lit(1000.0), F.least(F.lit(2.0 * (n - 500)), F.col("i") * 2.0)))), F.count("v")).first()
    assert got[0] < 1e-6 and got[1] == n
    assert time.perf_counter() - began < 60  # a frame walked anew for every row takes hours
