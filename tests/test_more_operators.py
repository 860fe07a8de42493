"""Aggregates, signals and trait ladders."""

import numpy as np
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.functions import signals
from millrace.operators import aggregates as A
from millrace.sources.files import mime_suffix


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_nested_documents(spark):
    df = spark.createDataFrame([("k", "wardrobe", "colour", "red", "s1"), ("k", "wardrobe", "colour", "red", "s1"), ("k", "wardrobe", "colour", "blue", "s2"), ("k", "wardrobe", "shape", "long", "s1")], "o string, k string, f string, v string, p string")
    got = A.nested_contracts(df, "o", "k", "f", "v", "p").first()
    assert {f: [tuple(x) for x in v] for f, v in got.fields.items()} == {"colour": [("blue", "s2"), ("red", "s1")], "shape": [("long", "s1")]}
    h = A.histogram(spark.createDataFrame([("image/png",), ("image/jpeg",), ("text/html",)], "m string"), "m", "image/").first()
    assert h.counts == {"image/jpeg": 1, "image/png": 1, "text/html": 1} and h.with_prefix == 2
    items = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert rows(A.declared_totals(spark.createDataFrame([("a", 2), ("b", 3), ("c", 1)], "k string, n int"), items, "k", "n")) == [("b", 3, 1), ("c", 1, 0)]


def test_sequences_and_audits(spark):
    shots = spark.createDataFrame([("s", 2, 5.0, 1.5, ["b"]), ("s", 1, 0.0, 5.0, ["a", "c"]), ("s", 3, 6.5, 1.0, None)], "scene string, o int, st double, d double, au array<string>")
    assert rows(A.assemble_sequences(shots, "scene", "o", "st", "d", "au")) == [("s", 0.0, 7.5, ["a", "c", "b"])]
    t = spark.createDataFrame([("x", "master", 60.0), ("x", "alt", 120.0), ("y", "alt", 3.0)], "k string, kind string, s double")
    assert rows(A.timeline_totals(t, "k", "kind", "s")) == [("x", 60.0, 120.0, 3.0), ("y", 0.0, 3.0, None)]
    r = spark.createDataFrame([(2, "b", False), (1, "a", None), (3, "c", True)], "n int, requirement string, passed boolean")
    assert rows(A.requirement_audit(r)) == [(3, 1, ["a", "b"])]
    claims = spark.createDataFrame([("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")], "k string, value string")
    seen = spark.createDataFrame([("a", "1", None), ("b", "2", "frame 3"), ("c", "2", "")], "k string, value string, reference string")
    assert [r.verdict for r in A.disagreements(claims, seen, "k").orderBy("k").collect()] == ["supported", "contradicted", "invalid", "unobserved"]
    m = spark.createDataFrame([("x",), ("y",), ("z",)], "k string")
    assert rows(A.consumption(m, m.where("k <> 'z'"), m.where("k = 'x'"), "k")) == [("x", "consumed"), ("y", "prepared"), ("z", "blocked")]
    plan = spark.createDataFrame([("a", 2), ("b", 1), ("c", 3)], "k string, o int")
    found, lost = A.select_clips(plan, spark.createDataFrame([("a", "p"), ("b", "q")], "k string, path string"), "k", "o")
    assert [r.k for r in found.collect()] == ["b", "a"] and rows(lost) == [("c", 3)]


def test_picks(spark):
    f = spark.createDataFrame([("n", 2, "x"), ("n", 1, "y"), ("m", 5, "z")], "name string, prio int, path string")
    assert [r.path for r in A.precedence(f, "name", "prio").orderBy("name").collect()] == ["z", "y"]
    assert [r.path for r in A.latest(f, "name", "path").orderBy("name").collect()] == ["z", "y"]
    b = spark.createDataFrame([("h", ["b"], ["u"]), ("h", ["a", "b"], [])], "h string, d array<string>, s array<string>")
    assert rows(A.merge_blobs(b, "h", ["d", "s"])) == [("h", ["a", "b"], ["u"])]
    e = spark.createDataFrame([(1, False, 0.1), (2, True, None), (3, True, 0.5)], "id int, ok boolean, d double")
    assert [(r.id, r["rank"]) for r in A.ranked(e, A.eligible_first(F.col("ok"), F.col("d")), 2).orderBy("rank").collect()] == [(3, 1), (2, 2)]


def test_vectors(spark):
    v = spark.createDataFrame([("g", "a", [2.0, 0.0]), ("g", "a", [2.0, 0.0]), ("g", "b", [0.0, 2.0])], "g string, s string, v array<double>")
    c = A.centroid(v, "g", "s", "v").first().centroid
    assert np.allclose(c, [0.5**0.5] * 2)
    x = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [0.1, 0.9])], "id int, v array<double>")
    assert A.farthest(x, "id", "v", [1.0, 0.0]).first().id == 3
    assert rows(A.two_means(x, "id", "v", [1.0, 0.0], [0.0, 1.0])) == [(1, 0), (2, 0), (3, 1), (4, 1)]


def test_signals(spark):
    flat, ramp = [5.0] * 64, [float(i * i) for i in range(64)]
    df = spark.createDataFrame([(flat,), (ramp,), ([1.0],), (None,)], "p array<double>")
    got = df.select(signals.sharpness("p").alias("s")).collect()
    assert got[0].s == 0 and got[1].s > 0 and got[2].s is None and got[3].s is None
    stats = df.select(signals.grid_stats(F.col("p")).alias("g")).first().g
    assert (stats.brightness, stats.contrast) == (5.0, 0.0)
    grid = [float(9 - i % 9) for i in range(72)]
    hashes = [r.h for r in spark.createDataFrame([(grid,), (grid[::-1],)], "p array<double>").select(signals.dhash64("p").alias("h")).collect()]
    assert hashes == ["f" * 16, "0" * 16]
    square = [0.0, 0.0, 1.0, 0.0, 1.0, 1.0, 0.0, 1.0]
    moved = [2 * c + 1 for c in square]
    h = spark.createDataFrame([(square, moved), (square, [0.0] * 8), ([0.0] * 8, moved)], "s array<double>, t array<double>").select(signals.homography("s", "t").alias("h")).collect()
    assert np.allclose(h[0].h, [2, 0, 1, 0, 2, 1, 0, 0, 1]) and h[2].h is None
    a = spark.createDataFrame([([1.0, -1.0, 0.0, 0.0],)], "s array<double>").select(signals.audio_stats(F.col("s"), F.lit(2)).alias("a")).first().a
    assert (a.seconds, a.clipping, a.silence, a.dc) == (2.0, 0.5, 0.5, 0.0) and abs(a.rms_dbfs + 3.0103) < 1e-3


def test_ladders(spark):
    df = spark.createDataFrame([("Three-quarter LEFT view", "softly Smiling", "full legs"), ("portrait", "?", "torso"), (None, "", "none")], "v string, e string, b string")
    got = rows(df.select(S.view_name(F.col("v")).alias("v"), S.canonical(F.col("e"), S.EXPRESSIONS, "uncertain").alias("e"), S.canonical(F.col("b"), S.BODY_VISIBILITY, "partial_or_uncertain").alias("b")))
    assert got == [("frontal", "uncertain", "upper_body"), ("left_three_quarter", "smiling", "full_body"), ("uncertain", "uncertain", "partial_or_uncertain")]
    faces = spark.createDataFrame([(0.4, 0.6, 0.5), (0.4, 0.6, 0.42), (0.6, 0.4, 0.6), (0.5, 0.51, 0.5), (0.4, 0.6, 0.9), (None, 0.6, 0.5)], "l double, r double, n double")
    assert [r.v for r in faces.select(S.facial_viewpoint(F.col("l"), F.col("r"), F.col("n")).alias("v")).collect()] == ["frontal", "left_three_quarter", "right_three_quarter", "profile_or_occluded", "profile", "undetermined"]
    t = spark.createDataFrame([("A CRT Monitor hums", "image/PNG; q=1")], "t string, m string")
    assert t.select(S.keyword_flags(F.col("t"), {"screen": ["screen", "crt"], "workers": ["worker"]}, ["camera"]).alias("f")).first().f == ["camera", "screen"]
    assert t.select(mime_suffix(F.col("m")).alias("s")).first().s == ".png"
