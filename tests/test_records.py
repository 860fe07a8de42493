"""Literal cases of record operators and of readers of malformed files."""

import json
import plistlib
import struct

import pytest
from pyspark.sql import functions as F

from millrace.functions import scalars as S
from millrace.operators import aggregates, dedup, records, select
from millrace.sources import files, sinks


def test_json_answers():
    read = records.json_answer
    assert read('noise {x} {"a":1} tail {y}', ["a"]) == '{"a":1}'
    assert read('{"b":1} then {"a":{"b":2}}', ["a"]) == '{"a":{"b":2}}'
    assert read('```json\n{"a": 1}\n```') == '{"a": 1}' and read("[1, 2]") == "[1, 2]"
    assert read("```{}```") == "{}" and read("~~~ ```JSON {\"a\":2}```", ["a"]) == '{"a":2}' and read("```json\nno\n```") is None
    assert read('{ "} {"a": "}"} x', ["a"]) == '{"a": "}"}' and read('say "hi" {[}] {"a":[{}]} {"a":2}', ["a"]) == '{"a":[{}]}'
    for deep in ("[" * 100_000, "{" * 100_000, '{"a":' * 50_000 + "1" + "}" * 50_000, "[" * 100_000 + "]" * 100_000, '"{' * 50_000):
        assert read(deep, ["b"]) is None
    assert read("[" * 100_000 + ' {"a": 1}', ["a"]) == '{"a": 1}'
    assert read('{"a": {"b": 1', ["a"]) is None and read('{"a": {"b": 1}', ["a"]) is None and read(None) is None and read("") is None


def test_stages_and_requirements(spark):
    rows = [("video__1", None, None, 5), ("video__1", None, None, 3), ("video__2", "extended_clips", None, None), ("video__3", "motion_proofs", None, 5), ("storyboard__1", None, "expansion", None), ("a", "known", None, None), ("b", None, None, None)]
    df = spark.createDataFrame(rows, "id string, phase string, priority string, seconds int")
    got = [r.s for r in df.select(records.stage_of(F.col("id"), F.col("phase"), F.col("priority"), F.col("seconds"), {"known": "x"}).alias("s")).collect()]
    assert got == ["extended_sequences", "scripted_clips", "extended_sequences", "scripted_clips", "storyboards", "x", "character_sheets"]
    need = spark.createDataFrame([("character_sheets", None, None), ("character_sheets", None, 3), ("character_sheets", "first_review", 3), ("storyboards", None, 1), ("x", None, None)], "s string, p string, n int")
    assert [r.x for r in need.select(records.is_required(F.col("s"), F.col("p"), F.col("n")).alias("x")).collect()] == [True, False, True, False, True]


def test_performer_keeps_to_the_nearest(spark):
    rows = [("a", 1, 0, 0.0, 0.0, 0.5), ("a", 1, 1, 1.0, 1.0, 0.9), ("a", 2, 0, 0.0, 0.0, 0.99), ("a", 2, 1, 0.9, 0.9, 0.1), ("a", 3, 0, None, None, 1.0), ("a", 4, 0, 0.8, 0.8, 0.2)]
    got = records.associate_performer(spark.createDataFrame(rows, "s string, t int, i int, x double, y double, c double"), "s", "t", "i", "x", "y", "c")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1, 1), ("a", 2, 1), ("a", 4, 0)]


def test_small_labels(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first()[0]
    assert one(records.iso_time(F.lit(86461))) == "1970-01-02T00:01:01+00:00"
    assert one(records.narrow_age(F.lit("in her mid-30s"))) and not one(records.narrow_age(F.lit("aged")))
    assert one(records.nearest_in(F.array(F.lit(1), F.lit(5)), F.lit(3))) == 1
    assert one(S.rational(F.lit("24000/1001"))) == 23.976024 and one(S.rational(F.lit("3000000000/2"))) == 1.5e9
    assert one(select.leakage_group(F.lit(None), F.lit("ab"))) == "source_sha256:ab"


def test_malformed_files_are_null():
    assert files.web_resources(plistlib.dumps([1])) is None and files.web_resources(plistlib.dumps({"WebMainResource": "x"})) == []
    for key in ("WebSubresources", "WebSubframeArchives"):
        assert files.web_resources(plistlib.dumps({key: 3})) is None
    assert files.web_resources(plistlib.dumps({"WebMainResource": {"WebResourceURL": 1, "WebResourceData": "x"}})) == [{"url": None, "mime": None, "content": None}]
    for count in (b"x", b"9" * 5000, str(2**70).encode()):
        assert files.ply_header(b"ply\nelement vertex " + count + b"\nend_header") is None
    deep = b'{"a":' * 100_000
    assert files.tensor_shapes(struct.pack("<Q", len(deep)) + deep) is None
    for header in ({"a": 1}, [1], {"a": {"shape": 3}}, {"a": {"shape": ["x"]}}, {"a": {"shape": [2**70]}}, {"a": {"shape": [True]}}):
        body = json.dumps(header).encode()
        assert files.tensor_shapes(struct.pack("<Q", len(body)) + body) is None


def test_jpeg_segments():
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 8, 8, 30, 40, 1)
    app = b"\xff\xe0" + struct.pack(">H", 6) + b"\xff\xc0ab"
    assert files.image_size(b"\xff\xd8" + app + b"\xff" + frame) == (40, 30)
    assert files.image_size(b"\xff\xd8" + app) is None and files.image_size(b"\xff\xd8\xff") is None and files.image_size(b"") is None


def test_reports_are_never_cut(spark):
    with pytest.raises(sinks.ExportRefused):
        sinks.markdown_report(spark.range(3), "T", most=2)
    assert len(sinks.markdown_report(spark.range(2), "T", most=2).splitlines()) == 6


def test_merged_lists_and_two_means(spark):
    df = spark.createDataFrame([("h", ["b", "a"]), ("h", ["a"]), ("k", [])], "h string, l array<string>")
    assert sorted(tuple(r) for r in aggregates.merge_blobs(df, "h", ["l"]).collect()) == [("h", ["a", "b"]), ("k", [])]
    points = spark.createDataFrame([(i, [1.0, 0.1 * i]) for i in range(4)] + [(i, [0.1 * i, 1.0]) for i in range(4, 8)], "i long, v array<double>")
    assert sorted(tuple(r) for r in aggregates.two_means(points, "i", "v", [1.0, 0.0], [0.0, 1.0]).collect()) == [(i, int(i > 3)) for i in range(8)]


def test_checkpoints_need_a_shared_folder_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError):
        dedup.reliable(Frame())
