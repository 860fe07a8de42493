"""Files, sinks and streaming on small inputs."""

import io
import json
import plistlib
import struct
import zipfile

import pytest
from pyspark.sql import functions as F

from millrace.sources import files, sinks
from millrace.streaming import windows


def png(width, height):
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">II", width, height) + b"\x08\x02\x00\x00\x00"


def jpeg(width, height):
    app = b"\xff\xe0" + struct.pack(">H", 4) + b"ab"
    return b"\xff\xd8" + app + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\x01\x11\x00" + b"\xff\xd9"


def wav(channels, rate, seconds):
    data = b"\0" * int(rate * channels * 2 * seconds)
    fmt = struct.pack("<HHIIHH", 1, channels, rate, rate * channels * 2, channels * 2, 16)
    body = b"WAVE" + b"fmt " + struct.pack("<I", 16) + fmt + b"data" + struct.pack("<I", len(data)) + data
    return b"RIFF" + struct.pack("<I", len(body)) + body


def zipped():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a/x.PNG", "1")
        z.writestr("y.png", "1")
        z.writestr("README", "1")
    return out.getvalue()


def test_discover_and_headers(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name, data in (("a.png", png(640, 480)), ("sub/b.jpg", jpeg(30, 20)), ("c.wav", wav(2, 8000, 0.5)), ("d.usdz", zipped()), ("e.xyz", b"?")):
        (tmp_path / name).write_bytes(data)
    found = files.discover(spark, f"file://{tmp_path}", content=True)
    kinds = {r.path.rsplit("/", 1)[1]: (r.kind, r.bytes) for r in found.select("path", "kind", "bytes").collect()}
    assert kinds["a.png"][0] == kinds["b.jpg"][0] == "image" and kinds["c.wav"][0] == "audio" and kinds["d.usdz"][0] == "geometry" and kinds["e.xyz"] == (None, 1)
    sizes = {r.path.rsplit("/", 1)[1]: (r.width, r.height) for r in files.with_image_size(found.select("path", "content")).collect()}
    assert sizes["a.png"] == (640, 480) and sizes["b.jpg"] == (30, 20) and sizes["c.wav"] == (None, None)
    audio = files.with_wav_facts(found.where("kind = 'audio'").select("path", "content")).first()
    assert (audio.channels, audio.rate, audio.seconds) == (2, 8000, 0.5)
    hist = files.suffix_histogram(files.with_zip_suffixes(found.where("kind = 'geometry'").select("path", "content")))
    assert {(r.suffix, r.n) for r in hist.collect()} == {(".png", 2), ("", 1)}
    assert files.discover(spark, f"file://{tmp_path}", "*.png").count() == 1


def test_model_headers(spark):
    ply = b"ply\nformat ascii 1.0\nelement vertex 3\nproperty float x\nproperty float y\nelement face 1\nproperty list uchar int vertex_indices\nend_header\n"
    header = json.dumps({"__metadata__": {}, "w": {"dtype": "F32", "shape": [2, 3], "data_offsets": [0, 24]}}).encode()
    df = spark.createDataFrame([("p", bytearray(ply)), ("t", bytearray(struct.pack("<Q", len(header)) + header)), ("n", None)], "k string, content binary")
    got = {r.k: (r.vertices, r.properties) for r in files.with_ply_header(df).collect()}
    assert got == {"p": (3, ["x", "y"]), "t": (None, None), "n": (None, None)}
    shapes = {r.k: r.tensors for r in files.with_tensor_shapes(df).collect()}
    assert [(t.name, t["shape"]) for t in shapes["t"]] == [("w", [2, 3])] and shapes["n"] is None


def test_web_archives(spark):
    inner = {"WebMainResource": {"WebResourceURL": "u3", "WebResourceMIMEType": "text/html", "WebResourceData": b"3"}}
    doc = {"WebMainResource": {"WebResourceURL": "u1", "WebResourceMIMEType": "text/html", "WebResourceData": b"1"}, "WebSubresources": [{"WebResourceURL": "u2", "WebResourceMIMEType": "image/png", "WebResourceData": b"2"}], "WebSubframeArchives": [inner]}
    df = spark.createDataFrame([(1, bytearray(plistlib.dumps(doc))), (2, bytearray(b"junk")), (3, None)], "k int, content binary")
    assert sorted((r.k, r.url, r.mime, bytes(r.content)) for r in files.archived_resources(df).collect()) == [(1, "u1", "text/html", b"1"), (1, "u2", "image/png", b"2"), (1, "u3", "text/html", b"3")]


def test_json_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": "x",\n "n": 1}')
    (tmp_path / "b.json").write_text('{"id": "y", ')
    got = {r.path.rsplit("/", 1)[1]: (r.id, r.malformed is not None) for r in files.read_json(spark, f"file://{tmp_path}/*.json", "id string, n int").collect()}
    assert got["a.json"] == ("x", False) and got["b.json"][1]
    assert files.read_optional(spark, f"file://{tmp_path}/none.json", "id string").count() == 0
    assert files.read_optional(spark, f"file://{tmp_path}/a.json", "id string").first().id == "x"


def test_variables_and_adapters(spark):
    assert files.expand_variables("${A}/x", {"A": "${B}", "B": "r"}) == "r/x"
    with pytest.raises(ValueError):
        files.expand_variables("${A}", {"A": "${A}"})
    df = spark.createDataFrame([([("s1", 2.0)],)], "scenes array<struct<id: string, d: double>>")
    assert files.adapt(df, "scenes").first().id == "s1"
    with pytest.raises(KeyError):
        files.adapt(df, "nothing")


def test_shot_list_adapter(spark):
    kind = "shot_list array<struct<shot_number: int, title: string, story_milestone: string, director_level_generation_prompt: struct<camera_movement: string, context: string>>>"
    df = spark.createDataFrame([([(4, None, "falls", ("pan", "dusk")), (None, "End", None, None)],)], kind)
    a, b = files.adapt(df, "shot_list").orderBy("ord").collect()
    assert (a.id, a.title, a.environment_id, a.continuity, a.source_timestamp_range) == ("scene_04", "Scene 04", "environment_04", ["dusk"], "")
    shot = a.shots[0]
    assert (shot.id, shot.duration_seconds, shot.action, shot.audio, shot.cast) == ("shot_04", 7.0, "falls", [""], [])
    assert [(f.id, f.camera, f.lens) for f in shot.formations] == [("wide", "pan", "24mm"), ("medium", "pan", "50mm"), ("detail", "pan", "85mm")]
    assert (b.id, b.title, b.shots[0].duration_seconds, b.shots[0].formations[0].camera) == ("scene_02", "End", 10.0, "Use the source camera direction.")
    alone = spark.createDataFrame([("s", ["x"])], "id string, shots array<string>")
    assert files.adapt(alone, "scenes").first().id == "s"
    for name in ("scenes", "shot_list"):
        with pytest.raises(ValueError):
            files.adapt(spark.range(1), name)
    a, b = spark.createDataFrame([("p", 1)], "path string, v int"), spark.createDataFrame([("p", 2), ("q", 3)], "path string, v int")
    assert sorted((r.path, r.v) for r in files.first_seen(a, b).collect()) == [("p", 1), ("q", 3)]


def test_probe_and_queue(spark):
    df = spark.createDataFrame([([(1, "audio", "x"), (0, "video", "y")],)], "streams array<struct<index: int, codec_type: string, junk: string>>")
    got = files.normalised_streams(df, "streams", ["codec_type"]).first().streams
    assert [(s["index"], s.codec_type) for s in got] == [(0, "video"), (1, "audio")] and "junk" not in got[0]
    q = spark.createDataFrame([('{"running": [{"prompt_id": "1", "prefix": "p/a"}], "pending": [{"prompt_id": "2", "prefix": "p/b"}]}',)], "payload string")
    assert sorted(tuple(r) for r in files.queue_prefixes(q).collect()) == [("queued", "2", "p/b"), ("running", "1", "p/a")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "h1", "train", True), (2, "h2", "validation", True)], "id int, h string, split string, ready boolean")
    path = f"file://{tmp_path}/out"
    sinks.guarded_export(df, path, "ready", "h")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["split=train", "split=validation"]
    with pytest.raises(sinks.ExportRefused):
        sinks.guarded_export(df.withColumn("ready", F.col("id") == 1), path, "ready", "h")
    with pytest.raises(sinks.ExportRefused):
        sinks.guarded_export(df.withColumn("h", F.lit("same")), path, "ready", "h")
    with pytest.raises(sinks.ExportRefused):
        sinks.verified_write(df, spark.createDataFrame([(1, "other")], "id int, h string"), path, "id", "h")
    sinks.verified_write(df, df, f"{path}2", "id", "h")
    sinks.create_if_absent(df.limit(0), f"{path}2")
    assert spark.read.parquet(f"{path}2").count() == 2
    sinks.write_partitions(df, f"{path}3", "split")
    sinks.write_partitions(df.where("id = 1").withColumn("h", F.lit("new")), f"{path}3", "split")
    assert sorted(r.h for r in spark.read.parquet(f"{path}3").collect()) == ["h2", "new"]
    assert sinks.rewrite_prefix(df.withColumn("p", F.lit("/old/x")), "p", "/old", "/new").first().p == "/new/x"
    assert sinks.markdown_report(df.select("id", "h").orderBy("id"), "T").splitlines()[-1] == "| 2 | h2 |"


def test_streams(spark, sf, tmp_path):
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    (tmp_path / "in").mkdir()
    (tmp_path / "in/events.parquet").symlink_to(f"{sf}/events.parquet")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in").withColumn("ts", F.col("ts").cast("timestamp"))
    batch = spark.read.schema(schema).parquet(f"{tmp_path}/in").withColumn("ts", F.col("ts").cast("timestamp"))

    def run(df, mode):
        name = f"t{abs(hash(str(df.columns)))}"
        q = df.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", f"{tmp_path}/{name}").start()
        q.processAllAvailable()
        q.stop()
        return spark.table(name)

    counts = run(windows.windowed_counts(stream, "1 hour"), "update")
    assert counts.agg(F.sum("n")).first()[0] == batch.count()
    want = {r.user_id: round(r.smoothed, 6) for r in _last_ema(batch)}
    got = {r.user_id: round(r.smoothed, 6) for r in run(windows.streaming_ema(stream), "update").collect()}
    assert got == want
    live = spark.createDataFrame([(1, "running")], "job_id long, live_state string")
    log = batch.select(F.col("event_id").alias("job_id"), F.lit("complete").alias("status"))
    assert windows.live_overlay(log, live).where("state = 'running'").count() == 1


def _last_ema(batch):
    from millrace.operators.ordered import ema

    return ema(batch, "user_id", "event_id", "value").groupBy("user_id").agg(F.max_by("smoothed", "event_id").alias("smoothed")).collect()
