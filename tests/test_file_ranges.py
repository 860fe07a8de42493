"""Header parsers over ranges, the header source, files written and copied by executors."""

import io
import json
import os
import plistlib
import struct
import zipfile

import pytest

from millrace.sources import blobs, headers
from millrace.sources.sinks import ExportRefused


def read(kind, data):
    """(parsed, bytes fetched) of contents through a range file."""

    class Held:
        def read_at(self, n, at):
            return data[at : at + n]

    ranges = headers.RangeFile(Held(), len(data))
    return headers.KINDS[kind].parse(io.BufferedReader(ranges, headers.BLOCK)), ranges.fetched


def zipped(n):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("a/b.USDC", b"x" * n)
        z.writestr("c", b"")
        z.writestr("d/", b"")
    return out.getvalue()


def archive(n, fmt=plistlib.FMT_BINARY):
    resource = lambda url, size: {"WebResourceURL": url, "WebResourceMIMEType": "image/png", "WebResourceData": b"\xff" * size}
    return plistlib.dumps({"WebMainResource": resource("m", n), "WebSubresources": [resource("s é", 3 * n), "odd"], "WebSubframeArchives": [{"WebMainResource": resource("f", 20)}]}, fmt=fmt)


def tensors(n):
    header = json.dumps({"__metadata__": {"a": "b"}, "w": {"dtype": "F32", "shape": [2, n]}}).encode()
    return struct.pack("<Q", len(header)) + header + b"\0" * n


FILES = {
    "image": lambda n: b"\xff\xd8\xff\xe1" + struct.pack(">H", 60_000) + b"\0" * 59_998 + b"\xff\xff\xc2" + struct.pack(">HBHHB", 8, 8, 30, 40, 1) + b"\0" * n,
    "wav": lambda n: b"RIFF\0\0\0\0WAVE" + b"junk" + struct.pack("<I", n) + b"\0" * (n + n % 2) + b"fmt " + struct.pack("<IHHIIHH", 16, 1, 2, 8000, 32000, 4, 16) + b"data" + struct.pack("<I", 64000),
    "zip": zipped,
    "ply": lambda n: b"ply\nelement vertex 12\nproperty float x\nelement face 3\nproperty list y\nend_header\n" + b"\0" * n,
    "tensors": tensors,
    "webarchive": archive,
}
WANT = {
    "image": lambda n: (40, 30),
    "wav": lambda n: (2, 8000, 2.0),
    "zip": lambda n: [".usdc", ""],
    "ply": lambda n: (12, ["x"]),
    "tensors": lambda n: [("w", [2, n])],
    "webarchive": lambda n: [("m", "image/png", n), ("s é", "image/png", 3 * n), ("f", "image/png", 20)],
}


@pytest.mark.parametrize("kind", sorted(FILES))
def test_bytes_read_stay_constant(kind):
    small, large = 100_000, 10_000_000
    (a, read_a), (b, read_b) = read(kind, FILES[kind](small)), read(kind, FILES[kind](large))
    assert (a, b) == (WANT[kind](small), WANT[kind](large))
    assert read_b <= read_a + headers.BLOCK and read_b < 150_000


@pytest.mark.parametrize("kind", sorted(FILES))
def test_malformed_files_are_null(kind):
    data = FILES[kind](64)
    assert read(kind, b"")[0] is None and read(kind, b"other" * 100)[0] is None
    for cut in range(0, len(data), max(1, len(data) // 40)):
        read(kind, data[:cut])  # no error
        read(kind, data[:cut] + b"\xff" * 40)
        read(kind, data[:cut] + b"\0\0\0" + data[cut + 3 :])


def test_text_archives_are_read_whole():
    assert read("webarchive", archive(50, plistlib.FMT_XML))[0] == WANT["webarchive"](50)
    loop = b"bplist00" + b"\xa2\x00\x00" + b"\x08" + struct.pack(">6xBBQQQ", 1, 1, 1, 0, 11)
    assert read("webarchive", loop)[0] is None


def test_source(spark, tmp_path):
    for i in range(7):
        folder = tmp_path / f"d{i % 2}"
        folder.mkdir(exist_ok=True)
        (folder / f"{i}.wav").write_bytes(FILES["wav"](i * 1000) if i else b"RIFF")
    (tmp_path / "d0" / "other.txt").write_bytes(b"x")
    spark.dataSource.register(headers.HeaderSource)
    at = lambda root, **o: spark.read.format("file_headers").options(kind="wav", glob="*.wav", files="2", **o).load(root)
    got = {os.path.basename(r.path): (r.bytes, r.channels, r.rate, r.seconds) for r in at(str(tmp_path)).collect()}
    assert got == {f"{i}.wav": (len(FILES["wav"](i * 1000)), 2, 8000, 2.0) for i in range(1, 7)} | {"0.wav": (4, None, None, None)}
    assert at(f"file://{tmp_path}").rdd.getNumPartitions() == 4 and at(f"{tmp_path}/d0/2.wav").count() == 1
    (tmp_path / "none").mkdir()
    assert at(f"{tmp_path}/none").count() == 0
    with pytest.raises(Exception, match="kind is one of"):
        spark.read.format("file_headers").load(str(tmp_path))


def test_writes_and_copies(spark, tmp_path):
    root = str(tmp_path)
    rows = [(f"{root}/s/{i}", bytes([i]) * i) for i in range(6)] + [(f"{root}/s/null", None), (f"{root}/s/twice", b"a"), (f"{root}/s/twice", b"b")]
    df = spark.createDataFrame(rows, "target string, content binary").repartition(3)
    state = lambda report: {os.path.basename(r.target): r.state for r in report.collect()}
    assert state(blobs.write_blobs(df)) == {**{str(i): "written" for i in range(6)}, "null": "written", "twice": "ambiguous"}
    assert set(state(blobs.write_blobs(df.where("content is not null and target not like '%twice'"))).values()) == {"identical"}
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "2").write_bytes(b"already")
    wrong, plan = "0" * 64, [(f"{root}/s/{i}", f"{root}/t/{i}", None) for i in range(4)]
    nowhere = spark.createDataFrame([(None, None, None), (f"{root}/s/1", None, None), (None, f"{root}/t/z", None)], "source string, target string, expected string")
    assert sorted(r.state for r in blobs.copy_files(nowhere).collect()) == ["missing", "missing", "no target"]
    assert blobs.write_blobs(spark.createDataFrame([(None, b"a"), (None, b"b")], "target string, content binary")).select("state").distinct().collect() == [("no target",)]
    plan += [(f"{root}/s/4", f"{root}/t/4", wrong), (f"{root}/s/9", f"{root}/t/9", None), (f"{root}/s/1", f"{root}/t/x", None), (f"{root}/s/2", f"{root}/t/x", None)]
    df = spark.createDataFrame(plan, "source string, target string, expected string")
    report = blobs.copy_files(df)
    assert state(report) == {"0": "written", "1": "written", "2": "differs", "3": "written", "4": "changed", "9": "missing", "x": "ambiguous"}
    assert sorted(os.listdir(tmp_path / "t")) == ["0", "1", "2", "3"] and (tmp_path / "t" / "2").read_bytes() == b"already" and (tmp_path / "t" / "3").read_bytes() == b"\3\3\3"
    assert state(blobs.copy_files(df)) == {"0": "identical", "1": "identical", "2": "differs", "3": "identical", "4": "changed", "9": "missing", "x": "ambiguous"}
    with pytest.raises(ExportRefused, match="differs"):
        blobs.require_copied(report.where("target like '%/2'"))
    blobs.require_copied(report.where("state = 'written'"))
    assert blobs.copy_files(df.limit(0)).count() == 0
