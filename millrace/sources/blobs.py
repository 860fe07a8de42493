"""Files written and copied by executors, hashed on the way, one row per file.

A file is written under a temporary name beside its place and renamed when it is
whole, so readers never see a part of one and a task that runs twice does no harm.
Files that are there already with the same content are left alone, others are never
overwritten.  Executors reach stores through ``pyarrow.fs``: folders that all
machines share, and object stores.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import stored
from .headers import file_system
from .sinks import ExportRefused

#: Bytes that a task holds of a file.
CHUNK = 1 << 20


def _chunks(place: str) -> Iterator[bytes]:
    store, path = file_system(place)
    with store.open_input_stream(path) as f:
        while data := f.read(CHUNK):
            yield data


def _there(place: str) -> bool:
    from pyarrow import fs

    store, path = file_system(place)
    return store.get_file_info(path).type == fs.FileType.File


def _digest(chunks: Iterable[bytes]) -> tuple[int, str]:
    size, sha = 0, hashlib.sha256()
    for data in chunks:
        size += len(data)
        sha.update(data)
    return size, sha.hexdigest()


def _put(chunks: Iterable[bytes], target: str, expected: str | None) -> tuple[int, str, str]:
    """(bytes, sha256, state) of contents written to a place.

    States: written; identical, the place has this content; differs, it has another one and keeps it;
    changed, the contents are not those expected and were not kept.
    """
    store, path = file_system(target)
    folder = path.rpartition("/")[0]
    store.create_dir(folder, recursive=True)
    part = f"{folder}/.{uuid.uuid4().hex}.part"
    try:
        with store.open_output_stream(part) as out:

            def passed() -> Iterator[bytes]:
                for data in chunks:
                    out.write(data)
                    yield data

            size, sha = _digest(passed())
        if expected is not None and sha != expected:
            return size, sha, "changed"
        if _there(target):
            return size, sha, "identical" if _digest(_chunks(target))[1] == sha else "differs"
        store.move(part, path)
        part = None
        return size, sha, "written"
    finally:
        if part is not None:
            store.delete_file(part)


def _copy(source: str | None, target: str | None, expected: str | None) -> tuple[int | None, str | None, str]:
    if source is None or not _there(source):
        return None, None, "missing"
    if target is None:
        return None, None, "no target"
    if _there(target):  # no temporary copy where nothing will be written
        size, sha = _digest(_chunks(source))
        if expected is not None and sha != expected:
            return size, sha, "changed"
        return size, sha, "identical" if _digest(_chunks(target))[1] == sha else "differs"
    return _put(_chunks(source), target, expected)


_REPORT = "bytes long, sha256 string, state string"


def _each(rows: DataFrame, act, keep: list[str], read: list[str]) -> DataFrame:
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 16):  # contents may be large
                batch = whole.slice(start, 16)
                found = [act(*row) for row in zip(*(batch.column(c).to_pylist() for c in read))]
                size, sha, state = zip(*found)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(size, pa.int64()), pa.array(sha, pa.string()), pa.array(state)], [*keep, "bytes", "sha256", "state"])

    return stored(rows.mapInArrow(run, f"{kinds}, {_REPORT}"))


def _single_targets(rows: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(rows whose target is theirs alone, the others)."""
    shared = rows.groupBy(target).count().where("count > 1").select(target)
    return rows.join(shared, target, "left_anti"), rows.join(shared, target, "left_semi")


def write_blobs(rows: DataFrame, target: str = "target", content: str = "content") -> DataFrame:
    """(target, bytes, sha256, state) of binary contents written as files; null contents are empty files, null targets are not written."""
    alone, shared = _single_targets(rows.select(target, content), target)
    done = _each(alone, lambda t, c: (None, None, "no target") if t is None else _put([c or b""], t, None), [target], [target, content])
    return done.unionByName(shared.select(target, F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("string").alias("sha256"), F.lit("ambiguous").alias("state")))


def copy_files(plan: DataFrame, source: str = "source", target: str = "target", expected: str = "expected") -> DataFrame:
    """(source, target, bytes, sha256, state) of a plan's copies; ``expected`` is a SHA-256 or null.

    States are those of a write, with missing for a source that isn't there, and ambiguous for targets
    that several rows of the plan name, none of which is written, and no target for a null one.  A file that was written counts once:
    a second run finds it identical.
    """
    alone, shared = _single_targets(plan.select(source, target, expected), target)
    done = _each(alone.repartition(source), _copy, [source, target], [source, target, expected])
    return done.unionByName(shared.select(source, target, F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("string").alias("sha256"), F.lit("ambiguous").alias("state")))


def require_copied(report: DataFrame, most: int = 5) -> None:
    """An error that names the first rows that are neither written nor identical."""
    bad = report.where(~F.col("state").isin("written", "identical")).orderBy("target").limit(most).collect()
    if bad:
        raise ExportRefused(", ".join(f"{r['target']}: {r['state']}" for r in bad))
