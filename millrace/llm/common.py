"""Helpers shared by the training-data operators.

Every operator takes DataFrames and returns DataFrames.  Work that needs Python
runs in ``mapInArrow`` tasks over batches of bounded size; intermediate tables
that are read more than once are written below ``spark.checkpoint.dir``, which
all executors share, so that a lost executor costs only its own tasks.
"""

from __future__ import annotations

import atexit
import ctypes
import gc
import tempfile
import uuid
import weakref
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters of text that a Python helper works on at once.
SLICE_CHARS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of an input table; other columns are never read."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, a temporary one in local mode and an error on a cluster."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def _delete(spark_ref, path: str) -> None:
    spark = spark_ref()
    try:
        if spark is not None and spark.sparkContext._jsc is not None:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception as e:  # the JVM may be gone at exit; the folder is then left
        del e


def work_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, deleted when the driver's Python ends."""
    path = f"{shared_dir(spark)}/millrace-{uuid.uuid4().hex}/{name}"
    atexit.register(_delete, weakref.ref(spark), path.rpartition("/")[0])
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back: cuts lineage."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean_shuffles(spark: SparkSession) -> None:
    """Have shuffle files of finished steps deleted: Spark's cleaner acts when the driver's JVM collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo parts: the folds of the held-out contracts."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def hash_share(column: str, share: float) -> Column:
    """True for about this share of ids, the same ones at every run."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def text_batches(batches: Iterator[pa.RecordBatch], text: str, chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Cut Arrow batches to about so many bytes of text, one row at least: (part, its texts).

    Texts become Python strings only part by part, which bounds a worker's memory.
    """
    try:
        yield from _cut(batches, text, chars)
    finally:
        release()


def release() -> None:
    """Give freed memory back at a task's end: its worker may stay idle beside others."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def _cut(batches: Iterator[pa.RecordBatch], text: str, chars: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate([*sizes, chars]):
            if i > start and (size + n > chars or i == len(sizes)):
                part = batch.slice(start, i - start)
                yield part, column(part, text)
                start, size = i, 0
            size += n
