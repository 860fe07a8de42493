"""Token ids in ORC files, and statistics read back from those files.

Layout: documents are range-partitioned and sorted by id, so file k holds smaller
ids than file k + 1 and each file is one task's output.  ORC stores ``ids`` as
integer run-length encoded stripes; row indexes and a Bloom filter on the
document id let a reader skip stripes and row groups for an id or an id range
(Spark pushes such filters down), and stripes are read in parallel.

A text is encoded word by word: this tokenizer drops ASCII white space and none
of its rules looks across it, so the ids of a text are those of its words, and a
distinct word is encoded once per worker.

Null text counts as empty; each document ends with ``end_id``.  Rows with equal
ids are ordered by text, so repeated rows keep one defined order, which ``row`` (a
row's place in its file) keeps too; null ids come first.  An empty table writes an empty file set.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import text_batches, work_path

#: Encoded words that a worker keeps.
CACHE_WORDS = 700_000
#: Most bytes of input files for each token file.
FILE_BYTES = 256 << 20

#: ASCII signs that are neither letters, digits nor white space.
_SIGNS = b"!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

_ENCODERS: dict[str, tuple] = {}
_ENDS: dict[int, np.ndarray] = {}


def _encoder(path: str):
    if path not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        _ENCODERS[path] = (Tokenizer.from_file(path), {})
    return _ENCODERS[path]


def _words(text: str | None) -> list[bytes]:
    if not text:
        return []
    if "<|" not in text:  # else a special token's upper-case look-alike would become one
        try:
            # the tokenizer lower-cases too, after composing characters, of which Latin-1 text has none left to compose
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            pass
    return text.encode().split()


def _encode_words(tokenizer, words: list[bytes], cache: dict[bytes, bytes]) -> dict[bytes, bytes]:
    """Ids of each word, many words in one call.

    A run of letters is one unit of this tokenizer and a run of other signs is another, so a word
    with punctuation around its letters is the ids of its parts, which other words share.
    """
    letters, rest, parts = set(), [], {}
    for w in words:
        if w.isalpha() or w.decode().isalpha():
            letters.add(w)
            continue
        core = w.strip(_SIGNS)
        if core and core != w and b"<|" not in w and (core.isalpha() or normalize("NFC", core.decode()).lower().isalpha()):
            at = w.index(core)
            parts[w] = (w[:at], core, w[at + len(core) :])
            if core not in cache:
                letters.add(core)
        else:
            rest.append(w)
    done: dict[bytes, bytes] = {}
    runs, ends = list(letters), _word_ends(tokenizer)
    for start in range(0, len(runs), 1000):
        # each word of letters ends with its only end-of-word token
        some = runs[start : start + 1000]
        ids = np.asarray(tokenizer.encode_batch_fast([b" ".join(some).decode()], add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) == len(some):
            data, cuts = ids.tobytes(), (4 * cuts).tolist()
            done.update(zip(some, [data[x:y] for x, y in zip([0, *cuts], cuts)]))
        else:
            rest += some
    rest += {x for head, _, tail in parts.values() for x in (head, tail) if x and x not in cache}
    for w, e in zip(rest, tokenizer.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False), strict=True):
        done[w] = np.asarray(e.ids, "<u4").tobytes()
    get = lambda x: (done.get(x) or cache[x]) if x else b""
    done |= {w: get(head) + get(core) + get(tail) for w, (head, core, tail) in parts.items()}
    return done


def _word_ends(tokenizer) -> np.ndarray:
    """For each id, whether its token ends a word."""
    key = id(tokenizer)
    if key not in _ENDS:
        vocab = tokenizer.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocab.values()) + 1, bool)
        ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        _ENDS[key] = ends
    return _ENDS[key]


def encode_texts(tokenizer, cache: dict[bytes, bytes], texts: list[str | None]) -> list[bytes]:
    """Ids of each text as little-endian unsigned 32-bit integers."""
    words = [_words(t) for t in texts]
    if len(cache) > CACHE_WORDS:
        cache.clear()
    new = set().union(*words).difference(cache)
    if new:
        cache.update(_encode_words(tokenizer, list(new), cache))
    get = cache.__getitem__
    return [b"".join(map(get, ws)) for ws in words]


def input_bytes(docs: DataFrame) -> int:
    """Bytes of the files that docs reads; 0 where it reads none."""
    jvm, conf = docs.sparkSession.sparkContext._jvm, docs.sparkSession.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(f) for f in docs.inputFiles()]
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", files: int | None = None) -> None:
    """Write (id, part, row, n_tokens, ids) as ORC in ascending id order.

    files: by default as many as the session's shuffle partitions, and more where the input files hold over FILE_BYTES for each.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    end = end_id.to_bytes(4, "little")
    spark = docs.sparkSession

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, cache = _encoder(tokenizer)
        row = 0
        for part, texts in text_batches(batches, text_col):
            ids = [x + end for x in encode_texts(own, cache, texts)]
            flat = pa.py_buffer(b"".join(ids))
            offsets = [0]
            for x in ids:
                offsets.append(offsets[-1] + len(x) // 4)
            values = pa.Array.from_buffers(pa.int32(), offsets[-1], [None, flat])
            yield pa.RecordBatch.from_arrays(
                [part.column(part.schema.get_field_index(id_col)), part.column(part.schema.get_field_index("part")), pa.array(range(row, row + len(ids)), pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)],
                [id_col, "part", "row", "n_tokens", "ids"],
            )
            row += len(ids)

    files = files or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1, input_bytes(docs) // FILE_BYTES)
    ordered = docs.select(id_col, text_col).repartitionByRange(files, F.col(id_col).asc_nulls_first()).sortWithinPartitions(F.col(id_col).asc_nulls_first(), F.col(text_col).asc_nulls_first())
    (
        ordered.withColumn("part", F.spark_partition_id())
        .mapInArrow(encode, f"{id_col} {id_type}, part int, row long, n_tokens long, ids array<int>")
        .write.option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(16 << 20))
        .option("orc.bloom.filter.columns", id_col)
        .option("orc.bloom.filter.fpp", "0.01")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str, id_type: str = "bigint", id_col: str = "doc_id") -> DataFrame:
    """The token files; filters on the id reach the ORC reader."""
    return spark.read.schema(f"{id_col} {id_type}, part int, row long, n_tokens long, ids array<int>").orc(path)


def token_stats(tokens: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: start (ids of all documents before it), n_tokens, ids_crc32.

    Files hold disjoint ascending id ranges, so a start is the sum over earlier
    files plus a running sum inside the file; only one row per file meets in one task.
    """
    id_type = tokens.schema[id_col].dataType.simpleString()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            flat, offsets = memoryview(lists.flatten().to_numpy(zero_copy_only=False)).cast("B"), lists.offsets.to_pylist()
            first = offsets[0]
            crc = [zlib.crc32(flat[4 * (a - first) : 4 * (b - first)]) for a, b in zip(offsets, offsets[1:])]
            n = [b - a for a, b in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(id_col)), batch.column(batch.schema.get_field_index("part")), batch.column(batch.schema.get_field_index("row")), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], [id_col, "part", "row", "n_tokens", "ids_crc32"])

    rows = tokens.select(id_col, "part", "row", "ids").mapInArrow(digest, f"{id_col} {id_type}, part int, row long, n_tokens long, ids_crc32 long")
    per_file = tokens.groupBy("part").agg(F.sum("n_tokens").alias("file_tokens"))
    before = per_file.select("part", (F.sum("file_tokens").over(Window.orderBy("part")) - F.col("file_tokens")).alias("file_start"))
    inside = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.join(before, "part").select(id_col, (F.col("file_start") + F.sum("n_tokens").over(inside) - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")


def tokenize_to_orc(docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write documents as token files in the shared folder and return their statistics."""
    path = work_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id, id_col, text_col)
    return token_stats(read_tokens(docs.sparkSession, path, docs.schema[id_col].dataType.simpleString(), id_col), id_col)
