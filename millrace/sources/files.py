"""Files as rows: discovery, JSON documents, headers of binary files, text statistics."""

from __future__ import annotations

import io
import plistlib
from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import headers

#: Suffixes of each kind of source file.
SUFFIXES = {
    "image": (".jpg", ".jpeg", ".png", ".webp", ".tif", ".tiff"),
    "video": (".mp4", ".mov", ".mkv", ".webm"),
    "webarchive": (".webarchive",),
    "audio": (".wav", ".aiff", ".aif", ".flac", ".m4a", ".mp3", ".ogg"),
    "transcript": (".txt", ".md"),
    "geometry": (".usdz",),
    "document": (".html", ".htm"),
}

#: Suffix of an extracted blob by its content type.
MIME_SUFFIXES = {
    "image/jpeg": ".jpg",
    "image/png": ".png",
    "image/webp": ".webp",
    "image/gif": ".gif",
    "image/tiff": ".tiff",
    "image/heic": ".heic",
    "image/avif": ".avif",
}


def mime_suffix(mime: Column) -> Column:
    """The suffix of a content type, parameters aside; null for others."""
    table = F.create_map(*(F.lit(x) for pair in MIME_SUFFIXES.items() for x in pair))
    return F.try_element_at(table, F.lower(F.trim(F.split_part(mime, F.lit(";"), F.lit(1)))))


def kind_of(path: Column) -> Column:
    """The kind of a file by its suffix, null for others."""
    suffix = F.lower(F.regexp_extract(path, r"(\.[^./]+)$", 1))
    out = F.lit(None).cast("string")
    for kind, listed in SUFFIXES.items():
        out = F.when(suffix.isin(*listed), kind).otherwise(out)
    return out


def discover(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True, content: bool = False) -> DataFrame:
    """(path, kind, bytes, modified[, content]) of the files below root, one row per path.

    Listing reads no contents; with content they are read on the executors, for files below 2 GB.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).option("pathGlobFilter", glob).load(root)
    columns = ["path", kind_of(F.col("path")).alias("kind"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified")]
    return files.select(*columns, *(["content"] if content else []))


def read_json(spark: SparkSession, path: str | list[str], schema: StructType | str, multi_line: bool = True) -> DataFrame:
    """JSON documents of a declared schema with their path; unreadable ones keep their text in ``malformed``."""
    schema = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    full = StructType(schema.fields).add("malformed", "string")
    return spark.read.schema(full).option("multiLine", str(multi_line).lower()).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "malformed").json(path).withColumn("path", F.input_file_name())


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON document, or no row of the schema where the path does not exist."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return spark.read.schema(schema).option("multiLine", "true").json(path)
    return spark.createDataFrame([], schema)


def expand_variables(text: str, values: Mapping[str, str], passes: int = 10) -> str:
    """``${NAME}`` replaced until none is left; an unknown or circular name is an error."""
    for _ in range(passes):
        if "${" not in text:
            return text
        for name, value in values.items():
            text = text.replace("${" + name + "}", value)
    if "${" in text:
        raise ValueError(f"unresolved variable in {text!r}")
    return text


ADAPTERS: dict[str, Callable[[DataFrame], DataFrame]] = {}


def adapter(name: str) -> Callable:
    """Register a function that turns a foreign document table into scenes."""

    def register(f: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame], DataFrame]:
        ADAPTERS[name] = f
        return f

    return register


def adapt(df: DataFrame, name: str) -> DataFrame:
    if name not in ADAPTERS:
        raise KeyError(f"no adapter {name!r}; there are {sorted(ADAPTERS)}")
    return df.transform(ADAPTERS[name])


@adapter("scenes")
def _scenes(df: DataFrame) -> DataFrame:
    """Documents that hold an array ``scenes``, or that are scenes themselves and hold ``shots``."""
    if "scenes" in df.columns:
        return df.select(F.posexplode("scenes").alias("ord", "scene")).select("ord", "scene.*")
    if "shots" in df.columns:
        return df.select(F.lit(0).alias("ord"), *df.columns)
    raise ValueError(f"neither scenes nor shots among {df.columns}")


# Seconds of a shot by its number (1 for others), and the three formations of every shot.
SHOT_SECONDS = {"01": 10.0, "02": 10.0, "03": 10.0, "04": 7.0, "05": 7.0, "06": 4.0, "07": 12.0}
FORMATIONS = [
    ("wide", "wide", "24mm", "action path and environment"),
    ("medium", "medium", "50mm", "main action"),
    ("detail", "close", "85mm", "face, hands, prop, or story detail"),
]


@adapter("shot_list")
def _shot_list(df: DataFrame) -> DataFrame:
    """Documents with an array ``shot_list``: every shot becomes a scene of one shot in three formations.

    Fields that a document's shots lack take their defaults; a shot without a number takes its place in the list.
    """
    if "shot_list" not in df.columns:
        raise ValueError(f"no shot_list among {df.columns}")
    shots = df.select(F.posexplode("shot_list").alias("ord", "s"))
    kind = shots.schema["s"].dataType
    told = kind["director_level_generation_prompt"].dataType.names if "director_level_generation_prompt" in kind.names else []

    def field(name: str, default: Column | str) -> Column:
        fallback = default if isinstance(default, Column) else F.lit(default)
        found = F.col(f"s.{name}") if name in kind.names else F.col(f"s.director_level_generation_prompt.{name}") if name in told else None
        return fallback if found is None else F.coalesce(found.cast("string"), fallback)

    digits = field("shot_number", (F.col("ord") + 1).cast("string"))
    number = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    seconds = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for pair in SHOT_SECONDS.items() for x in pair)), number), F.lit(1.0))
    camera = field("camera_movement", "Use the source camera direction.")
    formations = F.array(*(F.struct(F.lit(i).alias("id"), F.lit(framing).alias("framing"), camera.alias("camera"), F.lit(lens).alias("lens"), F.lit(first).alias("subject_priority")) for i, framing, lens, first in FORMATIONS))
    none = F.array().cast("array<string>")
    shot = F.struct(
        F.concat(F.lit("shot_"), number).alias("id"),
        seconds.alias("duration_seconds"),
        none.alias("cast"),
        none.alias("active_concepts"),
        field("action", field("story_milestone", "")).alias("action"),
        F.array(field("primary_audio_engine", "")).alias("audio"),
        F.array(field("lighting", "")).alias("continuity"),
        none.alias("negative"),
        formations.alias("formations"),
    )
    return shots.select(
        "ord",
        F.concat(F.lit("scene_"), number).alias("id"),
        field("title", F.concat(F.lit("Scene "), number)).alias("title"),
        F.concat(F.lit("environment_"), number).alias("environment_id"),
        F.array(field("context", "")).alias("continuity"),
        field("timestamp_range", "").alias("source_timestamp_range"),
        F.array(shot).alias("shots"),
    )


def first_seen(*sources: DataFrame, key: str = "path") -> DataFrame:
    """Rows of several sources, the earliest source winning for each key."""
    out = None
    for i, s in enumerate(sources):
        s = s.withColumn("_source", F.lit(i))
        out = s if out is None else out.unionByName(s, allowMissingColumns=True)
    best = out.groupBy(key).agg(F.min("_source").alias("_source"))
    return out.join(best, [key, "_source"]).dropDuplicates([key]).drop("_source")


# -- headers of binary files: small parsers in Arrow-batched UDFs ----------------------------------


def _of(parse: Callable) -> Callable:
    """A header parser of whole contents."""
    return lambda data: parse(io.BytesIO(data))


image_size, wav_facts, zip_suffixes, ply_header, tensor_shapes = map(_of, (headers.image_size, headers.wav_facts, headers.zip_suffixes, headers.ply_header, headers.tensor_shapes))


def web_resources(data: bytes) -> list[dict] | None:
    """Resources (url, mime, bytes) of a nested web archive: main, sub-resources and sub-frames."""
    try:
        waiting, out = [plistlib.loads(data)], []
    except Exception:
        return None
    while waiting:
        doc = waiting.pop(0)
        parts, frames = (doc.get(k, []) for k in ("WebSubresources", "WebSubframeArchives")) if isinstance(doc, dict) else (None, None)
        if not isinstance(parts, list) or not isinstance(frames, list):
            return None
        for r in [doc.get("WebMainResource"), *parts]:
            if isinstance(r, dict):
                kinds = {"url": ("WebResourceURL", str), "mime": ("WebResourceMIMEType", str), "content": ("WebResourceData", bytes)}
                out.append({name: r[key] if isinstance(r.get(key), kind) else None for name, (key, kind) in kinds.items()})
        waiting += frames
    return out


def _header(df: DataFrame, parse: Callable, shape: Callable, schema: str, content: str) -> DataFrame:
    kept = [f for f in df.schema.fields if f.name != content]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [parse(bytes(b)) if b is not None else None for b in pdf[content]]
            yield pdf[[f.name for f in kept]].assign(**shape(found))

    return df.mapInPandas(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), schema]))


def with_image_size(df: DataFrame, content: str = "content") -> DataFrame:
    return _header(df, image_size, lambda x: {"width": [v and v[0] for v in x], "height": [v and v[1] for v in x]}, "width long, height long", content)


def with_wav_facts(df: DataFrame, content: str = "content") -> DataFrame:
    return _header(df, wav_facts, lambda x: {"channels": [v and v[0] for v in x], "rate": [v and v[1] for v in x], "seconds": [v and v[2] for v in x]}, "channels long, rate long, seconds double", content)


def with_zip_suffixes(df: DataFrame, content: str = "content") -> DataFrame:
    return _header(df, zip_suffixes, lambda x: {"suffixes": x}, "suffixes array<string>", content)


def with_ply_header(df: DataFrame, content: str = "content") -> DataFrame:
    return _header(df, ply_header, lambda x: {"vertices": [v and v[0] for v in x], "properties": [v and v[1] for v in x]}, "vertices long, properties array<string>", content)


def with_tensor_shapes(df: DataFrame, content: str = "content") -> DataFrame:
    return _header(df, tensor_shapes, lambda x: {"tensors": [v and [{"name": n, "shape": s} for n, s in v] for v in x]}, "tensors array<struct<name: string, shape: array<long>>>", content)


def archived_resources(df: DataFrame, content: str = "content") -> DataFrame:
    """One row per resource of each archive."""
    listed = _header(df, web_resources, lambda x: {"resources": x}, "resources array<struct<url: string, mime: string, content: binary>>", content)
    return listed.select(*(c for c in df.columns if c != content), F.explode("resources").alias("r")).select(*(c for c in df.columns if c != content), "r.*")


def suffix_histogram(df: DataFrame, suffixes: str = "suffixes") -> DataFrame:
    return df.select(F.explode(suffixes).alias("suffix")).groupBy("suffix").agg(F.count("*").alias("n"))


# -- text statistics, all built in --------------------------------------------------------------


def html_stats(df: DataFrame, html: str = "html") -> DataFrame:
    """df with chars, title, and counts of tags and absolute URLs; null HTML counts as empty."""
    h = F.coalesce(F.col(html), F.lit(""))
    count = lambda p: F.regexp_count(h, F.lit(p)).cast("long")
    return df.select(
        "*",
        F.length(h).cast("long").alias("chars"),
        F.trim(F.regexp_extract(h, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        count("(?i)<img").alias("images"),
        count("(?i)<a[ >]").alias("links"),
        count("(?i)<p[ >]").alias("paragraphs"),
        count("https?://").alias("urls"),
    )


def transcript_stats(df: DataFrame, text: str = "text") -> DataFrame:
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
    return df.select("*", F.length(t).cast("long").alias("chars"), F.size(words).cast("long").alias("words"), F.regexp_count(t, F.lit(r"\[pause:")).cast("long").alias("pauses"))


def normalised_streams(df: DataFrame, streams: str, columns: list[str]) -> DataFrame:
    """Probe streams with the allowed columns only, in index order."""
    kept = F.transform(F.col(streams), lambda s: F.struct(s["index"].alias("index"), *(s[c].alias(c) for c in columns if c != "index")))
    return df.withColumn(streams, F.array_sort(kept))


def queue_prefixes(df: DataFrame, payload: str = "payload") -> DataFrame:
    """(state, prompt_id, prefix) of a queue's JSON answer with arrays ``running`` and ``pending``."""
    entry = "array<struct<prompt_id: string, prefix: string>>"
    doc = F.from_json(payload, f"running {entry}, pending {entry}")
    rows = df.select(doc.alias("d"))
    one = lambda name, state: rows.select(F.explode(f"d.{name}").alias("q")).select(F.lit(state).alias("state"), "q.*")
    return one("running", "running").unionByName(one("pending", "queued"))
