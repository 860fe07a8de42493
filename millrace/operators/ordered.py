"""Order-dependent operators: timelines, gap filling, smoothing, segmentation, tracking."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from ..functions.scalars import PAUSE
from .dedup import reliable
from .restarts import restarts


def timeline(df: DataFrame, by: str | Sequence[str], order: Sequence[str], duration: str, start: str = "start_seconds", end: str = "end_seconds") -> DataFrame:
    """Start and end of each row: running sums of the unrounded durations before it, rounded to 6 places."""
    keys = [by] if isinstance(by, str) else list(by)
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum(duration).over(before), F.lit(0.0))
    return df.withColumn(start, F.round(at, 6)).withColumn(end, F.round(at + F.col(duration), 6))


def proportional_map(df: DataFrame, by: str, order: Sequence[str], duration: str, total: str, start: str = "source_start", end: str = "source_end") -> DataFrame:
    """Intervals that share ``total`` in proportion to duration; the last end is total itself."""
    whole = Window.partitionBy(by)
    running = whole.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.row_number().over(whole.orderBy(*order)) == F.count("*").over(whole)
    scale = F.col(total) / F.sum(duration).over(whole)
    upto = F.sum(duration).over(running)
    out = df.withColumn(start, F.round((upto - F.col(duration)) * scale, 6))
    return out.withColumn(end, F.when(last, F.round(F.col(total).cast("double"), 6)).otherwise(F.round(upto * scale, 6)))


def fill_gaps(df: DataFrame, by: str, index: str, value: str, out: str = "filled") -> DataFrame:
    """Null values interpolated along index between their neighbours; the nearest value at the ends.

    What follows is the last value seen in descending order, so both windows only ever grow: time is linear.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)
    back, ahead = (Window.partitionBy(by).orderBy(o).rowsBetween(*upto) for o in (F.asc(index), F.desc(index)))
    seen = F.when(F.col(value).isNotNull(), F.struct(F.col(index).alias("i"), F.col(value).alias("v")))
    before, after = F.last(seen, True).over(back), F.last(seen, True).over(ahead)
    i0, v0, i1, v1 = before["i"], before["v"], after["i"], after["v"]
    between = v0 + (F.col(index) - i0) * (v1 - v0) / (i1 - i0)
    return df.withColumn(out, F.when(F.col(value).isNotNull(), F.col(value)).when(i0.isNull(), v1).when(i1.isNull(), v0).otherwise(between))


def interpolate_at(keyframes: DataFrame, times: DataFrame, by: str, at: str, value: str, time: str) -> DataFrame:
    """Values at arbitrary times, linear between keyframes and constant outside; the earlier segment wins at a keyframe.

    As-of through two growing windows over keyframes and times together: no range join, linear time.
    """
    marks = keyframes.select(by, F.col(at).alias("t"), F.col(value).alias("v"), F.lit(True).alias("mark"))
    asked = times.select(by, F.col(time).alias("t"), F.lit(None).cast("double").alias("v"), F.lit(False).alias("mark"))
    # only times are answered, so a row's own keyframe never counts and frames may end at it; descending, marks of a time come after it
    upto = (Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(by).orderBy("t", F.desc("mark")).rowsBetween(*upto)
    ahead = Window.partitionBy(by).orderBy(F.desc("t"), "mark").rowsBetween(*upto)
    point = F.when(F.col("mark"), F.struct("t", "v"))
    both = marks.unionByName(asked).withColumn("a", F.last(point, True).over(before)).withColumn("b", F.last(point, True).over(ahead))
    lerp = F.col("a.v") + (F.col("t") - F.col("a.t")) / (F.col("b.t") - F.col("a.t")) * (F.col("b.v") - F.col("a.v"))
    return both.where("not mark").select(by, F.col("t").alias(time), F.coalesce(F.when(F.col("a.t") == F.col("t"), F.col("a.v")), lerp, F.col("a.v"), F.col("b.v")).alias(value))


def each_series(rows: DataFrame, keys: list[str], order: Sequence[str | Column], drop: Sequence[str], fold: Callable[[tuple, Iterator[tuple]], Iterator[tuple]], schema: StructType) -> DataFrame:
    """What ``fold`` yields for every series: rows of equal keys, in order, without the dropped columns.

    A series streams through one task, sorted by Spark, and is never held as a whole: memory is that
    of the fold's own state, and time grows in proportion to the rows.
    """
    arrow, n = to_arrow_schema(schema), len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        out = (made for key, series in itertools.groupby(rows, lambda r: r[:n]) for made in fold(key, (r[n:] for r in series)))
        while part := list(itertools.islice(out, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part), arrow)], schema=arrow)

    return rows.repartition(*keys).sortWithinPartitions(*keys, *order).drop(*drop).mapInArrow(run, schema)


def ema(df: DataFrame, by: str, order: str, value: str, alpha: float = 0.35, usable: Column | None = None) -> DataFrame:
    """(by, order, smoothed): exponential mean per group; its first usable value starts it, unusable rows give none.

    A null value gives null and the value after it starts again.  Rows are dealt by ranges of group
    and order, so a long group is spread over many tasks: the rows of a group within one part map
    the mean before them to the mean after them by a * mean + b.  The driver chains these maps, one
    row per part, and each part is then smoothed from the mean that enters it.
    """
    rest = 1 - alpha
    rows = df.where(usable) if usable is not None else df
    series = rows.select(F.col(by).alias("k"), F.col(order).alias("o"), F.col(value).cast("double").alias("v"))
    parts = reliable(series.repartitionByRange("k", "o", "v").sortWithinPartitions("k", "o", "v").withColumn("p", F.spark_partition_id()))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = first = last = None
        keys, a, b, alone = 0, 1.0, 0.0, None
        for batch in batches:
            for k, v, part in zip(*(batch.column(c).to_pylist() for c in ("k", "v", "p"))):
                if not keys or k != last:
                    first = first if keys else k
                    keys, last, a, b, alone = keys + 1, k, 1.0, 0.0, None
                if v is None:
                    a, b, alone = None, None, None
                else:
                    alone = v if alone is None else alpha * v + rest * alone
                    a, b = (None, None) if a is None else (rest * a, alpha * v + rest * b)
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((part, first, last, keys == 1, a, b, alone), arrow)], schema=arrow)

    key = df.schema[by].dataType
    kinds = {"p": IntegerType(), "first": key, "last": key, "single": BooleanType(), "a": DoubleType(), "b": DoubleType(), "alone": DoubleType()}
    schema = StructType([StructField(c, t) for c, t in kinds.items()])
    arrow = to_arrow_schema(schema)
    entering, mean, before = {}, None, None
    for r in sorted(parts.mapInArrow(ends, schema).collect(), key=lambda r: r.p):  # one row per part
        enters = mean if before is not None and before.last == r.first else None
        if enters is not None:
            entering[r.p] = enters
        mean = r.a * enters + r.b if r.single and enters is not None and r.a is not None else r.alone
        before = r
    held = df.sparkSession.sparkContext.broadcast(entering)

    def smooth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = last = mean = None
        for batch in batches:
            out = []
            for k, v, p in zip(*(batch.column(c).to_pylist() for c in ("k", "v", "p"))):
                if part != p:
                    mean = held.value.get(p)
                elif k != last:
                    mean = None
                part, last = p, k
                mean = v if v is None or mean is None else alpha * v + rest * mean
                out.append(mean)
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("o"), pa.array(out, pa.float64())], [by, order, "smoothed"])

    return parts.mapInArrow(smooth, StructType([StructField(by, key), StructField(order, df.schema[order].dataType), StructField("smoothed", DoubleType())]))


def scene_segments(cuts: DataFrame, by: str, cut: str, duration: str, least: float, most: float) -> DataFrame:
    """(by, start, end): scenes between cuts that lie at least ``least`` apart, none longer than ``most``.

    Cuts within ``least`` of an end do not count; longer scenes are cut off every ``most`` seconds and
    remainders below ``least`` are dropped.  A long recording is spread over many tasks.
    """
    inside = (F.col(cut) > least) & (F.col(cut) < F.col(duration) - least) & (F.col(duration) - F.col(cut) >= least)
    rows = cuts.select(F.col(by).alias("g"), F.col(duration).cast("double").alias("d"), F.when(inside, F.col(cut).cast("double")).alias("c"))

    def spans_of(key: tuple, part: pa.RecordBatch, breaks: list[int], entering: tuple[float, int] | None, number: int, ends: bool) -> Iterator[tuple]:
        g, whole = key
        if whole is None:
            return
        at, places = entering[0] if entering else 0.0, part.column(2)
        for i in breaks:
            yield g, at, (at := places[i].as_py())
        if ends:
            yield g, at, whole

    schema = StructType([StructField(by, cuts.schema[by].dataType), StructField("x", DoubleType()), StructField("y", DoubleType())])
    spans = restarts(rows, ["g", "d"], ["c"], "c", "c", least, spans_of, schema, initial=0.0)
    # whole pieces: as many as leave a rest that is not longer than most
    parts = F.greatest(F.lit(0), F.ceil((F.col("y") - F.col("x")) / most - 1)).cast("int")
    cut_up = spans.select(by, "x", "y", parts.alias("n")).select(by, "x", "y", "n", F.explode(F.sequence(F.lit(0), F.col("n"))).alias("i"))
    start = F.col("x") + F.col("i") * most
    end = F.when(F.col("i") < F.col("n"), start + most).otherwise(F.col("y"))
    return cut_up.select(by, start.alias("start"), end.alias("end")).where(F.col("end") - F.col("start") >= least)


def word_chunks(words: DataFrame, by: str, order: str, start: str, end: str, text: str, flush: float = 4.5, least_tail: float = 1.0, least: float = 0.8, pad: float = 0.05) -> DataFrame:
    """(by, start, end, text): words joined until a chunk lasts ``flush``; a short tail joins the chunk before it.

    Chunks get ``pad`` on both sides and are dropped below ``least``.  A long recording is spread over many tasks.
    """
    rows = words.where(F.trim(text) != "").select(F.col(by).alias("g"), F.col(order).alias("o"), F.col(start).cast("double").alias("s"), F.col(end).cast("double").alias("e"), F.col(text).alias("w"))

    def numbered(key: tuple, part: pa.RecordBatch, breaks: list[int], entering: tuple[float, int] | None, number: int, ends: bool) -> Iterator[tuple]:
        chunk, opens = entering[1] if entering else number, set(breaks)
        for i, (s, e, w) in enumerate(zip(*(part.column(c).to_pylist() for c in (2, 3, 4)))):
            chunk = number + i if i in opens else chunk
            yield *key, chunk, number + i, s, e, w

    kinds = {"g": words.schema[by].dataType, "chunk": LongType(), "n": LongType(), "s": DoubleType(), "e": DoubleType(), "w": StringType()}
    said = restarts(rows, ["g"], ["o", "s", "e", "w"], "e", "s", flush, numbered, StructType([StructField(c, t) for c, t in kinds.items()]), behind=True)

    def joined(rows: DataFrame) -> DataFrame:
        words = F.array_sort(F.collect_list(F.struct("n", "w")))  # of one chunk
        return rows.groupBy("g", "chunk").agg(F.min("n").alias("n"), F.min_by("s", "n").alias("s"), F.max_by("e", "n").alias("e"), F.array_join(F.transform(words, lambda x: x["w"]), "").alias("w"))

    chunks = reliable(joined(said))
    last = chunks.groupBy("g").agg(F.max("chunk").alias("last"))
    tails = chunks.join(last.select(F.col("g").alias("tail_g"), F.col("last").alias("tail")), F.col("g").eqNullSafe(F.col("tail_g")) & (F.col("chunk") == F.col("tail"))).where(F.col("e") - F.col("s") < min(flush, least_tail)).select("tail_g", "tail")
    to = chunks.join(tails, F.col("g").eqNullSafe(F.col("tail_g")) & (F.col("chunk") < F.col("tail"))).groupBy("g", "tail").agg(F.max("chunk").alias("to")).select(F.col("g").alias("tail_g"), "tail", "to")
    moved = chunks.join(to, F.col("g").eqNullSafe(F.col("tail_g")) & F.col("chunk").isin(F.col("tail"), F.col("to")), "left").select("g", F.coalesce("to", "chunk").alias("chunk"), "n", "s", "e", "w")
    padded = joined(moved).select(F.col("g").alias(by), F.greatest(F.lit(0.0), F.col("s") - pad).alias("start"), (F.col("e") + pad).alias("end"), F.trim("w").alias("text"))
    return padded.where(F.col("end") - F.col("start") >= least)


def whole_segments(segments: DataFrame, words: DataFrame, by: str, start: str, end: str, text: str, least: float = 0.8, pad: float = 0.05) -> DataFrame:
    """(by, start, end, text): one chunk for each segment without any word, padded and gated as word chunks are."""
    spoken = words.where(F.trim(text) != "").select(by).distinct()
    padded = segments.join(spoken, by, "left_anti").select(by, F.greatest(F.lit(0.0), F.col(start) - pad).alias("start"), (F.col(end) + pad).alias("end"), F.trim(text).alias("text"))
    return padded.where(F.col("end") - F.col("start") >= least)


def drop_quiet(chunks: DataFrame, blocks: DataFrame, by: str, start: str, end: str, at: str, energy: str, least_db: float = -48.0) -> DataFrame:
    """The chunks with their level in dB, without those below least_db.

    blocks: (by, at, energy), mean squares of equally long stretches that begin at ``at``.  Chunks meet
    their blocks in bins of the first power of two seconds that is as long as the chunk, of which it touches
    two or three, so there is no range join and a long chunk makes no more rows than a short one.  Blocks are
    dealt to bins once for each such width.  A chunk without blocks has a null level and stays.
    """
    width = F.pow(F.lit(2.0), F.greatest(F.lit(0), F.ceil(F.log2(F.col(end) - F.col(start)))))
    spans = chunks.where(F.col(end) > F.col(start)).select(by, start, end, width.alias("_width"))
    bins = spans.distinct().withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / F.col("_width")), F.floor(F.col(end) / F.col("_width")))))
    widths = F.broadcast(spans.select("_width").distinct())  # powers of two: a few rows
    heard = blocks.crossJoin(widths).select(by, "_width", F.floor(F.col(at) / F.col("_width")).alias("_bin"), F.col(at).alias("_at"), F.col(energy).alias("_energy"))
    inside = bins.join(heard, [by, "_width", "_bin"]).where((F.col("_at") >= F.col(start)) & (F.col("_at") < F.col(end)))
    levels = inside.groupBy(by, start, end).agg((20 * F.log10(F.sqrt(F.avg("_energy") + 1e-12))).alias("level"))
    return chunks.join(levels, [by, start, end], "left").where(F.coalesce(F.col("level") >= least_db, F.lit(True)))


def pause_markers(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """(keys, i, seconds, offset) of every pause marker; offset counts the characters before it.  Keys name one row."""
    parts = df.select(
        *keys,
        F.transform(F.split(text, PAUSE), F.length).alias("gap"),
        F.transform(F.regexp_extract_all(text, F.lit(PAUSE), F.lit(0)), F.length).alias("width"),
        F.regexp_extract_all(text, F.lit(PAUSE), F.lit(1)).alias("seconds"),
    )
    rows = parts.select(*keys, F.posexplode(F.arrays_zip("gap", "width", "seconds")).alias("i", "m")).select(*keys, "i", "m.*").where("width is not null")
    before = Window.partitionBy(*keys).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.col("gap") + F.col("width")).over(before), F.lit(0)) + F.col("gap")
    return rows.select(*keys, "i", F.col("seconds").cast("double").alias("seconds"), offset.alias("offset"))


def assign_tracks(detections: DataFrame, by: str, frame: str, index: str, x: str, y: str, most: float) -> DataFrame:
    """(by, frame, index, track): nearest detections of consecutive frames share a track, at most ``most`` apart.

    Pairs are taken by distance, then detection, then track, each side once; other detections open
    tracks.  Only the frame before counts, so a track ends where one frame misses it.  Each source
    is one ordered series, of which a task holds two frames at a time.  Rows without a frame or a
    point have no track.
    """
    known = F.col(frame).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull()
    rows = detections.where(known).select(F.col(by).alias("g"), F.col(frame).alias("f"), F.col(index).alias("i"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))

    def follow(key: tuple, series: Iterator[tuple]) -> Iterator[tuple]:
        before: dict[int, tuple[float, float]] = {}
        following = 0
        for f, found in itertools.groupby(series, lambda r: r[0]):
            points = list(found)
            near = sorted((d, i, t) for i, p in enumerate(points) for t, q in before.items() if (d := math.dist(p[2:], q)) <= most)
            track_of: dict[int, int] = {}
            taken: set[int] = set()
            for _, i, t in near:
                if i not in track_of and t not in taken:
                    track_of[i] = t
                    taken.add(t)
            for i in range(len(points)):
                if i not in track_of:
                    track_of[i], following = following, following + 1
            before = {track_of[i]: p[2:] for i, p in enumerate(points)}
            for i, p in enumerate(points):
                yield *key, f, p[1], track_of[i]

    schema = StructType([*(StructField(c, detections.schema[c].dataType) for c in (by, frame, index)), StructField("track", LongType())])
    return each_series(rows, ["g"], ["f", F.col("i").asc_nulls_last(), "x", "y"], [], follow, schema)


def root_relative(df: DataFrame, by: Sequence[str], x: str, y: str, is_root: Column) -> DataFrame:
    """Points relative to their root, in units of the pose's vertical extent (1 if it has none)."""
    pose = Window.partitionBy(*by)
    extent = F.max(y).over(pose) - F.min(y).over(pose)
    scale = F.when(extent > 0, extent).otherwise(F.lit(1.0))
    rx, ry = F.max(F.when(is_root, F.col(x))).over(pose), F.max(F.when(is_root, F.col(y))).over(pose)
    return df.withColumn("rel_x", (F.col(x) - rx) / scale).withColumn("rel_y", (F.col(y) - ry) / scale)


def sample_points(start: Column, end: Column, shares: Sequence[tuple[str, float]]) -> Column:
    """Named times at given shares of an interval, as an array of (name, at)."""
    return F.array(*(F.struct(F.lit(n).alias("name"), F.round(start + (end - start) * s, 6).alias("at")) for n, s in shares))


def even_points(duration: Column, n: int) -> Column:
    """n times that cut a duration into n + 1 equal parts."""
    return F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: duration * i / (n + 1))


def runner_up_margin(df: DataFrame, by: str, distance: str, out: str = "margin") -> DataFrame:
    """The best row of each group with how far the second best stands behind; null if alone."""
    order = Window.partitionBy(by).orderBy(distance)
    return df.withColumn(out, F.lead(distance).over(order) - F.col(distance)).withColumn("_r", F.row_number().over(order)).where("_r = 1").drop("_r")
