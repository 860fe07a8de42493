"""Compile manifests: scenes, shots and formations become keyframe, video and assembly tasks.

One pass expands the three levels; every formation gives three rows whose ids name
each other.  Blockers of a shot's concepts hold up its keyframes, and what holds up a
task is carried to those that wait for it.  A timeline is built level by level, from
sums of scenes and places within a scene, so a long project is no single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import snap_frames
from ..operators.dedup import stored

#: What a video waits for besides its keyframe's blockers, and strategies that need reference media.
VIDEO_GATES = ("approved key frame", "approved motion direction")
BY_REFERENCE = ("reference", "prompt_reference")

#: So many distinct kinds of shots, or lists of concepts, are broadcast with their blockers; beyond, scenes carry all lists, and shots are dealt by theirs.
MOST_LISTS = 100_000


def video_frames(seconds: Column, fps: float, rule: str = "none") -> Column:
    """Frames of a clip, one at least; ``mod8_plus1`` takes the nearest 8n + 1, the lower one at a tie."""
    target = F.greatest(F.lit(1), F.bround(seconds * fps, 0).cast("long"))
    return snap_frames(target) if rule == "mod8_plus1" else target


def concept_blockers(shots: DataFrame, concepts: DataFrame, keys: list[str], active: str = "active_concepts") -> DataFrame:
    """(keys, blockers) of shots with any: concepts that are unknown, weights that aren't ready, references without media.

    concepts: (id, strategy, status, media), one row each.  Blockers are in the order of the shot's concepts, weights first.
    """
    listed = shots.select(*keys, F.posexplode(active).alias("_at", "id"))
    known = listed.join(concepts.select("id", "strategy", "status", "media", F.lit(True).alias("_known")), "id", "left")
    weights = F.col("strategy") == "lora"
    why = (
        F.when(F.col("_known").isNull(), F.struct(F.lit(0).alias("kind"), F.lit("unknown_concept").alias("what")))
        .when(weights & ~F.coalesce(F.col("status") == "ready", F.lit(False)), F.struct(F.lit(1).alias("kind"), F.coalesce("status", F.lit("unknown")).alias("what")))
        .when(F.col("strategy").isin(*BY_REFERENCE) & (F.coalesce("media", F.lit(0)) == 0), F.struct(F.lit(2).alias("kind"), F.lit("missing_reference_media").alias("what")))
    )
    bad = known.withColumn("_why", why).where("_why is not null")
    entry = F.struct(F.col("_why.kind").alias("kind"), F.col("_at").alias("at"), F.concat_ws(":", "id", "_why.what").alias("text"))
    return bad.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["text"]).alias("blockers"))  # of one shot's concepts


def kind_number(concepts: Column, formations: Column) -> Column:
    """Number of a kind of shots, with sizes, as hashes of lists run on and pass over nulls; kinds that share one are looked for before use."""
    return F.xxhash64(F.coalesce(F.size(concepts), F.lit(-1)), concepts, F.size(formations), formations)


def sums_before(values: Column) -> Column:
    """For each entry the sum of those before it, nulls as 0.  In blocks, as each appending of a fold copies its array."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / 256).cast("int")), lambda b: F.slice(values, b * 256 + 1, 256))
    no = lambda kind: F.array().cast(f"array<{kind}>")

    def block(done: Column, entries: Column) -> Column:
        sums = F.aggregate(entries, F.struct(done["total"].alias("total"), no("double").alias("sums")), lambda a, v: F.struct((a["total"] + F.coalesce(v, F.lit(0.0))).alias("total"), F.concat(a["sums"], F.array(a["total"])).alias("sums")))
        return F.struct(sums["total"].alias("total"), F.concat(done["sums"], F.array(sums["sums"])).alias("sums"))

    return F.flatten(F.aggregate(blocks, F.struct(F.lit(0.0).alias("total"), no("array<double>").alias("sums")), block)["sums"])


def compile_manifest(scenes: DataFrame, concepts: DataFrame, fps: float, rule: str = "none", root: str = "outputs", by: str = "project") -> DataFrame:
    """(by, kind, id, scene_id, shot_id, formation_id, depends_on, blockers, inherited, ready, output, frames, seconds, start_seconds).

    scenes: (by, ord, id, shots), where a shot has id, duration_seconds, active_concepts and formations with an
    id.  A shot's time is shared by its formations alike; starts run along a project.  ``blockers`` are a
    task's own, ``inherited`` those of the tasks it waits for; only what has neither is ready.

    Scenes are written once, numbered and without shots that make no task.  Each is dealt once, whole, to meet its
    start; shots, concepts and tasks are opened after that and not dealt again, unless distinct lists of concepts are
    too many to broadcast.  Lists are left behind where shots are of few kinds (lists of concepts and of formations).
    """
    used = F.filter("shots", lambda s: F.size(s["formations"]) > 0)
    slim = F.transform(used, lambda s: F.struct(s["id"].alias("shot_id"), s["duration_seconds"].cast("double").alias("length"), s["active_concepts"].alias("concepts"), s["formations"]["id"].alias("formations")))
    scenes = stored(scenes.select(F.col(by).alias("project"), "ord", F.col("id").alias("scene_id"), F.monotonically_increasing_id().alias("scene"), slim.alias("shots"))).where("size(shots) > 0")

    # what holds up a shot depends on its list of concepts alone; where kinds of shots are few, scenes are dealt with their numbers
    kinds = scenes.select(F.explode("shots").alias("s")).select("s.concepts", "s.formations")
    kinds = kinds.select(kind_number(F.col("concepts"), F.col("formations")).alias("kind"), "concepts", "formations")
    few = kinds.agg(F.approx_count_distinct("kind")).first()[0] <= MOST_LISTS
    if few:
        kinds = stored(kinds.distinct())
        few = kinds.count() == kinds.select("kind").distinct().count()  # each number stands for one kind
    held = stored(concept_blockers(kinds.select("concepts").distinct(), concepts, ["concepts"], "concepts").withColumnRenamed("blockers", "held"))
    held = F.broadcast(held) if held.count() <= MOST_LISTS else held
    numbered = F.transform("shots", lambda s: F.struct(s["shot_id"].alias("shot_id"), s["length"].alias("length"), kind_number(s["concepts"], s["formations"]).alias("kind")))

    # a scene's start is a sum over scenes, a shot's a sum within its scene, a formation's a product
    totals = scenes.select("project", "ord", "scene_id", "scene", F.aggregate("shots", F.lit(0.0), lambda t, s: t + s["length"]).alias("whole"))
    before = Window.partitionBy("project").orderBy("ord", "scene_id", "scene").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("scene", F.coalesce(F.sum("whole").over(before), F.lit(0.0)).alias("scene_start"))
    placed = scenes.select("project", "scene_id", "scene", (numbered if few else F.col("shots")).alias("shots")).join(starts.hint("shuffle_hash"), "scene").withColumn("before", sums_before(F.col("shots.length")))

    shots = placed.select("project", "scene_id", "scene_start", F.explode(F.arrays_zip("shots", "before")).alias("s")).select("project", "scene_id", (F.col("scene_start") + F.col("s.before")).alias("shot_start"), "s.shots.*")
    shots = shots.join(F.broadcast(kinds.join(held, "concepts", "left")), "kind") if few else shots.join(held, "concepts", "left")
    shots = shots.withColumn("held", F.coalesce("held", F.array().cast("array<string>")))
    each = shots.select("project", "scene_id", "held", "shot_start", "shot_id", (F.col("length") / F.size("formations")).alias("seconds"), F.posexplode("formations").alias("at", "formation_id"))
    each = each.withColumn("task", F.concat_ws("__", "scene_id", "shot_id", "formation_id"))
    place = lambda kind, suffix: F.concat(F.concat_ws("/", F.lit(f"{root}/{kind}"), "scene_id", "shot_id", "formation_id"), F.lit(suffix))
    name = lambda kind: F.concat(F.lit(f"{kind}__"), "task")
    none, gates = F.array().cast("array<string>"), F.array(*map(F.lit, VIDEO_GATES))
    start, frames = F.round(F.col("shot_start") + F.col("at") * F.col("seconds"), 6), video_frames(F.col("seconds"), fps, rule)

    def task(kind: str, needs: Column, blockers: Column, inherited: Column, output: Column, frames: Column, start: Column) -> Column:
        ready = (F.size(blockers) == 0) & (F.size(inherited) == 0)
        named = {"id": name(kind), "depends_on": needs, "blockers": blockers, "inherited": inherited, "ready": ready, "output": output, "frames": frames.cast("long"), "start_seconds": start.cast("double")}
        return F.struct(F.lit(kind).alias("kind"), *(c.alias(n) for n, c in named.items()))

    tasks = F.array(
        task("keyframe", none, F.col("held"), none, place("keyframes", ".png"), F.lit(None), F.lit(None)),
        task("video", F.array(name("keyframe")), gates, F.col("held"), place("clips", ".mp4"), frames, F.lit(None)),
        task("assembly", F.array(name("video")), none, F.concat(gates, "held"), place("clips", ".mp4"), F.lit(None), start),
    )
    out = each.select(F.col("project").alias(by), "scene_id", "shot_id", "formation_id", F.round("seconds", 6).alias("seconds"), F.explode(tasks).alias("t"))
    return out.select(by, "t.kind", "t.id", "scene_id", "shot_id", "formation_id", "t.depends_on", "t.blockers", "t.inherited", "t.ready", "t.output", "t.frames", "seconds", "t.start_seconds")


def manifest_counts(manifest: DataFrame, by: str = "project") -> DataFrame:
    """(by, scene_id, keyframes, videos, ready, blocked_shots, seconds) of each scene."""
    kind = F.col("kind")
    shots = manifest.groupBy(by, "scene_id", "shot_id").agg(
        F.count_if(kind == "keyframe").alias("keyframes"),
        F.count_if(kind == "video").alias("videos"),
        F.count_if("ready").alias("ready"),
        F.bool_or((kind == "keyframe") & ~F.col("ready")).cast("long").alias("blocked"),
        F.sum(F.when(kind == "assembly", F.col("seconds"))).alias("seconds"),
    )
    return shots.groupBy(by, "scene_id").agg(F.sum("keyframes").alias("keyframes"), F.sum("videos").alias("videos"), F.sum("ready").alias("ready"), F.sum("blocked").alias("blocked_shots"), F.sum("seconds").alias("seconds"))
