"""Plans: matrices, nested expansion, coverage, text assembly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix_plan(tables: Sequence[DataFrame], values: Mapping[str, Sequence[object]], key: Sequence[str], sep: str = "__") -> DataFrame:
    """Every combination of the tables' rows and the listed values, with a joined id and a hash of the row.

    The plan is the product by definition; listed values are exploded, not joined.
    """
    out = tables[0]
    for t in tables[1:]:
        out = out.crossJoin(t)
    for name, listed in values.items():
        out = out.withColumn(name, F.explode(F.array(*map(F.lit, listed))))
    out = out.withColumn("plan_id", F.concat_ws(sep, *(F.col(k).cast("string") for k in key)))
    return out.withColumn("plan_hash", F.sha2("plan_id", 256))


def expand_shots(scenes: DataFrame) -> DataFrame:
    """(scene_id, scene_order, shot_id, shot_order, ...) of scenes with an ordered array ``shots`` of structs."""
    shots = scenes.select(F.col("id").alias("scene_id"), F.col("ord").alias("scene_order"), F.posexplode("shots").alias("shot_order", "shot"))
    return shots.select("scene_id", "scene_order", "shot_order", "shot.*")


def coverage_plan(shots: DataFrame, key: str, alternates: str, duration: str, share: float = 0.5) -> DataFrame:
    """One master and all alternates of each shot, alternates with a share of its duration."""
    master = F.array(F.struct(F.lit("master").alias("role"), F.lit(None).cast("string").alias("name"), F.col(duration).cast("double").alias("seconds")))
    others = F.transform(F.coalesce(F.col(alternates), F.array().cast("array<string>")), lambda a: F.struct(F.lit("alternate").alias("role"), a.alias("name"), (F.col(duration) * share).cast("double").alias("seconds")))
    return shots.select(key, F.posexplode(F.concat(master, others)).alias("take", "c")).select(key, "take", "c.*")


def layers(shots: DataFrame, key: str, conditional: Sequence[tuple[str, Column, int]]) -> DataFrame:
    """(key, layer, z) of the layers whose condition holds, in z order."""
    rows = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(name).alias("layer"), F.lit(z).alias("z"))) for name, c, z in conditional)))
    return shots.select(key, F.explode(F.array_sort(rows, lambda a, b: a["z"] - b["z"])).alias("l")).select(key, "l.*")


def required_inputs(queue: DataFrame, files: DataFrame, key: str, inputs: str) -> DataFrame:
    """(key, missing, state): ready where every required input exists."""
    have = files.where("exists").select("path").distinct()
    lost = queue.select(key, F.explode(inputs).alias("path")).join(have, "path", "left_anti").groupBy(key).agg(F.array_sort(F.collect_set("path")).alias("missing"))
    out = queue.join(lost, key, "left").withColumn("missing", F.coalesce("missing", F.array().cast("array<string>")))
    return out.withColumn("state", F.when(F.size("missing") == 0, "ready").otherwise("blocked"))


def assemble_text(parts: Sequence[Column], sep: str = ", ") -> Column:
    """Distinct non-empty parts in their order."""
    return F.array_join(F.array_distinct(F.filter(F.array(*(F.trim(p) for p in parts)), lambda p: F.coalesce(p != "", F.lit(False)))), sep)


def fill_template(template: Column, values: Mapping[str, Column]) -> Column:
    out = template
    for name, value in values.items():
        out = F.replace(out, F.lit("{{" + name + "}}"), value)
    return out


def leftover_tokens(text: Column) -> Column:
    """Placeholders that no value filled."""
    return F.regexp_extract_all(text, F.lit(r"\{\{(\w+)\}\}"), F.lit(1))


def incomplete_pairs(halves: DataFrame, module: str, half: str, rank: str, names: Sequence[str]) -> DataFrame:
    """(module, reasons): modules without both halves, or whose halves disagree on the rank."""
    want = F.array_sort(F.array(*map(F.lit, names)))
    seen = halves.groupBy(module).agg(F.array_sort(F.collect_set(half)).alias("have"), F.count_distinct(rank).alias("ranks"))
    bad = F.array_compact(F.array(F.when(F.col("have") != want, F.lit("half_missing")), F.when(F.col("ranks") > 1, F.lit("rank_mismatch"))))
    return seen.select(module, bad.alias("reasons")).where(F.size("reasons") > 0)


def dry_run(queue: DataFrame) -> DataFrame:
    """Every job, marked as no production artifact."""
    return queue.withColumn("production_artifact", F.lit(False))
