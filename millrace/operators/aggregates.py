"""Aggregations into nested documents, summaries with checks, audits, small clusterings."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import dot, normalised


def nested_contracts(rows: DataFrame, owner: str, kind: str, field: str, value: str, provenance: str) -> DataFrame:
    """(owner, kind, fields): a map from field to its (value, provenance) list, distinct and sorted."""
    lists = rows.groupBy(owner, kind, field).agg(F.array_sort(F.collect_set(F.struct(F.col(value).alias("value"), F.col(provenance).alias("provenance")))).alias("values"))
    return lists.groupBy(owner, kind).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(field, "values")))).alias("fields"))


def histogram(df: DataFrame, key: str, prefix: str) -> DataFrame:
    """(counts, with_prefix): one row with the key-sorted counts as a map, and how many rows start with the prefix."""
    counts = df.groupBy(key).agg(F.count("*").alias("n"))
    return counts.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, "n")))).alias("counts"), F.coalesce(F.sum(F.when(F.startswith(key, F.lit(prefix)), F.col("n"))), F.lit(0)).alias("with_prefix"))


def declared_totals(manifests: DataFrame, items: DataFrame, key: str, declared: str) -> DataFrame:
    """(key, declared, counted) of manifests whose declared total differs from their items."""
    counts = items.groupBy(key).agg(F.count("*").alias("counted"))
    joined = manifests.select(key, F.col(declared).alias("declared")).join(counts, key, "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return joined.where(~F.col("declared").eqNullSafe(F.col("counted")))


def assemble_sequences(shots: DataFrame, scene: str, order: str, start: str, duration: str, audio: str) -> DataFrame:
    """(scene, start, seconds, audio): first start, rounded total, and the audio lists one after another."""
    lists = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(audio).alias("a")))), lambda x: x["a"])
    return shots.groupBy(scene).agg(F.min_by(start, order).alias("start"), F.round(F.sum(duration), 6).alias("seconds"), F.flatten(F.filter(lists, lambda a: a.isNotNull())).alias("audio"))


def timeline_totals(rows: DataFrame, by: str, kind: str, seconds: str, master: str = "master") -> DataFrame:
    """(by, master_seconds, other_seconds, multiplier): coverage against the master's length."""
    is_master = F.col(kind) == master
    own = F.coalesce(F.sum(F.when(is_master, F.col(seconds))), F.lit(0.0))
    rest = F.coalesce(F.sum(F.when(~is_master, F.col(seconds))), F.lit(0.0))
    return rows.groupBy(by).agg(own.alias("master_seconds"), rest.alias("other_seconds"), F.try_divide(own + rest, own).alias("multiplier"))


def requirement_audit(rows: DataFrame, number: str = "n", text: str = "requirement", passed: str = "passed") -> DataFrame:
    """One row: how many requirements there are, how many pass, and the texts of those that don't, in order."""
    lost = F.transform(F.array_sort(F.collect_list(F.when(~F.coalesce(F.col(passed), F.lit(False)), F.struct(number, text)))), lambda x: x[text])
    return rows.agg(F.count("*").alias("total"), F.count_if(passed).alias("passed"), lost.alias("blockers"))


def disagreements(claims: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """(key, claimed, observed, verdict): supported, contradicted or unobserved; a contradiction without evidence reference is invalid."""
    joined = claims.select(key, F.col("value").alias("claimed")).join(evidence.select(key, F.col("value").alias("observed"), "reference"), key, "left")
    verdict = F.when(F.col("observed").isNull(), "unobserved").when(F.col("observed") == F.col("claimed"), "supported").when(F.coalesce(F.col("reference"), F.lit("")) == "", "invalid").otherwise("contradicted")
    return joined.select(key, "claimed", "observed", verdict.alias("verdict"))


def consumption(modalities: DataFrame, prepared: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    """(key, state): consumed, prepared or blocked, by which evidence there is."""
    a = prepared.select(key).distinct().withColumn("_p", F.lit(True))
    b = consumed.select(key).distinct().withColumn("_c", F.lit(True))
    state = F.when(F.col("_c"), "consumed").when(F.col("_p"), "prepared").otherwise("blocked")
    return modalities.select(key).distinct().join(a, key, "left").join(b, key, "left").select(key, state.alias("state"))


def select_clips(plan: DataFrame, clips: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(clips in plan order, plan rows without a clip)."""
    found = plan.join(clips, key).orderBy(order)
    return found, plan.join(clips.select(key).distinct(), key, "left_anti")


def precedence(files: DataFrame, name: str, priority: str) -> DataFrame:
    """One file per name, the one of the lowest priority number."""
    return files.withColumn("_r", F.row_number().over(Window.partitionBy(name).orderBy(priority, "path"))).where("_r = 1").drop("_r")


def merge_blobs(blobs: DataFrame, hash_col: str, lists: Sequence[str]) -> DataFrame:
    """One row per content with the distinct, sorted union of its list columns."""
    out = blobs.select(hash_col).distinct()
    for c in lists:  # distinct values are told before lists are made, so copies of a content add nothing
        values = blobs.select(hash_col, F.explode(c).alias("_v")).distinct()
        out = out.join(values.groupBy(hash_col).agg(F.array_sort(F.collect_list("_v")).alias(c)), hash_col, "left").withColumn(c, F.coalesce(c, F.array().cast(blobs.schema[c].dataType)))
    return out


def centroid(rows: DataFrame, group: str, source: str, vector: str) -> DataFrame:
    """(group, centroid): mean of the sources' mean vectors, so every source weighs the same, at unit length."""
    dims = rows.select(group, source, F.posexplode(vector).alias("i", "x"))
    mean = dims.groupBy(group, source, "i").agg(F.avg("x").alias("x")).groupBy(group, "i").agg(F.avg("x").alias("x"))
    lists = mean.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    return lists.select(group, normalised(F.transform("v", lambda p: p["x"])).alias("centroid"))


def farthest(rows: DataFrame, id_col: str, vector: str, reference: Sequence[float]) -> DataFrame:
    """The row least like a reference vector, the smallest id at a tie."""
    return rows.select(id_col, dot(F.col(vector), F.array(*map(F.lit, reference))).alias("score")).orderBy("score", id_col).limit(1)


def two_means(rows: DataFrame, id_col: str, vector: str, first: Sequence[float], second: Sequence[float], rounds: int | None = None) -> DataFrame:
    """(id, cluster): two-means on unit vectors from two given centres.

    Rounds go on until the centres stay as they are, or for so many; each is one aggregation, and the
    driver holds the two centres only.
    """
    dims = len(first)
    centres = [list(map(float, first)), list(map(float, second))]
    for _ in itertools.count() if rounds is None else range(rounds):
        labelled = rows.select(id_col, vector, _nearer(vector, centres).alias("cluster"))
        means = labelled.groupBy("cluster").agg(*(F.avg(F.col(vector)[i]).alias(f"m{i}") for i in range(dims))).collect()
        new = list(centres)
        for r in means:
            v = [r[f"m{i}"] for i in range(dims)]
            norm = sum(x * x for x in v) ** 0.5 or 1.0
            new[r["cluster"]] = [x / norm for x in v]
        if max(abs(x - y) for a, b in zip(new, centres) for x, y in zip(a, b)) < 1e-12:  # sums differ in their last bits between runs
            break
        centres = new
    return rows.select(id_col, _nearer(vector, centres).alias("cluster"))


def _nearer(vector: str, centres: Sequence[Sequence[float]]) -> Column:
    a, b = (dot(F.col(vector), F.array(*map(F.lit, c))) for c in centres)
    return F.when(b > a, 1).otherwise(0)


def ranked(df: DataFrame, order: Sequence[Column], most: int) -> DataFrame:
    """The first rows of an order with their rank."""
    return df.orderBy(*order).limit(most).withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def eligible_first(eligible: Column, distance: Column, *more: Column) -> list[Column]:
    """Eligible rows first, then known distances ascending, unknown ones last."""
    return [eligible.desc(), distance.isNull(), distance, *more]


def latest(df: DataFrame, by: str, path: str) -> DataFrame:
    """The row of each group whose path sorts last."""
    return df.groupBy(by).agg(F.max_by(F.struct(*df.columns), path).alias("r")).select("r.*")
