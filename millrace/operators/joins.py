"""Joins with a stated rule for repeated keys, missing partners and disjunctions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def last_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the last by order: what building a dictionary keeps."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).desc()))).where("_r = 1").drop("_r")


def first_wins(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key, the first by order: what scanning a list keeps."""
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.col(order).asc()))).where("_r = 1").drop("_r")


def fallback_lookup(df: DataFrame, lookups: Sequence[tuple[DataFrame, Sequence[str]]], value: str) -> DataFrame:
    """df with value from the first lookup table that has the row's key; each table holds one row per key."""
    out, found = df, []
    for i, (table, keys) in enumerate(lookups):
        side = table.select(*keys, F.struct(F.col(value)).alias(f"_v{i}"))
        out = out.join(side, list(keys), "left")
        found.append(F.col(f"_v{i}"))
    return out.withColumn(value, F.coalesce(*found)[value]).drop(*(f"_v{i}" for i in range(len(found))))


def missing_keys(df: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """(check, key) of non-null foreign keys without a parent."""
    keys = parent.select(F.col(parent_key).alias("_k")).distinct()
    lost = df.where(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("_k"), "left_anti")
    return lost.select(F.lit(name).alias("check"), F.col(key).cast("string").alias("key")).distinct()


def key_differences(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(key, side): ``missing`` if only expected has it, ``extra`` if only actual has it."""
    a = expected.select(key).distinct().withColumn("_e", F.lit(True))
    b = actual.select(key).distinct().withColumn("_a", F.lit(True))
    both = a.join(b, key, "full_outer").where("_e is null or _a is null")
    return both.select(key, F.when(F.col("_a").isNull(), F.lit("missing")).otherwise(F.lit("extra")).alias("side"))


def either_key(claims: DataFrame, tasks: DataFrame, key: str, tag: str, tags: str, claim_id: str, task_id: str) -> DataFrame:
    """(claim, task) pairs with the same key, or, for claims without a key, with the claim's tag among the task's tags.

    The disjunction becomes a union of two equi-joins.
    """
    by_key = claims.where(F.col(key).isNotNull()).join(tasks, key).select(claim_id, task_id)
    exploded = tasks.select(task_id, F.explode(F.array_distinct(tags)).alias(tag))
    by_tag = claims.where(F.col(key).isNull()).join(exploded, tag).select(claim_id, task_id)
    return by_key.unionByName(by_tag)


def preferred_match(left: DataFrame, right: DataFrame, key: str | list[str], preferred: Column, order: str) -> DataFrame:
    """Left rows with the preferred right row of their key, else the first by order."""
    keys = [key] if isinstance(key, str) else key
    best = right.withColumn("_p", F.coalesce(preferred, F.lit(False))).withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_p").desc(), order))).where("_r = 1").drop("_p", "_r")
    return left.join(best, keys, "left")


def outside_range(samples: DataFrame, ranges: DataFrame, key: str, at: str, low: str, high: str) -> DataFrame:
    """(key, n): samples that lie outside their key's [low, high]."""
    bad = samples.join(ranges.select(key, low, high), key).where(~F.col(at).between(F.col(low), F.col(high)))
    return bad.groupBy(key).agg(F.count("*").alias("n"))


def in_namespace(df: DataFrame, prefix: str, namespace: str) -> DataFrame:
    """Rows whose first path segment is the namespace."""
    return df.where(F.split_part(F.col(prefix), F.lit("/"), F.lit(1)) == namespace)


def drifted(planned: DataFrame, current: DataFrame, key: str, hash_col: str) -> DataFrame:
    """Planned keys whose content is gone or has another hash now."""
    now = current.select(key, F.col(hash_col).alias("_now"))
    return planned.join(now, key, "left").where(~F.col(hash_col).eqNullSafe(F.col("_now"))).select(key, hash_col, F.col("_now").alias("current_hash"))


def upsert(old: DataFrame, new: DataFrame, key: str, keep: Sequence[str]) -> DataFrame:
    """New rows with the kept columns of the old row of their key, where it has them."""
    prior = old.select(key, *(F.col(c).alias(f"_old_{c}") for c in keep))
    joined = new.join(prior, key, "left")
    return joined.select(*(F.coalesce(f"_old_{c}", c).alias(c) if c in keep else F.col(c) for c in new.columns))
