"""Balanced selection, group-safe splits and their checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import reliable


def round_robin(df: DataFrame, strata: Sequence[str], order: Sequence[Column], most: int) -> DataFrame:
    """Up to ``most`` rows, taken in turn from the strata in key order, each stratum in the given order.

    A row's turn is its number inside its stratum, so the whole is a top-k by (turn, stratum).
    """
    turn = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return df.withColumn("turn", turn).where(F.col("turn") <= most).orderBy("turn", *strata).limit(most)


def global_rank(df: DataFrame, *order: str, out: str = "place") -> DataFrame:
    """df with each row's place in a total order, from 1, without a single-task sort.

    Rows are range-partitioned and numbered inside their partition; only one count per partition
    meets in one task.  The partitioned rows are checkpointed, so counts and numbers see the same rows.
    """
    parts = reliable(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return parts.withColumn("_r", inside).join(before, "_part").withColumn(out, F.col("_r") + F.col("_before")).drop("_part", "_r", "_before")


def leakage_group(group: Column, sha256: Column) -> Column:
    """A row's group; without one, the hash of its content."""
    return F.coalesce(group.cast("string"), F.concat(F.lit("source_sha256:"), sha256))


def group_safe_splits(df: DataFrame, group: Column, fractions: Mapping[str, float]) -> DataFrame:
    """(group_id, split): distinct groups in order of their SHA-256, cut into held-out splits and train.

    fractions: held-out splits in the order they take groups.  Every held-out split gets a group
    and one is left for train; with fewer groups than splits all are train.  Only the thresholds
    are computed on the driver, from the number of groups.
    """
    groups = df.select(group.cast("string").alias("group_id")).where("group_id is not null").distinct()
    n = groups.count()
    names = list(fractions)
    bounds, left = [], n
    if n > len(names):
        for i, name in enumerate(names):
            count = min(max(1, round(n * fractions[name])), left - (len(names) - i))
            left -= count
            bounds.append((n - left, name))
    if not bounds:
        return groups.withColumn("split", F.lit("train"))
    split = F.lit("train")
    for bound, name in reversed(bounds):
        split = F.when(F.col("place") <= bound, name).otherwise(split)
    ranked = global_rank(groups.withColumn("h", F.sha2("group_id", 256)), "h")
    return ranked.select("group_id", split.alias("split"))


def split_leakage(df: DataFrame, split_col: str, key_col: str) -> DataFrame:
    """(key, splits) of every key that occurs in more than one split; empty when splits are safe."""
    return df.groupBy(key_col).agg(F.array_sort(F.collect_set(split_col)).alias("splits")).where(F.size("splits") > 1)


def facet_counts(df: DataFrame, facets: Sequence[str]) -> DataFrame:
    """(facet, value, n) over several columns, in one pass of grouping sets."""
    pairs = F.explode(F.array(*(F.struct(F.lit(f).alias("facet"), F.col(f).cast("string").alias("value")) for f in facets))).alias("p")
    return df.select(pairs).select("p.facet", "p.value").groupBy("facet", "value").agg(F.count("*").alias("n"))


def gaps(counts: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets (facet, value, target) with n and how many rows are missing, never below 0."""
    joined = targets.join(counts, ["facet", "value"], "left")
    return joined.select("facet", "value", "target", F.coalesce("n", F.lit(0)).alias("n"), F.greatest(F.lit(0), F.col("target") - F.coalesce("n", F.lit(0))).alias("gap"))


def pick_without_reuse(df: DataFrame, id_col: str, categories: Sequence[tuple[str, Column, Sequence[Column]]]) -> DataFrame:
    """(category, id): for each category in turn, the first row of those eligible that no earlier one took.

    One small top-1 per category; a fixed, short list by nature.
    """
    taken, out = [], []
    for name, eligible, order in categories:
        row = df.where(eligible).where(~F.col(id_col).isin(taken) if taken else F.lit(True)).orderBy(*order, id_col).select(id_col).first()
        if row is not None:
            taken.append(row[0])
            out.append((name, row[0]))
    return df.sparkSession.createDataFrame(out, f"category string, {id_col} {df.schema[id_col].dataType.simpleString()}")


def authority_ranking(evidence: DataFrame, authority: DataFrame) -> DataFrame:
    """(characteristic, rank, modality, n): ordered modality lists with how much evidence each has.

    authority: (characteristic, modalities array); evidence: (modality, ...).
    """
    counts = evidence.groupBy("modality").agg(F.count("*").alias("n"))
    listed = authority.select("characteristic", F.posexplode("modalities").alias("rank", "modality"))
    return listed.join(counts, "modality", "left").select("characteristic", "rank", "modality", F.coalesce("n", F.lit(0)).alias("n"))


def unique_winner(df: DataFrame, id_col: str, eligible: Column, score: Sequence[Column], same: Sequence[str]) -> DataFrame:
    """The best eligible row, or no row if the two best have the same summary."""
    top = df.where(eligible).orderBy(*score, id_col).limit(2)
    place = Window.orderBy(*score, id_col)
    both = top.withColumn("_place", F.row_number().over(place)).withColumn("_tie", F.struct(*same).eqNullSafe(F.lead(F.struct(*same)).over(place)))
    # with one row there is no next summary, and a null next one is no tie
    return both.where((F.col("_place") == 1) & ~F.col("_tie")).drop("_place", "_tie")
