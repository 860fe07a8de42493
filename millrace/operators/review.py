"""Review decisions as append-only events, and policies on records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .gates import reasons


def latest_decisions(events: DataFrame, key: str, order: str, allowed: Sequence[str] = ("pending", "approved", "rejected")) -> DataFrame:
    """The last allowed decision of each key; a pending one clears its reviewer."""
    last = Window.partitionBy(key).orderBy(F.col(order).desc())
    kept = events.where(F.col("decision").isin(list(allowed))).withColumn("_r", F.row_number().over(last)).where("_r = 1").drop("_r")
    return kept.withColumn("reviewed_by", F.when(F.col("decision") != "pending", F.col("reviewed_by")))


def decision_errors(events: DataFrame, known: DataFrame, key: str, allowed: Sequence[str], selected: Column | None = None) -> DataFrame:
    """Events with the reasons why they cannot stand."""
    ids = known.select(key).distinct().withColumn("_known", F.lit(True))
    checks = [(F.col("_known").isNull(), "unknown_id"), (~F.col("decision").isin(list(allowed)), "unknown_decision")]
    if selected is not None:
        checks.append((F.col("_known") & ~selected, "not_in_selection"))
    return events.join(ids, key, "left").withColumn("errors", reasons(checks)).drop("_known").where(F.size("errors") > 0)


def approval_gate(records: DataFrame, derivatives: DataFrame, key: str) -> DataFrame:
    """Records with blockers: approval needs a split, and two approved derivatives where there are several subjects; rejection sets the split to reject."""
    counts = derivatives.where("decision = 'approved'").groupBy(key).agg(F.count("*").alias("_n"))
    joined = records.join(counts, key, "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    approved = F.col("decision") == "approved"
    checks = [(approved & (F.col("split").isNull() | (F.col("split") == "unassigned")), "split_missing"), (approved & F.col("multi_subject") & (F.col("_n") < 2), "derivatives_missing")]
    return joined.withColumn("split", F.when(F.col("decision") == "rejected", F.lit("reject")).otherwise(F.col("split"))).withColumn("blockers", reasons(checks)).drop("_n")


def artifacts_present(records: DataFrame, files: DataFrame, key: str, required: Sequence[str]) -> DataFrame:
    """(key, missing): required path columns that name no existing file."""
    listed = records.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("name"), F.col(c).alias("path")) for c in required))).alias("a")).select(key, "a.name", "a.path")
    have = files.where("exists").select("path").distinct()
    lost = listed.join(have, "path", "left_anti").groupBy(key).agg(F.array_sort(F.collect_list("name")).alias("missing"))
    return records.select(key).join(lost, key, "left").select(key, F.coalesce("missing", F.array().cast("array<string>")).alias("missing"))


def attribute_to_user(df: DataFrame, confirmed: Column, band_col: str = "band", issues_col: str = "issues") -> DataFrame:
    """A user's confirmation overrides the model's band and clears the issues."""
    return df.withColumn(band_col, F.when(confirmed, F.lit("HOLDS")).otherwise(F.col(band_col))).withColumn(issues_col, F.when(confirmed, F.array().cast("array<string>")).otherwise(F.col(issues_col)))


def exactly_one(*columns: Column) -> Column:
    """Whether exactly one of the columns is not null."""
    return sum((F.when(c.isNotNull(), 1).otherwise(0) for c in columns), F.lit(0)) == 1


def multi_subject(subjects: Column, labels: Column, stop: Sequence[str], text: Column, phrases: str) -> Column:
    """More than one subject, a label of the stop list, or a phrase in the text."""
    return F.coalesce(F.size(subjects) > 1, F.lit(False)) | F.coalesce(F.arrays_overlap(labels, F.array(*map(F.lit, stop))), F.lit(False)) | F.coalesce(text.rlike(phrases), F.lit(False))


def normalise_record(df: DataFrame, tags_col: str, required: Sequence[str], risks_col: str, risk: str, unusable: Column, usable_col: str = "training_usable") -> DataFrame:
    """Required tags first, a risk added once where it applies, usability forced false there."""
    tags = F.array_distinct(F.concat(F.array(*map(F.lit, required)), F.col(tags_col)))
    risks = F.when(unusable, F.array_union(F.col(risks_col), F.array(F.lit(risk)))).otherwise(F.col(risks_col))
    return df.withColumn(tags_col, tags).withColumn(risks_col, risks).withColumn(usable_col, F.when(unusable, F.lit(False)).otherwise(F.col(usable_col)))


def key_set_errors(keys: Column, expected: Sequence[str]) -> Column:
    """Reasons of a structured response's keys: missing and extra ones, each sorted."""
    want = F.array(*map(F.lit, expected))
    missing = F.transform(F.array_sort(F.array_except(want, keys)), lambda k: F.concat(F.lit("missing:"), k))
    extra = F.transform(F.array_sort(F.array_except(keys, want)), lambda k: F.concat(F.lit("extra:"), k))
    return F.concat(missing, extra)


def carry_over(tasks: DataFrame, results: DataFrame, prior: DataFrame, key: str) -> DataFrame:
    """Task status: complete if it has a result, else its prior status, else pending."""
    done = results.select(key).distinct().withColumn("_done", F.lit(True))
    old = prior.select(key, F.col("status").alias("_old"))
    joined = tasks.join(done, key, "left").join(old, key, "left")
    return joined.withColumn("status", F.when(F.col("_done"), F.lit("complete")).otherwise(F.coalesce("_old", F.lit("pending")))).drop("_done", "_old")


def fan_out(observations: DataFrame, tasks: DataFrame, key: str, default: str = "observed") -> DataFrame:
    """Each observation of a shot copied to every task of that shot, with a default status."""
    return tasks.join(observations, key).withColumn("status", F.coalesce("status", F.lit(default)))


def technical_check(exists: Column, size: Column, channels: Column) -> Column:
    """Reasons against a media file's metadata; human approval is another record."""
    return reasons([(~F.coalesce(exists, F.lit(False)), "missing"), (F.coalesce(size, F.lit(0)) == 0, "empty"), (channels != 1, "not_mono")])
