"""Job states, stage rollups and readiness from plans, logs, reviews and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def job_states(jobs: DataFrame) -> DataFrame:
    """jobs with ``state``; input columns: log_status, live_state, outputs, outputs_missing (counts), decision, clean_approval.

    Order: rejected review, live state, running, failed, complete (missing output, approved or
    present), else graph_ready.  A job with neither log nor live state is graph_ready whatever its review.
    """
    complete = F.when((F.coalesce("outputs", F.lit(0)) == 0) | (F.coalesce("outputs_missing", F.lit(0)) > 0), "output_missing").when(F.coalesce("clean_approval", F.lit(False)), "approved").otherwise("output_present")
    state = (
        F.when(F.col("log_status").isNull() & F.col("live_state").isNull(), "graph_ready")
        .when(F.col("decision") == "rejected", "rejected")
        .when(F.col("live_state").isin("running", "queued"), F.col("live_state"))
        .when(F.col("log_status").isin("running", "failed"), F.col("log_status"))
        .when(F.col("log_status") == "complete", complete)
        .otherwise("graph_ready")
    )
    return jobs.withColumn("state", state)


def stage_rollup(jobs: DataFrame, stage: str = "stage", required: str = "required") -> DataFrame:
    """(stage, jobs, required, approved, status): the first status of a fixed order that holds.

    Active, rejected, complete, failed, missing output, ready, needs approval, else blocked.
    """
    of = lambda *states: F.col("state").isin(*states)
    n = lambda c: F.count_if(c)
    counts = jobs.groupBy(stage).agg(
        F.count("*").alias("jobs"),
        n(F.col(required)).alias("required"),
        n(F.col(required) & of("approved")).alias("approved"),
        n(of("running", "queued")).alias("_live"),
        n(F.col(required) & of("rejected")).alias("_rejected"),
        n(F.col(required) & of("failed")).alias("_failed"),
        n(F.col(required) & of("output_missing")).alias("_missing"),
        n(of("graph_ready")).alias("_ready"),
        n(F.col(required) & of("output_present")).alias("_present"),
    )
    status = (
        F.when(F.col("_live") > 0, "active")
        .when(F.col("_rejected") > 0, "failed")
        .when((F.col("required") > 0) & (F.col("approved") == F.col("required")), "complete")
        .when(F.col("_failed") > 0, "failed")
        .when(F.col("_missing") > 0, "blocked")
        .when(F.col("_ready") > 0, "ready")
        .when(F.col("_present") > 0, "needs_approval")
        .otherwise("blocked")
    )
    return counts.select(stage, "jobs", "required", "approved", status.alias("status"))


def stages_with_none(stages: DataFrame, rollup: DataFrame, stage: str = "stage") -> DataFrame:
    """The rollup with a not_started row for each stage that has no job."""
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("jobs", "required", "approved")]
    return stages.select(stage).distinct().join(rollup, stage, "left").select(stage, *zero, F.coalesce("status", F.lit("not_started")).alias("status"))


def groups_with_approval(jobs: DataFrame, group: str) -> DataFrame:
    """(groups, approved): how many groups there are and how many have an approved member."""
    return jobs.groupBy(group).agg(F.bool_or(F.col("state") == "approved").alias("any")).agg(F.count("*").alias("groups"), F.count_if("any").alias("approved"))


def readiness(required: DataFrame, inventory: DataFrame, kind: str = "kind", name: str = "name") -> DataFrame:
    """(kind, total, present, missing names): required rows against an inventory of existing names."""
    have = inventory.where("exists").select(name).distinct().withColumn("_have", F.lit(True))
    rows = required.join(have, name, "left").withColumn("_have", F.coalesce("_have", F.lit(False)))
    return rows.groupBy(kind).agg(F.count("*").alias("total"), F.count_if("_have").alias("present"), F.array_sort(F.collect_list(F.when(~F.col("_have"), F.col(name)))).alias("missing"))


def pending_jobs(jobs: DataFrame, log: DataFrame, files: DataFrame, key: str = "id") -> DataFrame:
    """Jobs still to run: those whose log is not complete, or whose outputs no longer all exist; timeouts are not retried."""
    have = files.where("exists").select(F.col("path").alias("_path")).distinct()
    lost = log.select(key, F.explode("outputs").alias("_path")).join(have, "_path", "left_anti").select(key).distinct().withColumn("_lost", F.lit(True))
    joined = jobs.join(log.select(key, F.col("status").alias("_status")), key, "left").join(lost, key, "left")
    done = (F.col("_status") == "complete") & F.col("_lost").isNull()
    return joined.where(~F.coalesce(done, F.lit(False)) & ~F.coalesce(F.col("_status") == "timeout", F.lit(False))).select(*jobs.columns)


def split_blockers(blockers: DataFrame, deferred: Column) -> DataFrame:
    """(hard, waiting, may_start, may_complete): deferred blockers let early stages run but not complete."""
    return blockers.agg(F.count_if(~deferred).alias("hard"), F.count_if(deferred).alias("waiting")).select("hard", "waiting", (F.col("hard") == 0).alias("may_start"), (F.col("hard") + F.col("waiting") == 0).alias("may_complete"))
