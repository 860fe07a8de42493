"""Record audits, stages of jobs, claims, lookups and small labels."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .gates import first_match, reasons

# -- reading of model answers ------------------------------------------------------------------------


#: Parts of JSON that decide where an object ends: whole strings and brackets.
_PARTS = re.compile(r'"(?:[^"\\]|\\.)*"|[][{}]', re.S)


def _match_brackets(text: str, start: int, ends: dict[int, int | None]) -> None:
    """Enters where the objects open that are met from a brace on close, or None for those that never do."""
    open_: list[tuple[str, int]] = []
    for part in _PARTS.finditer(text, start):
        if part[0] in "{[":
            open_.append((part[0], part.start()))
        elif part[0] in "}]":
            kind, at = open_.pop()
            if kind + part[0] not in ("{}", "[]"):
                open_.append((kind, at))
                break
            ends[at] = part.end()
            if not open_:
                return
    for _, at in open_:
        ends[at] = None


def balanced_objects(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of every balanced object of a text, in order; brackets are matched once per reading of its quotes."""
    ends: dict[int, int | None] = {}
    at = text.find("{")
    while at >= 0:
        if at not in ends:
            _match_brackets(text, at, ends)
        if (end := ends[at]) is not None:
            yield at, end
        at = text.find("{", at + 1)


def _parsed(text: str, start: int = 0) -> tuple[object, int] | None:
    """The JSON value at a place of a text and where it ends; None if there is none or it is nested too deeply."""
    try:
        return json.JSONDecoder().raw_decode(text, start)
    except (ValueError, RecursionError):
        return None


def json_answer(text: str | None, required: Sequence[str] = ()) -> str | None:
    """The JSON of a model's answer: the text, or its fenced block, where that is JSON; else the first object in it with all required fields.

    Objects nested too deeply to be read count as none.
    """
    if text is None:
        return None
    body = text.strip()
    if len(body) >= 6 and body.startswith("```") and body.endswith("```"):
        body = body[3:-3]
        body = (body[4:] if body[:4].lower() == "json" else body).strip()
    whole = _parsed(body)
    if whole is not None and not body[whole[1] :].strip():
        return body
    for start, end in balanced_objects(body):
        found = _parsed(body, start)
        if found is not None and found[1] == end and set(required) <= found[0].keys():
            return body[start:end]
    return None


def json_answers(text: Column, required: Sequence[str] = ()) -> Column:
    """json_answer of a column; a JSON prefix of a text has no built-in function."""

    @pandas_udf("string")
    def read(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: json_answer(t, required), na_action="ignore")

    return read(text)


# -- stages and requirements of jobs -----------------------------------------------------------------


def stage_of(job: Column, phase: Column, priority: Column, seconds: Column, phases: Mapping[str, str]) -> Column:
    """A job's stage: by its phase where the map knows it, else by its id, priority and length."""
    # fixed values: names of stages, phases and priorities, and the prefixes of ids
    named = F.try_element_at(F.create_map(*(F.lit(x) for pair in phases.items() for x in pair)), phase) if phases else F.lit(None).cast("string")
    on = lambda c: F.coalesce(c, F.lit(False))
    short, long = on((seconds == 3) | (phase == "motion_proofs")), on((seconds == 5) | (phase == "extended_clips"))
    rules = [
        (F.startswith(job, F.lit("storyboard__")), "storyboards"),
        (F.contains(job, F.lit("character_sheet")) | on(priority.isin("first_review", "expansion")), "character_sheets"),
        (F.startswith(job, F.lit("video__")) & long & ~short, "extended_sequences"),
        (F.startswith(job, F.lit("video__")), "scripted_clips"),
    ]
    return F.coalesce(named, first_match(rules, "character_sheets"))


def is_required(stage: Column, priority: Column, number: Column) -> Column:
    """Storyboards and expansions are optional; so are character sheets after the second candidate without a first review."""
    # fixed values: names of stages and priorities
    sheet = F.when(priority == "expansion", False).when(priority == "first_review", True).otherwise(F.coalesce(number <= 2, F.lit(True)))
    return F.when(stage == "character_sheets", sheet).otherwise(stage != "storyboards")


def first_review_order(priority: Column, job: Column) -> list[Column]:
    """First reviews before all others, each in id order."""
    return [(F.coalesce(priority, F.lit("")) != "first_review").asc(), job.asc()]


# -- lookups -------------------------------------------------------------------------------------------


def matched_or_missing(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(left rows with their right row, left keys without one): a composite lookup whose misses are data; right has one row per key."""
    return left.join(right, list(keys)), left.join(right.select(*keys).distinct(), list(keys), "left_anti").select(*keys)


def concept_lookup(shots: DataFrame, concepts: DataFrame, key: str, names: str, concept: str = "concept") -> DataFrame:
    """(key, position, concept columns, known): the concepts that a shot's ordered list of names holds."""
    listed = shots.select(key, F.posexplode(names).alias("position", concept))
    return listed.join(concepts.withColumn("known", F.lit(True)), concept, "left").withColumn("known", F.coalesce("known", F.lit(False)))


def written_claims(rows: DataFrame, key: str, fields: Sequence[str], lists: Sequence[str] = ()) -> DataFrame:
    """(claim_id, key, field, value): one row for each non-blank text field and list entry, entries numbered from 0."""
    one = [F.array(F.struct(F.lit(f).alias("field"), F.lit(f).alias("name"), F.trim(f).alias("value"))) for f in fields]

    def entries(f: str) -> Column:
        row = lambda v, i: F.struct(F.lit(f).alias("field"), F.concat(F.lit(f"{f}."), i.cast("string")).alias("name"), F.trim(v).alias("value"))
        return F.transform(F.coalesce(F.col(f), F.array().cast("array<string>")), row)

    many = [entries(f) for f in lists]
    flat = rows.select(F.col(key), F.explode(F.concat(*one, *many)).alias("c")).where("c.value <> ''")
    return flat.select(F.concat_ws(".", F.col(key).cast("string"), "c.name").alias("claim_id"), key, "c.field", "c.value")


# -- sums and warnings ---------------------------------------------------------------------------------


def warnings(counts: DataFrame, checks: Sequence[tuple[Column, str]], out: str = "warnings") -> DataFrame:
    """A row of counts with the warnings whose ratio or threshold test holds, in order."""
    return counts.withColumn(out, reasons(checks))


def series_coverage(df: DataFrame, by: str, at: str, has: Column) -> DataFrame:
    """(by, n, covered, share, first, last): how much of a series satisfies a test, and its ends."""
    return df.groupBy(by).agg(F.count("*").alias("n"), F.count_if(has).alias("covered"), F.avg(F.coalesce(has, F.lit(False)).cast("double")).alias("share"), F.min(at).alias("first"), F.max(at).alias("last"))


def label_totals(df: DataFrame, label: str, start: str, end: str) -> DataFrame:
    """(label, n, seconds) of intervals."""
    return df.groupBy(label).agg(F.count("*").alias("n"), F.sum(F.col(end) - F.col(start)).alias("seconds"))


# -- audits ----------------------------------------------------------------------------------------------


def record_audit(tasks: DataFrame, sources: DataFrame, results: DataFrame, key: str, checks: Sequence[tuple[Column, str]]) -> DataFrame:
    """Tasks (key, sha256) with every defect: of the source's hash now (key, sha256_now), of a missing result or raw answer, and of the result's own checks.

    results: (key, raw, ...) with the columns that the checks read; checks apply to found results only.
    """
    joined = tasks.join(sources, key, "left").join(results.withColumn("_found", F.lit(True)), key, "left")
    found = F.coalesce("_found", F.lit(False))
    fixed = [
        (F.col("sha256_now").isNull(), "source_missing"),
        (F.col("sha256_now") != F.col("sha256"), "source_changed"),
        (~found, "result_missing"),
        (~found | F.col("raw").isNull(), "raw_missing"),
    ]
    own = [(found & F.coalesce(bad, F.lit(True)), name) for bad, name in checks]
    return joined.withColumn("errors", reasons([*fixed, *own])).drop("_found")


def audit_summary(audited: DataFrame, state: str = "review_state") -> DataFrame:
    """One row: total, valid, invalid, approved, rejected and pending records."""
    s = F.col(state)
    clean = F.size("errors") == 0
    return audited.agg(F.count("*").alias("total"), F.count_if(clean).alias("valid"), F.count_if(~clean).alias("invalid"), *(F.count_if(s == v).alias(v) for v in ("approved", "rejected", "pending")))


def reset_review(records: DataFrame, state: str = "review_state", split: str = "split") -> DataFrame:
    """Records as if never reviewed: pending and unassigned."""
    return records.withColumn(state, F.lit("pending")).withColumn(split, F.lit("unassigned"))


def import_records(records: DataFrame, tasks: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(records with reset reviews, keys that no task has); importing is right only if the second is empty."""
    known = tasks.select(key).distinct()
    return reset_review(records.join(known, key, "left_semi")), records.join(known, key, "left_anti").select(key).distinct()


def intake_stages(counts: DataFrame) -> DataFrame:
    """(id, status, blockers) of the intake stages, from one row: assets, tasks, complete, subjects, isolated, reviewed, datasets_ready."""
    share = lambda what, a, b: F.concat(F.lit(f"{what} "), F.col(a).cast("string"), F.lit("/"), F.col(b).cast("string"))
    stages = [
        ("source_ingestion", F.col("assets") > 0, F.lit("no sources")),
        ("structured_captioning", (F.col("tasks") > 0) & (F.col("complete") == F.col("tasks")), share("results", "complete", "tasks")),
        ("identity_isolation", F.col("isolated") == F.col("subjects"), share("isolations", "isolated", "subjects")),
        ("caption_review", (F.col("tasks") > 0) & (F.col("reviewed") == F.col("tasks")), share("reviews", "reviewed", "tasks")),
        ("concept_datasets", F.col("datasets_ready") > 0, F.lit("no ready dataset")),
        ("concept_training", F.lit(False), F.lit("training adapter")),
    ]
    rows = [F.struct(F.lit(i).alias("id"), F.when(ok, "complete").otherwise("blocked").alias("status"), F.when(ok, F.array().cast("array<string>")).otherwise(F.array(why)).alias("blockers")) for i, ok, why in stages]
    return counts.select(F.explode(F.array(*rows)).alias("s")).select("s.*")


def stubs(blocked: DataFrame, key: str, reason: str) -> DataFrame:
    """Contracts for handoffs that can't run yet: never ready, never counted as consumed."""
    return blocked.select(key, F.lit("blocked_stub").alias("status"), F.lit(False).alias("production_ready"), F.lit(False).alias("consumed"), F.col(reason).alias("reason"))


# -- labels and points -----------------------------------------------------------------------------------


def shot_size(area: Column, poses: Column) -> Column:
    """How near a face is, by its share of the picture."""
    # fixed values: least shares
    return first_match([(area >= 0.18, "close_up"), (area >= 0.07, "head_and_shoulders"), (area >= 0.025, "medium"), (poses > 0, "wide_or_full_body")], "undetermined")


def narrow_age(text: Column) -> Column:
    """Whether a text names an age or a decade of life."""
    # fixed value: the pattern
    return text.rlike(r"(?i)\b(?:early|mid|late)[ -]?\d{2}s\b|\b\d{1,2}[ -]?years?[ -]?old\b")


def iso_time(seconds: Column) -> Column:
    """Whole seconds since 1970 as ISO-8601 text in UTC, whatever the session's time zone is."""
    at = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    return F.concat(F.replace(F.substring(at.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("+00:00"))


def first_named(items: Column, name: str) -> Column:
    """The first struct of an array with the name, or null."""
    return F.try_element_at(F.filter(items, lambda x: x["name"] == name), F.lit(1))


def nearest_in(values: Column, to: Column) -> Column:
    """The element of an array nearest to a value, the smaller one at a tie; null in an empty array."""
    return F.array_min(F.transform(values, lambda v: F.struct(F.abs(v - to).alias("away"), v.alias("value"))))["value"]


def margin_label(rules: Sequence[tuple[Sequence[Column], str]], last: str) -> Column:
    """The first label all of whose conditions hold; a null condition does not."""
    out = []
    for conditions, label in rules:
        whole = F.lit(True)
        for c in conditions:
            whole = whole & F.coalesce(c, F.lit(False))
        out.append((whole, label))
    return first_match(out, last)


def keypoint_joints(flat: Column, names: Sequence[str], width: Column, height: Column, left: str = "left_hip", right: str = "right_hip") -> Column:
    """(name, x, y, confidence) of flat keypoint triplets, in shares of the canvas, with a ``root`` between two sure joints.

    Points left of or above the canvas have no confidence; triplets that are cut off are left out.
    """
    known = F.array(*map(F.lit, names))
    n = F.least(F.lit(len(names)), F.floor(F.size(flat) / 3)).cast("int")

    def joint(i: Column) -> Column:
        x, y, sure = (flat[3 * i + k].cast("double") for k in range(3))
        return F.struct(known[i].alias("name"), (x / width).alias("x"), (y / height).alias("y"), F.when((x < 0) | (y < 0), 0.0).otherwise(sure).alias("confidence"))

    joints = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), joint)).otherwise(F.array().cast("array<struct<name: string, x: double, y: double, confidence: double>>"))
    a, b = first_named(joints, left), first_named(joints, right)
    least = F.least(a["confidence"], b["confidence"])
    root = F.struct(F.lit("root").alias("name"), ((a["x"] + b["x"]) / 2).alias("x"), ((a["y"] + b["y"]) / 2).alias("y"), least.alias("confidence"))
    return F.when(a.isNotNull() & b.isNotNull() & (least > 0), F.concat(joints, F.array(root))).otherwise(joints)


def associate_performer(poses: DataFrame, by: str, at: str, index: str, x: str, y: str, confidence: str) -> DataFrame:
    """(by, at, index): the pose of each sample that follows one performer.

    The first sample takes its surest pose; later ones the pose nearest to the one before, then the
    surest, then the first.  Poses without a place take no part.  A series is one ordered fold, so it is
    the unit of parallelism; memory holds one sample's poses besides the rows of a series.
    """

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        prior, out = None, []
        for t, rows in pdf.sort_values([at, index]).groupby(at, sort=True):
            places = list(zip(rows[x].tolist(), rows[y].tolist()))
            best = min(range(len(rows)), key=lambda i: (math.dist(places[i], prior) if prior else 0.0, -rows[confidence].iloc[i], rows[index].iloc[i]))
            prior = places[best]
            out.append((rows[by].iloc[0], t, rows[index].iloc[best]))
        return pd.DataFrame(out, columns=[by, at, index])

    kind = {f.name: f.dataType.simpleString() for f in poses.schema.fields}
    placed = poses.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(by, at, index, x, y, confidence)
    return placed.groupBy(by).applyInPandas(follow, ", ".join(f"{c} {kind[c]}" for c in (by, at, index)))
