"""Gates: policies that keep every failing reason, and ordered first-match rules."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reasons(checks: Sequence[tuple[Column, str | Column]]) -> Column:
    """Names of all violated checks, in the checks' order; a null check is not violated."""
    named = [F.when(bad, name if isinstance(name, Column) else F.lit(name)) for bad, name in checks]
    return F.array_compact(F.array(*named)) if named else F.array().cast("array<string>")


def gate(df: DataFrame, checks: Sequence[tuple[Column, str | Column]], reasons_col: str = "reasons", pass_col: str = "passed") -> DataFrame:
    """df with the array of failing reasons and whether it is empty."""
    return df.withColumn(reasons_col, reasons(checks)).withColumn(pass_col, F.size(reasons_col) == 0)


def zero_as(value: Column, missing: float) -> Column:
    """The value, with null and zero both read as missing."""
    return F.when(value.isNull() | (value == 0), F.lit(missing)).otherwise(value)


def quality_checks(policy: Mapping[str, object], width: str = "width", height: str = "height", contrast: str = "contrast", sharpness: str = "sharpness", brightness: str = "brightness") -> list[tuple[Column, str]]:
    """Checks of an image-like measurement row; missing measures count as 0."""
    value = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    dark, bright = policy["brightness_range"]
    return [
        (value(width) < policy["minimum_width"], "width_below_minimum"),
        (value(height) < policy["minimum_height"], "height_below_minimum"),
        (value(contrast) < policy["minimum_contrast"], "contrast_below_minimum"),
        (value(sharpness) < policy["minimum_sharpness"], "sharpness_below_minimum"),
        (value(brightness) < dark, "too_dark"),
        (value(brightness) > bright, "too_bright"),
    ]


def decoded_or(status: Column, failed: str, checks: Sequence[tuple[Column, str]]) -> Column:
    """A single reason where decoding did not complete, else all reasons of the checks."""
    return F.when(F.coalesce(status, F.lit("")) != "complete", F.array(F.lit(failed))).otherwise(reasons(checks))


def first_match(rules: Sequence[tuple[Column, str]], default: str | None = None) -> Column:
    """The value of the first rule that holds, else the default."""
    out = F.lit(default).cast("string")
    for condition, value in reversed(list(rules)):
        out = F.when(condition, F.lit(value)).otherwise(out)
    return out


def glob_regex(glob: str) -> str:
    """Regular expression of a shell glob: ``*`` and ``?`` match any character, brackets a set."""
    out, i = "", 0
    while i < len(glob):
        c = glob[i]
        end = glob.find("]", i + 2) if c == "[" else -1
        if c == "*":
            out += ".*"
        elif c == "?":
            out += "."
        elif end > 0:
            body = glob[i + 1 : end].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body.startswith("!") else body) + "]"
            i = end
        else:
            out += c if c.isalnum() or c in "_/ " else "\\" + c
        i += 1
    return f"(?s)^{out}$"


def exclusion_reason(path: Column, terms: Sequence[str] = (), globs: Sequence[str] = ()) -> Column:
    """First configured term (case-insensitive substring), then first glob that matches, else null."""
    rules = [(F.lower(path).contains(t.lower()), f"excluded_term:{t}") for t in terms]
    rules += [(path.rlike(glob_regex(g)), f"excluded_glob:{g}") for g in globs]
    return first_match(rules)


def tiered_roles(df: DataFrame, exact: DataFrame, path_col: str, globs: Sequence[tuple[str, str]], default: str, out: str = "role") -> DataFrame:
    """Role of a path: exact override (path, role; any case), then first glob rule, then the default."""
    table = exact.select(F.lower("path").alias("_path"), F.col("role").alias("_exact")).dropDuplicates(["_path"])
    rules = [(F.col(path_col).rlike(glob_regex(g)), role) for g, role in globs]
    joined = df.join(table, F.lower(path_col) == F.col("_path"), "left")
    return joined.withColumn(out, F.coalesce("_exact", first_match(rules, default))).drop("_path", "_exact")


def band(value: Column, bounds: Sequence[tuple[float, str]], last: str) -> Column:
    """The label of the first bound that the value lies below."""
    return first_match([(value < b, label) for b, label in bounds], last)


def similarity_band(distance: Column, confirmed: Column | None = None) -> Column:
    """HOLDS below 0.45, DRIFTS below 0.65, else NO MATCH; a confirmed row always holds."""
    found = band(distance, [(0.45, "HOLDS"), (0.65, "DRIFTS")], "NO MATCH")
    return found if confirmed is None else F.when(confirmed, F.lit("HOLDS")).otherwise(found)


def user_approved(decision: Column, by: Column, issues: Column, missing_is_empty: bool = False) -> Column:
    """Approved by a user with an empty list of issues; null issues count as empty only on request."""
    clean = F.size(issues) == 0
    clean = F.when(issues.isNull(), F.lit(missing_is_empty)).otherwise(clean)
    return F.coalesce((decision == "approved") & (by == "user") & clean, F.lit(False))


def channels(roles: Column, of: Mapping[str, Sequence[str]], exclude: str = "exclude") -> Column:
    """Channels that any of a record's roles opens; the excluding role closes all of them."""
    opened = [F.when(F.arrays_overlap(roles, F.array(*map(F.lit, names))), F.lit(channel)) for channel, names in of.items()]
    none = F.array().cast("array<string>")
    return F.when(F.array_contains(roles, exclude), none).otherwise(F.coalesce(F.array_compact(F.array(*opened)), none))


def scope_conflicts(include: Column, exclude: Column) -> Column:
    """Owners named on both sides of a scope."""
    return F.array_intersect(include, exclude)


def partition_leftovers(df: DataFrame, used: DataFrame, key: str, ignored: Column, out: str = "leftover") -> DataFrame:
    """Rows without a partner in used, told apart as ignored or unmatched."""
    left = df.join(used.select(key).distinct(), key, "left_anti")
    return left.withColumn(out, F.when(ignored, F.lit("ignored")).otherwise(F.lit("unmatched")))
