"""Writers: manifests, split files, guarded exports, ledgers, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class ExportRefused(ValueError):
    """A guarded export found rows that must not leave."""


def write_manifest(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite as a whole, columns in name order; Spark's commit protocol makes it all or nothing."""
    df.select(*sorted(df.columns)).write.mode("overwrite").format(fmt).save(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """JSON lines, one folder per split."""
    df.write.mode("overwrite").partitionBy(split).json(path)


def write_partitions(df: DataFrame, path: str, by: str, fmt: str = "parquet") -> None:
    """Replace only the partitions that df has rows for."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).format(fmt).save(path)


def create_if_absent(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    df.write.mode("ignore").format(fmt).save(path)


def hash_conflicts(expected: DataFrame, actual: DataFrame, key: str, hash_col: str) -> DataFrame:
    """Expected keys whose content is missing or differs."""
    now = actual.select(key, F.col(hash_col).alias("actual_hash"))
    return expected.join(now, key, "left").where(~F.col(hash_col).eqNullSafe(F.col("actual_hash"))).select(key, hash_col, "actual_hash")


def verified_write(df: DataFrame, expected: DataFrame, path: str, key: str, hash_col: str, fmt: str = "parquet") -> None:
    """Write unless a source's hash changed since it was planned."""
    bad = hash_conflicts(expected, df, key, hash_col).limit(5).collect()
    if bad:
        raise ExportRefused(f"content changed: {[r[key] for r in bad]}")
    write_manifest(df, path, fmt)


def guarded_export(df: DataFrame, path: str, ready: str, hash_col: str, split: str = "split") -> None:
    """Write splits unless a row is not ready or a content occurs in two splits."""
    waiting = df.where(~F.coalesce(F.col(ready), F.lit(False))).limit(1).count()
    if waiting:
        raise ExportRefused("rows that are not ready")
    leak = df.groupBy(hash_col).agg(F.count_distinct(split).alias("n")).where("n > 1").limit(1).count()
    if leak:
        raise ExportRefused("content in several splits")
    write_splits(df.drop(ready), path, split)


def rewrite_prefix(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    """Paths inside serialised text moved from one root to another."""
    return df.withColumn(column, F.replace(F.col(column), F.lit(old), F.lit(new)))


def markdown_report(df: DataFrame, title: str, most: int = 1000) -> str:
    """A table as Markdown; reports are short by nature, so more than ``most`` rows are an error, never cut off."""
    found = df.limit(most + 1).collect()
    if len(found) > most:
        raise ExportRefused(f"a report of more than {most} rows")
    rows = [f"# {title}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    rows += ["| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in found]
    return "\n".join(rows) + "\n"
