"""Exact duplicates by content hash, near duplicates by Hamming distance, components."""

from __future__ import annotations

import functools
import itertools
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def content_hash(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def duplicate_groups(df: DataFrame, hash_col: str, id_col: str) -> DataFrame:
    """(hash, n, first) of content that more than one row has; partial sums, so a hot content costs no task more."""
    return df.groupBy(hash_col).agg(F.count("*").alias("n"), F.min(id_col).alias("first")).where("n > 1")


def duplicate_members(df: DataFrame, hash_col: str, id_col: str) -> DataFrame:
    """(id, hash, n, first) of every row whose content another row has too: groups as rows, not as lists of any length."""
    return df.select(id_col, hash_col).join(duplicate_groups(df, hash_col, id_col), hash_col)


def first_per_hash(df: DataFrame, hash_col: str, order_col: str, merge: tuple[str, ...] = ()) -> DataFrame:
    """The first row of each content by order_col; listed array columns become the union over its rows, in row order.

    A union holds distinct values only, each found by its first row, so copies add nothing to a task.
    """
    first = Window.partitionBy(hash_col).orderBy(order_col)
    kept = df.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r", *merge)
    for c in merge:
        values = df.select(hash_col, order_col, F.posexplode(c).alias("_at", "_v")).groupBy(hash_col, "_v").agg(F.min(F.struct(F.col(order_col).alias("o"), F.col("_at").alias("i"))).alias("_first"))
        union = values.groupBy(hash_col).agg(F.transform(F.array_sort(F.collect_list(F.struct("_first", "_v"))), lambda x: x["_v"]).alias(c))
        kept = kept.join(union, hash_col, "left").withColumn(c, F.coalesce(c, F.array().cast(df.schema[c].dataType)))
    return kept.select(*df.columns)


def best_per_group(df: DataFrame, group: str | list[str], *order: Column) -> DataFrame:
    """The first row of each group in the given order."""
    keys = [group] if isinstance(group, str) else group
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


def hex_to_long(hex64: Column) -> Column:
    """A 16-digit hexadecimal hash as a signed 64-bit integer."""
    return F.conv(hex64, 16, -10).cast("long")


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_pairs(df: DataFrame, hash_col: str, distance: int, agree: int = 2) -> DataFrame:
    """(x, y, distance) with x < y of distinct 64-bit hashes at most so far apart.

    Of ``distance + agree`` bit blocks, hashes within the distance agree on at least ``agree``, so
    pairs come from an equi-join on every choice of that many blocks and a check.  More blocks to
    agree on make longer keys with fewer chance partners, for more rows; 3 suits billions of hashes.
    """
    distinct = df.where(F.col(hash_col).isNotNull()).select(F.col(hash_col).alias("h")).distinct()
    n = min(64, distance + agree)
    blocks = [(64 * i // n, 64 * (i + 1) // n) for i in range(n)]
    masks = [sum((1 << high) - (1 << low) for low, high in chosen) for chosen in itertools.combinations(blocks, n - distance)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keys = [F.struct(F.lit(i).alias("band"), F.col("h").bitwiseAND(F.lit(m).cast("long")).alias("bits")) for i, m in enumerate(signed)]
    banded = distinct.select("h", F.explode(F.array(*keys)).alias("k")).select("h", "k.band", "k.bits")
    x, y = banded.withColumnRenamed("h", "x"), banded.withColumnRenamed("h", "y")
    close = x.join(y, ["band", "bits"]).where("x < y").where(hamming(F.col("x"), F.col("y")) <= distance).select("x", "y").distinct()
    return close.select("x", "y", hamming(F.col("x"), F.col("y")).alias("distance"))


def near_duplicate_clusters(df: DataFrame, id_col: str, hash_col: str, distance: int) -> DataFrame:
    """(id, cluster): cluster is the smallest id connected by hashes within the distance.  Rows without a hash stand alone."""
    own = df.select(F.col(id_col).alias("id"), F.col(hash_col).alias("h"))
    heads = own.where("h is not null").groupBy("h").agg(F.min("id").alias("head"))
    pairs = near_pairs(df, hash_col, distance)
    edges = pairs.join(heads.select(F.col("h").alias("x"), F.col("head").alias("a")), "x").join(heads.select(F.col("h").alias("y"), F.col("head").alias("b")), "y").select("a", "b")
    roots = connected_components(edges)
    named = own.join(heads, "h", "left").select("id", F.coalesce("head", "id").alias("head"))
    out = named.join(roots.withColumnRenamed("node", "head"), "head", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("root", "head").alias("cluster"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node whose component holds a smaller one.

    Smallest labels travel along edges and jump along labels, so rounds grow with the logarithm of
    a component's width; each round is written and read back, which cuts lineage and survives lost
    executors.  A checkpoint would keep the plan's estimated size, a product over joins whose digits
    multiply from round to round in the driver's memory.  Joins are merged, so no round's rows pass through the driver.
    """
    both = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    both = stored(both.union(both.select("y", "x")).distinct())
    labels = stored(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("root")).select(F.col("x").alias("node"), "root"))
    while True:
        seen = both.join(labels.select(F.col("node").alias("y"), F.col("root").alias("r")).hint("merge"), "y").groupBy("x").agg(F.min("r").alias("r"))
        near = labels.join(seen.withColumnRenamed("x", "node").hint("merge"), "node").select("node", F.least("root", "r").alias("new"), "root")
        jump = labels.select(F.col("node").alias("new"), F.col("root").alias("top")).hint("merge")
        after = stored(near.join(jump, "new", "left").select("node", F.least("new", F.coalesce("top", "new")).alias("new"), "root"))
        labels = after.select("node", F.col("new").alias("root"))
        if after.where("new <> root").isEmpty():
            return labels.where("node <> root")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, of spark.checkpoint.dir; where none is set, a temporary folder in local mode and an error on a cluster."""
    import tempfile

    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="millrace-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def reliable(df: DataFrame) -> DataFrame:
    """Checkpoint in the cluster's shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """Written once as Parquet in the shared folder and read back: for rows whose making has effects."""
    path = f"{shared_dir(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def simhash64(text: Column, words: int = 2) -> Column:
    """64-bit similarity hash of a text's word shingles: bit i is the majority of bit i over the shingles."""
    tokens = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: t != "")
    count = F.size(tokens)
    shingles = F.when(count <= words, F.array(F.array_join(tokens, " "))).otherwise(F.transform(F.sequence(F.lit(1), count - words + 1), lambda i: F.array_join(F.slice(tokens, i, words), " ")))
    hashes = F.transform(shingles, lambda s: F.xxhash64(s))
    bits = [F.when(2 * F.size(F.filter(hashes, functools.partial(_bit_set, i))) > F.size(hashes), F.lit(1 << i if i < 63 else -(1 << 63)).cast("long")).otherwise(F.lit(0).cast("long")) for i in range(64)]
    return functools.reduce(lambda x, y: x.bitwiseOR(y), bits)


def _bit_set(i: int, h: Column) -> Column:
    return F.shiftrightunsigned(h, i).bitwiseAND(F.lit(1)) == 1
