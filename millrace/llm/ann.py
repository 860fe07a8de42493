"""Approximate nearest neighbours by balanced posting lists.

Largest inner product becomes nearest distance when every vector gets one more
component, sqrt(M^2 - |x|^2) with M the largest norm, and a query a zero.  A bounded
sample, cut again and again at the median of its widest direction, gives centroids of
equally large lists.  Lists grow in number
with the rows, up to the square root of them, and so does the sample.  Centroids sit in an in-memory neighbour graph that every task
holds; a search follows it from fixed entry points through all centroids within a
distance ratio of the nearest one met.  A vector joins the nearest list, and as a
boundary vector up to ``replicas`` lists within ``boundary`` of that distance; a
query reads all lists within ``probe`` of its nearest centroid's distance.

Lists are packed into bins; a bin with many rows is cut into chunks and a bin with
many queries into blocks, so no task gets an unbounded share.  Scores are sums in
component order in double precision.  Equal vectors are indexed once, with their
``k + 1`` smallest ids: no answer can need more of them.

Vectors that are null, empty, zero, or hold null or non-finite components take no
part, nor do rows without an id or with another length than most vectors have.
Equal rows count once; ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Vectors of the sample, at least and for each list; vectors that a list should hold, while there are fewer lists than the root of all rows.
SAMPLE, SAMPLE_ROWS, LIST_ROWS = 16_384, 8, 512
#: Lists of a bin; rows of a bin's chunk; queries of a block.
BIN_LISTS, CHUNK_ROWS, BLOCK_QUERIES = 2, 2048, 1024
DEGREE = 16
#: Distances to centroids that a task holds at once.
GRAPH_CELLS = 4 << 20


def balanced_centroids(x: np.ndarray, lists: int) -> np.ndarray:
    """Means of the leaves of a tree that halves the sample at the median of its widest direction."""
    groups = [np.arange(len(x))]
    while len(groups) < lists:
        cut = []
        for g in groups:
            centred = x[g] - x[g].mean(0)
            direction = centred[np.argmax((centred**2).sum(1))]
            for _ in range(6):
                direction = centred.T @ (centred @ direction)
                direction = direction / (np.linalg.norm(direction) + 1e-300)
            order = np.argsort(centred @ direction, kind="stable")
            cut += [g[order[: len(g) // 2]], g[order[len(g) // 2 :]]]
        groups = [g for g in cut if len(g)]
    return np.stack([x[g].mean(0) for g in groups])


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1)[None] - 2 * x @ y.T, 0))


@dataclass(frozen=True)
class CentroidGraph:
    centroids: np.ndarray
    norm: float  #: M, the largest norm
    near: np.ndarray  #: neighbours of each centroid, padded with its own number
    entries: np.ndarray

    @staticmethod
    def build(centroids: np.ndarray, norm: float) -> CentroidGraph:
        k = len(centroids)
        step = max(1, GRAPH_CELLS // k)
        order = np.concatenate([np.argsort(distances(centroids[i : i + step], centroids), axis=1, kind="stable")[:, : DEGREE + 1] for i in range(0, k, step)])
        a, b = np.repeat(np.arange(k), order.shape[1]), order.ravel()
        ends = np.unique(np.stack((np.concatenate((a, b)), np.concatenate((b, a))), 1), axis=0)  # both ways
        first = np.searchsorted(ends[:, 0], np.arange(k + 1))
        near = np.repeat(np.arange(k)[:, None], np.diff(first).max(), axis=1)
        near[ends[:, 0], np.arange(len(ends)) - first[ends[:, 0]]] = ends[:, 1]
        return CentroidGraph(centroids, norm, near, np.unique(np.linspace(0, k - 1, min(k, 16)).astype(int)))

    def lift(self, x: np.ndarray, query: bool) -> np.ndarray:
        last = np.zeros(len(x)) if query else np.sqrt(np.maximum(self.norm**2 - (x**2).sum(1), 0))
        return np.concatenate((x, last[:, None]), 1)

    def search(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Distances of lifted vectors to the centroids met within the ratio of the nearest, infinite elsewhere."""
        found = np.full((len(x), len(self.centroids)), np.inf)
        found[:, self.entries] = distances(x, self.centroids[self.entries])
        opened = np.zeros(found.shape, bool)
        while True:
            ahead = (found <= (1 + ratio) * found.min(1, keepdims=True)) & ~opened
            if not ahead.any():
                return np.where(opened, np.where(found <= (1 + ratio) * found.min(1, keepdims=True), found, np.inf), np.inf)
            opened |= ahead
            rows, cols = np.nonzero(ahead)
            met = np.zeros(found.shape, bool)
            met[rows[:, None], self.near[cols]] = True
            rows, cols = np.nonzero(met & ~np.isfinite(found))
            found[rows, cols] = np.sqrt(((x[rows] - self.centroids[cols]) ** 2).sum(1))


def best_of(q: np.ndarray, x: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, member row, score) of at least the ``most`` allowed members with the largest inner products.

    A matrix product picks them, with a margin far above its rounding; their scores are then summed
    in component order, so equal vectors score equal wherever they lie.
    """
    rough = np.where(allowed, q @ x.T, -np.inf)
    most = min(most, len(x))
    least = np.partition(rough, -most, axis=1)[:, -most]
    margin = 1e-9 * np.sqrt((q**2).sum(1) * (x**2).sum(1).max())
    rows, cols = np.nonzero((rough >= (least - margin)[:, None]) & np.isfinite(rough))
    total = np.zeros(len(rows))
    for j in range(q.shape[1]):
        total += q[rows, j] * x[cols, j]
    return rows, cols, total


def _vectors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows that take part, v as doubles."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(finite & F.exists("v", lambda c: c != 0))
    most = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.col("count").desc(), "n").first()
    return rows.where(F.size("v") == (most["n"] if most else 0))


def nearest(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 20, k: int = 20, replicas: int = 2, boundary: float = 0.05, probe: float = 0.15) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest found for rows whose id is divisible by every."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).distinct()
    firsts = rows.withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("r") <= k + 1)
    classes = materialize(firsts.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids")).select(F.col("ids")[0].alias("cls"), "ids", "v"), "classes")
    asked = materialize(rows.where(F.col("id") % every == 0).join(classes.select("cls", "v"), "v").select(F.col("id").alias("query_id"), "cls"), "asked")

    stats = classes.agg(F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda t, c: t + c * c)).alias("square")).first()
    lists = 1
    while lists * LIST_ROWS < stats["n"] and lists * lists < stats["n"]:
        lists *= 2
    sample = classes.orderBy(F.xxhash64("cls"), "cls").limit(max(SAMPLE, SAMPLE_ROWS * lists)).select("v").collect()
    norm = float(np.sqrt(stats["square"] or 0.0)) * (1 + 1e-12)
    seen = np.array([r["v"] for r in sample], np.float64) if sample else np.zeros((0, 1))
    lifted = np.concatenate((seen, np.sqrt(np.maximum(norm**2 - (seen**2).sum(1), 0))[:, None]), 1)
    graph = CentroidGraph.build(balanced_centroids(lifted, min(lists, max(1, len(lifted) // 4))), norm) if len(lifted) else None
    shared = spark.sparkContext.broadcast(graph)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, min(1024, GRAPH_CELLS // len(shared.value.centroids)))
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                away = shared.value.search(shared.value.lift(_vectors(batch, "v"), False), max(boundary, probe))
                order = np.argsort(away, axis=1, kind="stable")[:, :replicas]
                near = np.take_along_axis(away, order, 1)
                row, col = np.nonzero(np.isfinite(near) & (near <= (1 + boundary) * near[:, :1]))
                own = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(order[row, col].astype(np.int32)), *(own.column(own.schema.get_field_index(c)) for c in ("cls", "v"))], ["list", "cls", "v"])

    id_type = classes.schema["cls"].dataType.simpleString()
    postings = materialize(classes.select("cls", "v").mapInArrow(post, f"list int, cls {id_type}, v array<double>"), "postings").withColumn("bin", F.floor(F.col("list") / BIN_LISTS))
    chunks = materialize(postings.groupBy("bin").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("chunks")), "chunks")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, min(1024, GRAPH_CELLS // len(shared.value.centroids)))
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                row, col = np.nonzero(np.isfinite(shared.value.search(shared.value.lift(_vectors(batch, "v"), True), probe)))
                own = batch.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([own.column(own.schema.get_field_index("cls")), pa.array(col.astype(np.int32))], ["cls", "list"])

    questions = asked.select("cls").distinct().join(classes.select("cls", "v"), "cls")
    routed = questions.mapInArrow(route, f"cls {id_type}, list int").groupBy("cls", F.floor(F.col("list") / BIN_LISTS).alias("bin")).agg(F.collect_list("list").alias("lists"))
    routed = materialize(routed, "routed")
    blocks = materialize(routed.groupBy("bin").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("blocks")).join(chunks, "bin"), "blocks")
    left = routed.join(blocks, "bin").select("bin", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), "cls", "lists").join(questions, "cls")
    right = postings.join(blocks, "bin").select(F.col("bin").alias("bin_"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block_"), F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int").alias("chunk_"), F.col("list").alias("list_"), F.col("cls").alias("cls_"), F.col("v").alias("v_"))

    def compare(queries: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(queries) and len(held):
            x, ids = np.stack(held["v_"].to_numpy()), held["cls_"].to_numpy()
            lists, member_of = np.unique(held["list_"].to_numpy(), return_inverse=True)
            q, names = np.stack(queries["v"].to_numpy()), queries["cls"].to_numpy()
            wanted = np.stack([np.isin(lists, w) for w in queries["lists"]])
            for start in range(0, len(q), 128):
                # a boundary vector may be in two lists of the bin
                rows, cols, scores = best_of(q[start : start + 128], x, wanted[start : start + 128][:, member_of], 2 * (k + 1))
                order = np.lexsort((ids[cols], -scores, rows))
                rows, near, scores = rows[order], ids[cols[order]], scores[order]
                bounds = np.searchsorted(rows, np.arange(min(128, len(q) - start) + 1))
                for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    once = np.sort(np.unique(near[a:b], return_index=True)[1])[: k + 1] + a
                    out.append((names[start + i], [{"away": -s, "cls": c} for s, c in zip(scores[once].tolist(), near[once].tolist())]))
        return pd.DataFrame(out, columns=["q", "near"])

    found_type = f"array<struct<away: double, cls: {id_type}>>"
    near = left.groupBy("bin", "block", "chunk").cogroup(right.groupBy("bin_", "block_", "chunk_")).applyInPandas(compare, f"q {id_type}, near {found_type}")
    # a class comes at most once per list it is in, so the first replicas * (k + 1) hold k + 1 different ones
    first = F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, replicas * (k + 1))
    best = near.groupBy("q").agg(F.slice(F.array_distinct(first), 1, k + 1).alias("near"))
    # ids of equal vectors come in again; each query class needs its k + 1 first
    ids = best.select("q", F.explode("near").alias("n")).select("q", F.col("n.away").alias("away"), F.col("n.cls").alias("cls")).join(classes.select("cls", "ids"), "cls")
    ids = ids.select("q", F.transform("ids", lambda i: F.struct(F.col("away").alias("away"), i.alias("vec_id"))).alias("hits"))
    answers = ids.groupBy("q").agg(F.slice(F.sort_array(F.flatten(F.collect_list("hits"))), 1, k + 1).alias("hits"))
    own = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    out = asked.join(materialize(answers, "answers"), F.col("cls") == F.col("q")).select("query_id", F.posexplode(own).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.away")).alias("score"))
