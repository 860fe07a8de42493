"""Hard negatives from k-means inverted lists with stored centroid radii.

A row's score is its integer inner product with the anchor.  Rows are dealt to the
nearest of at most ``MOST_LISTS`` centroids, which k-means fits to a sample of at
most ``SAMPLE`` rows; each list stores the largest distance of a member from its
centroid.  By Cauchy-Schwarz the members of a list score between ``a.c - |a| r``
and ``a.c + |a| r`` for an anchor ``a``.  An anchor opens lists by falling upper
bound in two waves: first until ``FIRST_ROWS`` rows are opened, then every other
list whose upper bound isn't strictly below the k-th score found so far.  Lists
whose bounds lie outside the window of wanted scores are never opened.  No list is
left out for any other reason, so results are exact, whatever the centroids are.

Lists are cut into chunks of about ``CHUNK_ROWS`` rows; a task holds one chunk and
streams the anchors that opened it.  Rows of one label and vector are one class
with its smallest ids, as many as an answer can need; anchors of one class are
searched for once.

Null ids, labels, vectors and components, and components that aren't finite, take
no part.  A vector shorter than the longest counts as ended by zeros.  Equal rows
count once; rows that share an id but differ are different rows.  Ties go to the
smaller id.  An anchor without positives, a positive without negatives and an
empty table give no rows.  Other columns, whatever their names, are not read.
Scores of more than 62 bits are an error.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: Rows of the sample that k-means sees; rounds of k-means.
SAMPLE, ROUNDS = 16_384, 8
#: Rows a list should hold, while there are fewer lists than the most.
LIST_ROWS, MOST_LISTS = 512, 1024
#: Rows of a chunk; rows that an anchor opens before it has a threshold; anchors compared at once.
CHUNK_ROWS, FIRST_ROWS, BLOCK = 2048, 4096, 128
_LEAST = -(1 << 62)


@dataclass(frozen=True)
class Lists:
    """What every task knows of the lists."""

    centroids: np.ndarray
    radii: np.ndarray
    counts: np.ndarray
    exact: bool  #: products of doubles are exact
    chunks: np.ndarray
    first_rows: int

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bounds of scores, anchors by lists, widened by far more than their rounding."""
        middle, size = q @ self.centroids.T, np.sqrt((q**2).sum(1))[:, None]
        spread = size * self.radii[None] + 1e-9 * size * (self.radii + np.sqrt((self.centroids**2).sum(1)))[None] + 1e-6
        return middle - spread, middle + spread

    def first(self, upper: np.ndarray, open_to: np.ndarray) -> np.ndarray:
        """The lists of the first wave: highest bounds, until they hold first_rows rows."""
        order = np.argsort(np.where(open_to, -upper, np.inf), axis=1, kind="stable")
        before = np.cumsum(self.counts[order], axis=1) - self.counts[order]
        out = np.zeros(upper.shape, bool)
        np.put_along_axis(out, order, before < self.first_rows, 1)
        return out & open_to


def fit(x: np.ndarray, lists: int) -> np.ndarray:
    """Centroids by k-means from the first rows; an empty list keeps its centroid."""
    c = x[:lists].copy()
    for _ in range(ROUNDS):
        own = nearest_centroid(x, c)
        sums, n = np.zeros_like(c), np.bincount(own, minlength=len(c))
        np.add.at(sums, own, x)
        c[n > 0] = sums[n > 0] / n[n > 0, None]
    return c


def nearest_centroid(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return np.argmin((c**2).sum(1)[None] - 2 * (x @ c.T), axis=1)


def _matrix(batch: pa.RecordBatch, name: str, kind=np.float64) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index(name))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(kind)


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(batch.schema.get_field_index(name)).to_numpy(zero_copy_only=False)


def _top(hits: DataFrame, k: int) -> DataFrame:
    """The k first classes of each anchor class and window."""
    order = Window.partitionBy("q", "ps").orderBy(F.desc("score"), "ids")
    return hits.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)


def _windows(low: int, high: int, same: bool) -> Callable[[list[int]], list[tuple[int, int]]]:
    """Wanted scores for each positive's score: all of the same label, a window of other labels."""
    return lambda ps: [(_LEAST, -_LEAST) if same else (-(-low * p // 100), high * p // 100) for p in ps]


class _Search:
    """Searches of anchor classes over the lists."""

    def __init__(self, postings: DataFrame, lists: Lists, low: int, high: int) -> None:
        self.postings, self.low, self.high = postings, low, high
        self.lists = postings.sparkSession.sparkContext.broadcast(lists)

    def best(self, questions: DataFrame, same: bool, k: int, name: str) -> DataFrame:
        """(q, ps, score, ids, own, r): the k first classes of each question (q, label, v) and window ps.

        With ``same`` classes of the anchor's label without a window, else classes of other labels within the windows.
        """
        fresh = questions.withColumn("least", F.transform("ps", lambda p: F.lit(_LEAST)))
        first = materialize(_top(self._scores(self._visits(fresh, same, False), same, k), k), f"{name}_first")
        kth = first.where(F.col("r") == k).groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("ps", "score"))).alias("kth"))
        known = questions.join(kth, "q", "left").withColumn("least", F.transform("ps", lambda p: F.coalesce(F.try_element_at("kth", p), F.lit(_LEAST)))).drop("kth")
        second = self._scores(self._visits(known, same, True), same, k)
        return _top(first.drop("r").unionByName(second), k)

    def _visits(self, questions: DataFrame, same: bool, later: bool) -> DataFrame:
        """A row for each question and chunk of a list that it opens in this wave."""
        shared, windows_of = self.lists, _windows(self.low, self.high, same)

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lists, chunks = shared.value, shared.value.chunks
            for whole in batches:
                for start in range(0, whole.num_rows, BLOCK):
                    batch = whole.slice(start, BLOCK)
                    low, high = lists.bounds(_matrix(batch, "v"))
                    inside, wanted = np.zeros(low.shape, bool), np.zeros(low.shape, bool)
                    for i, (ps, least) in enumerate(zip(batch.column("ps").to_pylist(), batch.column("least").to_pylist())):
                        for (a, b), kth in zip(windows_of(ps), least):
                            fits = (high[i] >= a) & (low[i] <= b) if a <= b else np.zeros(low.shape[1], bool)
                            inside[i] |= fits
                            wanted[i] |= fits & (high[i] >= kth)
                    first = lists.first(high, inside)
                    row, col = np.nonzero(wanted & ~first if later else first)
                    times = chunks[col]
                    row, col = np.repeat(row, times), np.repeat(col, times)
                    chunk = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                    own = batch.take(pa.array(row))
                    yield pa.RecordBatch.from_arrays([pa.array(col.astype(np.int32)), pa.array(chunk.astype(np.int32)), *own.columns], ["list", "chunk", *own.schema.names])

        types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in questions.schema)
        return questions.mapInArrow(visit, f"list int, chunk int, {types}")

    def _scores(self, visits: DataFrame, same: bool, k: int) -> DataFrame:
        """(q, ps, score, ids, own): of each chunk the k first classes of every question that opened it."""
        shared, windows_of = self.lists, _windows(self.low, self.high, same)
        held = self.postings.select("list", "chunk", F.lit(0).alias("kind"), F.col("key").alias("q"), "label", "v", "ids")
        asks = visits.select("list", "chunk", F.lit(1).alias("kind"), "q", "label", "v", "ps", "least")
        dealt = held.unionByName(asks, allowMissingColumns=True).repartition("list", "chunk").sortWithinPartitions("list", "chunk", "kind")

        def compare(asking: pa.RecordBatch, members: list[pa.RecordBatch], exact: bool) -> Iterator[pa.RecordBatch]:
            of = pa.Table.from_batches(members).combine_chunks().to_batches()[0]
            kind = np.float64 if exact else np.int64
            x, labels, ids, names = _matrix(of, "v", kind), _numbers(of, "label"), of.column("ids"), _numbers(of, "q")
            smallest = np.array([i[0] for i in ids.to_pylist()])
            for start in range(0, asking.num_rows, BLOCK):
                batch = asking.slice(start, BLOCK)
                ps, least = batch.column("ps").to_pylist(), batch.column("least").to_pylist()
                pairs = [(i, p, max(a, t), b) for i, (pp, ll) in enumerate(zip(ps, least)) for p, t, (a, b) in zip(pp, ll, windows_of(pp))]
                if not pairs:
                    continue
                own = np.array([p[0] for p in pairs])
                scores = _matrix(batch, "v", kind) @ x.T
                fits = (_numbers(batch, "label")[:, None] == labels[None]) == same
                at = scores[own]
                ok = fits[own] & (at >= np.array([p[2] for p in pairs], kind)[:, None]) & (at <= np.array([p[3] for p in pairs], kind)[:, None])
                if len(x) > k and ok.sum() > 4 * k * len(pairs):
                    ok &= at >= np.partition(np.where(ok, at, kind(_LEAST)), -k, axis=1)[:, -k, None]
                row, col = np.nonzero(ok)
                order = np.lexsort((smallest[col], -at[row, col], row))
                row, col = row[order], col[order]
                first = np.searchsorted(row, np.arange(len(pairs)))
                keep = np.arange(len(row)) - first[row] < k
                row, col = row[keep], col[keep]
                q = _numbers(batch, "q")[own[row]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.string()), pa.array([pairs[i][1] for i in row], pa.int64()), pa.array(at[row, col].astype(np.int64)), ids.take(pa.array(col)), pa.array(q == names[col])],
                    ["q", "ps", "score", "ids", "own"],
                )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            cell, members = None, []
            for batch in batches:
                marks = np.stack([_numbers(batch, c) for c in ("list", "chunk", "kind")], 1)
                cuts = [0, *(np.flatnonzero((marks[1:] != marks[:-1]).any(1)) + 1), len(marks)]
                for a, b in zip(cuts, cuts[1:]):
                    if a == b:
                        continue
                    here = tuple(marks[a, :2])
                    if marks[a, 2] == 0:
                        members = [*(members if here == cell else []), batch.slice(a, b - a)]
                        cell = here
                    elif here == cell:
                        yield from compare(batch.slice(a, b - a), members, shared.value.exact)

        id_type = self.postings.schema["ids"].dataType.simpleString()
        return dealt.mapInArrow(run, f"q string, ps long, score long, ids {id_type}, own boolean")


def mine_negatives(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 50, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for anchors whose id is divisible by ``every``.

    Components become floor(scale * x).  Negatives have another label and a score between low and high percent of the positive's.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("x")).where("id is not null and label is not null and x is not null")
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    rows = rows.select("id", "label", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))
    shape = rows.agg(F.min(F.size("v")).alias("short"), F.max(F.size("v")).alias("long"), F.max(F.aggregate("v", F.lit(0.0), lambda t, c: t + c.cast("double") * c)).alias("square"), F.max(F.aggregate("v", F.lit(0).cast("long"), lambda t, c: F.greatest(t, F.abs(c)))).alias("most")).first()
    if (shape["square"] or 0) >= 2.0**62:
        raise ValueError("scores of these vectors do not fit 62 bits")
    width = max(1, shape["long"] or 1)
    if shape["short"] != width:
        rows = rows.withColumn("v", F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: F.coalesce(F.get("v", i), F.lit(0).cast("long"))))
    rows = rows.withColumn("v", F.col("v").cast("array<int>" if (shape["most"] or 0) < 1 << 31 else "array<long>"))
    rows = rows.withColumn("key", F.md5(F.concat_ws(",", F.col("label").cast("string"), F.transform("v", lambda c: c.cast("string")))))

    named = Window.partitionBy("key").orderBy("id")
    firsts = rows.dropDuplicates(["key", "id"]).withColumn("r", F.row_number().over(named)).where(F.col("r") <= positives + 1)
    classes = materialize(firsts.groupBy("key").agg(F.first("label").alias("label"), F.first("v").alias("v"), F.array_sort(F.collect_list("id")).alias("ids")), "classes")
    asked = materialize(rows.where(F.col("id") % every == 0).select("id", "key").distinct(), "asked")

    n = classes.count()
    count = max(1, min(MOST_LISTS, n // LIST_ROWS))
    sample = classes.select("key", "v").orderBy("key").limit(SAMPLE).select("v").toArrow()  # the key is a hash
    seen = np.array(sample.column("v").to_pylist(), np.float64).reshape(-1, width) if n else np.zeros((1, width))
    centroids = fit(seen, count)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "v")
            own = nearest_centroid(x, centroids)
            away = np.sqrt(((x - centroids[own]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own.astype(np.int32)), pa.array(away)], [*batch.schema.names, "list", "away"])

    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in classes.schema)
    members = materialize(classes.mapInArrow(deal, f"{types}, list int, away double"), "members")
    found = members.groupBy("list").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect()  # MOST_LISTS rows at most
    radii, counts = np.zeros(count), np.zeros(count, np.int64)
    for r in found:
        radii[r["list"]], counts[r["list"]] = r["radius"], r["n"]
    lists = Lists(centroids, radii, counts, (shape["square"] or 0) < 2.0**52, -(-counts // CHUNK_ROWS), FIRST_ROWS)
    cut = spark.createDataFrame([(i, int(c)) for i, c in enumerate(lists.chunks)], "list int, chunks int")
    postings = members.join(F.broadcast(cut), "list").withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    search = _Search(postings, lists, low, high)

    ask = materialize(asked.select("key").distinct().join(classes.select("key", "label", "v"), "key").select(F.col("key").alias("q"), "label", "v"), "questions")
    same = search.best(ask.withColumn("ps", F.array(F.lit(0).cast("long"))), True, positives + 1, "positives")
    each = same.select("q", F.explode("ids").alias("id"), "score", (F.col("own") & (F.size("ids") == 1)).alias("alone"), "own")
    each = each.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id"))).where(F.col("r") <= positives + 1)
    near = materialize(each.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("r", "id", "score", "own", "alone"))).alias("near")), "near")

    wanted = F.array_distinct(F.transform(F.filter("near", lambda p: ~p["alone"]), lambda p: p["score"]))
    other = search.best(ask.join(near.select("q", wanted.alias("ps")), "q"), False, negatives, "negatives")
    each = other.select("q", "ps", F.explode("ids").alias("id"), "score").withColumn("r", F.row_number().over(Window.partitionBy("q", "ps").orderBy(F.desc("score"), "id"))).where(F.col("r") <= negatives)
    far = each.groupBy("q").agg(F.collect_list(F.struct("ps", "r", "id", "score")).alias("far"))

    answers = materialize(near.join(far, "q"), "answers")  # at most (positives + 1) * (negatives + 1) entries a row
    mine = F.slice(F.filter("near", lambda p: ~(p["own"] & (p["id"] == F.col("anchor_id")))), 1, positives)
    pairs = asked.withColumnRenamed("id", "anchor_id").join(answers, asked["key"] == answers["q"]).select("anchor_id", "far", F.explode(mine).alias("p"))
    out = pairs.select("anchor_id", "p", F.explode(F.filter("far", lambda f: f["ps"] == F.col("p.score"))).alias("f"))
    return out.select("anchor_id", F.col("p.id").alias("positive_id"), F.col("f.r").cast("int").alias("rank"), F.col("f.id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("f.score").alias("negative_score"))
