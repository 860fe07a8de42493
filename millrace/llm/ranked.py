"""Ranked lexical search: WAND over document shards.

One pass over the documents counts each document's terms and keeps, for the terms
of the queries, its term frequencies; these postings are written, and collection
counts come from them.  A task then reads postings in groups, orders a group by
document length and cuts it into shards, so that the largest impact of a term in
a shard is close to its others.  Each shard gets an inverted index.  For every
query WAND keeps a cursor in each posting list and a heap of the best documents:
cursors are ordered by document, the first whose summed maximum impacts can reach
the heap's least score is the pivot, documents before it are skipped by binary
search.  A group starts from the scores of the documents that hold a query's
rarest terms, and from the thresholds of the groups before it in its task.  The
heaps of all groups are merged by Spark.

Terms are the longest runs of ASCII letters, digits and characters beyond ASCII;
only A-Z are lower-cased.  With N documents that have a term, L terms in all, n in
the document and df documents that hold a term, its weight is
``w = floor(1000 ln((2N + 2) / (2 df + 1)))`` and its impact
``w * ((10^9 tf) div (1000 tf + 8 m))`` with ``m = 25 + (75 n N) div L``.

Queries with equal texts are searched once.  They are taken in blocks of about
``BLOCK_CHARS`` characters, each of which passes over the documents.  Null and
empty texts have no term: such a document is not counted and never found, and such
a query has no rows.  Equal rows are documents, or queries, of their own.  Null ids
are kept; among equal scores they come last.  Very long texts are read whole, in
slices.  Empty tables give no rows; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SLICE_CHARS, column, materialize, release

#: Characters of query texts that are searched for in one pass; postings of a group; documents of a shard.
BLOCK_CHARS, GROUP_POSTINGS, SHARD_DOCS = 4_000_000, 1 << 21, 1024
#: Documents scored to get a query's first threshold in a group, per document asked for.
FIRST_DOCS = 4
_END = 1 << 62
#: Bytes of terms, A-Z lower-cased; a space for all others.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_slices(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, some at a time."""
    start = 0
    while start < len(text):
        end = start + SLICE_CHARS
        while end < len(text) and _TERM_BYTES[text[end]] != 0x20:
            end += 1
        yield text[start:end].translate(_TERM_BYTES).split()
        start = end


def wand(lists: list[tuple[int, list[int], list[int]]], heap: list[tuple[int, int]], k: int, bar: int) -> int:
    """Offers a shard's documents to a heap of k (score, -document); returns the least score that can still enter.

    A list is (largest impact, documents ascending and then _END, their impacts).
    """
    cursors = [[docs[0], 0, most, docs, impacts] for most, docs, impacts in lists]
    first, at = itemgetter(0), 0
    while True:
        cursors.sort(key=first)
        reach = 0
        for at, c in enumerate(cursors):  # noqa: B007
            reach += c[2]
            if reach >= bar:
                break
        else:
            return bar
        pivot = c[0]
        if pivot == _END:
            return bar
        if cursors[0][0] < pivot:
            for c in cursors[:at]:
                if c[0] < pivot:
                    c[1] = bisect_left(c[3], pivot, c[1])
                    c[0] = c[3][c[1]]
            continue
        score = 0
        for c in cursors:
            if c[0] != pivot:
                break
            score += c[4][c[1]]
            c[1] += 1
            c[0] = c[3][c[1]]
        if score >= bar:
            if len(heap) < k:
                heapq.heappush(heap, (score, -pivot))
            elif (score, -pivot) > heap[0]:
                heapq.heapreplace(heap, (score, -pivot))
            if len(heap) == k:
                bar = max(bar, heap[0][0])


class _Group:
    """Documents of a task that are searched together; documents are numbered by ascending id."""

    def __init__(self, ids: list, n: list[int], sizes: np.ndarray, terms: np.ndarray, tf: np.ndarray, weights: np.ndarray, counted: int, total: int) -> None:
        rank = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
        number = np.empty(len(ids), np.int64)
        number[rank] = np.arange(len(ids))
        self.ids = [ids[i] for i in rank]
        m = np.array([25 + 75 * x * counted // total for x in n], np.int64)
        of = np.repeat(np.arange(len(ids)), sizes)
        impact = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 8 * m[of]))
        shard_of = np.empty(len(ids), np.int64)
        shard_of[np.argsort(n, kind="stable")] = np.arange(len(ids)) // SHARD_DOCS
        doc, shard = number[of], shard_of[of]
        order = np.lexsort((doc, terms, shard))
        self.doc, self.impact, terms, shard = doc[order], impact[order], terms[order], shard[order]
        starts = np.flatnonzero(np.diff(shard * (len(weights) + 1) + terms, prepend=-1))
        ends = np.append(starts[1:], len(terms))
        self.parts: dict[int, dict[int, tuple[int, int, int]]] = {}  # shard, term: largest impact, start, end
        for s, t, *held in zip(*(x.tolist() for x in (shard[starts], terms[starts], np.maximum.reduceat(self.impact, starts), starts, ends))):
            self.parts.setdefault(s, {})[t] = tuple(held)
        by_term = np.lexsort((self.doc, terms))
        self.by_term, self.term_ends = self.doc[by_term], np.searchsorted(terms[by_term], np.arange(len(weights) + 1))
        by_doc = np.lexsort((terms, self.doc))
        self.doc_terms, self.doc_impact, self.doc_ends = terms[by_doc], self.impact[by_doc], np.searchsorted(self.doc[by_doc], np.arange(len(ids) + 1))

    def first_bar(self, asked: dict[int, int], rarest: list[int], k: int) -> int:
        """The k-th best score among documents that hold the query's rarest terms; 1 if there are fewer than k."""
        docs: list[int] = []
        for t in rarest:
            docs += self.by_term[self.term_ends[t] : self.term_ends[t + 1]][: FIRST_DOCS * k].tolist()
            if len(docs) >= FIRST_DOCS * k:
                break
        scores = []
        for d in set(docs):
            a, b = self.doc_ends[d], self.doc_ends[d + 1]
            scores.append(sum(asked.get(t, 0) * i for t, i in zip(self.doc_terms[a:b].tolist(), self.doc_impact[a:b].tolist())))
        return max(1, heapq.nlargest(k, scores)[-1]) if len(scores) >= k else 1

    def search(self, queries: list[dict[int, int]], rarest: list[list[int]], bars: list[int], k: int) -> Iterator[tuple[int, object, int]]:
        """(query, document id, score) of the k best documents of each query; raises the bars."""
        heaps: list[list[tuple[int, int]]] = [[] for _ in queries]
        for q, asked in enumerate(queries):
            bars[q] = max(bars[q], self.first_bar(asked, rarest[q], k))
        for known in self.parts.values():
            opened: dict[int, tuple[list[int], list[int]]] = {}
            for q, asked in enumerate(queries):
                here = [(t, c) for t, c in asked.items() if t in known]
                if sum(known[t][0] * c for t, c in here) < bars[q]:
                    continue
                lists = []
                for t, c in here:
                    most, a, b = known[t]
                    if t not in opened:
                        opened[t] = [*self.doc[a:b].tolist(), _END], self.impact[a:b].tolist()
                    docs, impacts = opened[t]
                    lists.append((most * c, docs, impacts if c == 1 else [i * c for i in impacts]))
                bars[q] = wand(lists, heaps[q], k, bars[q])
        for q, heap in enumerate(heaps):
            for score, doc in heap:
                if score >= bars[q]:
                    yield q, self.ids[-doc], score


def rank_documents(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k best documents with a score above 0 for each item."""
    wanted = materialize(items.select(F.col(item_col).alias("item"), F.col(item_text).alias("text")).where("text is not null").withColumn("key", F.md5("text")), "items")
    texts = wanted.groupBy("key").agg(F.first("text").alias("text"))
    blocks = math.ceil((texts.agg(F.sum(F.length("text"))).first()[0] or 0) / BLOCK_CHARS)
    found = None
    for b in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).collect()  # about BLOCK_CHARS characters
        hits = _search(docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("binary").alias("text")), [(r["key"], Counter(t for s in term_slices(r["text"].encode()) for t in s)) for r in rows], k)
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        found = docs.limit(0).select(F.lit("").alias("key"), F.lit(1).alias("rank"), F.col(id_col).alias("doc"), F.lit(0).cast("long").alias("score"))
    return found.join(wanted.select("key", "item"), "key").select(F.col("item").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def _search(docs: DataFrame, texts: list[tuple[str, Counter]], k: int) -> DataFrame:
    """(key, rank, doc, score) of one block of queries."""
    spark, names = docs.sparkSession, [key for key, _ in texts]
    numbers: dict[bytes, int] = {}
    queries = [{numbers.setdefault(t, len(numbers)): c for t, c in counts.items()} for _, counts in texts]
    vocabulary = spark.sparkContext.broadcast(numbers)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            keep, n, terms, tf = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                if not text.is_valid:
                    continue
                held, size = Counter(), 0
                for words in term_slices(text.as_py()):
                    held.update(map(number, words))
                    size += len(words)
                if size:
                    held.pop(None, None)
                    keep.append(i)
                    n.append(size)
                    terms.append(list(held))
                    tf.append(list(held.values()))
            yield pa.RecordBatch.from_arrays([batch.column("doc").take(pa.array(keep, pa.int64())), pa.array(n, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tf, pa.list_(pa.int64()))], ["doc", "n", "terms", "tf"])
        release()

    id_type = docs.schema["doc"].dataType.simpleString()
    postings = materialize(docs.mapInArrow(count, f"doc {id_type}, n long, terms array<int>, tf array<long>"), "postings")
    size = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    df = np.zeros(len(numbers), np.int64)
    for r in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # the vocabulary of a block at most
        df[r["t"]] = r["count"]
    weights = np.array([math.floor(1000 * math.log((2 * size["documents"] + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    rarest = [sorted(q, key=lambda t: (df[t], t)) for q in queries]
    shared = spark.sparkContext.broadcast((queries, rarest, weights, size["documents"], size["terms"]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, rarest, weights, documents, total = shared.value
        bars = [1] * len(queries)

        def one(group: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(group).combine_chunks()
            lists = [rows.column(c).chunk(0) for c in ("terms", "tf")]
            sizes = np.diff(lists[0].offsets.to_numpy(zero_copy_only=False))
            flat = [x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in lists]
            hits = list(_Group(rows.column("doc").to_pylist(), rows.column("n").to_pylist(), sizes, *flat, weights, documents, total).search(queries, rarest, bars, k))
            q, doc, score = zip(*hits) if hits else ((), (), ())
            return pa.RecordBatch.from_arrays([pa.array(q, pa.int32()), pa.array(doc, rows.schema.field("doc").type), pa.array(score, pa.int64())], ["q", "doc", "score"])

        group, size = [], 0
        for whole in batches:
            for start in range(0, whole.num_rows, SHARD_DOCS):
                batch = whole.slice(start, SHARD_DOCS)
                group.append(batch)
                size += len(batch.column("terms").flatten())
                if size >= GROUP_POSTINGS:
                    yield one(group)
                    group, size = [], 0
        if group:
            yield one(group)
        release()

    hits = postings.where(F.size("terms") > 0).mapInArrow(search, f"q int, doc {id_type}, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    best = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    known = spark.createDataFrame([(i, key) for i, key in enumerate(names)], "q int, key string")
    return materialize(best.join(F.broadcast(known), "q").select("key", "rank", "doc", "score"), "hits")
