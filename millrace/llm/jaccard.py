"""N-gram Jaccard join with a token-group matrix.

A document's set holds the 64-bit hashes of its five-word shingles (words split at
ASCII white space, A-Z lower-cased).  Documents with equal sets form one class;
everything below works on classes, so copies cost one comparison at most.

1. One pass over the texts gives each document's set size and class key, and a
   fixed-size counting sketch of all shingles.
2. A second pass writes each class's prefix: its rarest shingles by the sketch (any
   total order is right, a rare-first one is fast), as many as two linked sets can
   not both do without.  Shingles of one class only are dropped; the others are the
   token-group matrix's rows.
3. Each class has a hub: the class with the most common prefix among those that share
   most of its prefix tokens (edits make shingles rare, so a hub is near the original).
   Classes that link with their hubs make components.  A component is one column of the
   matrix; the classes of a hub that don't link with it fill at most ``COLUMNS`` others.
4. The matrix, token by column, bounds a query's overlap with each column: two sets that
   link must share a certain number of prefix tokens, which follows from their sizes.
   Columns below the bound stay closed; of two columns the smaller one's classes ask,
   no class asks its own component, and classes that no hub joined ask their own column too.
5. A qualifying column is opened in groups of about ``GROUP_CLASSES``: one task counts the overlaps of a block of queries with
   all members of a group through an inverted list, and returns a link only where it joins
   two components that it has not seen joined.

Every link between different sets is found or lies inside a component already
known, so components are exact; 64-bit hashes stand for shingles and sets.
Pairs inside a group are never made rows.

Null, empty and blank texts have an empty set, link with nothing and are their own
component.  Very long texts are sets like others; a group that holds one holds few others.  Rows with the same id and text give equal rows; a component id is the smallest id
in the component, so ties need no rule.  Rows with a null id link like others; a component without
any id has a null component id.  An empty table gives an empty table.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import clean_shuffles, materialize, text_batches
from .graphs import components

WORDS = 5
PERCENT = 80
#: Counters of the shingle sketch, and how many make one row of it.
SKETCH, SKETCH_ROW = 1 << 22, 1 << 12
#: Word hashes that a task keeps.
CACHE_WORDS = 200_000
#: Classes of a group, queries that are compared with it at once, and shingles that either may hold (one set may hold more).
GROUP_CLASSES, BLOCK_QUERIES, MOST_SHINGLES = 256, 64, 1_000_000
#: Columns of the matrix that classes of one hub may fill which don't link with it.
COLUMNS = 16
#: Postings that a comparison expands at once.
POSTINGS = 500_000
#: A table of so many short rows may be broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 500_000

_P = np.uint64(0x9E3779B97F4A7C15)
_M = np.uint64(0xFF51AFD7ED558CCD)


def shingle_set(text: str | None, size: int = WORDS, cache: dict[bytes, int] | None = None) -> np.ndarray:
    """Ascending distinct shingle hashes; a shorter text is one shingle as a whole.  cache: a task's word hashes."""
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    cache = {} if cache is None else cache
    try:
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    except KeyError:
        if len(cache) > CACHE_WORDS:
            cache.clear()
        for w in set(words).difference(cache):
            cache[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = min(size, len(h))
    count = len(h) - n + 1
    total = h[:count].copy()
    for i in range(1, n):  # in place: this runs for every text, three times
        total *= _P
        total += h[i : count + i]
    total ^= total >> np.uint64(31)
    total *= _M
    total += np.uint64(n)
    total ^= total >> np.uint64(29)
    total.sort()
    fresh = np.empty(count, bool)
    fresh[0] = True
    np.not_equal(total[1:], total[:-1], out=fresh[1:])
    return total if fresh.all() else total[fresh]


def set_key(shingles: np.ndarray) -> int:
    """64-bit hash of a set, signed as Spark's long."""
    key = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return key - (1 << 64) if key >> 63 else key


def needed(n, percent: int = PERCENT):
    """Fewest shingles that a set of n shares with any set it links with."""
    return -(-n * percent // 100)


def linked(shared, n, m, percent: int = PERCENT):
    """100 * intersection >= percent * union, from an intersection and two sizes."""
    return (shared > 0) & (100 * shared >= percent * (n + m - shared))


def shared_count(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of ascending distinct arrays."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


class Group:
    """An opened group: its members' sets as an inverted list."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets])
        tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), self.sizes)
        order = np.argsort(tokens, kind="stable")
        tokens, self.owners = tokens[order], owners[order]
        first = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        self.tokens, self.bounds = tokens[first], np.append(first, len(tokens))

    def links(self, query: np.ndarray, percent: int) -> np.ndarray:
        """Indexes of the members that the query links with."""
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        sizes = self.bounds[at + 1] - self.bounds[at]
        shared = np.zeros(len(self.sizes), np.int64)
        # postings of so many tokens at once that they stay small, whatever the sets' sizes
        step = max(1, POSTINGS // len(self.sizes))
        for k in range(0, len(at), step):
            n = sizes[k : k + step]
            places = np.repeat(self.bounds[at[k : k + step]] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            shared += np.bincount(self.owners[places], minlength=len(self.sizes))
        return np.flatnonzero(linked(shared, len(query), self.sizes, percent))


def _scan(docs: DataFrame, size: int) -> DataFrame:
    """Per document: id, n, key; and per task the rows of a shingle sketch."""
    id_type = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SKETCH, np.uint8)  # a task's counters stay at 255
        seen: set[int] = set()
        cache: dict[bytes, int] = {}
        names = ["id", "n", "key", "block", "counts"]
        id_arrow = None
        for part, texts in text_batches(batches, "text"):
            ids = part.column(part.schema.get_field_index("id"))
            id_arrow = ids.type
            n, keys = [], []
            for text in texts:
                s = shingle_set(text, size, cache)
                n.append(len(s))
                key = set_key(s) if len(s) else None
                keys.append(key)
                if len(s) and key not in seen:
                    seen.add(key)
                    at = (s % np.uint64(SKETCH)).astype(np.int64)
                    counts[at] += counts[at] < 255
            empty = pa.nulls(len(texts), pa.int32())
            yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(keys, pa.int64()), empty, pa.nulls(len(texts), pa.binary())], names)
        if seen:
            blocks = SKETCH // SKETCH_ROW
            yield pa.RecordBatch.from_arrays([pa.nulls(blocks, id_arrow), pa.nulls(blocks, pa.int64()), pa.nulls(blocks, pa.int64()), pa.array(range(blocks), pa.int32()), pa.array([c.tobytes() for c in counts.reshape(blocks, -1)], pa.binary())], names)

    return docs.mapInArrow(run, f"id {id_type}, n long, key long, block int, counts binary")


def _ranks(sketch: DataFrame) -> np.ndarray:
    """Rank of every counter: eighths of its binary logarithm, one byte each.  Sums run in two steps."""

    def add(pdf):
        total = np.zeros(SKETCH_ROW, np.uint64)
        for c in pdf["counts"]:
            total += np.frombuffer(c, np.uint64 if len(c) == 8 * SKETCH_ROW else np.uint8)
        return pdf.head(1).assign(counts=total.tobytes())

    tasks = sketch.where("block = 0").count()
    bins = F.lit(max(1, math.isqrt(tasks)))
    some = sketch.withColumn("bin", F.pmod(F.xxhash64(F.monotonically_increasing_id()), bins).cast("int")).select("block", "bin", "counts")
    schema = "block int, bin int, counts binary"
    total = some.groupBy("block", "bin").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    ranks = np.zeros(SKETCH, np.uint8)
    for r in total.collect():  # SKETCH counters, whatever the input
        ranks[r["block"] * SKETCH_ROW : (r["block"] + 1) * SKETCH_ROW] = np.minimum(8 * np.log2(1 + np.frombuffer(r["counts"], np.uint64)), 255)
    return ranks


def _prefixes(docs: DataFrame, ranks: np.ndarray, size: int, percent: int) -> DataFrame:
    """(token, key, n, weight) for the prefix of every document; a task writes each set once.  weight: how common its tokens are."""
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        cache: dict[bytes, int] = {}
        for _, texts in text_batches(batches, "text"):
            tokens, keys, sizes, weights, takes = [np.zeros(0, np.uint64)], [], [], [], []
            for text in texts:
                s = shingle_set(text, size, cache)
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                seen.add(key)
                take = len(s) - needed(len(s), percent) + 1
                rank = shared.value[(s % np.uint64(SKETCH)).astype(np.int64)]
                order = np.argsort(rank, kind="stable")[:take]  # ties stay in hash order
                tokens.append(s[order])
                keys.append(key)
                sizes.append(len(s))
                weights.append(1000 * int(rank[order].sum(dtype=np.int64)) // take)
                takes.append(take)
            columns = [np.repeat(np.array(x, np.int64), np.array(takes, np.int64)) for x in (keys, sizes, weights)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(tokens).view(np.int64), *columns)], ["token", "key", "n", "weight"])

    return docs.select("text").mapInArrow(run, "token long, key long, n long, weight long")


def _sets(docs: DataFrame, keys: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """(key, shingles) of the wanted classes, each read from one document; those without any id by their keys."""
    wanted = materialize(keys.distinct().join(reps, "key"), "wanted")
    count, nameless = wanted.agg(F.count("*"), F.count_if(F.col("id").isNull())).first()
    checked = F.broadcast if count <= BROADCAST_ROWS else lambda df: df

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for part, texts in text_batches(batches, "text"):
            kept, sets = [], []
            for key, text in zip(part.column(part.schema.get_field_index("key")).to_pylist(), texts):
                s = shingle_set(text, size, cache)
                if len(s) and set_key(s) == key:  # another row may bear the same id
                    kept.append(key)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(sets, pa.binary())], ["key", "shingles"])

    def read_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        cache: dict[bytes, int] = {}
        for _, texts in text_batches(batches, "text"):
            kept, sets = [], []
            for text in texts:
                s = shingle_set(text, size, cache)
                if len(s) and (key := set_key(s)) not in seen:
                    seen.add(key)
                    kept.append(key)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64()), pa.array(sets, pa.binary())], ["key", "shingles"])

    schema = "key long, shingles binary"
    sets = docs.join(checked(wanted), "id").select("key", "text").mapInArrow(read, schema)
    if nameless:
        rest = docs.where("id is null").select("text").mapInArrow(read_all, schema).join(checked(wanted.where("id is null").select("key")), "key")
        sets = sets.unionByName(rest.dropDuplicates(["key"]))
    found = materialize(sets, "sets")
    return found if found.count() <= count else found.dropDuplicates(["key"])  # repeated rows give their set again


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of class keys whose sets link."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y = (batch.column(batch.schema.get_field_index(c)) for c in ("a", "b", "x", "y"))
            keep = []
            for p, q in zip(x, y):
                s, t = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                keep.append(bool(linked(shared_count(s, t), len(s), len(t), percent)))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a").join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
    return materialize(both.mapInArrow(compare, "a long, b long").distinct(), "links")


def _parts(classes: int, n: str) -> Column:
    """How many parts rows of sets make, by their number and by their shingles."""
    return F.greatest(F.ceil(F.count("*") / classes), F.ceil(F.sum(n) / MOST_SHINGLES))


def _open(opened: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between queries (grp, q, n, comp) and members (grp, key, comp) of their groups.

    A task gets one group and one block of its queries, so neither a large group nor a much-asked one meets in one place.
    """
    blocks = opened.groupBy("grp").agg(_parts(BLOCK_QUERIES, "n").cast("int").alias("blocks"))
    blocks = materialize(blocks, "blocks")
    asked = opened.join(blocks, "grp").select("grp", F.pmod(F.xxhash64("q", "grp"), F.col("blocks")).cast("int").alias("block"), F.col("q").alias("key"), "comp")
    held = members.join(blocks, "grp").select("grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "key", "comp")
    asked = asked.join(sets, "key")
    held = held.join(sets, "key").select(*(F.col(c).alias(f"{c}_") for c in ("grp", "block", "key", "comp", "shingles")))

    def compare(queries, group):
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                x = parent[x]
            return x

        out = []
        if len(queries) and len(group):
            keys, comps = group["key_"].tolist(), group["comp_"].tolist()
            index = Group([np.frombuffer(s, np.uint64) for s in group["shingles_"]])
            for q, comp, shingles in zip(queries["key"].tolist(), queries["comp"].tolist(), queries["shingles"]):
                for i in index.links(np.frombuffer(shingles, np.uint64), percent).tolist():
                    x, y = root(comp), root(comps[i])
                    if keys[i] != q and x != y:
                        parent[max(x, y)] = min(x, y)
                        out.append((q, keys[i]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return materialize(asked.groupBy("grp", "block").cogroup(held.groupBy("grp_", "block_")).applyInPandas(compare, "a long, b long"), "links")


def _fewest(n: Column, m: Column, percent: int) -> Column:
    """Fewest prefix tokens that linked sets of sizes n and m share.

    Linked sets share at least percent * (n + m) / (100 + percent) tokens.  Tokens up to the earlier
    of the two prefixes' ends lie in both prefixes; of that set fewer than its ``needed`` follow.
    """
    least = F.ceil(F.lit(percent) * (n + m) / (100 + percent) - 1e-9)
    return F.greatest(F.lit(1), least - F.ceil(F.greatest(n, m) * percent / 100 - 1e-9) + 1)


def _matrix(docs: DataFrame, ranks: np.ndarray, size: int, percent: int) -> DataFrame:
    """(token, key, n, weight) of prefix tokens that several classes have.

    Counts combine before their shuffle, and the join's skewed partitions can be split, so a token of very
    many classes meets in no single task.
    """
    some = materialize(_prefixes(docs, ranks, size, percent).distinct(), "prefixes")
    several = some.groupBy("token").agg(F.count("*").alias("f")).where("f > 1").select("token")
    return materialize(some.join(several, "token"), "matrix")


def _hubs(matrix: DataFrame, percent: int) -> DataFrame:
    """(key, n, hub, m, votes, low) of the classes in the matrix: each class's hub, the hub's size, for how many tokens it is that, and the smallest token.

    A token's hub is its class with the most common prefix; a class's hub is that of most of its
    tokens, one whose size allows a link if there is any.  A class may be its own hub.
    """
    best = F.max(F.struct("weight", "key", "n")).alias("h")
    hubs = matrix.groupBy("token").agg(best).select("token", F.col("h.key").alias("hub"), F.col("h.n").alias("m"), F.col("h.weight").alias("hub_weight"))
    votes = matrix.join(hubs, "token").select("token", "key", "n", "hub", "m", "hub_weight").repartition("key").groupBy("key", "n", "hub", "m", "hub_weight").agg(F.count("*").alias("votes"), F.min("token").alias("low"))
    near = F.least("n", "m") * 100 >= F.greatest("n", "m") * percent
    chosen = votes.groupBy("key", "n").agg(F.max(F.struct(near.alias("near"), "votes", "hub_weight", "hub", "m")).alias("h"), F.min("low").alias("low"))
    return materialize(chosen.select("key", "n", "h.hub", "h.m", "h.votes", "low"), "hubs")


def _groups(hubs: DataFrame, inside: DataFrame) -> DataFrame:
    """(key, n, comp, base, joined, members, parts): a base is a component that hubs made, or some of a hub's other classes.

    Those are dealt to at most COLUMNS bases by their smallest token, which similar classes share: alone where
    they are few, so that bounds are tight, and together where they are many, so that a token has few columns.
    """
    ends = inside.select(F.col("a").alias("key")).union(inside.select(F.col("b").alias("key"))).distinct().withColumn("joined", F.lit(True))
    comps = hubs.join(components(inside).withColumnRenamed("node", "key"), "key", "left").join(ends, "key", "left")
    comps = materialize(comps.select("key", "n", F.coalesce("root", "key").alias("comp"), F.coalesce("joined", F.lit(False)).alias("joined"), "hub", "low"), "comps")
    alone = comps.where("not joined").groupBy("hub").agg(F.least(F.count("*"), F.lit(COLUMNS)).alias("columns"))
    comps = comps.join(alone, "hub", "left").withColumn("base", F.when(F.col("joined"), F.xxhash64("comp")).otherwise(F.xxhash64("hub", F.pmod(F.xxhash64("low"), "columns"))))
    comps = materialize(comps.select("key", "n", "comp", "joined", "base"), "based")
    sizes = comps.groupBy("base").agg(F.count("*").alias("members"), _parts(GROUP_CLASSES, "n").cast("int").alias("parts"))
    return materialize(comps.join(sizes, "base"), "grouped")


def _overlaps(matrix: DataFrame, grouped: DataFrame) -> DataFrame:
    """Rows (token, q, nq, base, low_n, high_n): a query's token that classes of another base hold, or others of its own.

    The matrix has one entry per token and base, not per token and member: the base's token union.  Of two
    bases the smaller one asks, and a component does not ask itself, so a group of near copies makes one row
    per member and token at most.
    """
    rows_of = materialize(matrix.select("token", "key").join(grouped.select("key", "n", "base", "joined", "members"), "key"), "rows")
    columns = rows_of.groupBy("token", "base", "members").agg(F.min("n").alias("low_n"), F.max("n").alias("high_n"), F.count("*").alias("holders"))
    asking = rows_of.select("token", F.col("key").alias("q"), F.col("n").alias("nq"), F.col("base").alias("own"), "joined", F.col("members").alias("own_members"))
    other = F.struct("own_members", "own") < F.struct("members", "base")
    inner = (F.col("own") == F.col("base")) & ~F.col("joined") & (F.col("holders") > 1)
    return asking.join(columns, "token").where(other | inner).select("token", "q", "nq", "base", "low_n", "high_n")


def _qualifying(overlaps: DataFrame, percent: int) -> DataFrame:
    """(q, base) whose shared tokens reach the least that any member's size allows."""
    shared = overlaps.groupBy("q", "nq", "base").agg(F.count("*").alias("c"), F.min("low_n").alias("low_n"), F.max("high_n").alias("high_n"))
    low_n, high_n = F.greatest(F.col("low_n"), F.ceil(F.col("nq") * percent / 100)), F.least(F.col("high_n"), F.floor(F.col("nq") * 100 / percent))
    # the bound rises and then falls with the member's size, up to one for rounding
    least = F.greatest(F.lit(1), F.least(_fewest(F.col("nq"), low_n, percent), _fewest(F.col("nq"), high_n, percent)) - 1)
    return shared.where(low_n <= high_n).where(F.col("c") >= least).select("q", "base")


def _solve(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """From (id, text): rows (id, n, key), and classes (key, id, root, component_id), id the smallest of the class."""
    scanned = materialize(_scan(docs, size), "scan")
    rows = scanned.where("block is null").select("id", "n", "key")
    classes = materialize(rows.where("n > 0").groupBy("key", "n").agg(F.min("id").alias("id")), "classes")
    matrix = _matrix(docs, _ranks(scanned.where("block is not null")), size, percent)
    hubs = _hubs(matrix, percent)
    clean_shuffles(docs.sparkSession)
    # a hub with too few votes may still share enough tokens: the matrix finds such links
    likely = (F.least("n", "m") * 100 >= F.greatest("n", "m") * percent) & (F.col("votes") >= _fewest(F.col("n"), F.col("m"), percent))
    pairs = materialize(hubs.where("key <> hub").where(likely).select(F.col("key").alias("a"), F.col("hub").alias("b")), "pairs")
    reps = classes.select("key", "id")
    inside = _verify(pairs, _sets(docs, pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))), reps, size), percent)

    grouped = _groups(hubs, inside)
    asked = _qualifying(_overlaps(matrix, grouped), percent)
    # groups are parts of bases, of bounded size
    parts = grouped.select("base", "parts").distinct().select("base", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    grp = F.xxhash64("base", "part").alias("grp")
    opened = asked.join(parts, "base").select("q", grp).join(grouped.select(F.col("key").alias("q"), "n", "comp"), "q")
    opened = materialize(opened.select("grp", "q", "n", "comp"), "opened")
    members = grouped.select("key", "comp", "base", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part")).select("key", "comp", grp)
    targets = materialize(members.join(opened.select("grp").distinct(), "grp").select("grp", "key", "comp"), "targets")
    clean_shuffles(docs.sparkSession)
    sets = _sets(docs, opened.select(F.col("q").alias("key")).union(targets.select("key")), reps, size)
    final = components(inside.unionByName(_open(opened, targets, sets, percent)))

    named = materialize(classes.join(final.withColumnRenamed("node", "key"), "key", "left").select("key", "id", F.coalesce("root", "key").alias("root")), "named")
    smallest = materialize(named.groupBy("root").agg(F.min("id").alias("component_id")), "smallest")
    return rows, materialize(named.join(smallest, "root"), "components")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per document: id, n_shingles, component_id.  Other columns of docs are not read."""
    rows, of_class = _solve(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), size, percent)
    full = rows.where("n > 0").join(of_class.select("key", "component_id"), "key").select("id", "n", "component_id")
    empty = rows.where("n = 0").select("id", "n", F.col("id").alias("component_id"))
    return full.unionByName(empty).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _keyed(docs: DataFrame, text_col: str, key_col: str, size: int) -> DataFrame:
    """docs with the class key of every text as one more, last column; null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[bytes, int] = {}
        for part, texts in text_batches(batches, text_col):
            sets = [shingle_set(t, size, cache) for t in texts]
            yield part.append_column(key_col, pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(key_col, T.LongType())]))


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row, all columns, of each component: that of its smallest id.  Rows with an empty set all stay.

    Of several rows with that id in one component, and of a component without any id, one row stays: of the
    smallest class key, then the smallest text.  Rows with equal ids and different texts are told apart.
    """
    rows, of_class = _solve(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), size, percent)
    copies = materialize(rows.join(of_class.select("key", "component_id"), "key").where("id <> component_id").select(F.col("id").alias(id_col)).distinct(), "copies")
    repeated = materialize(rows.where("id is not null").groupBy(F.col("id").alias(id_col)).count().where("count > 1").select(id_col), "repeated")
    checked = lambda ids: F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    kept = docs.where(F.col(id_col).isNotNull()).join(checked(copies), id_col, "left_anti")
    odd = [docs.where(F.col(id_col).isNull())] if rows.where("id is null").limit(1).count() else []
    if not repeated.isEmpty():
        kept = kept.join(checked(repeated), id_col, "left_anti")
        odd.append(docs.join(checked(repeated), id_col, "left_semi").select(*docs.columns))
    kept = kept.select(*docs.columns)
    if not odd:
        return kept
    key, row = f"_key_{uuid.uuid4().hex}", f"_row_{uuid.uuid4().hex}"
    keyed = materialize(_keyed(reduce(DataFrame.unionByName, odd), text_col, key, size), "keyed")
    chosen = of_class.where(F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min("key").alias(key), F.first("component_id").alias(row))
    own = keyed.join(chosen.select(key, row), key).where(F.col(id_col).eqNullSafe(F.col(row))).drop(row)
    one = own.groupBy(key).agg(F.min_by(F.struct(*docs.columns), F.col(text_col)).alias(row)).select(f"{row}.*")
    return kept.unionByName(one).unionByName(keyed.where(F.col(key).isNull()).select(*docs.columns))
