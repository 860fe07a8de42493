"""Dependency graphs: invalidation, upstream search, integrity."""

from __future__ import annotations

import functools
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import stored as reliable  # a checkpoint keeps the plan's estimated size, whose digits grow from round to round


class _Seen:
    """Rows found round by round.  Each round is written once; eight of one size are joined into one of the next."""

    def __init__(self, first: DataFrame):
        self.parts: list[tuple[int, DataFrame]] = [(0, first)]

    def rows(self) -> DataFrame:
        return functools.reduce(DataFrame.unionByName, (df for _, df in self.parts))

    def add(self, df: DataFrame) -> None:
        self.parts.append((0, df))
        while len(self.parts) >= 8 and self.parts[-8][0] == self.parts[-1][0]:
            joined = functools.reduce(DataFrame.unionByName, (df for _, df in self.parts[-8:]))
            self.parts[-8:] = [(self.parts[-1][0] + 1, reliable(joined))]


#: Rounds of a plain search before chains are contracted.
SHALLOW = 6


def reachable(edges: DataFrame, seeds: DataFrame, src: str = "src", dst: str = "dst", node: str = "node") -> DataFrame:
    """Nodes reached from the seeds along edges, seeds included.

    Only the newest nodes are joined with the edges in each round; a node is visited once, so
    cycles end.  The driver sees whether a frontier is empty, never its nodes.  A search that goes
    deep contracts unbranched chains and rings in logarithmic rounds and goes on over the rest, so
    rounds follow the branchings on the longest way, not its nodes.
    """
    step = edges.select(F.col(src).alias(node), F.col(dst).alias("_next")).where("_next is not null")
    seen, going = _search(step, reliable(seeds.select(node).distinct()), node, SHALLOW)
    return _deep(reliable(step.distinct()), seen.rows(), node) if going else seen.rows()


def _search(step: DataFrame, frontier: DataFrame, node: str, most: int | None) -> tuple[_Seen, bool]:
    """What rounds of a search find, and whether it was still going after the most."""
    seen, rounds = _Seen(frontier), 0
    while not frontier.isEmpty():
        if rounds == most:
            return seen, True
        found = step.join(frontier, node, "left_semi").select(F.col("_next").alias(node)).distinct()
        frontier = reliable(found.join(seen.rows(), node, "left_anti"))
        seen.add(frontier)
        rounds += 1
    return seen, False


def chains(step: DataFrame, node: str = "node") -> DataFrame:
    """(node, head, place, ring) of every node of edges (node, _next): its unbranched chain.

    An edge is a link of a chain if it is the only one out of its start and the only one into its end.
    Each round doubles how far a node sees back along its links; what sees no head after the
    logarithm of the nodes is a ring, whose head is its smallest node.
    """
    loose = step.where(F.col(node) != F.col("_next"))
    only_out = step.groupBy(node).count().where("count = 1").select(node)
    only_in = step.groupBy("_next").count().where("count = 1").select("_next")
    links = loose.join(only_out, node, "left_semi").join(only_in, "_next", "left_semi")
    nodes = step.select(node).union(step.select("_next")).distinct()
    back = nodes.join(links.select(F.col("_next").alias(node), F.col(node).alias("_back")), node, "left")
    state = reliable(back.select(node, F.coalesce("_back", node).alias("head"), F.when(F.col("_back").isNull(), 0).otherwise(1).cast("long").alias("place"), F.least(node, F.coalesce("_back", node)).alias("least")))
    for _ in range(math.ceil(math.log2(max(2, state.count()))) + 1):
        far = state.select(F.col(node).alias("head"), F.col("head").alias("_head"), F.col("place").alias("_place"), F.col("least").alias("_least"))
        state = reliable(state.join(far, "head").select(node, F.col("_head").alias("head"), (F.col("place") + F.col("_place")).alias("place"), F.least("least", "_least").alias("least")))
        open_ = state.join(state.where("place > 0").select(F.col(node).alias("head")), "head", "left_semi")
        if open_.isEmpty():
            break
    ring = state.join(state.where("place > 0").select(F.col(node).alias("head"), F.lit(True).alias("_ring")), "head", "left").withColumn("ring", F.coalesce("_ring", F.lit(False)))
    return reliable(ring.select(node, F.when(F.col("ring"), F.col("least")).otherwise(F.col("head")).alias("head"), F.when(F.col("ring"), 0).otherwise(F.col("place")).alias("place"), "ring"))


def _deep(step: DataFrame, seeds: DataFrame, node: str) -> DataFrame:
    """The search over contracted chains.  All ways into a chain but seeds lead to its head, all ways out start at its end."""
    chain = chains(step, node)
    entries = seeds.join(chain, node).groupBy("head").agg(F.min("place").alias("place"))
    ends = chain.join(chain.groupBy("head").agg(F.max("place").alias("place")), ["head", "place"], "left_semi").where("not ring")
    over = reliable(step.join(ends.select(node, "head"), node).select(F.col("head").alias(node), "_next").distinct())
    found, _ = _search(over, reliable(entries.select(F.col("head").alias(node))), node, None)
    whole = over.join(found.rows(), node, "left_semi").select(F.col("_next").alias("head"), F.lit(0).cast("long").alias("place"))
    begun = entries.select("head", F.col("place").cast("long").alias("place")).union(whole).groupBy("head").agg(F.min("place").alias("_from"))
    inside = chain.join(begun, "head").where("place >= _from").select(node)
    return inside.union(seeds.join(chain, node, "left_anti").select(node))


def invalidated(current: DataFrame, previous: DataFrame, edges: DataFrame, key: str = "id", fingerprint: str = "fingerprint") -> DataFrame:
    """(id, changed): current nodes whose fingerprint changed, and all that depend on a changed or removed one.

    edges: (parent, child), read again in each round of the search.  Removed nodes start the search but are not
    in the result.  Both states meet once.
    """
    now = current.select(F.col(key).alias("node"), F.col(fingerprint).alias("_new"), F.lit(True).alias("_now"))
    old = previous.select(F.col(key).alias("node"), F.col(fingerprint).alias("_old"))
    there = F.col("_now").isNotNull()
    nodes = reliable(now.join(old, "node", "full").select("node", there.alias("_now"), (there & ~F.col("_new").eqNullSafe(F.col("_old"))).alias("changed")))
    hit = reachable(edges, nodes.where(~F.col("_now") | F.col("changed")).select("node"), "parent", "child")
    return nodes.where("_now").join(hit, "node", "left_semi").groupBy(F.col("node").alias(key)).agg(F.bool_or("changed").alias("changed"))


def removed(current: DataFrame, previous: DataFrame, key: str = "id") -> DataFrame:
    return previous.join(current, key, "left_anti").select(key)


def nearest_upstream(nodes: DataFrame, edges: DataFrame, starts: DataFrame, wanted: str, key: str = "id", kind: str = "kind") -> DataFrame:
    """(start, id, hops): nodes of the wanted kind that each start's first such level of parents holds."""
    parents = edges.select(F.col("child").alias("_at"), F.col("parent").alias("_up")).distinct()
    level = reliable(starts.select(F.col(key).alias("start"), F.col(key).alias("_at")).distinct())
    seen, found, hops = _Seen(level), None, 0
    kinds = nodes.select(F.col(key).alias("_at"), F.col(kind).alias("_kind"))
    while not level.isEmpty():
        here = reliable(level.join(kinds.where(F.col("_kind") == wanted), "_at").select("start", F.col("_at").alias(key), F.lit(hops).alias("hops")))
        if found is None:
            found = _Seen(here)
        else:
            found.add(here)
        going = level.join(here.select("start").distinct(), "start", "left_anti")
        step = going.join(parents, "_at").select("start", F.col("_up").alias("_at")).distinct()
        level = reliable(step.join(seen.rows(), ["start", "_at"], "left_anti"))
        seen.add(level)
        hops += 1
    return found.rows() if found is not None else starts.select(F.col(key).alias("start"), F.col(key), F.lit(0).alias("hops")).limit(0)


def dangling_edges(nodes: DataFrame, edges: DataFrame, key: str = "id") -> DataFrame:
    """Edges (parent, child) with an end that is no node, and which end it is."""
    known = nodes.select(F.col(key).alias("_n")).distinct()
    ends = edges.select("parent", "child", F.explode(F.array(F.struct(F.lit("parent").alias("end"), F.col("parent").alias("_v")), F.struct(F.lit("child").alias("end"), F.col("child").alias("_v")))).alias("e")).select("parent", "child", "e.*")
    return ends.join(known, F.col("_v") == F.col("_n"), "left_anti").select("parent", "child", "end")


def class_shortfalls(nodes: DataFrame, required: DataFrame, kind: str = "kind") -> DataFrame:
    """(kind, least, n) of required kinds with fewer nodes than asked for."""
    counts = nodes.groupBy(kind).agg(F.count("*").alias("n"))
    return required.join(counts, kind, "left").select(kind, "least", F.coalesce("n", F.lit(0)).alias("n")).where("n < least")


def signature(*columns: str):
    """SHA-256 of the canonical JSON of columns, names sorted."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def stale_stages(stages: DataFrame, ledger: DataFrame, key: str = "stage") -> DataFrame:
    """Stages to run: not in the ledger, or with another signature, or with other output hashes."""
    old = ledger.select(key, F.col("signature").alias("_s"), F.col("outputs").alias("_o"))
    joined = stages.join(old, key, "left")
    return joined.where(~(F.col("signature").eqNullSafe(F.col("_s")) & F.col("outputs").eqNullSafe(F.col("_o")))).drop("_s", "_o")
