"""Ordered folds that start again, with one series spread over many tasks.

A fold of this kind walks a series with one number as its state.  An element breaks
the state if ``reach - state`` is not below a limit, and the element's own ``start``
is then the state.  Scene cuts (a cut counts if it lies far enough behind the last
one that did) and word chunks (a chunk grows until it is long enough) are such folds.

Rows are dealt by ranges of series and order and read in blocks.  A block maps the
state that enters it to the one that leaves: which element an entering state breaks
at depends on how far it reaches, and from there on the block goes its own way.
Ways soon run together, so a map is a short list of steps.  The driver chains the
maps, one row per block, and every block then emits its elements from the state that
enters it.  Inside a block all next breaks are found at once, by doubling.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from .dedup import reliable

#: Rows of a block.
BLOCK = 1 << 16


def next_breaks(reach: np.ndarray, start: np.ndarray, limit: float) -> np.ndarray:
    """For each element the first one behind it that breaks its start; the length if there is none.

    Maxima over runs of 1, 2, 4, ... elements let all elements skip ahead together.
    """
    n = len(reach)
    levels = [reach]
    while 2 * (1 << (len(levels) - 1)) <= n:
        half = 1 << (len(levels) - 1)
        levels.append(np.maximum(levels[-1][:-half], levels[-1][half:]))
    at = np.arange(1, n + 1)
    for level in range(len(levels) - 1, -1, -1):
        highest = levels[level]
        inside = at < len(highest)
        with np.errstate(invalid="ignore"):
            holds = highest[np.minimum(at, len(highest) - 1)] - start < limit
        at = np.where(inside & holds, at + (1 << level), at)
    return at


@dataclass
class Segment:
    """The rows of one series in a block."""

    reach: np.ndarray
    start: np.ndarray
    limit: float

    def __post_init__(self) -> None:
        self.next = next_breaks(self.reach, self.start, self.limit)

    def last(self) -> np.ndarray:
        """For each element the last break of the way that starts with it."""
        n = len(self.next)
        to = np.where(self.next < n, self.next, np.arange(n))
        while True:
            further = to[to]
            if (further == to).all():
                return to
            to = further

    def first(self, state: float) -> int:
        """The first element that breaks a state that enters; the length if none does."""
        with np.errstate(invalid="ignore"):
            breaks = ~(self.reach - state < self.limit)
        return int(np.argmax(breaks)) if breaks.any() else len(breaks)

    def way(self, first: int) -> list[int]:
        out = []
        while first < len(self.next):
            out.append(first)
            first = int(self.next[first])
        return out

    def steps(self) -> list[tuple[float, int]]:
        """(highest reach, last break) of the runs of first breaks that leave the block alike."""
        highest, last = np.maximum.accumulate(self.reach), self.last()
        out: list[tuple[float, int]] = []
        for j in np.flatnonzero(highest > np.append(-np.inf, highest[:-1])).tolist():
            if out and out[-1][1] == last[j]:
                out.pop()
            out.append((float(highest[j]), int(last[j])))
        return out


_STEP = StructType([StructField("reach", DoubleType()), StructField("row", LongType()), StructField("start", DoubleType())])


def restarts(
    rows: DataFrame,
    key: list[str],
    order: list[str],
    reach: str,
    start: str,
    limit: float,
    emit: Callable[[tuple, pa.RecordBatch, list[int], tuple[float, int] | None, int, bool], Iterator[tuple]],
    schema: StructType,
    initial: float | None = None,
    behind: bool = False,
) -> DataFrame:
    """What ``emit`` yields for the rows of every series in every block.

    emit(key, rows, breaks, entering, number, ends) gets the rows of one series in one block, the places of
    its breaks, the state that enters with the number of the row that set it (None before the first break),
    the number of the block's first row, and whether the series ends with the block.  Row numbers grow along
    a series.  ``initial`` is the state at the start of a series; without it the first row is a break.  With
    ``behind`` a row's reach counts from the row after it.  A null reach breaks nothing, or everything with
    ``behind``; a null start is broken by every row.
    """
    limit, most = max(limit, 5e-324), BLOCK
    held = rows.repartitionByRange(*key, *order).sortWithinPartitions(*key, *order).withColumn("_p", F.spark_partition_id())
    parts = reliable(held)
    names = parts.columns

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int]]:
        """(rows, partition, number of the first row) in blocks."""
        waiting, size, done = [], 0, 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - size)
                waiting.append(part)
                size += part.num_rows
                batch = batch.slice(part.num_rows)
                if size == most:
                    yield _joined(waiting), done, size
                    waiting, done, size = [], done + size, 0
        if size:
            yield _joined(waiting), done, size

    def series(block: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        columns = [block.column(names.index(k)) for k in key]
        codes = [c.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for c in columns]
        cuts = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in codes])) + 1 if len(block) > 1 else np.array([], int)
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)]):
            yield tuple(c[a].as_py() for c in columns), block.slice(a, b - a)

    def numbers(part: pa.RecordBatch, before: float | None) -> tuple[np.ndarray, np.ndarray]:
        r = part.column(names.index(reach)).to_numpy(zero_copy_only=False).astype(float)
        s = part.column(names.index(start)).to_numpy(zero_copy_only=False).astype(float)
        r = np.where(np.isnan(r), np.inf if behind else -np.inf, r)
        return (np.append(-np.inf if before is None else before, r[:-1]) if behind else r), s

    def edge(part: pa.RecordBatch) -> float:
        value = part.column(names.index(reach))[-1].as_py()
        return np.inf if value is None else value

    def opening(segment: Segment) -> int:
        """The first break of a series that begins here."""
        return 0 if initial is None else segment.first(initial)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, number, _ in blocks(batches):
            found = list(series(block))
            (first, head), (last, tail) = found[0], found[-1]
            segment = Segment(*numbers(head, None), limit)
            to = segment.last()
            steps = [{"reach": r, "row": number + i, "start": float(segment.start[i])} for r, i in segment.steps()]
            zero = int(to[0])  # where the way leaves that starts with the first row
            end = segment if len(found) == 1 else Segment(*numbers(tail, None), limit)
            at, offset = opening(end), number + len(block) - len(tail)
            own = int(end.last()[at]) if at < len(end.next) else -1
            values = [
                block.column(names.index("_p"))[0].as_py(), number, [str(k) if k is not None else None for k in first], [str(k) if k is not None else None for k in last], len(found) == 1, steps,
                {"reach": None, "row": number + zero, "start": float(segment.start[zero])},
                None if own < 0 else {"reach": None, "row": offset + own, "start": float(end.start[own])}, edge(tail),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([v], t.type) for v, t in zip(values, summary_arrow)], schema=summary_arrow)

    text = ArrayType(StringType())
    summary = StructType([StructField("p", LongType()), StructField("number", LongType()), StructField("first", text), StructField("last", text), StructField("single", BooleanType()), StructField("steps", ArrayType(_STEP)), StructField("zero", _STEP), StructField("own", _STEP), StructField("edge", DoubleType())])
    summary_arrow = to_arrow_schema(summary)

    entering: dict[tuple[int, int], tuple] = {}
    state, before = None, None
    found = sorted(parts.mapInArrow(summarise, summary).collect(), key=lambda r: (r.p, r.number))  # one row per block
    for i, r in enumerate(found):
        going = before is not None and before.last == r.first
        ends = i + 1 == len(found) or found[i + 1].first != r.last
        entering[r.p, r.number] = (going, state if going else None, before.edge if going else None, ends)
        if going and r.single:
            value = initial if state is None else state[0]
            if behind and not _holds(before.edge, value, limit):
                state = (r.zero.start, _number(r.p, r.zero.row))
            else:
                step = next((s for s in r.steps if not _holds(s.reach, value, limit)), None)
                state = state if step is None else (step.start, _number(r.p, step.row))
        else:
            state = None if r.own is None else (r.own.start, _number(r.p, r.own.row))
        before = r
    shared = rows.sparkSession.sparkContext.broadcast(entering)
    out_arrow = to_arrow_schema(schema)

    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for block, number, _ in blocks(batches):
            p = block.column(names.index("_p"))[0].as_py()
            going, state, edge_before, ends = shared.value[p, number]
            at, parts_of = number, list(series(block))
            for i, (k, part) in enumerate(parts_of):
                enters = going and i == 0
                segment = Segment(*numbers(part, edge_before if enters else None), limit)
                if enters:
                    first = segment.first(initial if state is None else state[0])
                else:
                    first, state = opening(segment), None
                yield from emit(k, part, segment.way(first), state, _number(p, at), ends if i + 1 == len(parts_of) else True)
                at += len(part)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = []
        for row in emitted(batches):
            waiting.append(row)
            if len(waiting) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), out_arrow)], schema=out_arrow)
                waiting = []
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*waiting), out_arrow)], schema=out_arrow)

    return parts.mapInArrow(run, schema)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return batches[0] if len(batches) == 1 else pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _number(partition: int, row: int) -> int:
    return (partition << 40) + row


def _holds(reach: float, state: float, limit: float) -> bool:
    return reach - state < limit
