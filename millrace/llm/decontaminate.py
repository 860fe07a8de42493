"""Benchmark decontamination by pigeonhole edit matching.

A test item and a document are compared after lower-casing and joining runs of
white space.  An item may differ from a stretch of the document by at most
``rate`` times its length (rounded down) insertions, deletions and substitutions.  Cut into one piece
more than that budget, at least one piece must occur unchanged: an Aho-Corasick
automaton over all pieces finds such hits in one pass, and Myers' bit-parallel
distance checks the stretch around each.  The same argument holds for any run of
pieces, so a hit is checked against ever larger runs around its piece (each with
its own budget) and given up at the first that fails; the last run is the item.

Items are taken in blocks of about ``block_chars`` characters, one pass over the
documents per block, so an automaton's size does not grow with the benchmark.

Items with fewer than ``least_chars`` characters must occur unchanged and as whole
words, since parts and variants of such strings occur by chance; the same automaton
finds them.  Letters of scripts without spaces between words bound a word.

Null and empty texts, of documents and items, match nothing.  Items with equal texts are each reported; repeated documents are reported
row by row.  An empty benchmark or document table gives no rows.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import text_batches

RATE = 0.1
LEAST_CHARS = 24
BLOCK_CHARS = 4_000_000


def normal_text(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


#: Letters of scripts without spaces: Thai and Lao, Myanmar, Khmer, kana, Han.
UNSPACED = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF))


def word_character(c: str) -> bool:
    """A letter, mark or digit that belongs to one word with such neighbours."""
    return unicodedata.category(c)[0] in "LMN" and not any(a <= ord(c) <= b for a, b in UNSPACED)


def whole_words(text: str, start: int, end: int) -> bool:
    """Whether no word of the text crosses either end of the stretch."""
    return not any(0 < at < len(text) and word_character(text[at - 1]) and word_character(text[at]) for at in (start, end))


def pieces(length: int, parts: int) -> list[tuple[int, int]]:
    """Bounds of so many pieces of nearly equal length."""
    return [(length * i // parts, length * (i + 1) // parts) for i in range(parts)]


def myers_search(pattern_bits: dict[str, int], length: int, text: str, most: int) -> int | None:
    """Smallest edit distance of a pattern to any substring of text, None above most.

    pattern_bits has, for each character, the set of its positions in the pattern.
    """
    full = (1 << length) - 1
    top = 1 << (length - 1)
    up, down, distance, best = full, 0, length, length
    for c in text:
        equal = pattern_bits.get(c, 0)
        diagonal = (((equal & up) + up) ^ up) | equal | down
        rise = down | (full & ~(diagonal | up))
        fall = up & diagonal
        if rise & top:
            distance += 1
        elif fall & top:
            distance -= 1
            if distance < best:
                best = distance
        rise = (rise << 1) & full
        fall = (fall << 1) & full
        up = fall | (full & ~(diagonal | rise))
        down = rise & diagonal
    return best if best <= most else None


def enclosing_runs(bounds: list[tuple[int, int]], piece: int) -> list[tuple[int, int, int]]:
    """Runs of pieces around one, from small to the whole: (start, end, budget).

    A run of n pieces with fewer than n errors has a half with fewer errors than pieces, and so on
    down to an unchanged piece.
    """
    low, high, runs = 0, len(bounds), []
    while high - low > 1:
        runs.append((bounds[low][0], bounds[high - 1][1], high - low - 1))
        middle = (low + high) // 2
        low, high = (low, middle) if piece < middle else (middle, high)
    return runs[::-1]


class ItemIndex:
    """Automaton and bit patterns of one block of items; those under least_chars are matched as whole words."""

    def __init__(self, items: Iterable[tuple[int, str]], rate: float, least_chars: int = 0):
        import ahocorasick

        self.ids: dict[str, list[int]] = {}
        for i, text in items:
            self.ids.setdefault(text, []).append(i)
        self.texts = sorted(self.ids)
        self.bits: dict[tuple[int, int, int], dict[str, int]] = {}
        where: dict[str, list[tuple[int, int, list | None]]] = {}
        for k, text in enumerate(self.texts):
            if len(text) < least_chars:
                where.setdefault(text, []).append((k, 0, None))
                continue
            bounds = pieces(len(text), int(rate * len(text)) + 1)
            for j, (a, b) in enumerate(bounds):
                where.setdefault(text[a:b], []).append((k, a, enclosing_runs(bounds, j) or [(a, b, 0)]))
        self.automaton = ahocorasick.Automaton()
        for piece, places in where.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def pattern(self, k: int, a: int, b: int) -> dict[str, int]:
        found = self.bits.get((k, a, b))
        if found is None:
            found = self.bits[k, a, b] = {}
            for i, c in enumerate(self.texts[k][a:b]):
                found[c] = found.get(c, 0) | 1 << i
        return found

    def search(self, text: str) -> list[tuple[int, int]]:
        """(item id, smallest distance) of every item within its budget of a stretch of the normal text."""
        if not text or not self.texts:
            return []
        best: dict[int, int] = {}
        done: dict[int, tuple[int, int]] = {}  # each item's last stretch that was checked as a whole
        for end, (n, places) in self.automaton.iter(text):
            for k, a, runs in places:
                start = end + 1 - n - a  # where the item would start
                if best.get(k) == 0 or k in done and done[k][0] <= start <= done[k][1]:
                    continue
                if runs is None:
                    if whole_words(text, start, end + 1):
                        best[k] = 0
                    continue
                for x, y, budget in runs:
                    if y - x == len(self.texts[k]):
                        # all starts within the budget of this one are covered at once
                        done[k] = (start - budget, start + budget)
                        distance = 0 if text.startswith(self.texts[k], start) else myers_search(self.pattern(k, x, y), y - x, text[max(0, start - 2 * budget) : start + y + 2 * budget], budget)
                        if distance is not None:
                            best[k] = min(distance, best.get(k, distance))
                    elif myers_search(self.pattern(k, x, y), y - x, text[max(0, start + x - budget) : start + y + budget], budget) is None:
                        break
        return [(i, d) for k, d in sorted(best.items()) for i in self.ids[self.texts[k]]]


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """Searched items as (id, normal text), in blocks of about block_chars characters; one block at least."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).where("text is not null")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(chars / block_chars))
    for block in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        yield [(r["item"], t) for r in rows if (t := normal_text(r["text"]))]


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE, least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Rows (id, item, distance) of every document and item that it holds within the budget."""
    id_type, item_type = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    item_arrow = to_arrow_type(benchmark.schema[item_col].dataType)
    found = None
    for block in item_blocks(benchmark, item_col, item_text_col, block_chars):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(held.value, rate, least_chars)
            for part, texts in text_batches(batches, text_col):
                hits = [(row, i, d) for row, t in enumerate(texts) for i, d in index.search(normal_text(t))]
                ids = part.column(part.schema.get_field_index(id_col)).take(pa.array([h[0] for h in hits], pa.int64()))
                yield pa.RecordBatch.from_arrays([ids, pa.array([h[1] for h in hits], item_arrow), pa.array([h[2] for h in hits], pa.int32())], [id_col, item_col, "distance"])

        hits = docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {id_type}, {item_col} {item_type}, distance int")
        found = hits if found is None else found.unionByName(hits)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE, least_chars: int = LEAST_CHARS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows, all columns, that hold no item within its budget."""
    for block in item_blocks(benchmark, item_col, item_text_col, block_chars):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            index = ItemIndex(held.value, rate, least_chars)
            for part, texts in text_batches(batches, text_col):
                yield part.filter(pa.array([not index.search(normal_text(t)) for t in texts], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
