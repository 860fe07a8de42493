"""Byte-pair encoding and decoding with a prefix-sharing trie traversal.

The pre-tokenizer cuts a text into pieces.  Distinct pieces that a worker has not
met yet are visited in sorted order, which is the depth-first order of their
trie: a stack holds, for every prefix on the path from the root, the last token
of that prefix's encoding, and two pieces share the stack up to their longest
common prefix, so a shared prefix is encoded once.  The state of a prefix follows
from earlier states: its last token is the vocabulary entry that ends there and
that may follow the last token of the remaining prefix, where two tokens may
follow each other if merging their concatenated bytes gives back the two.  A piece's ids
are read by walking back along the last tokens.  A piece for which no last token
is found falls back to plain merging.

Null text encodes as empty text: no ids.  Very long texts are encoded in chunks
of pieces.  Rows are independent, so ties and repeated rows need no rule.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import text_batches

#: Characters of text whose new pieces share one trie; pieces encoded at once; encoded pieces and judged pairs that a task keeps.
TRIE_CHARS = 2_000_000
CHUNK_PIECES = 200_000
CACHE_PIECES = 250_000
CACHE_PAIRS = 400_000

PIECES = r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"


def byte_letters() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairCoder:
    """Vocabulary and merge ranks of one worker, and the caches of its task."""

    def __init__(self, spec: dict):
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        self.ids = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            self.ranks[raw(a), raw(b)] = rank
        self.bytes_of = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}
        self.longest = max(map(len, self.ids))
        self.sizes = {i: len(t) for i, t in self.bytes_of.items()}
        self.packed = {i: i.to_bytes(4, "little") for i in self.bytes_of}
        self.follows: dict[int, bool] = {}
        self.cache: dict[str, bytes] = {}
        import regex

        self.find = regex.compile(PIECES)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Plain merging, lowest rank first, leftmost first among equals."""
        parts = [word[i : i + 1] for i in range(len(word))]
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = ranks.get((parts[i], parts[i + 1]))
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ids[p] for p in parts]

    def _judge(self, a: int, b: int) -> bool:
        """Whether token b may follow token a; a of -1 stands for the start of a piece."""
        before = self.bytes_of[a] if a >= 0 else b""
        return self.merge(before + self.bytes_of[b]) == ([a, b] if a >= 0 else [b])

    def traverse(self, words: Iterable[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct words as little-endian 32-bit integers, by the depth-first traversal of their trie."""
        ids, longest, follows, sizes, packed = self.ids.get, self.longest, self.follows, self.sizes, self.packed
        last: list[int] = [-1]  # last[i]: last token of the current prefix of length i
        before, out = b"", {}
        for word in sorted(words):
            top, same = min(len(before), len(word), len(last) - 1), 0
            while same < top and before[same] == word[same]:
                same += 1
            del last[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                state = -1
                for start in range(end - longest if end > longest else 0, end):
                    token = ids(word[start:end])
                    if token is None:
                        continue
                    pair = (last[start] + 1) << 20 | token
                    fits = follows.get(pair)
                    if fits is None:
                        if len(follows) > CACHE_PAIRS:
                            follows.clear()
                        fits = follows[pair] = self._judge(last[start], token)
                    if fits:
                        state = token
                        break
                if state < 0:
                    break
                last.append(state)
            before = word
            if len(last) <= len(word):
                out[word] = b"".join([packed[t] for t in self.merge(word)])
                continue
            found, at = [], len(word)
            while at:
                token = last[at]
                found.append(packed[token])
                at -= sizes[token]
            found.reverse()
            out[word] = b"".join(found)
        return out

    def forget(self) -> None:
        """Let the caches go, so that an idle worker holds little."""
        self.cache, self.follows = {}, {}

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces that are not in the cache."""
        cache = self.cache
        if len(cache) > CACHE_PIECES:
            cache.clear()
        new = set(pieces).difference(cache)
        if new:
            encoded = self.traverse({p.encode() for p in new})
            cache.update((p, encoded[p.encode()]) for p in new)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; the new pieces of all texts that fit one chunk share one trie."""
        held, new = [], set()
        for text in texts:
            if len(text) < 4 * CHUNK_PIECES and not any(s in text for s in self.special):
                pieces = self.find.findall(text)
                new.update(pieces)
                held.append(pieces)
            else:
                held.append(None)
        self.learn(new)
        return [self._encode_parts(text) if pieces is None else self.join(pieces) for text, pieces in zip(texts, held)]

    def _encode_parts(self, text: str) -> bytes:
        """A text with special tokens, or one so long that its pieces come in chunks."""
        out = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part].to_bytes(4, "little"))
                continue
            found = (m.group() for m in self.find.finditer(part))
            while pieces := list(islice(found, CHUNK_PIECES)):
                out.append(self.join(pieces))
        return b"".join(out)

    def join(self, pieces: list[str]) -> bytes:
        get = self.cache.__getitem__
        try:
            return b"".join(map(get, pieces))
        except KeyError:  # a piece of a later chunk, or one that the cache has let go
            self.learn(pieces)
            return b"".join(map(get, pieces))

    def decode(self, ids: bytes) -> str:
        """Text of ids; bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I").tolist())).decode("utf-8", "replace")


_CODERS: dict[str, BytePairCoder] = {}


def coder(path: str) -> BytePairCoder:
    """This worker's coder for a tokenizer file."""
    if path not in _CODERS:
        with open(path) as f:
            _CODERS[path] = BytePairCoder(json.load(f))
    return _CODERS[path]


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """One row per document: id, n_tokens, ids_sha256, decoded_sha256; with keep_ids also ids and decoded.

    tokenizer: path of a byte-level BPE file, on every executor at the same place.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(tokenizer)
        try:
            for part, texts in text_batches(batches, text_col, TRIE_CHARS):
                n, ids_sha, text_sha, all_ids, decoded = [], [], [], [], []
                for ids in own.encode_batch([text or "" for text in texts]):
                    back = own.decode(ids)
                    n.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    text_sha.append(hashlib.sha256(back.encode()).hexdigest())
                    if keep_ids:
                        all_ids.append(memoryview(ids).cast("I").tolist())
                        decoded.append(back)
                arrays = [part.column(part.schema.get_field_index(id_col)), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    arrays += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names)
        finally:
            own.forget()

    more = ", ids array<int>, decoded string" if keep_ids else ""
    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
