"""Byte-level BPE encoding and decoding as a reduction over a tree.

A piece of text is halved until a half is a token; the encodings of two halves
are joined by re-encoding a window of tokens around the seam.  A sequence of
tokens is the encoding of its bytes exactly if each pair of neighbours is the
encoding of its own bytes, so a window is done as soon as its outer tokens form
such pairs with the tokens outside it; else it grows by a token on that side.
Decoding concatenates byte strings up a tree.

Scale: a map over rows, no shuffle; memory is a batch of texts, the ids of a few
megabytes of them, a cache of encoded pieces of fixed size and the rank table, which each worker reads from
the installed tokenizer files.

Cases: a null text is an empty one (no ids); texts are never cut, a piece of
any length takes time in proportion to its length; repeated rows and ids are
kept as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_slices

RANKS = "byte_bpe_50k.tiktoken"
#: Pieces, parts and pairs (of each so many) that a task remembers; it forgets them at its end, as workers live on.
CACHE = 300_000
LEAF = 2048
#: Parts of so many bytes are remembered; data of more bytes is merged by a heap.
PART, SHORT = 8, 48


class Encoder:
    """Encodes pieces by a table of ranks; pattern splits a text into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None):
        import regex

        self.ranks = ranks
        self.bytes_of = dict(zip(ranks.values(), ranks.keys(), strict=True))
        self.split = regex.compile(pattern).findall if pattern else None
        self.pairs: dict[tuple[int, int], tuple[int, ...]] = {}
        self.parts: dict[bytes, list[int]] = {}
        self.text_of = {r: str(r) for r in ranks.values()}
        self.pieces: dict[str, tuple[tuple[int, ...], str]] = {}

    def merge(self, data: bytes) -> list[int]:
        """The definition, for short data: merge the adjacent pair of lowest rank, leftmost first, until none is left."""
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        if len(data) > SHORT:
            return self.merge_by_heap(data)
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min(((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1)))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [ranks[p] for p in parts]

    def merge_by_heap(self, data: bytes) -> list[int]:
        """merge() in time n log n: a heap of candidate pairs over a linked list of parts."""
        rank_of, n = self.ranks.get, len(data)
        end = list(range(1, n + 1))  # a part runs from its place to end[place]; 0 marks a part merged into its left neighbour
        before = list(range(-1, n - 1))
        heap = [(r, i) for i in range(n - 1) if (r := rank_of(data[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            r, i = heappop(heap)
            j = end[i]
            if not j or j >= n or rank_of(data[i : end[j]]) != r:
                continue
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
                if (r := rank_of(data[i : end[end[i]]])) is not None:
                    heappush(heap, (r, i))
            if (k := before[i]) >= 0 and (r := rank_of(data[k : end[i]])) is not None:
                heappush(heap, (r, k))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[data[i : end[i]]])
            i = end[i]
        return out

    def pair(self, a: int, b: int) -> tuple[int, ...]:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= CACHE:
                self.pairs.clear()
            got = self.pairs[a, b] = tuple(self.merge(self.bytes_of[a] + self.bytes_of[b]))
        return got

    def join(self, left: list[int], right: list[int]) -> list[int]:
        i, j = 1, 1
        window = self.pair(left[-1], right[0])
        if len(window) == 2 and window[0] == left[-1] and window[1] == right[0]:
            return left + right
        while True:
            grow_left = i < len(left) and self.pair(left[-i - 1], window[0]) != (left[-i - 1], window[0])
            grow_right = j < len(right) and self.pair(window[-1], right[j]) != (window[-1], right[j])
            if not grow_left and not grow_right:
                return [*left[: len(left) - i], *window, *right[j:]]
            i, j = min(len(left), i + i * grow_left), min(len(right), j + j * grow_right)
            of = self.bytes_of
            window = self.merge(b"".join([of[t] for t in left[len(left) - i :]] + [of[t] for t in right[:j]]))

    def tree(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        half = len(data) // 2
        if len(data) > PART:
            return self.join(self.tree(data[:half]), self.tree(data[half:]))
        got = self.parts.get(data)
        if got is None:
            if len(self.parts) >= CACHE:
                self.parts.clear()
            got = self.parts[data] = self.join(self.tree(data[:half]), self.tree(data[half:]))
        return got

    def piece(self, text: str) -> tuple[tuple[int, ...], str]:
        got = self.pieces.get(text)
        if got is None:
            ids = tuple(self.tree(text.encode("utf-8")))
            got = (ids, " ".join([self.text_of[t] for t in ids]))
            if len(text) <= 64:
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[text] = got
        return got

    def forget(self) -> None:
        """Drop what was remembered, and give memory back, as the worker goes on to other stages; results do not depend on it."""
        for memory in (self.pairs, self.parts, self.pieces):
            memory.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> list[tuple[tuple[int, ...], str]]:
        """For each piece its ids, and the same as decimal text."""
        if not text:
            return []
        known, piece = self.pieces.get, self.piece
        return [known(p) or piece(p) for p in self.split(text)]

    def decode(self, ids: list[int]) -> bytes:
        of = self.bytes_of
        level = [b"".join([of[t] for t in ids[k : k + LEAF]]) for k in range(0, len(ids), LEAF)]
        while len(level) > 1:
            level = [b"".join(level[k : k + 2]) for k in range(0, len(level), 2)]
        return level[0] if level else b""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


@lru_cache(maxsize=2)
def encoder(name: str) -> Encoder:
    """The encoder of an installed rank file, once in a worker."""
    import public_tokenizers

    return Encoder(read_ranks(public_tokenizers.path(name)), public_tokenizers.PATTERN)


def encode_column(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS) -> DataFrame:
    """doc_id, ids: the tokens of each whole text."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks)
        for b in (part for batch in batches for part in byte_slices(batch, "text")):
            ids = [list(chain.from_iterable(p[0] for p in e.encode(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])
        e.forget()

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_column(encoded: DataFrame, ranks: str = RANKS) -> DataFrame:
    """doc_id, data: the bytes of each row's ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks)
        for b in batches:
            data = [e.decode(ids or []) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, data binary")


def round_trip(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", ranks: str = RANKS, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with_ids, ids of each row: encode, digest, decode and digest in one pass."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(ranks)
        for b in (part for batch in batches for part in byte_slices(batch, "text")):
            n, ids_hash, data_hash, kept = [], [], [], []
            for t in b.column("text"):
                pieces = e.encode(t.as_py())
                ids = list(chain.from_iterable([p[0] for p in pieces]))
                n.append(len(ids))
                kept.append(ids if with_ids else None)
                ids_hash.append(hashlib.sha256(" ".join([p[1] for p in pieces]).encode()).hexdigest())
                data_hash.append(hashlib.sha256(e.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(data_hash, pa.string()), pa.array(kept, pa.list_(pa.int32()))],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"],
            )
        e.forget()

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = docs.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, ids array<int>")
    return out if with_ids else out.drop("ids")
