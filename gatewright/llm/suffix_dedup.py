"""Removal of long repeated substrings by longest previous factors.

A byte goes if it lies in a string of LENGTH bytes that also starts earlier.
The longest previous factor of a suffix is the longest beginning it shares with
one that starts earlier; in suffix order that is one of two, the nearest before
and the nearest behind it that start earlier (previous and next smaller
position).  Where the factor has LENGTH bytes or more, LENGTH bytes go.  So
suffix order is only needed up to LENGTH bytes, and only between suffixes that
can share so many.

Suffixes are dealt out by the smallest hash of the GRAM-byte strings in their
first LENGTH bytes (the anchor), which suffixes that share these bytes share.
Consecutive suffixes of a document with one anchor form a run.  A run equal to an
earlier one (128 bits of anchor and content hash) goes whole.  A run that is the
first of its kind goes on only if its anchor has other kinds of runs too; then
its bytes are fetched, the suffixes of an anchor are sorted by their first LENGTH
bytes, and their factors follow from previous and next smaller positions and the
common beginnings of neighbours.

Scale: about one row for 35 bytes is shuffled, once; texts are shuffled twice
(to fetch bytes, to remove ranges).  Equal runs within an Arrow batch are
combined before the shuffle.  Anchors that a sample of documents shows to be
frequent are split by the run's hash in the first step; the sample steers this
split alone, never the result.  In the second step the runs left of every anchor
are counted: one of HOT_RUNS or more is split into its suffixes, dealt by a hash
of their bytes, combined within Arrow batches, and sorted by Spark, so that they
stream past their neighbours.  No task holds more than HOT_RUNS runs of an anchor.

Cases: null is empty; texts below LENGTH bytes keep all; rows that share doc_id
and text are one document (each row is returned); rows that share only doc_id
are different documents, in order of a hash of their text; documents without id
come first; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, keep, parallelism, with_variant

LENGTH, GRAM, SALTS, HOT_SAMPLE = 100, 32, 64, 64
#: An anchor of so many rows in the sample (1 / HOT_SAMPLE of the documents) is split in the first step, and one of so many runs left in the second.
HOT_ROWS, HOT_RUNS = 300, 1000
#: Bytes that are hashed at a time, and suffixes of a run at most.
CHUNK, RUN = 1 << 20, 128
U = np.uint64
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 1 << 16, dtype=U)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def gram_hashes(data: np.ndarray, length: int) -> dict[int, np.ndarray]:
    """For each power of two up to length: the hashes of all strings of so many bytes."""
    two = data.astype(np.uint16)
    h = {1: _TABLE[data], 2: _TABLE[(two[:-1] << np.uint16(8)) | two[1:]]}
    k = 2
    while 2 * k <= length:
        a = h[k]
        x = a[:-k] * U(0x9E3779B97F4A7C15)
        x += a[k:]
        x ^= x >> U(29)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(32)
        h[2 * k] = x
        k *= 2
    return h


def suffix_hashes(h: dict[int, np.ndarray], n: int, length: int) -> np.ndarray:
    """Hashes of the strings of `length` bytes that start at 0..n-1."""
    acc, at, k = np.zeros(n, U), 0, max(h)
    while at < length:
        while k > length - at:
            k //= 2
        acc = mix(acc * U(0xD6E8FEB86659FD93) + h[k][at : at + n])
        at += k
    return acc


def row_hashes(strings: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes."""
    n, length = strings.shape
    words = np.zeros((n, -(-length // 8) * 8), np.uint8)
    words[:, :length] = strings
    acc = np.zeros(n, U)
    for column in words.view(U).T:
        acc = mix(acc * U(0xD6E8FEB86659FD93) + column)
    return acc


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    k = 1
    while 2 * k <= width:
        x = np.minimum(x[:-k], x[k:])
        k *= 2
    return np.minimum(x[: -(width - k)], x[width - k :]) if width > k else x


def runs_of(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """start, number of suffixes, anchor and content hash of each run of a text, and whether equal suffixes may stand in it."""
    h = gram_hashes(data, length)
    n = len(data) - length + 1
    suffix = suffix_hashes(h, n, length)
    anchor = sliding_min(h[gram], length - gram + 1)[:n]
    start = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    size = np.diff(np.append(start, n))
    if size.max() > RUN:  # periodic text: a long run is cut in pieces
        pieces = -(-size // RUN)
        first = np.repeat(start, pieces)
        k = np.arange(len(first)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        size = np.minimum(RUN, np.repeat(size, pieces) - k * RUN)
        start = first + k * RUN
    kind = mix(suffix[start] * U(7) + mix(suffix[start + size // 2] * U(5) + mix(suffix[start + size - 1] * U(3) + size.astype(U))))
    # equal suffixes of one run hold its anchor at two places; the first and the last suffix of a run see all places
    v, width = anchor[start], np.arange(length - gram + 1)
    head, tail = h[gram][start[:, None] + width] == v[:, None], h[gram][(start + size - 1)[:, None] + width] == v[:, None]
    twice = (size > len(width)) | (head.sum(axis=1) > 1) | (tail.sum(axis=1) > 1) | (start + head.argmax(axis=1) != start + size - 1 + tail.argmax(axis=1))
    return start, size, v, kind, twice


def all_runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """v (anchor), r (kind), doc_id, variant, p, w; twice: suffixes may repeat in the run; later: an earlier equal run stands in the same batch."""
    kind_of_id = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                out: list[tuple[np.ndarray, ...]] = []
                for row, t in enumerate(b.column("text")):
                    data = np.frombuffer(t.as_py().encode("utf-8"), np.uint8)
                    for at in range(0, len(data) - length + 1, CHUNK):
                        p, w, v, r, twice = runs_of(data[at : at + CHUNK + length - 1], length, gram)
                        out.append((np.full(len(p), row), p + at, w, v, r, twice))
                if not out:
                    continue
                row, p, w, v, r, twice = (np.concatenate(x) for x in zip(*out, strict=True))
                ids, variants = b.column("doc_id"), b.column("variant")
                rank = np.array(pa.compute.rank(pa.chunked_array([ids]), sort_keys="ascending", null_placement="at_start", tiebreaker="dense"))
                order = np.unique(np.stack((rank.astype(np.int64), np.array(variants))), axis=1, return_inverse=True)[1].ravel()[row]
                o = np.lexsort((p, order, r, v))
                same = (v[o][1:] == v[o][:-1]) & (r[o][1:] == r[o][:-1])
                head = np.concatenate(([True], ~same))
                first = o[np.maximum.accumulate(np.where(head, np.arange(len(o)), 0))]
                later = np.zeros(len(o), bool)
                later[o] = (order[first] != order[o]) | (p[first] != p[o])
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.view(np.int64)), pa.array(r.view(np.int64)), ids.take(take), variants.take(take), pa.array(p.astype(np.int32)), pa.array(w.astype(np.int32)), pa.array(twice), pa.array(later)],
                    names=["v", "r", "doc_id", "variant", "p", "w", "twice", "later"],
                )

    return docs.mapInArrow(run, f"v bigint, r bigint, doc_id {kind_of_id.simpleString()}, variant bigint, p int, w int, twice boolean, later boolean")


def fetch(docs: DataFrame, length: int) -> DataFrame:
    """v, salt, doc_id, variant, p, w, data, later of the runs in the column wanted.

    A run of a hot anchor comes as a row for each suffix, its salt above 0 and by
    its bytes; later: an earlier equal one stands in the same batch (no data).
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in (part.slice(lo, 1000) for part in batches for lo in range(0, part.num_rows, 1000)):
                rows, v, p, w, hot, data = [], [], [], [], [], []
                for row, (t, wanted) in enumerate(zip(b.column("text"), b.column("wanted"), strict=True)):
                    text = t.as_py().encode("utf-8")
                    for x in wanted.as_py():
                        rows.append(row), v.append(x["v"]), p.append(x["p"]), w.append(x["w"]), hot.append(x["hot"])
                        data.append(text[x["p"] : x["p"] + x["w"] + length - 1])
                if not rows:
                    continue
                rows, v, p, w, hot = np.array(rows), np.array(v, np.int64), np.array(p), np.array(w), np.array(hot)
                salt, later, out = np.zeros(len(rows), np.int64), np.zeros(len(rows), bool), pa.array(data, pa.binary())
                if hot.any():
                    k = np.flatnonzero(hot)
                    owner, off, strings = suffixes([data[i] for i in k], w[k], length)
                    owner = k[owner]
                    h = row_hashes(strings)
                    ids, variants = b.column("doc_id"), np.array(b.column("variant"))
                    rank = np.array(pa.compute.rank(pa.chunked_array([ids]), sort_keys="ascending", null_placement="at_start", tiebreaker="dense"))
                    at = p[owner] + off
                    o = np.lexsort((at, variants[rows[owner]], rank[rows[owner]], h, v[owner]))
                    same = np.concatenate(([False], (h[o][1:] == h[o][:-1]) & (v[owner][o][1:] == v[owner][o][:-1])))
                    again = np.zeros(len(o), bool)
                    again[o] = same
                    # rows of documents that are given twice: the same place is no earlier one
                    first = o[np.maximum.accumulate(np.where(same, 0, np.arange(len(o))))]
                    place = np.zeros(len(o), bool)
                    place[o] = (rank[rows[owner]][o] != rank[rows[owner]][first]) | (variants[rows[owner]][o] != variants[rows[owner]][first]) | (at[o] != at[first])
                    bytes_of = pa.FixedSizeBinaryArray.from_buffers(pa.binary(length), len(strings), [None, pa.py_buffer(np.ascontiguousarray(strings))]).cast(pa.binary())
                    again &= place
                    calm = np.flatnonzero(~hot)
                    out = pa.concat_arrays([out.take(pa.array(calm)), pa.compute.if_else(pa.array(again), pa.scalar(None, pa.binary()), bytes_of)])
                    salt = np.concatenate((salt[calm], (h >> U(33)).astype(np.int64) + 1))
                    later = np.concatenate((later[calm], again))
                    rows, v, p, w = (np.concatenate((x[calm], y)) for x, y in ((rows, rows[owner]), (v, v[owner]), (p, at), (w, np.ones(len(owner), w.dtype))))
                take = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v), pa.array(salt), b.column("doc_id").take(take), b.column("variant").take(take), pa.array(p.astype(np.int32)), pa.array(w.astype(np.int32)), out, pa.array(later)],
                    names=["v", "salt", "doc_id", "variant", "p", "w", "data", "later"],
                )

    return docs.mapInArrow(run, f"v bigint, salt bigint, doc_id {kind}, variant bigint, p int, w int, data binary, later boolean")


def suffixes(data: list[bytes], w: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each suffix of the runs: its run, its place in it and its first `length` bytes."""
    owner = np.repeat(np.arange(len(w)), w)
    off = np.arange(len(owner)) - np.repeat(np.cumsum(w) - w, w)
    size = w + length - 1
    buffer = np.frombuffer(b"".join(data), np.uint8)
    return owner, off, np.lib.stride_tricks.sliding_window_view(buffer, length)[(np.cumsum(size) - size)[owner] + off]


def nearest_earlier(position: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each place in suffix order, the bytes shared with the nearest one before it whose position is smaller (0 if there is none).

    common: the bytes that each shares with the one just before it.  Pointers
    skip what starts later, all places at once, so that ways halve in each round.
    """
    to, least = np.arange(len(position)) - 1, common.copy()
    moving = np.flatnonzero(to >= 0)
    while len(moving := moving[position[to[moving]] > position[moving]]):
        over = to[moving]
        far, smaller = to[over], np.minimum(least[moving], least[over])
        to[moving], least[moving] = far, smaller
        moving = moving[far >= 0]
    return np.where(to >= 0, least, 0)


def previous_factors(group: np.ndarray, strings: np.ndarray) -> np.ndarray:
    """The longest previous factor of each suffix among those of its group, up to the length of the strings; suffixes come in order of position."""
    n, length = strings.shape
    keys = np.empty((n, 8 + length), np.uint8)
    keys[:, :8] = group.astype(">u8").view(np.uint8).reshape(n, 8)
    keys[:, 8:] = strings
    order = np.argsort(keys.view(f"S{8 + length}").ravel(), kind="stable")  # suffix order, ties by position
    keys = keys[order]
    differ = keys[1:] != keys[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), 8 + length) - 8
    common = np.maximum(np.concatenate(([0], common)), 0)  # 0 between groups
    before = nearest_earlier(order, common)
    behind = nearest_earlier(order[::-1], np.concatenate(([0], common[:0:-1])))[::-1]
    out = np.empty(n, np.int64)
    out[order] = np.maximum(before, behind)
    return out


def mark(sorted_runs: DataFrame, length: int) -> DataFrame:
    """doc_id, variant, p, w of the suffixes whose previous factor has `length` bytes; the input is sorted by v, salt, bytes of a hot suffix, doc_id, variant, p."""
    kind = sorted_runs.schema["doc_id"].dataType.simpleString()
    columns = ("doc_id", "variant", "p", "w")

    def marked(t: pa.Table, witness: int) -> pa.RecordBatch:
        """witness: so many first rows only stand for what came before."""
        pc = pa.compute
        if len(t) > 1:  # rows of documents that are given twice stand side by side
            same = pa.array(np.ones(len(t) - 1, bool))
            for c in ("v", "salt", "doc_id", "variant", "p"):
                a, b = t.column(c).combine_chunks().slice(0, len(t) - 1), t.column(c).combine_chunks().slice(1)
                same = pc.and_(same, pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b))))
            t = t.filter(pa.concat_arrays([pa.array([True]), pc.invert(same)]))
        w = np.array(t.column("w"))
        owner, off, strings = suffixes(t.column("data").to_pylist(), w, length)
        v, salt = np.array(t.column("v")), np.array(t.column("salt"))
        group = np.cumsum(np.concatenate(([0], (v[1:] != v[:-1]) | (salt[1:] != salt[:-1]))))[owner]
        seen = np.flatnonzero(previous_factors(group, strings) >= length)
        seen = seen[owner[seen] >= witness]
        if not len(seen):
            return pa.RecordBatch.from_arrays([t.column(c).combine_chunks().slice(0, 0) for c in columns], names=columns)
        new = np.concatenate(([True], (np.diff(seen) != 1) | (np.diff(owner[seen]) != 0)))
        first, size = seen[new], np.diff(np.append(np.flatnonzero(new), len(seen)))
        take = pa.array(owner[first])
        p = np.array(t.column("p"))[owner[first]] + off[first]
        return pa.RecordBatch.from_arrays(
            [t.column("doc_id").combine_chunks().take(take), t.column("variant").combine_chunks().take(take), pa.array(p.astype(np.int32)), pa.array(size.astype(np.int32))],
            names=columns,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # of the group that may go on: all its runs, or the last suffix of a hot one
        witness = 0
        with np.errstate(over="ignore"):
            for b in batches:
                for lo in range(0, b.num_rows, 4096):
                    part = b.slice(lo, 4096)
                    v, s = np.array(part.column("v")), np.array(part.column("salt"))
                    if s[-1]:
                        yield marked(pa.Table.from_batches([*held, part]), witness)
                        held, witness = [part.slice(len(v) - 1)], 1
                        continue
                    other = np.flatnonzero((v != v[-1]) | (s != s[-1]))
                    cut_at = int(other[-1]) + 1 if len(other) else 0
                    if cut_at or (held and (held[-1].column("v")[-1].as_py() != v[0] or held[-1].column("salt")[-1].as_py() != s[0])):
                        whole = [*held, part.slice(0, cut_at)] if cut_at else held
                        yield marked(pa.Table.from_batches(whole), witness)
                        held, witness = [], 0
                    held.append(part.slice(cut_at))
            if held:
                yield marked(pa.Table.from_batches(held), witness)

    return sorted_runs.mapInArrow(run, f"doc_id {kind}, variant bigint, p int, w int")


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_runs: int = HOT_RUNS) -> DataFrame:
    """doc_id, variant, p, w: the suffixes p .. p+w-1 have an equal beginning of `length` bytes before them; docs: doc_id, variant, text."""
    n = parallelism(docs.sparkSession)
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(HOT_SAMPLE)) == 0)
    split = cut(all_runs(sample, length, gram).groupBy("v").count().where(F.col("count") >= HOT_ROWS).orderBy(F.desc("count")).select("v", F.lit(True).alias("split")).limit(10_000))
    runs = all_runs(docs, length, gram).join(F.broadcast(split), "v", "left")
    salt = F.when(F.col("later"), F.pmod(F.xxhash64("doc_id", "p"), F.lit(SALTS)) + SALTS + 1).when(F.col("split"), F.pmod(F.col("r"), F.lit(SALTS)) + 1).otherwise(0)
    dealt = runs.withColumn("salt", salt.cast("int")).repartition(n, "v", "salt")
    by_kind = Window.partitionBy("v", "salt", "r").orderBy("doc_id", "variant", "p")
    by_anchor = Window.partitionBy("v", "salt")
    seen = dealt.withColumn("rank", F.rank().over(by_kind)).withColumn("kinds", F.min("r").over(by_anchor) != F.max("r").over(by_anchor))
    gone = F.col("later") | (F.col("rank") > 1)
    seen = keep(
        seen.select("doc_id", "variant", "p", "w", "v", gone.alias("gone"), F.coalesce("split", F.lit(False)).alias("split"), "kinds", "twice")
        .where(F.col("gone") | F.col("kinds") | F.col("split") | F.col("twice"))
        .drop("kinds", "split", "twice")
    )
    firsts = seen.where(~F.col("gone")).drop("gone")
    hot = cut(firsts.groupBy("v").count().where(F.col("count") >= hot_runs).select(F.col("v").alias("hot_v")))
    firsts = firsts.join(broadcast_if_small(hot), F.col("v") == F.col("hot_v"), "left").withColumn("hot", F.col("hot_v").isNotNull())
    wanted = firsts.groupBy("doc_id", "variant").agg(F.collect_set(F.struct("p", "w", "v", "hot")).alias("wanted"))
    wanted = wanted.withColumnsRenamed({"doc_id": "id_", "variant": "variant_"})
    with_text = docs.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("variant") == F.col("variant_")))
    fetched = keep(fetch(with_text.select("doc_id", "variant", "text", "wanted"), length))
    again = fetched.where("later").select("doc_id", "variant", "p", "w")
    dealt = fetched.where("not later").drop("later").withColumn("hot_data", F.when(F.col("salt") > 0, F.col("data")))
    marks = mark(dealt.repartition(n, "v", "salt").sortWithinPartitions("v", "salt", "hot_data", "doc_id", "variant", "p").drop("hot_data"), length)
    return seen.where("gone").select("doc_id", "variant", "p", "w").unionByName(again).unionByName(keep(marks))


def remove_ranges(docs: DataFrame, ranges: DataFrame, length: int, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, bytes) of each row of docs."""
    per_doc = ranges.groupBy("doc_id", "variant").agg(F.collect_list(F.struct("p", "w")).alias("ranges"))
    per_doc = per_doc.withColumnsRenamed({"doc_id": "id_", "variant": "variant_"})
    joined = docs.join(per_doc.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("variant") == F.col("variant_")), "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t, r in zip(b.column("text"), b.column("ranges"), strict=True):
                data = t.as_py().encode("utf-8")
                removed = spans = end = 0
                kept = []
                if r.is_valid:
                    x = r.values
                    p = np.array(x.field("p")).astype(np.int64)
                    stop = p + np.array(x.field("w")) + length - 1
                    o = np.argsort(p, kind="stable")
                    far = np.maximum.accumulate(stop[o])
                    new = np.concatenate(([True], p[o][1:] > far[:-1]))
                    starts, stops = p[o][new], far[np.append(np.flatnonzero(new)[1:] - 1, len(far) - 1)]
                    spans, removed = len(starts), int((stops - starts).sum())
                    for s, e in zip(starts.tolist(), stops.tolist(), strict=True):
                        kept.append(data[end:s])
                        end = e
                kept.append(data[end:])
                left = b"".join(kept)
                rows.append((len(data), removed, spans, hashlib.sha256(left).hexdigest(), left if with_text else None))
            n, gone, spans, digest, left = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()), pa.array(digest, pa.string()), pa.array(left, pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    out = joined.select("doc_id", "text", "ranges").mapInArrow(run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary")
    return out if with_text else out.drop("kept")


def suffix_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM, with_text: bool = False) -> DataFrame:
    """One row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, with_text, the kept bytes."""
    named = with_variant(docs, doc_id, text)
    return remove_ranges(named, repeated_ranges(named, length, gram), length, with_text)
