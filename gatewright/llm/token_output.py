"""Token ids in compressed binary segments: an adaptive context-mixing range coder.

Ids are cut into blocks of at most BLOCK that are coded independently, each
from a fresh model and with a CRC-32 of its ids.  Of each id the coder first says
whether it is the one predicted by the last two ids (order 2), else by the last
one (order 1); the odds of these answers mix adaptive counts kept by how often
either prediction was right of late.  Other ids are coded by adaptive counts of
ids (order 0), taken up at steps 0, 1, 2, 4, ... of the block.  A block is split
into lanes of consecutive ids, which share its model and are coded in step, a
range coder for each, so that a step is a few NumPy operations for all lanes.

Where the tokenizer's pattern (SPLIT) never matches across blanks, texts are cut
at spaces and line feeds, SLICE bytes of them at a time, and the library encodes
each different word of a slice, and what else there is, once.

Spark ranges and sorts documents by id, tasks encode segments, and Spark's own
writer stores each segment as one binary value of a Parquet table in the shared
folder, so that retries and lost executors leave no half files.  Reading maps
over segments; the only thing gathered is one number of ids for each partition.

Scale: one shuffle of the texts (by range, for the order); a segment holds about
SEGMENT ids, whatever the length of a document, so a task's memory is bounded
but for the ids of its longest document.

Cases: null or empty text has no ids but the end id; documents without id come
first; rows that share a doc_id stand next to each other, in order of a hash of
their text; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, parallelism

BLOCK, LANES, STEPS, SEGMENT = 1 << 20, 4096, 256, 4_000_000
MAGIC = b"GWT3"
#: Fixed value: the pattern of the tokenizer whose texts may be cut at blanks.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD = 24
_LOW = (1 << _WORD) - 1
_ALL = (1 << 2 * _WORD) - 1
_ANSWER_BITS, _ID_BITS = 16, 20


class _Model:
    """What one block has shown so far; the encoder and the decoder take the same steps."""

    def __init__(self, lanes: int, vocabulary: int):
        self.last = np.zeros(1 << 16, np.int64)  # predicted id and how often it was right of late (0 to 3), by the last id
        self.pair = np.zeros(1 << 18, np.int64)  # the same by the last two
        self.answers = np.full((4, 4, 3), 64, np.int64)  # counts by sureness of order 2 and order 1
        self.counts, self.pending = np.zeros(vocabulary, np.int64), []
        self.one = self.two = np.zeros(lanes, np.int64)
        self.step = 0

    def predict(self) -> None:
        """Predictions of each lane, and the mixed odds of the answers: order 2, order 1, neither; the odds follow the counts every fourth step."""
        self.hash = ((self.two << 16 | self.one) * 0x9E3779B1 >> 16) & (1 << 18) - 1
        a, b = self.pair.take(self.hash), self.last.take(self.one)
        self.p2, self.p1, self.s2, self.s1 = a >> 2, b >> 2, a & 3, b & 3
        self.context = (self.s2 << 2 | self.s1) * 3
        if self.step % 4 and self.step > 4:
            return
        parts = (self.answers, self.answers.sum(axis=0, keepdims=True), self.answers.sum(axis=1, keepdims=True), self.answers.sum(axis=(0, 1), keepdims=True))
        mixed = sum((w * x << 10) // x.sum(axis=2, keepdims=True) for w, x in zip((32, 12, 12, 8), parts, strict=True))
        f = 1 + (mixed * ((1 << _ANSWER_BITS) - 3) >> 16).reshape(16, 3)
        f[:, 2] += (1 << _ANSWER_BITS) - f.sum(axis=1)
        self.size = f.ravel()
        self.start = (np.cumsum(f, axis=1) - f).ravel()

    def fresh(self) -> bool:
        """Counts of order 0 are taken up at steps 0, 1, 2, 4, ... and at multiples of 32."""
        if self.step & (self.step - 1) and self.step % 32:
            return False
        if self.pending:
            self.counts += np.bincount(np.concatenate(self.pending), minlength=len(self.counts))
            self.pending = []
        room = (1 << _ID_BITS) - len(self.counts)
        total = int(self.counts.sum())
        self.id_size = 1 + (self.counts * room // total if total else np.full(len(self.counts), room // len(self.counts)))
        self.id_size[self.counts.argmax()] += (1 << _ID_BITS) - self.id_size.sum()
        self.id_start = np.cumsum(self.id_size) - self.id_size
        return True

    def update(self, ids: np.ndarray, right2: np.ndarray, right1: np.ndarray, slot: np.ndarray, others: np.ndarray) -> None:
        """ids came; whether order 2 and order 1 predicted them, context and answer of each lane, and the ids that neither did."""
        self.answers += 16 * np.bincount(slot, minlength=48).reshape(4, 4, 3) - (self.answers >> 4)
        base = ids << 2
        self.pair[self.hash] = base | np.minimum(self.s2 + 1, 3) * right2
        self.last[self.one] = base | np.minimum(self.s1 + 1, 3) * right1
        if len(others):
            self.pending.append(others)
        self.two, self.one = self.one, ids
        self.step += 1


def _encode_block(ids: np.ndarray) -> bytes:
    """Lanes and steps, vocabulary, words of each lane, words of all lanes."""
    n = len(ids)
    lanes = min(LANES, -(-n // STEPS))
    steps = -(-n // lanes)
    grid = np.zeros(lanes * steps, np.int64)
    grid[:n] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, steps).T)
    m = _Model(lanes, int(ids.max()) + 1)
    width = 2 * steps + 2  # words that a lane can need
    low, span = np.zeros(lanes, np.int64), np.full(lanes, 1 << 2 * _WORD, np.int64)
    words, first = np.zeros(lanes * width, np.int32), np.arange(lanes) * width
    at = first.copy()  # where each lane's next word goes

    def put(lane: np.ndarray | slice, start: np.ndarray, size: np.ndarray, bits: int) -> None:
        part = span[lane] >> bits
        lo, sp = low[lane] + start * part, size * part
        over = np.flatnonzero(lo > _ALL)
        if len(over):
            words[at[lane][over] - 1] += 1  # words that grow too large so are set right at the end
            lo[over] &= _ALL
        out = np.flatnonzero(sp <= _LOW)
        if len(out):
            who = out if isinstance(lane, slice) else lane.take(out)
            ends, place = lo.take(out), at.take(who)
            words[place] = ends >> _WORD
            at[who] = place + 1
            lo[out] = (ends & _LOW) << _WORD
            sp[out] <<= _WORD
        low[lane], span[lane] = lo, sp

    for x in grid:
        m.predict()
        m.fresh()
        right2, right1 = m.p2 == x, m.p1 == x
        slot = m.context + np.where(right2, 0, 2 - right1)
        put(slice(None), m.start.take(slot), m.size.take(slot), _ANSWER_BITS)
        rest = np.flatnonzero(~(right2 | right1))
        others = x.take(rest)
        if len(rest):
            put(rest, m.id_start.take(others), m.id_size.take(others), _ID_BITS)
        m.update(x, right2, right1, slot, others)
    words[at] = (low + _LOW) >> _WORD
    at += 1 - first
    columns = np.ascontiguousarray(words.reshape(lanes, width)[:, : int(at.max())].T)
    for k in range(len(columns) - 1, 0, -1):
        columns[k - 1] += columns[k] >> _WORD
        columns[k] &= _LOW
    used = np.arange(len(columns)) < at[:, None]
    stream = np.ascontiguousarray(columns.T[used]).astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3]
    return struct.pack("<III", lanes, steps, len(m.counts)) + at.astype("<u2").tobytes() + stream.tobytes()


def _decode_block(data: bytes, n: int) -> np.ndarray:
    lanes, steps, vocabulary = struct.unpack_from("<III", data)
    if not (0 < lanes <= LANES and steps <= STEPS and 0 < vocabulary <= 1 << 16 and n <= lanes * steps):
        raise ValueError("not a block of token ids")
    size = np.frombuffer(data, "<u2", lanes, 12).astype(np.int64)
    stream = np.frombuffer(data, np.uint8, int(size.sum()) * 3, 12 + 2 * lanes).reshape(-1, 3).astype(np.int64)
    words = np.zeros((lanes, int(size.max()) + 2), np.int64)
    width = words.shape[1]
    words[np.arange(width) < size[:, None]] = stream[:, 0] | stream[:, 1] << 8 | stream[:, 2] << 16
    ahead = words[:, 0] << _WORD | words[:, 1]  # how far the code is above the lower end
    words, last = words.ravel(), lanes * width - 1
    m, span, at = _Model(lanes, vocabulary), np.full(lanes, 1 << 2 * _WORD, np.int64), np.arange(lanes) * width + 2
    grid = np.zeros((steps, lanes), np.int64)

    def take(lane: np.ndarray | slice, part: np.ndarray, ah: np.ndarray, start: np.ndarray, size: np.ndarray) -> None:
        ah, sp = ah - start * part, size * part
        more = np.flatnonzero(sp <= _LOW)
        if len(more):
            who = more if isinstance(lane, slice) else lane.take(more)
            place = at.take(who)
            ah[more] = ah.take(more) << _WORD | words.take(np.minimum(place, last))
            at[who] = place + 1
            sp[more] <<= _WORD
        ahead[lane], span[lane] = ah, sp

    for t in range(steps):
        m.predict()
        if m.fresh():
            ids_of = np.repeat(np.arange(vocabulary, dtype=np.uint16), m.id_size)
        part = span >> _ANSWER_BITS
        # a float holds the 48 bits of ahead, and its quotient is exact to more than the bits of part
        v = (ahead / part).astype(np.int64)
        slot = m.context + (v >= m.start.take(m.context + 1)) + (v >= m.start.take(m.context + 2))
        take(slice(None), part, ahead, m.start.take(slot), m.size.take(slot))
        x = np.where(slot == m.context, m.p2, m.p1)
        rest = np.flatnonzero(slot == m.context + 2)
        others = x.take(rest)
        if len(rest):
            part, ah = span.take(rest) >> _ID_BITS, ahead.take(rest)
            others = ids_of[np.clip((ah / part).astype(np.int64), 0, (1 << _ID_BITS) - 1)].astype(np.int64)
            take(rest, part, ah, m.id_start.take(others), m.id_size.take(others))
            x[rest] = others
        grid[t] = x
        m.update(x, m.p2 == x, m.p1 == x, slot, others)
    return grid.T.reshape(-1)[:n].astype(np.int32)


def encode_segment(ids: np.ndarray) -> bytes:
    """ids (0 to 65535) as one segment: header, block table (length, CRC-32 of the ids), blocks."""
    if len(ids) and not 0 <= int(ids.min()) <= int(ids.max()) < 1 << 16:
        raise ValueError(f"ids from {ids.min()} to {ids.max()}: the format holds 0 to 65535")
    blocks = [ids[k : k + BLOCK] for k in range(0, len(ids), BLOCK)]
    coded = [_encode_block(b) for b in blocks]
    table = b"".join(struct.pack("<II", len(c), zlib.crc32(b.astype("<u4").tobytes())) for b, c in zip(blocks, coded, strict=True))
    return struct.pack("<4sIII", MAGIC, len(ids), BLOCK, len(blocks)) + table + b"".join(coded)


def decode_segment(data: bytes) -> np.ndarray:
    magic, n, block, blocks = struct.unpack_from("<4sIII", data)
    if magic != MAGIC or block != BLOCK:
        raise ValueError("not a segment of token ids")
    out, at = [np.zeros(0, np.int32)], 16 + 8 * blocks
    for k in range(blocks):
        size, crc = struct.unpack_from("<II", data, 16 + 8 * k)
        try:
            ids = _decode_block(data[at : at + size], min(BLOCK, n - k * BLOCK))
        except (ValueError, IndexError, struct.error) as e:
            raise ValueError(f"block {k} is damaged") from e
        if zlib.crc32(ids.astype("<u4").tobytes()) != crc:
            raise ValueError(f"block {k} is damaged")
        out.append(ids)
        at += size
    return np.concatenate(out)


@lru_cache(maxsize=2)
def tokenizer(name: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


#: So many bytes of text are cut into pieces at a time (a longer document alone).
SLICE = 16 << 20
#: Letters that neither join with what stands beside them nor change in number by lower-casing, then marks without the apostrophe.
_WORD_AND_MARKS = "^(?P<word>[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)(?P<marks>[!-&(-/:-@\\[-`{-~]*)$"


class _Pool:
    """Ids of many strings behind one another: where those of string k start and how many they are."""

    def __init__(self, ids: np.ndarray, size: np.ndarray):
        self.ids, self.size = ids.astype(np.int32, copy=False), size
        self.start = np.cumsum(size) - size

    def take(self, which: np.ndarray) -> np.ndarray:
        """The ids of these strings, in their order."""
        n = self.size[which]
        ends = np.cumsum(n)
        return self.ids[np.repeat(self.start[which] - (ends - n), n) + np.arange(ends[-1] if len(n) else 0)]


class _Encoder:
    """Ids of whole texts."""

    def __init__(self, name: str, end: int):
        self.tokenizer, self.end = tokenizer(name), end
        spec = json.loads(self.tokenizer.to_str())
        kinds = [x["type"] for x in (spec["normalizer"] or {}).get("normalizers", [])]
        first = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
        dropped = first.get("behavior") == "Removed" and first.get("invert") and first["pattern"].get("Regex") == SPLIT
        self.in_pieces = kinds == ["NFC", "Replace", "Lowercase"] and dropped and spec["model"].get("end_of_word_suffix") == "</w>"
        if self.in_pieces:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[k for t, k in vocabulary.items() if t.endswith("</w>")]] = True
            self.bare = bare_words(name)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        ids, lengths = self.all_ids(pa.array(texts, pa.string()))
        return np.split(ids, np.cumsum(lengths)[:-1])

    def all_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of each text's."""
        if self.in_pieces:
            cut = pa.compute.split_pattern(pa.compute.replace_substring(texts, "\n", " "), " ")
            coded = cut.flatten().dictionary_encode()
            which, pool = np.array(coded.indices), self.pieces(coded.dictionary)
            ends = np.concatenate(([0], np.cumsum(pool.size[which])))
            ids, lengths = pool.take(which), np.diff(ends[np.array(cut.offsets) - cut.offsets[0].as_py()])
        else:
            pool = self.whole(texts.to_pylist())
            ids, lengths = pool.ids, pool.size
        return np.insert(ids, np.cumsum(lengths), self.end), lengths + 1

    def pieces(self, pieces: pa.Array) -> _Pool:
        """Ids of each of these different pieces: those of its word and of its marks, or of it as a whole."""
        both = pa.compute.extract_regex(pieces, _WORD_AND_MARKS)
        cut = np.array(both.is_valid())
        word = pa.compute.utf8_lower(both.field("word")).filter(both.is_valid()).dictionary_encode()
        marks = both.field("marks").filter(both.is_valid()).dictionary_encode()
        pools = [self.words(word.dictionary), self.whole(marks.dictionary.to_pylist()), self.whole(pieces.filter(both.is_null()).to_pylist())]
        joined = _Pool(np.concatenate([p.ids for p in pools]), np.concatenate([p.size for p in pools]))
        parts = np.full((len(pieces), 2), len(joined.size))  # the last string of the pool is empty
        parts[cut, 0] = np.array(word.indices)
        parts[cut, 1] = np.array(marks.indices) + len(word.dictionary)
        parts[~cut, 0] = np.arange(len(pieces) - cut.sum()) + len(word.dictionary) + len(marks.dictionary)
        joined = _Pool(joined.ids, np.append(joined.size, 0))
        return _Pool(joined.take(parts.ravel()), joined.size[parts].sum(axis=1))

    def whole(self, texts: list[str]) -> _Pool:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return _Pool(np.array([x for i in ids for x in i], np.int32), np.fromiter(map(len, ids), np.int64, len(ids)))

    def words(self, words: pa.Array) -> _Pool:
        """Each word of letters only has one id that ends a word, its last; so all are encoded as one text."""
        text = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py()
        ids = np.array(self.bare.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(words):
            raise ValueError("a word has no id of its own at its end")
        return _Pool(ids, np.diff(stops, prepend=0))


@lru_cache(maxsize=2)
def bare_words(name: str):
    """The tokenizer for words of lower-case letters with single blanks between: its model, without what changes no such word."""
    from tokenizers import Tokenizer, pre_tokenizers

    bare = Tokenizer(tokenizer(name).model)
    bare.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return bare


def write_segments(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = "word_bpe_49k.json", end: int = 1, segment: int = SEGMENT) -> DataFrame:
    """part, seq, before (ids of the part before the segment), doc_ids, lengths, data: the stored table of segments."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = docs.withColumn("h", F.xxhash64("text")).repartitionByRange(parallelism(docs.sparkSession), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, encode = TaskContext.get().partitionId(), _Encoder(name, end)
        ids: list[np.ndarray] = []
        names: list[pa.Array] = []
        lengths: list[np.ndarray] = []
        held = seq = before = 0

        def flush() -> pa.RecordBatch:
            data = np.concatenate(ids)
            owner = pa.concat_arrays(names)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(owner)], pa.int32()), owner), pa.array([np.concatenate(lengths)], pa.list_(pa.int64())), pa.array([encode_segment(data)], pa.binary())],
                names=["part", "seq", "before", "doc_ids", "lengths", "data"],
            )

        for b in batches:
            size = np.cumsum(np.array(pa.compute.binary_length(b.column("text"))), dtype=np.int64)
            lo = 0
            while lo < b.num_rows:
                hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + SLICE, "right")))
                encoded, n = encode.all_ids(b.column("text").slice(lo, hi - lo))
                ids.append(encoded)
                lengths.append(n)
                names.append(b.column("doc_id").slice(lo, hi - lo))
                held, lo = held + len(encoded), hi
                if held >= segment:
                    yield flush()
                    seq, before, held = seq + 1, before + held, 0
                    ids, names, lengths = [], [], []
        if held:
            yield flush()

    return keep(ordered.select("doc_id", "text").mapInArrow(run, f"part int, seq int, before bigint, doc_ids array<{kind}>, lengths array<bigint>, data binary"))


def read_segments(segments: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, decoded from the segments."""
    ends = segments.groupBy("part").agg(F.max(F.col("before") + F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("n"))
    # one row for each partition
    offsets = ends.withColumn("offset", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint"))).select("part", "offset")
    placed = segments.join(F.broadcast(offsets), "part").select((F.col("offset") + F.col("before")).alias("start"), "doc_ids", "lengths", "data")
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                ids = decode_segment(b.column("data")[k].as_py()).astype("<u4")
                n = np.array(b.column("lengths")[k].values)
                stop = np.cumsum(n)
                crc = [zlib.crc32(ids[e - s : e].tobytes()) for e, s in zip(stop.tolist(), n.tolist(), strict=True)]
                owner = b.column("doc_ids")[k].values
                yield pa.RecordBatch.from_arrays([owner, pa.array(b.column("start")[k].as_py() + stop - n, pa.int64()), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return placed.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
