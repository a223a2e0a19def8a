"""The trie of conversation prefixes, with totals of subtrees by time-forward processing.

A node is a distinct sequence of the first d turns (role, text) of some
conversation.  It is named by 128 bits: the exclusive-or, over its turns, of
hashes of position and turn, so that prefixes of a conversation are a running
exclusive-or and the name of a parent is the node's without its last turn.

Totals go up the trie as messages.  The nodes of a task are sorted externally (by
Spark) in reverse level order, deepest first; a node takes all messages for it
off a priority queue that spills sorted runs to disk, adds them up and sends its
total to its parent, whose time comes later.  Shards are subtrees: a node is heavy
if more than `shard` turns of conversations lie below it (each conversation of
its own counted), and the topmost nodes that are not are the roots of shards,
dealt over tasks whole.  Their totals, added up by parent, go to the heavy nodes
on top, which are cut by depth into pieces of `band` levels: a piece is worked off
on its own, then the roots of pieces among each other, then the pieces again with
what comes from below.

Scale: texts move once, to sort the turns by range of (conversation, turn, role,
start of the text), so that a conversation of any length is spread over tasks;
then 128 bits a turn stand for it.  Positions and prefixes inside long
conversations are made in blocks with carries.  Nodes are counted with partial
sums, so that a prefix that many conversations share costs a row a task.  The
heavy nodes are fewer than depth * turns / shard; of roots of pieces there are
`band` times fewer.  Ids of conversations that end at a node are sorted by range,
joined in blocks, and the blocks run through the digest one after the other.

Cases: a null turn comes first, equal turns are in order of role and text, rows
that repeat are turns of their own; null role or text is empty; rows without
conv_id belong to no conversation and are left out; a conversation that is
turnless once rebuilt ends at the root; an empty table has no nodes, not even a
root; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, keep, keep_counted, parallelism

#: Every GROUP conversations share the head of their first one; heads have less than HEADS turns.
GROUP, HEADS = 5, 9
#: Levels of a piece of heavy nodes; turns in a block of a long conversation; characters of a text that ranges are cut by.
BAND, BLOCK, START = 1024, 4096, 64
#: Messages a priority queue holds in memory, and reads of a spilled run at once; ids in a block of the digest.
HELD, READ, IDS = 200_000, 2048, 50_000
_NODE = ("p1", "p2", "depth")


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id, i (from 1), t1, t2 (hashes of role and text) and bytes of each turn; and conv_id, length of each conversation."""
    spark = conversations.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))
    ranges = [*(F.col(c) for c in ("conv_id", "turn", "role")), F.substring("text", 1, START)]
    turns = turns.repartitionByRange(parallelism(spark), *ranges).sortWithinPartitions("conv_id", "turn", "role", "text")
    # places grow along the order; kept once, so that they stay
    placed = keep(turns.select(
        "conv_id", F.monotonically_increasing_id().alias("place"), F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "role", "text").alias("t2"), F.octet_length("text").alias("bytes")
    ))
    placed = placed.withColumn("part", F.shiftrightunsigned("place", 33))
    chunks = keep(placed.groupBy("conv_id", "part").agg(F.min("place").alias("first"), F.count("*").alias("n")))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.select("conv_id", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first") + 1).alias("shift"))
    numbered = placed.join(starts, ["conv_id", "part"]).select("conv_id", (F.col("place") + F.col("shift")).alias("i"), "t1", "t2", "bytes")
    return numbered, chunks.groupBy("conv_id").agg(F.sum("n").alias("length"))


def with_shared_heads(turns: DataFrame, lengths: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """turns and lengths of the rebuilt conversations: the first turns of the group's first one, then the own ones behind as many."""
    c = F.col("conv_id")
    own = lengths.select("conv_id", "length", (c - c % group).alias("base"), (F.crc32(c.cast("string").cast("binary")) % heads).alias("head"))
    of_base = lengths.select(c.alias("base"), F.least("length", F.lit(heads)).alias("base_length"))
    own = own.join(of_base, "base", "left").withColumn("taken", F.least("head", F.coalesce("base_length", F.lit(0))))
    own = keep(own.select("conv_id", "base", "head", "taken", (F.col("taken") + F.greatest(F.col("length") - F.col("head"), F.lit(0))).alias("length")))
    first = turns.where((c % group == 0) & (F.col("i") < heads)).withColumnRenamed("conv_id", "base")
    what = ["conv_id", "length", "pos", "t1", "t2", "bytes"]
    front = own.where("taken > 0").join(first, "base").where("i <= taken").withColumn("pos", F.col("i")).select(*what)
    rest = turns.join(own, "conv_id").where("i > head").withColumn("pos", F.col("i") - F.col("head") + F.col("taken")).select(*what)
    return front.unionByName(rest), own.select("conv_id", "length")


def prefixes(turns: DataFrame, lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """conv_id, length, depth, p1, p2 (the prefix), q1, q2 (its parent) and bytes (of the last text) of each turn of turns (conv_id, length, pos, t1, t2, bytes)."""
    turns = turns.select(
        "conv_id", "length", "pos", "bytes", F.xxhash64("pos", "t1", "t2").alias("m1"), F.xxhash64("t2", "t1", "pos").alias("m2"), F.floor((F.col("pos") - 1) / block).alias("block")
    )
    so_far = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    inside = turns.withColumns({f"x{k}": F.bit_xor(f"m{k}").over(so_far) for k in (1, 2)})
    if not lengths.where(F.col("length") > block).limit(1).count():
        return _named(inside.withColumns({"c1": F.lit(0), "c2": F.lit(0)}))
    whole = turns.where(F.col("length") > block).groupBy("conv_id", "block").agg(F.bit_xor("m1").alias("m1"), F.bit_xor("m2").alias("m2"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = broadcast_if_small(keep(whole.select("conv_id", "block", *[F.bit_xor(f"m{k}").over(before).alias(f"c{k}") for k in (1, 2)]).where("block > 0")))
    return _named(inside.join(carried, ["conv_id", "block"], "left"))


def _named(turns: DataFrame) -> DataFrame:
    for k in (1, 2):
        turns = turns.withColumn(f"p{k}", F.col(f"x{k}").bitwiseXOR(F.coalesce(f"c{k}", F.lit(0)))).withColumn(f"q{k}", F.col(f"p{k}").bitwiseXOR(F.col(f"m{k}")))
    return turns.select("conv_id", "length", F.col("pos").alias("depth"), "p1", "p2", "q1", "q2", "bytes")


class Messages:
    """A priority queue of tuples of six integers that spills what it can't hold to disk, as sorted runs."""

    def __init__(self, held: int = HELD):
        self.held, self.heap, self.runs = held, [], []
        self.record = struct.Struct("<6q")

    def push(self, message: tuple[int, ...]) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.held:
            file = tempfile.TemporaryFile()  # of this task alone, gone when closed
            self.heap.sort()
            for at in range(0, len(self.heap), READ):
                file.write(b"".join([self.record.pack(*m) for m in self.heap[at : at + READ]]))
            file.seek(0)
            self.heap = []
            self._head(self._read(file))

    def _read(self, file) -> Iterator[tuple[int, ...]]:
        with file:
            while data := file.read(READ * self.record.size):
                yield from self.record.iter_unpack(data)

    def _head(self, run: Iterator[tuple[int, ...]]) -> None:
        if (first := next(run, None)) is not None:
            heapq.heappush(self.runs, (first, id(run), run))

    def take(self, key: tuple[int, int, int]) -> Iterator[tuple[int, ...]]:
        """All messages for key, which are taken off; those for earlier keys are dropped, as their nodes are elsewhere."""
        while self.heap and self.heap[0][:3] <= key:
            message = heapq.heappop(self.heap)
            if message[:3] == key:
                yield message
        while self.runs and self.runs[0][0][:3] <= key:
            message, _, run = heapq.heappop(self.runs)
            self._head(run)
            if message[:3] == key:
                yield message


_TOTALS = ("n_children", "n_leaves", "saved_tokens")
_CARRIED = ("p1", "p2", "q1", "q2", "depth", "conv_id", "n_convs", "bytes", "n_ends", "heavy")


def time_forward(nodes: DataFrame, messages: DataFrame | None, tasks: int, by: list[str] | None = None, held: int = HELD, band: int | None = None) -> DataFrame:
    """nodes with n_children, n_leaves and saved_tokens; messages (p1, p2, depth and the three) come from children elsewhere.

    Nodes at multiples of band send nothing.  A node that is not heavy and has no messages is a leaf.  Nodes and messages
    of equal `by` go to one of `tasks`, in which their order is reverse level order.
    """
    rows = nodes.select(*_CARRIED, *(by or []), F.lit(True).alias("node"), *[F.lit(0).cast("bigint").alias(t) for t in _TOTALS])
    if messages is not None:
        rows = rows.unionByName(messages.select(*_NODE, *(by or []), *_TOTALS, F.lit(False).alias("node")), allowMissingColumns=True)
    rows = (rows.repartition(tasks, *by) if by else rows.coalesce(1)).sortWithinPartitions(F.col("depth").desc(), "p1", "p2", "node")
    rows = rows.select(*_CARRIED, "node", *_TOTALS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue, came = Messages(held), (0, 0, 0)
        for b in batches:
            p1, p2, q1, q2, depth, _, n_convs, size, _, heavy, node, *sums = (b.column(k).to_pylist() for k in range(b.num_columns))
            out: tuple[list[int], ...] = ([], [], [])
            for k in range(b.num_rows):
                if not node[k]:  # stands before its node
                    came = tuple(x + s[k] for x, s in zip(came, sums, strict=True))
                    continue
                children, leaves, saved = came
                came = (0, 0, 0)
                for m in queue.take((-depth[k], p1[k], p2[k])):
                    children, leaves, saved = children + m[3], leaves + m[4], saved + m[5]
                leaves += not children and not heavy[k]
                saved += (n_convs[k] - 1) * size[k]
                for o, x in zip(out, (children, leaves, saved), strict=True):
                    o.append(x)
                if depth[k] % band if band else depth[k]:
                    queue.push((1 - depth[k], q1[k], q2[k], 1, leaves, saved))
            rest = b.select(list(_CARRIED)).filter(b.column("node"))
            yield pa.RecordBatch.from_arrays([*rest.columns, *[pa.array(o, pa.int64()) for o in out]], names=[*_CARRIED, *_TOTALS])

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    return rows.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in (*_CARRIED, *_TOTALS)))


def to_parents(done: DataFrame) -> DataFrame:
    """Messages from the nodes of done to their parents, added up."""
    up = done.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), (F.col("depth") - 1).alias("depth"), "n_leaves", "saved_tokens")
    return up.groupBy(*_NODE).agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))


def digests(ends: DataFrame, ids: int = IDS) -> DataFrame:
    """p1, p2, ends_sha256: the digest of the ids, ascending and joined, of the conversations that end at each node (p1, p2, conv_id)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, held[0], ",".join(map(str, held)))], names=["p1", "p2", "first", "piece"])

        for b in batches:
            ready = []
            for p1, p2, c in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                if held and ((p1, p2) != key or len(held) >= ids):
                    ready.append(piece())
                    held = []
                key = (p1, p2)
                held.append(c)
            if ready:
                yield from pa.Table.from_batches(ready).combine_chunks().to_batches()
        if held:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for b in batches:
            done = []
            for p1, p2, text in zip(*(b.column(c).to_pylist() for c in ("p1", "p2", "piece")), strict=True):
                if (p1, p2) == key:
                    state.update(b",")
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (p1, p2), hashlib.sha256()
                state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done, strict=True)], names=["p1", "p2", "ends_sha256"])
        if key:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*key, state.hexdigest())], names=["p1", "p2", "ends_sha256"])

    tasks, order = parallelism(ends.sparkSession), ["p1", "p2", "conv_id"]
    kind = ends.schema["conv_id"].dataType.simpleString()
    pieces = ends.select(*order).repartitionByRange(tasks, *order).sortWithinPartitions(*order).mapInArrow(blocks, f"p1 bigint, p2 bigint, first {kind}, piece string")
    return pieces.repartition(tasks, "p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(digest, "p1 bigint, p2 bigint, ends_sha256 string")


def prefix_trie(turns: DataFrame, lengths: DataFrame, shard: int | None = None, band: int = BAND, block: int = BLOCK, held: int = HELD) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256 of each node.

    turns has conv_id, length, pos (from 1), t1, t2 (hashes of a turn), bytes (of its text); lengths has conv_id and length, 0 for a turnless one.
    """
    tasks = parallelism(turns.sparkSession)
    rows, n_rows = keep_counted(prefixes(turns, lengths, block))
    if shard is None:
        shard = max(n_rows // (4 * tasks), 1)
    nodes = rows.groupBy(*_NODE).agg(
        F.first("q1").alias("q1"), F.first("q2").alias("q2"), F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("bytes").alias("bytes"),
        F.count_if(F.col("depth") == F.col("length")).alias("n_ends"), (F.sum(F.col("length") - F.col("depth")) > shard).alias("heavy"),
    )
    zero = F.lit(0).cast("bigint")
    root = lengths.groupBy().agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if(F.col("length") == 0).alias("n_ends")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in (*_NODE, "q1", "q2")], "conv_id", "n_convs", F.lit(0).alias("bytes"), "n_ends", F.lit(True).alias("heavy"))
    nodes = keep(nodes.unionByName(root))

    # a shard is named by the first node on its conversations' way that is not heavy
    heavy = keep(nodes.where("heavy"))
    marks = broadcast_if_small(heavy.select("p1", "p2", F.lit(True).alias("is_heavy")))
    light_rows = rows.join(marks, ["p1", "p2"], "left").where("is_heavy is null")
    tops = light_rows.groupBy("conv_id").agg(F.min_by(F.struct("p1", "p2"), "depth").alias("top"))
    light = nodes.where("not heavy").join(tops, "conv_id").withColumns({"s1": F.col("top.p1"), "s2": F.col("top.p2")})
    shards = keep(time_forward(light, None, tasks, ["s1", "s2"], held))
    from_shards = keep(to_parents(shards.join(marks.toDF("q1", "q2", "is_heavy"), ["q1", "q2"], "left_semi")))

    # heavy nodes: of a piece's node, the node at its conversation's last depth that is a multiple of band
    deepest = heavy.agg(F.max("depth")).first()[0] or 0
    if deepest < band:
        top = time_forward(heavy, from_shards, 1, None, held)
    else:
        cut = rows.where(F.col("depth") % band == 0).select("conv_id", (F.col("depth") / band).cast("bigint").alias("level"), F.col("p1").alias("s1"), F.col("p2").alias("s2"))
        level = F.floor(F.col("depth") / band)
        pieces = heavy.withColumn("level", level).join(cut, ["conv_id", "level"], "left").withColumns({s: F.coalesce(s, zero) for s in ("s1", "s2")})
        pieces = keep(pieces)

        def with_piece(messages: DataFrame) -> DataFrame:
            return messages.join(pieces.select("p1", "p2", "s1", "s2"), ["p1", "p2"])

        alone = time_forward(pieces, with_piece(from_shards), tasks, ["s1", "s2"], held, band).where(F.col("depth") % band == 0)
        # among roots of pieces: one level a piece, the parent is the root of the parent's piece
        over = pieces.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("s1").alias("r1"), F.col("s2").alias("r2"))
        alone = keep(alone.join(over, ["q1", "q2"], "left"))
        ends = alone.select(
            "p1", "p2", F.coalesce("r1", zero).alias("q1"), F.coalesce("r2", zero).alias("q2"), (F.col("depth") / band).cast("bigint").alias("depth"), "conv_id", F.lit(1).cast("bigint").alias("n_convs"), "bytes", "n_ends", "heavy"
        )
        own = alone.select("p1", "p2", (F.col("depth") / band).cast("bigint").alias("depth"), *_TOTALS)
        joined = time_forward(ends, own, 1, None, held).select("p1", "p2", "n_leaves", "saved_tokens")
        roots = alone.drop("n_leaves", "saved_tokens").join(joined, ["p1", "p2"]).where("depth > 0")
        both = from_shards.unionByName(to_parents(roots))
        top = time_forward(pieces, with_piece(both), tasks, ["s1", "s2"], held, band)

    last = rows.where(F.col("depth") == F.col("length")).select("p1", "p2", "conv_id")
    turnless = lengths.where("length = 0").select(zero.alias("p1"), zero.alias("p2"), "conv_id")
    ended = digests(last.unionByName(turnless))
    parents = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    whole = shards.unionByName(top).join(ended, ["p1", "p2"], "left").join(parents, ["q1", "q2", "depth"], "left")
    leaves = F.when(F.col("n_children") == 0, F.lit(1).cast("bigint")).otherwise(F.col("n_leaves"))  # a root without turns below is one
    return whole.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", leaves.alias("n_leaves"), "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")
    )


def conversation_trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS, **sizes: int) -> DataFrame:
    """The trie of the conversations rebuilt with shared heads (`with_shared_heads`)."""
    return prefix_trie(*with_shared_heads(*numbered_turns(conversations), group, heads), **sizes)
