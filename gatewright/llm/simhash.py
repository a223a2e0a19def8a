"""Near-duplicates by SimHash, compared exactly in tiles.

A text's fingerprint has a bit set where more than half of the hashes of its
shingles, repeats included, have it set.  Equal fingerprints become one; the
rest works on distinct ones.  Each is put into the cell of its population
counts: those of its PARTS equal parts.  The counts of one part differ by no
more than the bits that differ in it, so fingerprints within the radius lie in
cells whose counts differ by no more than the radius in sum; all other pairs of
cells are skipped.  A cell is cut into tiles of about TILE fingerprints.  Each
pair of tiles that is left is compared whole, by exclusive-or and bit counts of
numpy, and gives no more links than join what it found connected: a forest over
the two tiles, not all its pairs.  Components of these links are those of all
links within the radius.

Scale: one map over the texts; then 8 bytes a distinct fingerprint.  A tile goes
to each cell near its own (21 with itself at 4 parts and radius 2, half of the
41), so a pair of cells meets once.  Tiles are small, so that a crowded cell
becomes many pairs of tiles, which Spark deals over tasks.  The share of pairs
compared falls with the parts; their number follows the count of distinct
fingerprints (`parts_for`) and has no influence on the result.

Cases: a null, empty or blank text has the fingerprint zero and is linked like
any other; fewer words than a shingle make one shingle of all; rows of one id
with different texts are rows of their own, each with its component; the
smallest id of a component ignores null ids and is null only if all are;
an empty table gives an empty result; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, keep, keep_counted
from .components import connected_components

WORDS, SEED, RADIUS = 3, 42, 2
BITS = 64
#: Fingerprints in a tile, about; hashes counted, and pairs compared, at once.
TILE, BLOCK, PAIRS = 1024, 8192, 1 << 16


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z and ASCII white space only
    if not w:
        return 0
    n, counts = max(len(w) - words + 1, 1), np.zeros(BITS, np.int64)
    for at in range(0, n, BLOCK):
        h = [xxh64_intdigest(b" ".join(w[k : k + words]), seed) for k in range(at, min(at + BLOCK, n))]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, fp of each row."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(t.as_py(), words, seed) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], names=["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint")


def parts_for(distinct: int) -> int:
    """Parts to count: more of them skip more pairs and make more cells, each of which has more neighbours."""
    return 4 if distinct <= 1 << 24 else 8


def part_counts(fp: Column, parts: int) -> Column:
    width = BITS // parts
    return F.array(*[F.bit_count(F.shiftrightunsigned(fp, k * width).bitwiseAND(F.lit((1 << width) - 1 if parts > 1 else -1))) for k in range(parts)])


def cell(counts: Column, parts: int, width: int) -> Column:
    """A number for a cell: its counts as digits."""
    return sum((F.get(counts, F.lit(k)).cast("bigint") * (width + 1) ** k for k in range(parts)), F.lit(0).cast("bigint"))


def steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of counts within the radius: none, and one of each pair of opposites."""
    found = [()]
    for _ in range(parts):
        found = [(*s, d) for s in found for d in range(-radius, radius + 1) if sum(map(abs, s)) + abs(d) <= radius]
    return [s for s in found if s >= (0,) * parts]


def forest(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> list[tuple[int, int]]:
    """Links within the radius between two tiles (or within one), as many as connect what they connect."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = x = parent.get(up, up)
        return x

    links: list[tuple[int, int]] = []
    most = len(a) - 1 if same else len(a) + len(b) - 1
    rows = max(PAIRS // max(len(b), 1), 1)
    for at in range(0, len(a), rows):
        i, j = np.nonzero(np.bitwise_count(a[at : at + rows, None] ^ b) <= radius)
        if same:
            later = j > i + at
            i, j = i[later], j[later]
        for x, y in zip(a[at + i].tolist(), b[j].tolist(), strict=True):
            p, q = top(x), top(y)
            if p != q:
                parent[q] = p
                links.append((x, y))
                if len(links) == most:
                    return links
    return links


def tile_links(pairs: DataFrame, radius: int) -> DataFrame:
    """a, b: links of each row of pairs (left, right: fingerprints; same: whether they are one tile)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, same = (batch.column(c) for c in ("left", "right", "same"))
            found: list[tuple[int, int]] = []
            for k in range(batch.num_rows):
                found += forest(left[k].values.to_numpy().view(np.uint64), right[k].values.to_numpy().view(np.uint64), radius, same[k].as_py())
            a, b = np.array(found, np.uint64).reshape(-1, 2).T.astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return pairs.mapInArrow(run, "a bigint, b bigint")


def links_within(prints: DataFrame, radius: int = RADIUS, tile: int = TILE, parts: int = 4) -> DataFrame:
    """a, b: links between rows of prints (distinct fp) that connect what all links within the radius connect."""
    width = BITS // parts
    placed = prints.select("fp", part_counts(F.col("fp"), parts).alias("counts")).withColumn("cell", cell(F.col("counts"), parts, width))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("n"), F.first("counts").alias("counts"))
    sizes = keep(sizes.select("cell", "counts", F.ceil(F.col("n") / tile).alias("tiles")))
    crowded = broadcast_if_small(keep(sizes.where("tiles > 1").select("cell", "tiles")))
    dealt = placed.select("fp", "cell").join(crowded, "cell", "left").withColumn("tile", F.coalesce(F.pmod(F.xxhash64("fp"), "tiles"), F.lit(0)))
    tiles = dealt.groupBy("cell", "tile").agg(F.collect_list("fp").alias("fps"))
    tiles = keep(tiles)

    # cells that stand near each other and both exist; a step and its opposite count once
    moves = F.explode(F.array(*[F.array(*[F.lit(d) for d in s]) for s in steps(parts, radius)]))
    moved = sizes.select("cell", "counts", moves.alias("step")).select("cell", F.zip_with("counts", "step", lambda c, d: c + d).alias("counts"))
    inside = moved.where(F.forall("counts", lambda c: (c >= 0) & (c <= width)))
    near = inside.select("cell", cell(F.col("counts"), parts, width).alias("other")).join(sizes.select(F.col("cell").alias("other")), "other", "left_semi")
    near = broadcast_if_small(keep(near))
    one = tiles.select("cell", F.col("tile").alias("t1"), F.col("fps").alias("left")).join(near, "cell")
    two = tiles.select(F.col("cell").alias("other"), F.col("tile").alias("t2"), F.col("fps").alias("right"))
    pairs = one.join(two, "other").where((F.col("cell") != F.col("other")) | (F.col("t1") <= F.col("t2")))
    same = ((F.col("cell") == F.col("other")) & (F.col("t1") == F.col("t2"))).alias("same")
    return tile_links(pairs.select("left", "right", same), radius)


def simhash_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, seed: int = SEED, radius: int = RADIUS, tile: int = TILE, parts: int | None = None
) -> DataFrame:
    """doc_id, fp and component_id of each row: the smallest id reachable by fingerprints of at most `radius` differing bits."""
    marked = keep(fingerprints(docs, doc_id, text, words, seed))
    prints, distinct = keep_counted(marked.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    labels = connected_components(links_within(prints.select("fp"), radius, tile, parts or parts_for(distinct)))
    grouped = prints.join(labels.withColumnRenamed("id", "fp"), "fp", "left")
    ends = grouped.where("component is not null").groupBy("component").agg(F.min("least").alias("end"))
    # fingerprints of one row without links need no look-up
    shared = grouped.join(ends, "component", "left").where("n > 1 or component is not null")
    shared = broadcast_if_small(keep(shared.select("fp", F.coalesce("end", "least").alias("end"), F.lit(True).alias("shared"))))
    return marked.join(shared, "fp", "left").select("doc_id", "fp", F.when(F.col("shared"), F.col("end")).otherwise(F.col("doc_id")).alias("component_id"))
