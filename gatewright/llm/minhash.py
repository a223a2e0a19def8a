"""Near-duplicate documents by banded MinHash with odd sketches.

A document's set is its distinct shingles, as 64-bit hashes.  One pass makes,
for each document, the size and a 128-bit fingerprint of its set, the hashes of
bands of MinHash samples, and an odd sketch: the samples folded into
a bitmap of parities, so that the ones in the XOR of two bitmaps tell how many
samples differ.  Equal sets become a class with one representative; the rest
works on representatives.

Pairs are not enumerated within a band's bucket.  Each bucket picks one pivot by
a hash of its own, so that a document meets a different pivot in each band;
pairs with pivots that pass size and sketch are verified on full sets, and
verified links give components.  What is left in doubt are members of a bucket
outside its largest component.  Semi-joins leave those of them that another
member of the bucket fits by size and sketch, and those that fit them; these
alone take their full sets along into a join whose condition decides on the sets,
so that only links come out of it.  Where more than CROWD members of a bucket are
outside, as of a template whose texts differ too much to be linked, members are
not compared with each other but joined by the rarest shingles of their sets
(prefix_links), which is exact as well.  No link between components that share a
bucket is lost, and a bucket of copies costs a row a member.  Intermediate tables
are kept as Parquet; hot buckets are split by Spark where it sees a skewed join.

Bands and rows follow from the threshold: a pair at it shares no bucket with a
probability of 2e-5 at most (MISS), and the sketch bound rejects it with one below
1e-6.  For 0.85 (op7_minhash) these are 28 bands of 7 samples, missing 2.0e-5; for
0.80 (the pipeline and the default) 36 of 6, missing 1.8e-5.

Cases: null, empty or blank text has an empty set, size 0, and is linked with
nothing; fewer words than a shingle make one shingle of all; a vertex of the
links is a set, whatever the ids, so that different texts of one doc_id or of
none are linked and kept each for itself; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, keep, keep_counted
from .components import connected_components

#: A pair at the threshold shares no bucket with this probability at most; samples that a document has at most for that.
MISS, MOST_SAMPLES, SKETCH_LONGS = 2e-5, 256, 8
#: Buckets of more than one member that are broadcast at most.
BUCKETS_SENT = 100_000
#: Members outside its largest component from which on a bucket's members are joined by prefixes of their sets, not with each other.
CROWD = 64


@cache
def layout(percent: int) -> tuple[int, int]:
    """Bands, and rows of each, for links of this similarity: as many rows as MOST_SAMPLES allow with the bands that keep MISS."""
    s = min(max(percent, 1), 99) / 100
    bands = [math.ceil(math.log(MISS) / math.log1p(-(s**r))) for r in range(1, 17)]
    return next(((b, r) for r, b in reversed(list(enumerate(bands, 1))) if b * r <= MOST_SAMPLES), (bands[0], 1))


@cache
def _random(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors, addends and salts of n samples."""
    rng = np.random.default_rng(20240229)
    mul = rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    return mul, rng.integers(0, 1 << 32, n, dtype=np.uint32), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    from xxhash import xxh3_64_intdigest

    w = (text or "").encode("utf-8").lower().split()  # of bytes: A-Z and ASCII white space only
    if not w:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, w), np.uint64, len(w))
    n = max(len(h) - words + 1, 1)
    acc = np.full(n, len(w) if len(w) < words else words, np.uint64)
    for k in range(min(words, len(h))):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n])
    return np.unique(acc)


def samples(s: np.ndarray, percent: int = 85) -> np.ndarray:
    """The MinHash samples of a set."""
    mul, add, _ = _random(math.prod(layout(percent)))
    h, out = (s >> np.uint64(32)).astype(np.uint32), np.full(len(mul), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 2048):
        np.minimum(out, (h[at : at + 2048, None] * mul + add).min(axis=0), out=out)
    return out


def odd_bits(items: np.ndarray) -> np.ndarray:
    """A bitmap of parities of distinct items."""
    bits = np.bincount(mix(items) % np.uint64(64 * SKETCH_LONGS), minlength=64 * SKETCH_LONGS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def odd_sketch(sample: np.ndarray) -> np.ndarray:
    return odd_bits(sample.astype(np.uint64) + _random(len(sample))[2])


def band_hashes(sample: np.ndarray, percent: int = 85) -> np.ndarray:
    bands, rows = layout(percent)
    acc = np.arange(bands, dtype=np.uint64)
    for k in range(rows):
        acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + sample[k::rows].astype(np.uint64))
    return acc.view(np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """doc_id, fp, n (size), f1 and f2 (fingerprint), bands and sketch of each row."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                n, f1, f2, bands, sketch = [], [], [], [], []
                for t in b.column("text"):
                    s = shingle_set(t.as_py(), words)
                    n.append(len(s))
                    f1.append(int(s.sum(dtype=np.uint64).astype(np.int64)))
                    f2.append(int(mix(s ^ np.uint64(0x5DEECE66D)).sum(dtype=np.uint64).astype(np.int64)))
                    m = samples(s, percent) if len(s) else np.zeros(math.prod(layout(percent)), np.uint32)
                    bands.append(band_hashes(m, percent))
                    sketch.append(odd_sketch(m))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("fp"), pa.array(n, pa.int64()), pa.array(f1, pa.int64()), pa.array(f2, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketch, pa.list_(pa.int64()))],
                    names=["doc_id", "fp", "n", "f1", "f2", "bands", "sketch"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, fp bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>, sketch array<bigint>")


def sets(docs: DataFrame, words: int) -> DataFrame:
    """id, items: the full set of each row of docs (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                items = [shingle_set(t.as_py(), words).view(np.int64) for t in b.column("text")]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(items, pa.list_(pa.int64()))], names=["id", "items"])

    return docs.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, items array<bigint>")


def most_ones(percent: int) -> int:
    """The most ones that the XOR of two sketches has, but for a chance below 1e-6, at this similarity."""
    p, n = 1 - percent / 100, math.prod(layout(percent))
    differ = n * p + 5 * (n * p * (1 - p)) ** 0.5
    size = 64 * SKETCH_LONGS
    ones = size / 2 * (1 - (1 - 2 / size) ** (2 * differ))
    return int(ones + 10)


def ones(x: str, y: str) -> Column:
    return sum((F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k)))) for k in range(SKETCH_LONGS)), F.lit(0))


def with_parity(sets: DataFrame) -> DataFrame:
    """id, parity: the odd sketch of the whole set, not of samples; the ones in the XOR of two are no more than the shingles that only one of the sets has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for b in batches:
                made = [odd_bits(x.values.to_numpy().view(np.uint64)) for x in b.column("items")]
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(made, pa.list_(pa.int64()))], names=["id", "parity"])

    return sets.select("id", "items").mapInArrow(run, f"id {sets.schema['id'].dataType.simpleString()}, parity array<bigint>")


def sizes_fit(percent: int) -> Column:
    return (100 * F.least("n_a", "n_b")) >= percent * F.greatest("n_a", "n_b")


def prefix_links(members: DataFrame, sets: DataFrame, percent: int, linked) -> DataFrame:
    """a, b: components of members (id, component, n, outside) that a link joins, of which one member at least is outside.

    An exact join of sets: shingles in order of rarity among the members, those
    of one member left out, as they cannot meet.  Of a link, the smaller set's
    first shingles meet the larger one's: beyond the first |x| - o + 1 too few are
    left for the overlap o that the sizes ask for.  Where a shingle stands bounds
    the overlap further, and so does the odd sketch of the whole set.  Members that
    share a template but have more of their own than the threshold allows have their
    own shingles first and meet nobody.
    """
    pieces = sets.select("id", F.explode("items").alias("w"))
    common = pieces.groupBy("w").agg(F.count("*").alias("f")).where("f > 1")
    ranked = pieces.join(common, "w").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("f", "w"))).alias("ws"))
    # of sets of sizes x <= y, the overlap is at least percent (x + y) / (100 + percent): so much for y = x, and percent y / 100 for the least x
    small = F.ceil(2 * percent * F.col("n") / F.lit(100 + percent) - 1e-9)
    large = F.ceil(percent * F.col("n") / F.lit(100) - 1e-9)
    placed = ranked.join(members, "id").join(with_parity(sets), "id").withColumns({"own": F.col("n") - F.size("ws"), "short": F.col("n") - small + 1, "long": F.col("n") - large + 1})
    heads = placed.select("id", "component", "n", "outside", "parity", "short", "own", F.posexplode(F.slice("ws", F.lit(1), F.greatest(F.col("long") - F.col("own"), F.lit(0)).cast("int"))).alias("k", "x"))
    heads = keep(heads.select("id", "component", "n", "outside", "parity", F.col("x.w").alias("w"), (F.col("own") + F.col("k")).alias("p"), (F.col("own") + F.col("k") < F.col("short")).alias("as_small")))
    x = heads.where("as_small").select(*[F.col(c).alias(f"{c}_a") for c in ("id", "component", "n", "outside", "parity", "w", "p")])
    y = heads.select(*[F.col(c).alias(f"{c}_b") for c in ("id", "component", "n", "outside", "parity", "w", "p")])
    room = (100 + percent) * F.least(F.col("n_a") - F.col("p_a"), F.col("n_b") - F.col("p_b")) >= percent * (F.col("n_a") + F.col("n_b"))
    meets = (F.col("w_a") == F.col("w_b")) & (F.col("component_a") != F.col("component_b")) & (F.col("n_a") <= F.col("n_b")) & sizes_fit(percent) & room
    meets = meets & ((100 + percent) * ones("parity_a", "parity_b") <= (100 - percent) * (F.col("n_a") + F.col("n_b")))

    def met(one: DataFrame, two: DataFrame) -> DataFrame:
        return one.join(two, meets).select("id_a", "id_b", "component_a", "component_b")

    pairs = met(x.where("outside_a"), y).unionByName(met(x.where("not outside_a"), y.where("outside_b"))).distinct()
    both = pairs.join(sets.toDF("id_a", "i_a"), "id_a").join(sets.toDF("id_b", "i_b"), "id_b")
    return both.where(linked("i_a", "i_b")).select(F.col("component_a").alias("a"), F.col("component_b").alias("b"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_shingles, component_id, fp (of the text) and kept of each row; links are sets with 100 * intersection >= percent * union.

    component_id is the smallest doc_id of the component, null only if all are
    null; of a component the document of smallest (doc_id, fp) is kept, null ids last.
    """
    source = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("fp", F.xxhash64("text"))
    signed = keep(signatures(source, "doc_id", "text", words, percent))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "fp")
    classes = signed.where("n > 0").groupBy("f1", "f2", "n").agg(F.min(first).alias("rep"), F.first(F.struct("bands", "sketch")).alias("mark"))
    # kept once, so that the ids stay
    classes = keep(classes.select(F.monotonically_increasing_id().alias("id"), "f1", "f2", "n", "rep", "mark.bands", "mark.sketch"))
    light = classes.select("id", "n", "sketch")

    # a key holds the number of its band
    placed = classes.select("id", F.explode("bands").alias("key"))
    buckets = placed.groupBy("key").agg(F.count("*").alias("m"), F.min_by("id", F.xxhash64("id", "key")).alias("pivot")).where("m > 1").select("key", "pivot")
    buckets, n_buckets = keep_counted(buckets)
    members = keep(placed.join(F.broadcast(buckets) if n_buckets <= BUCKETS_SENT else buckets, "key"))

    def with_sketches(pairs: DataFrame) -> DataFrame:
        one = pairs.join(light.toDF("a", "n_a", "s_a"), "a")
        two = one.join(light.toDF("b", "n_b", "s_b"), "b")
        return two.where(sizes_fit(percent) & (ones("s_a", "s_b") <= most_ones(percent))).select("a", "b")

    def full_sets(ids: DataFrame) -> DataFrame:
        wanted = classes.select("id", F.col("rep.doc_id").alias("rep_id"), F.col("rep.fp").alias("rep_fp")).join(ids.distinct(), "id")
        wanted, n_wanted = keep_counted(wanted)
        of_rep = F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("fp") == F.col("rep_fp"))
        texts = source.join(F.broadcast(wanted) if n_wanted <= BROADCAST_ROWS else wanted, of_rep).select("id", "text")
        return keep(sets(texts, words).groupBy("id").agg(F.first("items").alias("items")))

    def linked(x: str, y: str) -> Column:
        common = F.size(F.array_intersect(x, y))
        return 100 * common >= percent * (F.size(x) + F.size(y) - common)

    # links with pivots
    pairs = keep(with_sketches(members.where("id <> pivot").select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()))
    full = full_sets(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
    both = pairs.join(full.toDF("a", "i_a"), "a").join(full.toDF("b", "i_b"), "b")
    labels = connected_components(both.where(linked("i_a", "i_b")).select("a", "b"))

    # what is in doubt: members of a bucket outside its largest component, against all others of the bucket
    labelled = members.join(labels, "id", "left").select("key", "id", F.coalesce("component", "id").alias("component"))
    mixed = (
        labelled.groupBy("key", "component").agg(F.count("*").alias("m"))
        .groupBy("key").agg(F.count("*").alias("parts"), F.sum("m").alias("all"), F.max("m").alias("most"), F.max_by("component", F.struct("m", "component")).alias("main"))
        .where("parts > 1").select("key", "main", (F.col("all") - F.col("most") > crowd).alias("crowded"))
    )
    doubtful = keep(labelled.join(mixed, "key").select("key", "id", "component", "main", "crowded").join(light, "id"))
    crowded = keep(doubtful.where("crowded").groupBy("id").agg(F.first("component").alias("component"), F.first("n").alias("n"), F.bool_or(F.col("component") != F.col("main")).alias("outside")))
    doubtful = doubtful.where("not crowded").drop("crowded")

    def side(rows: DataFrame, x: str) -> DataFrame:
        names = {"key": "key", "id": "id", "component": "c", "n": "n", "sketch": "s"}
        return rows.select(*[F.col(c).alias(f"{short}_{x}") for c, short in names.items()], *(["main"] if x == "b" else []))

    fits = (
        (F.col("key_a") == F.col("key_b")) & (F.col("c_a") != F.col("c_b")) & ((F.col("c_b") == F.col("main")) | (F.col("id_a") < F.col("id_b")))
        & sizes_fit(percent) & (ones("s_a", "s_b") <= most_ones(percent))
    )
    outside = doubtful.where("component <> main")
    able = keep(side(outside, "a").join(side(doubtful, "b"), fits, "left_semi"))
    others = keep(side(doubtful, "b").join(able, fits, "left_semi"))
    full = full_sets(able.select(F.col("id_a").alias("id")).union(others.select("id_b"))).join(classes.select("id", "bands"), "id")
    able = able.join(full.toDF("id_a", "i_a", "k_a"), "id_a")
    others = others.join(full.toDF("id_b", "i_b", "k_b"), "id_b")
    # a pair counts in its first common bucket only
    near = able.join(others, fits & (F.get(F.array_intersect("k_a", "k_b"), F.lit(0)) == F.col("key_a")) & linked("i_a", "i_b"))
    joins = near.select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    if crowded.limit(1).count():
        joins = joins.unionByName(prefix_links(crowded, full_sets(crowded.select("id")), percent, linked))
    merged = connected_components(joins).toDF("component", "joined")

    # of a set: its component by pivots, then what that was joined to
    own = classes.select("id", "f1", "f2", "n", "rep").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    own = own.join(merged, "component", "left").select("f1", "f2", "n", "rep", F.coalesce("joined", "component").alias("component"))
    ends = own.groupBy("component").agg(F.min("rep").alias("least"))
    firsts = own.join(ends, "component").select("f1", "f2", "n", "least")
    alone = F.col("least").isNull()
    return signed.select("doc_id", "fp", "n", "f1", "f2").join(firsts, ["f1", "f2", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        "fp",
        (alone | (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("fp") == F.col("least.fp")))).alias("kept"),
    )
