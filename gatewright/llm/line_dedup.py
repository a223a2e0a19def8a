"""Line deduplication with DataFrame functions only.

Lines (ends stripped, A-Z lower-cased) are hashed once to 128 bits and the
hashes stored.  They are dealt out by range of (hash, salt) and sorted there by
document and position, so that each run of equal lines streams past in order:
its first row is the first occurrence and its length the number of documents.
Hashes are even, so ranges are cut by rule and need no sampling pass.  The salt
turns the hash's upper bits, so that a line that a third of all documents hold
stands in SALTS ranges; one row of each run goes on, and the second, global step
sees SALTS rows of a line at most.  The answer is a bitmap of kept lines for
each document that loses any, compressed to the runs of its dropped lines; text
is only touched again when a caller asks for it.

Cases: null or empty text is one empty line, which is kept, as are all blank
lines; a line that a document repeats counts once for it, with its first
position; rows that share doc_id and text are one document given twice (each is
returned); rows that share only doc_id are different documents, ordered by a
hash of their text; other columns of the input stay, but for such as are called
n_lines, n_dropped or kept_text, which are replaced; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound, broadcast_if_small, cut, keep, lower_ascii, parallelism, strip_blanks

SALT_BITS = 6
SALTS = 1 << SALT_BITS


def line_key(line: Column) -> Column:
    return strip_blanks(lower_ascii(line))


def hashed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, pos, h1, h2 of each non-blank line."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (
        docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(t).alias("fp"), F.posexplode_outer(F.split(t, "\n")).alias("pos", "line"))
        .select("doc_id", "fp", "pos", line_key(F.col("line")).alias("key"))
        .where(F.col("key") != "")
        .select("doc_id", "fp", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    )


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, n_docs, first (doc_id, fp, pos) of the lines that min_docs documents or more hold."""
    n = parallelism(lines.sparkSession)
    salt = F.pmod(F.xxhash64("doc_id", "fp"), F.lit(SALTS))
    place = F.floor((F.col("turned") / 2.0**64 + 0.5) * n).cast("int")
    run = Window.partitionBy("place", "turned", "h2", "h1").orderBy("doc_id", "fp", "pos")
    same_doc = F.lag("fp").over(run).eqNullSafe(F.col("fp")) & F.lag("doc_id").over(run).eqNullSafe(F.col("doc_id")) & F.lag(F.lit(1)).over(run).isNotNull()
    streamed = (
        lines.withColumn("turned", F.col("h1").bitwiseXOR(F.shiftleft(salt, 64 - SALT_BITS)))
        .withColumn("place", F.least(place, F.lit(n - 1)))
        .repartitionById(n, "place")
        .sortWithinPartitions("place", "turned", "h2", "h1", "doc_id", "fp", "pos")
        .withColumn("new_doc", (~same_doc).cast("bigint"))
    )
    runs = streamed.groupBy("place", "turned", "h2", "h1").agg(F.sum("new_doc").alias("n"), F.min(F.struct("doc_id", "fp", "pos")).alias("first"))
    return (
        runs.groupBy("h1", "h2").agg(F.sum("n").alias("n_docs"), F.min("first").alias("first")).where(F.col("n_docs") >= min_docs)
    )


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_docs: int = 10, keep_first: bool = False) -> DataFrame:
    """doc_id, fp and bitmap of each document that loses lines.

    bitmap: the dropped lines as sorted runs, array<struct<start, n>>; all other
    lines of the document are kept.  keep_first: the first occurrence of a line
    (smallest document, then position) stays, and later ones go.
    """
    lines = keep(hashed_lines(docs, doc_id, text))
    repeated = broadcast_if_small(cut(repeated_lines(lines, min_docs)))
    hit = lines.join(repeated, ["h1", "h2"])
    if keep_first:
        hit = hit.where(F.struct("doc_id", "fp", "pos") != F.col("first"))
    dropped = hit.groupBy("doc_id", "fp").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    starts = F.filter("p", lambda x, i: (i == 0) | (F.get("p", i - 1) != x - 1))
    ends = F.filter("p", lambda x, i: (i == F.size("p") - 1) | (F.get("p", i + 1) != x + 1))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s + 1).alias("n")))
    return dropped.select("doc_id", "fp", runs.alias("bitmap"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with n_lines, n_dropped and kept_text (the kept lines, joined by one line feed)."""
    rows = docs.select(F.struct("*").alias("row"))
    t = F.coalesce(F.col("row")[text], F.lit(""))
    same = F.col("row")[doc_id].eqNullSafe(F.col("doc_id")) & (F.xxhash64(t) == F.col("fp"))
    joined = rows.join(bitmaps.select("doc_id", "fp", "bitmap").hint("shuffle_hash"), same, "left")
    gone = F.flatten(F.transform("bitmap", lambda r: F.sequence(r["start"], r["start"] + r["n"] - 1)))

    def kept(lines: Column) -> Column:
        at = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
        return F.array_join(F.transform(at, lambda i: F.get(lines, i)), "\n")

    untouched = F.col("bitmap").isNull()
    made = {
        "n_lines": (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("bigint"),
        "n_dropped": F.when(untouched, F.lit(0)).otherwise(F.aggregate("bitmap", F.lit(0), lambda a, r: a + r["n"])).cast("bigint"),
        "kept_text": F.when(untouched, t).otherwise(bound(F.split(t, "\n"), kept)),
    }
    # in two steps, as a name of docs may be one used here
    both = joined.select("row", F.struct(*[v.alias(k) for k, v in made.items()]).alias("made"))
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in made], "made.*")
