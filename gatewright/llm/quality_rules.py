"""Quality rules by cross-document line frequency, with DataFrame functions only.

Lines are normalised (ends stripped, A-Z lower-cased) and hashed to 128 bits;
the documents of each host that hold a line are counted.  Lines over the limit
are removed and a document that loses too much of its text is rejected.

Scale: a document emits each of its distinct lines once, counts are combined on
the map side, and the frequent lines come back by broadcast only if they have
been counted to be few (else by a shuffled join, which splits skewed keys).
Text itself never moves.

Cases: a null host is a host of its own; null or empty text has no words and
fails; blank lines are never counted or removed; equal lines of one document
count once for it but are all removed; each input row is a document, also when
rows or ids repeat; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, bound, broadcast_if_small, cut, lower_ascii, strip_blanks

SYMBOLS = "[#*$%&|<>]"
MIN_WORDS = 10
#: A line is boilerplate of its host from so many of its documents on, however many the host has.
LINE_MIN_DOCS = 10
#: A document is depleted if less than this share of its characters outside white space stays.
KEEP_SHARE = 0.3
GRAM = 5


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{BLANK}+"), lambda w: w != "")


def covered_by_repeats(word_hashes: Column, gram: int = GRAM) -> Column:
    """How many words lie in windows of `gram` words that occur twice or more in the array."""

    def grams(h: Column) -> Column:
        return F.when(
            F.size(h) >= gram,
            F.transform(F.sequence(F.lit(0), F.size(h) - gram), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(gram)])),
        ).otherwise(F.expr("cast(array() as array<bigint>)"))

    def count(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))

        def starts(s: Column) -> Column:
            twice = F.filter(
                F.transform(
                    s,
                    lambda x, j: F.when(
                        ((j > 0) & (F.get(s, j - 1)["g"] == x["g"])) | (F.get(s, j + 1)["g"] == x["g"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return F.sort_array(twice)

        def fold(p: Column) -> Column:
            new = F.transform(p, lambda x, j: F.when(j == 0, F.lit(gram)).otherwise(F.least(F.lit(gram), x - F.get(p, j - 1))))
            return F.aggregate(new, F.lit(0).cast("bigint"), lambda a, x: a + x)

        heavy = bound(bound(pairs, starts), fold)
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("bigint")).otherwise(heavy)

    return bound(bound(word_hashes, grams), count)


def base_metrics(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed for each row."""
    t = F.coalesce(F.col(text), F.lit(""))
    with_words = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.withColumns(
            {
                "n_words": F.size(words(t)).cast("bigint"),
                "word_chars": F.length(F.regexp_replace(t, f"{BLANK}+", "")).cast("bigint"),
                "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, f"{SYMBOLS}+", ""))).cast("bigint"),
                "n_dup_lines": bound(with_words, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("bigint")),
                "n_repeat_words": covered_by_repeats(F.transform(words(t), lambda w: F.xxhash64(w))),
            }
        )
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))
    )


def line_keys(text: Column) -> Column:
    """For each distinct non-blank line of a text: its two hashes, how often it stands there and its characters outside white space."""
    keys = F.filter(F.transform(F.split(text, "\n"), lambda x: strip_blanks(lower_ascii(x))), lambda x: x != "")
    return F.transform(
        keys,
        lambda x: F.struct(
            F.xxhash64(x).alias("h1"),
            F.xxhash64(F.lit(1), x).alias("h2"),
            F.length(F.regexp_replace(x, f"{BLANK}+", "")).alias("chars"),
        ),
    )


def cross_document_lines(docs: DataFrame, text: str = "text", host: str = "source", min_docs: int = LINE_MIN_DOCS) -> DataFrame:
    """host, h1, h2, n_docs of the lines over the limit."""
    t = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(host).alias("host"), t.alias("t"))
    lines = base.select("host", F.explode_outer(F.array_distinct(line_keys(F.col("t")))).alias("k")).where("k is not null").select("host", "k.h1", "k.h2")
    return lines.groupBy("host", "h1", "h2").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") >= min_docs)


def quality_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_docs: int = LINE_MIN_DOCS,
    keep_share: float = KEEP_SHARE,
) -> DataFrame:
    """One row for each row of docs: doc_id, the base metrics, removed_chars, depleted, base_failed and kept."""
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("t"), F.col(host).alias("host"))
    frequent = broadcast_if_small(cut(cross_document_lines(docs, "t", "host", min_docs)))
    key = [F.col("doc_id"), F.xxhash64("t").alias("fp"), F.col("host")]
    lines = docs.select(*key, F.explode_outer(line_keys(F.coalesce(F.col("t"), F.lit("")))).alias("k")).where("k is not null").select("doc_id", "fp", "host", "k.*")
    f = frequent.select(F.col("host").alias("host_"), F.col("h1").alias("h1_"), F.col("h2").alias("h2_"))
    lost = lines.join(f, (F.col("h1") == F.col("h1_")) & (F.col("h2") == F.col("h2_")) & F.col("host").eqNullSafe(F.col("host_")))
    each = base_metrics(docs.select(*key, "t"), "t").drop("t")
    gone = lost.select("doc_id", "fp", "host", F.col("chars").cast("bigint").alias("lost"))
    # one aggregation gathers a document's metrics and what it loses; rows that repeat wholly are counted and given back
    metrics = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    both = each.withColumns({"lost": F.lit(0).cast("bigint"), "rows": F.lit(1).cast("bigint")}).unionByName(
        gone.withColumn("rows", F.lit(0).cast("bigint")), allowMissingColumns=True
    )
    summed = both.groupBy("doc_id", "fp", "host").agg(
        *[F.max(m).alias(m) for m in metrics], F.sum("lost").alias("lost"), F.sum("rows").alias("rows")
    )
    removed = (F.col("lost") / F.col("rows")).cast("bigint")
    return (
        summed.withColumn("removed_chars", removed)
        .withColumn("depleted", (F.col("word_chars") > 0) & (F.col("word_chars") - F.col("removed_chars") < keep_share * F.col("word_chars")))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("depleted"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
        .select("doc_id", *metrics[:5], "removed_chars", "depleted", "base_failed", "kept")
    )
