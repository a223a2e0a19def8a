"""Benchmark decontamination by a prefix-filtered join, with DataFrame functions only.

A benchmark item is cut into windows of `window` consecutive words.  A document
holds a window only if it holds each of its words, so that one word is the
whole necessary prefix: the rarest one, by counts over all documents.  The
windows that share such an anchor are joined as one stretch of the item; words
of documents meet the anchors, length and position bounds drop those whose
window cannot fit, and the words around decide exactly.

Scale: document words are exploded and probed inside one stage and never
shuffled; only hits and a row for each document are.  Anchors are broadcast
after they have been counted; more than `block` of them go in blocks by their
number, each against all documents, so the size of a broadcast is bounded for any
benchmark.  What is done for an item grows with its words, not with their square.
A passage that a third of all documents hold costs a few rows a document.

Cases: a null or empty text, or one without words, is a document without words
and never contaminated; an item without words or
without id is ignored; an item of fewer than
`window` words is one window; equal items all count; rows that share doc_id and
text come back as often as they were given; rows that share only doc_id are
different documents; empty tables: no documents, no rows; no items, no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bound, broadcast_if_small, cut, lower_ascii

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10


def padded_words(text: Column) -> Column:
    """The words with an empty string before them, and one behind them if the text does not end in a word."""
    return F.split(F.concat(F.lit(" "), lower_ascii(F.coalesce(text, F.lit("")))), NOT_WORD)


def size_of(padded: Column) -> Column:
    return F.size(padded) - 1 - F.when((F.size(padded) > 1) & (F.element_at(padded, -1) == ""), 1).otherwise(0)


def items_of(benchmark: DataFrame, item_id: str, text: str) -> DataFrame:
    """item_id and its words."""
    words = F.filter(padded_words(F.col("t")), lambda w: w != "")
    return benchmark.select(F.col(item_id).alias("item_id"), F.col(text).alias("t")).select("item_id", words.alias("w")).where(F.size("w") > 0)


def word_counts(docs: DataFrame, items: DataFrame) -> DataFrame:
    """How often each word of the items stands in the documents."""
    vocabulary = broadcast_if_small(cut(items.select(F.explode("w").alias("word")).distinct()))
    stream = docs.select(F.explode_outer(padded_words(F.col("t"))).alias("word"))
    return vocabulary.join(stream.join(vocabulary, "word").groupBy("word").agg(F.count("*").alias("n")), "word", "left").fillna(0, ["n"])


def anchors(items: DataFrame, counts: DataFrame, window: int) -> DataFrame:
    """word, item_id, stretch (words of the item), at (of the anchor in it), length (of a window)."""
    items = items.withColumn("row", F.monotonically_increasing_id())
    placed = items.select("item_id", "row", F.posexplode("w").alias("a", "word")).join(counts, "word")
    # the words of an item in order, each with its rank by rarity; a row holds one word until here, and one item from here on
    rank = F.struct("n", "word", "a").alias("rank")
    per_item = placed.groupBy("item_id", "row").agg(F.sort_array(F.collect_list(F.struct("a", rank))).alias("ranks")).withColumn("length", F.least(F.size("ranks"), F.lit(window)))
    ranks, length = F.col("ranks"), F.col("length")

    def lowest(start: Column) -> Column:
        return F.array_min(F.transform(F.slice(ranks, start + 1, length), lambda x: x["rank"]))["a"]

    # a word is the anchor of the windows from the last rarer or equally rare word before it to the next rarer one
    starts = F.transform(F.sequence(F.lit(0), F.size(ranks) - length), lambda s: F.struct(s.alias("s"), lowest(s).alias("a")))

    def heads(x: Column) -> Column:
        return F.filter(x, lambda h, i: (i == 0) | (F.get(x, i - 1)["a"] != h["a"]))

    def stretches(x: Column) -> Column:
        def one(h: Column, i: Column) -> Column:
            stop = F.coalesce(F.get(x, i + 1)["s"], F.size(ranks) - length + 1) - 1 + length
            words = F.transform(F.slice(ranks, h["s"] + 1, stop - h["s"]), lambda y: y["rank"]["word"])
            return F.struct(F.get(ranks, h["a"])["rank"]["word"].alias("word"), words.alias("stretch"), (h["a"] - h["s"]).alias("at"))

        return F.transform(x, one)

    found = per_item.select("item_id", "length", F.explode(bound(bound(starts, heads), stretches)).alias("x"))
    return found.select("x.word", "item_id", "x.stretch", "x.at", "length")


def hits(docs: DataFrame, anchor_rows: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, fp, n_words, item_id, lo, hi: the words lo..hi of a document stand in windows of an item.

    Each document also has a row without item.
    """
    spark = docs.sparkSession
    mark = spark.range(1).select(
        F.lit("").alias("word"),
        F.lit(None).cast(anchor_rows.schema["item_id"].dataType).alias("item_id"),
        F.lit(None).cast("array<string>").alias("stretch"),
        F.lit(None).cast("int").alias("at"),
        F.lit(None).cast("int").alias("length"),
    )
    stream = (
        docs.select("doc_id", "fp", padded_words(F.col("t")).alias("w"))
        .withColumn("n_words", size_of(F.col("w")))
        .select("doc_id", "fp", "n_words", "w", F.posexplode_outer("w").alias("p", "word"))
    )
    m = F.size("stretch")
    # w has one empty string in front: word k of the stretch stands at p - at + k; a window must fit between the ends
    room = (F.least(F.col("p") - 1, F.col("at")) + F.least(F.col("n_words") - F.col("p") + 1, m - F.col("at"))) >= F.col("length")

    def extent(step: int) -> Column:
        """How many words in a row agree, going from the anchor by step; spelled out, so that the join stays in generated code."""
        off = [
            ~F.get("w", F.col("p") + step * k).eqNullSafe(F.get("stretch", F.col("at") + step * k)) | F.get("stretch", F.col("at") + step * k).isNull()
            for k in range(1, window)
        ]
        found = F.lit(window - 1)
        for k in reversed(range(1, window)):
            found = F.when(off[k - 1], F.lit(k - 1)).otherwise(found)
        return found

    left, right = extent(-1), extent(1)
    found = stream.join(
        F.broadcast(anchor_rows.unionByName(mark)).withColumnRenamed("word", "anchor"),
        (F.col("word") == F.col("anchor")) & ((F.col("item_id").isNull() & (F.col("p") == 0)) | (F.col("item_id").isNotNull() & room & (left + right + 1 >= F.col("length")))),
    )
    return found.select(
        "doc_id", "fp", F.col("n_words").cast("bigint").alias("n_words"), "item_id",
        (F.col("p") - 1 - left).alias("lo"), (F.col("p") - 1 + right).alias("hi"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BROADCAST_ROWS
) -> DataFrame:
    """doc_id, fp (hash of the text), n_words, n_hit, items (sorted strings) and spans (array of first and last word)."""
    d = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("fp"), F.col(text).alias("t"))
    items = cut(items_of(benchmark, item_id, item_text).withColumn("item_id", F.col("item_id").cast("string")).where("item_id is not null"))
    table = cut(anchors(items, word_counts(d, items), window).withColumn("nr", F.monotonically_increasing_id()))
    blocks = max(1, -(-table.count() // block))
    found = None
    for b in range(blocks):
        part = hits(d, table.where(F.pmod("nr", F.lit(blocks)) == b).drop("nr"), window)  # by number: a word of many anchors is split too
        found = part if found is None else found.unionByName(part)
    per_doc = found.groupBy("doc_id", "fp").agg(
        F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set("item_id")).alias("items"),
        F.sort_array(F.collect_set(F.when(F.col("item_id").isNotNull(), F.struct("lo", "hi")))).alias("spans"),
        F.count_if(F.col("item_id").isNull()).alias("marks"),  # one a row and block
    )
    # spans come by their first word: each adds what lies beyond the furthest last word so far
    walked = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-1).alias("end")),
        lambda a, x: F.struct(
            (a["n"] + F.greatest(F.lit(0), x["hi"] - F.greatest(x["lo"] - 1, a["end"]))).cast("bigint").alias("n"),
            F.greatest(a["end"], x["hi"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    once = per_doc.select("doc_id", "fp", "n_words", walked.alias("n_hit"), "items", "spans", "marks")
    return once.select("*", F.explode(F.array_repeat(F.lit(0), (F.col("marks") / blocks).cast("int"))).alias("copy")).drop("marks", "copy")
