"""Five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns the columns of documents; the last returns the encoded corpus.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.llm.bpe import round_trip
from gatewright.llm.common import checkpoint_folder, cut
from gatewright.llm.decontaminate import decontaminate
from gatewright.llm.line_dedup import apply_bitmaps, keep_bitmaps
from gatewright.llm.minhash import near_duplicates
from gatewright.llm.toxicity import score, train

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a toxicity of 0.5 or more go."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model, keep=COLUMNS).where("score < 0.5").select(*COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of ten documents or more stay in their first one; a document that loses all its lines so goes."""
    kept = apply_bitmaps(docs.select(*COLUMNS), keep_bitmaps(docs, min_docs=10, keep_first=True))
    kept = kept.where((F.col("n_dropped") == 0) | (F.trim("kept_text") != ""))
    changed = F.col("n_dropped") > 0
    return kept.withColumns(
        {"text": F.when(changed, F.col("kept_text")).otherwise(F.col("text")), "n_chars": F.when(changed, F.length("kept_text").cast("bigint")).otherwise(F.col("n_chars"))}
    ).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of smallest (id, text), those without id last.

    Rows of one id (or none) are told apart by their texts; of rows that repeat wholly one stays, blank ones all do.
    """
    docs = docs.select(*COLUMNS)
    found = near_duplicates(docs, words=5, percent=80).where("kept")
    blank = (F.col("n_shingles") == 0).alias("blank")
    kept = cut(found.groupBy(F.col("doc_id").alias("kept_id"), F.col("fp").alias("kept_fp"), blank).agg(F.count("*").alias("copies")))
    same = docs["doc_id"].eqNullSafe(F.col("kept_id")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("kept_fp"))
    if not kept.where("copies > 1 and not blank").limit(1).count():
        return docs.join(kept.hint("shuffle_hash"), same, "left_semi").select(*COLUMNS)
    rows = docs.join(kept.hint("shuffle_hash"), same)
    own = F.when(F.col("blank"), F.monotonically_increasing_id())
    return rows.withColumn("own", own).dropDuplicates(["kept_id", "kept_fp", "own"]).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item, or a shorter item whole, go."""
    docs = docs.select(*COLUMNS)
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("n_hit > 0")
    found = found.select(F.col("doc_id").alias("hit_id"), F.col("fp").alias("hit_fp"))
    same = docs["doc_id"].eqNullSafe(F.col("hit_id")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("hit_fp"))
    return docs.join(found.hint("shuffle_hash"), same, "left_anti").select(*COLUMNS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ids of each document."""
    return round_trip(docs, with_ids=True)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("bpe", bpe)]

#: A fitted model decides the first stage, which SQL cannot express; a test compares run() with plain Python through all five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    folder = checkpoint_folder(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
