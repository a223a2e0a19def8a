"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A table is broadcast only after its rows have been counted and are no more than this.
BROADCAST_ROWS = 200_000

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BLANK, BLANKS = r"[\x20\x09-\x0D]", " \t\n\x0b\x0c\r"
#: Characters beyond ASCII that lower-casing changes, and those the Java version may not know yet.
OTHER_CAPITALS = r"[\x{80}-\x{10FFFF}&&[\p{Lu}\p{Lt}\p{IsUppercase}\p{Cn}]]"


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or what the context was given.

    Without either, a session in local mode gets a temporary folder of its
    machine; on a cluster executors would not share one, so that is an error.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not sc.getCheckpointDir():
        if not folder and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return folder or sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and go on from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def keep(df: DataFrame) -> DataFrame:
    """cut() for large tables: a compressed Parquet table of its own in the shared folder, which the cluster's cleaning of that folder removes."""
    path = f"{checkpoint_folder(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_counted(df: DataFrame, rows: Column | None = None) -> tuple[DataFrame, int]:
    """keep(), and how many of its rows hold `rows` (all, without it), counted as they are written: no job besides."""
    seen = Observation()
    kept = keep(df.observe(seen, F.count_if(F.lit(True) if rows is None else rows).alias("n")))
    return kept, seen.get["n"]


def with_variant(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text and variant: 0, but a hash of the text for rows whose doc_id stands with different texts.

    (doc_id, variant) then names a document; rows that repeat wholly are one.
    Shared ids are found by two numbers an id, combined on the map side.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    fp = F.xxhash64("text").alias("fp")
    several = cut(docs.select("doc_id", fp).groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b").select(F.col("doc_id").alias("id_")))
    if not several.limit(1).count():
        return docs.withColumn("variant", F.lit(0).cast("bigint"))
    both = docs.join(broadcast_if_small(several.withColumn("shared", F.lit(True))), F.col("doc_id").eqNullSafe(F.col("id_")), "left")
    return both.select("doc_id", "text", F.when(F.col("shared"), F.xxhash64("text")).otherwise(0).alias("variant"))


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df, to be broadcast if it has at most `rows` rows; else Spark joins by shuffle.

    df is counted, so it should have been cut before.
    """
    return F.broadcast(df) if df.count() <= rows else df


def byte_slices(batch: pa.RecordBatch, text: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """batch in parts of at most `size` bytes of its column text, or of one row: what a task makes of a batch at once is bounded by bytes, not rows."""
    ends = np.cumsum(np.asarray(pc.binary_length(batch.column(text))))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        to = max(int(np.searchsorted(ends, before + size, "right")), at + 1)
        yield batch.slice(at, to - at)
        at = to


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else; texts without other capitals take the quick way."""
    quick = (F.length(text) == F.octet_length(text)) | ~text.rlike(OTHER_CAPITALS)
    return F.when(quick, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def strip_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def bound(value: Column, use) -> Column:
    """use(v), with value computed once: an optimizer may copy an expression into each use, not into a lambda's argument."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
