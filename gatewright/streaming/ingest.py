"""Files as a stream: each micro-batch goes through the same functions as a batch load.

The file source's checkpoint gives every file once; a batch that holds an error
or a repeated key goes to quarantine as a whole.  What a batch writes lies in a
folder named by its batch id, so a batch run again after a failure replaces
its own rows.  Later batches look keys up in the rows already loaded, by join,
in the folders that hold keys like theirs.

That look-up grows with what is loaded.  `watch_keys` finds repeated keys of a
stream by state instead: Spark keeps a count a key in its state store (give the
session the RocksDB one, so that it lies on disk), a batch touches only its own
keys, and a restart goes on from the checkpoint.  `first_within` bounds the state
by time, for streams whose repeats come within a delay.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gatewright.operators import dates as D
from gatewright.operators import keys as K


#: Loaded rows lie in folders by a hash of their key, so that a batch looks only into those of its own keys; so many unless the caller says otherwise.
BUCKETS = 64


def _bucket(key: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")


def _loaded(rows: DataFrame, target: str, key: Sequence[str], batch_id: int, buckets: int) -> DataFrame:
    """The keys of earlier batches, from the folders that hold keys like those of rows."""
    spark = rows.sparkSession
    kinds = StructType([rows.schema[k] for k in key]).add("_batch", "long").add("_bucket", "integer")
    try:
        known = spark.read.schema(kinds).parquet(target)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return rows.select(*key).limit(0)
    touched = [r[0] for r in rows.select(_bucket(key, buckets)).distinct().collect()]  # as many numbers at most
    return known.where((F.col("_batch") < batch_id) & F.col("_bucket").isin(touched)).select(*key)


def load_batch(
    batch: DataFrame,
    batch_id: int,
    target: str,
    quarantine: str,
    issues: str,
    key: Sequence[str],
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    check: Callable[[DataFrame], DataFrame] | None = None,
    screen: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int = BUCKETS,
) -> bool:
    """Check one batch and write it to the target or to quarantine; True if it was loaded.

    `check` gives severity, code, column_name, detail of prepared rows, `screen` of
    the batch as it came: an error there ends it before it is prepared, and the rows
    go to quarantine as they are.  Warnings do not stop a batch.  `buckets` stays the same for the life of a target.
    """
    spark = batch.sparkSession
    if screen:
        early = screen(batch).select("severity", "code", "column_name", "detail")
        if early.where("severity = 'ERROR'").limit(1).count():
            early.write.mode("overwrite").parquet(f"{issues}/_batch={batch_id}")
            batch.withColumn("_bucket", _bucket(key, buckets)).write.mode("overwrite").partitionBy("_bucket").parquet(f"{quarantine}/_batch={batch_id}")
            return False
    rows = prepare(batch).persist()  # kept for three passes, spilled to disk; lost parts are read again from the files
    try:
        found = K.append_guard(rows, _loaded(rows, target, key, batch_id, buckets), {k: k for k in key}).where("n > 0")
        found = found.select(F.lit("ERROR").alias("severity"), "code", F.lit(",".join(key)).alias("column_name"), F.col("n").cast("string").alias("detail"))
        if check:
            found = found.unionByName(check(rows).select("severity", "code", "column_name", "detail"))
        found.write.mode("overwrite").parquet(f"{issues}/_batch={batch_id}")
        blocked = spark.read.schema(found.schema).parquet(f"{issues}/_batch={batch_id}").where("severity = 'ERROR'").limit(1).count() > 0
        rows.withColumn("_bucket", _bucket(key, buckets)).write.mode("overwrite").partitionBy("_bucket").parquet(f"{quarantine if blocked else target}/_batch={batch_id}")
        return not blocked
    finally:
        rows.unpersist()


def dates_by_file(columns: Sequence[str], us: bool = False) -> dict[str, Callable[[DataFrame], DataFrame]]:
    """screen and prepare for load_batch: the order of dates is found in all rows that a batch has of a file, before any of them is converted.

    A file whose dates cannot be decided is an error of its batch; text that is no date stays as it is.
    """

    def screen(batch: DataFrame) -> DataFrame:
        found = [D.date_issues(batch, c, us=us, by=["source_file_name"]) for c in columns]
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return out

    def prepare(batch: DataFrame) -> DataFrame:
        for c in columns:
            read = D.normalise_dates(batch, c, "_date", us=us, by=["source_file_name"], text_out="_text")
            batch = read.withColumn(c, F.col("_text")).drop("_date", "_text")
        return batch

    return {"screen": screen, "prepare": prepare}


def stream_csv(
    spark: SparkSession, folder: str, schema: StructType, checkpoint: str, target: str, quarantine: str, issues: str, key: Sequence[str],
    files_per_batch: int = 100, archive: str | None = None, buckets: int = BUCKETS, **functions: Callable[[DataFrame], DataFrame],
) -> StreamingQuery:
    """Load what has arrived since the last call, then end; with `archive`, finished files are moved there."""
    source = spark.readStream.schema(schema).option("header", True).option("escape", '"').option("maxFilesPerTrigger", files_per_batch)
    if archive:
        source = source.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("source_file_name")
    rows = source.csv(folder).select("*", name) if "source_file_name" not in schema.names else source.csv(folder)

    def each(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, batch_id, target, quarantine, issues, key, buckets=buckets, **functions)

    return rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def repeated_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """key, n of each key of a stream that has come more than once, in the batches in which it comes again: state is a count a key.

    Null keys are one key.  Output in update mode.
    """
    return rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def watch_keys(rows: DataFrame, key: Sequence[str], checkpoint: str, out: str) -> StreamingQuery:
    """Write repeated_keys of what has arrived to out, a folder a batch, which a batch run again replaces; then end."""

    def each(found: DataFrame, batch_id: int) -> None:
        found.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

    return repeated_keys(rows, key).writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_within(rows: DataFrame, key: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """The first row of each key of a stream; a repeat is dropped if it comes within the delay of the first, after which the key's state goes."""
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(key))
