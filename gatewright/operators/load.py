"""Loads: common-column promotion, upsert, swap, and the audit ledger."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from gatewright.sources.versions import VersionedTable

from .keys import duplicate_groups, key_conflicts


def common_columns(staged: list[str], target: list[str]) -> list[tuple[str, str]]:
    """(staged name, target name) of columns on both sides, by lower-cased name, in target order."""
    by_key = {c.lower(): c for c in staged}
    return [(by_key[c.lower()], c) for c in target if c.lower() in by_key]


def promote(staged: DataFrame, target: DataFrame, strategy: str) -> DataFrame:
    """What the target holds after promotion: TRUNCATE replaces its rows, APPEND adds to them."""
    pairs = common_columns(staged.columns, target.columns)
    if not pairs:
        raise ValueError("staging and target have no common column")
    rows = staged.select(*[F.col(s).alias(t) for s, t in pairs])
    if strategy == "TRUNCATE":
        return target.limit(0).unionByName(rows, allowMissingColumns=True)
    return target.unionByName(rows, allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """What the target holds after a merge: on equal keys the source's other columns replace the target's, and new keys are added.

    Target columns that the source lacks keep their values (null in new rows); a
    source of keys only adds rows.  A null key matches nothing.  One full outer
    join.  A key that the source holds twice is an error, found before the merge.
    """
    keys = [k.strip() for k in keys if k and k.strip()]
    if not keys:
        raise ValueError("merge keys are needed")
    if missing := [k for k in keys if k not in source.columns]:
        raise ValueError(f"merge keys missing from source: {missing}")
    if unknown := [c for c in source.columns if c not in target.columns]:
        raise ValueError(f"columns missing from target: {unknown}")
    filled = source.where(" and ".join(f"`{k}` is not null" for k in keys))
    if filled.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        raise ValueError(f"merge keys repeat in source: {keys}")
    same = None
    for k in keys:
        part = F.col(f"t.row.`{k}`") == F.col(f"s.row.`{k}`")
        same = part if same is None else same & part
    both = target.select(F.struct("*").alias("row")).alias("t").join(source.select(F.struct("*").alias("row")).alias("s"), same, "full_outer")
    came = F.col("s.row").isNotNull()
    return both.select(*[(F.when(came, F.col(f"s.row.`{c}`")).otherwise(F.col(f"t.row.`{c}`")) if c in source.columns else F.col(f"t.row.`{c}`")).alias(c) for c in target.columns])


def write_truncate(df: DataFrame, path: str) -> None:
    """Replace a table's rows; an empty df leaves an empty table."""
    df.write.mode("overwrite").parquet(path)


def write_append(df: DataFrame, path: str, keys: list[str] | None = None) -> bool:
    """Add rows; False and nothing written if df is empty.  With keys, repeated ones and those the table holds are an error before any write."""
    if not df.limit(1).count():
        return False
    if keys:
        check_key(df, keys)
        if conflicts := key_conflicts(df, df.sparkSession.read.schema(df.schema).parquet(path), {k: k for k in keys}).limit(5).collect():
            raise ValueError(f"PRIMARY_KEY_VIOLATION: keys in target: {[tuple(r) for r in conflicts]}")
    df.write.mode("append").parquet(path)
    return True


def check_key(df: DataFrame, keys: list[str]) -> None:
    found = duplicate_groups(df, keys).orderBy(*keys).limit(5).collect()
    if found:
        raise ValueError(f"PRIMARY_KEY_VIOLATION: {len(found)} or more keys with duplicates. Sample duplicate key values: {[tuple(r)[:-1] for r in found]}")


def swap(table: VersionedTable, chunks: DataFrame | list[DataFrame], strategy: str = "TRUNCATE", keys: list[str] | None = None) -> int:
    """Stage one frame or several chunks of a load, check the keys of all of them, and make them live in one commit; the commit's number.

    Whatever fails before the commit leaves the table as it was, and what was
    staged is dropped.  APPEND also checks the keys against the live rows.
    """
    chunks = chunks if isinstance(chunks, list) else [chunks]
    after, version = max(table.numbers(), default=0), None
    try:
        for df in chunks:
            version = table.stage(df, version)
        rows = table.staged(version, chunks[0].schema)
        if keys:
            check_key(rows, keys)
            if strategy == "APPEND" and after:
                if conflicts := key_conflicts(rows, table.read(after), {k: k for k in keys}).limit(5).collect():
                    raise ValueError(f"PRIMARY_KEY_VIOLATION: keys in target: {[tuple(r) for r in conflicts]}")
        return table.commit(version, chunks[0].schema, strategy, after)
    except Exception:
        if version:
            table.discard(version)
        raise


def write_swap(spark: SparkSession, df: DataFrame, folder: str, version: str, keys: list[str] | None = None) -> DataFrame:
    """Write a new version beside the old one and read it, without a manifest (see swap).  Its keys, if named, are checked first."""
    if keys:
        check_key(df, keys)
    path = f"{folder}/_v={version}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


_BUCKET = re.compile(r"^_bucket_of_(\d+)$")


def write_buckets(df: DataFrame, path: str, keys: list[str], buckets: int = 64) -> None:
    """A table in folders by a hash of its key, which merge_buckets can merge into."""
    name = f"_bucket_of_{buckets}"
    df.withColumn(name, _bucket(keys, buckets)).repartition(name).write.mode("overwrite").partitionBy(name).parquet(path)


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def read_buckets(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.drop(*[c for c in df.columns if _BUCKET.match(c)])


def merge_buckets(source: DataFrame, path: str, keys: list[str]) -> int:
    """upsert() into a table of write_buckets: only the folders that hold keys of the source are read and replaced; how many.

    The number of buckets stands in the name of the partition column.  At most so
    many numbers come to the driver; the filter on them reaches the scan as a
    partition filter.  A folder is replaced when the job commits; of several, a
    crash in that moment may leave some replaced, and the same merge run again
    gives the same rows.
    """
    stored = source.sparkSession.read.parquet(path)
    name = next(c for c in stored.columns if _BUCKET.match(c))
    buckets = int(_BUCKET.match(name)[1])
    touched = sorted(r[0] for r in source.select(_bucket(keys, buckets)).distinct().collect())
    if not touched:
        return 0
    merged = upsert(touched_rows(stored, name, touched).drop(name), source, keys)
    out = merged.withColumn(name, _bucket(keys, buckets)).repartition(name)
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)
    return len(touched)


def touched_rows(stored: DataFrame, name: str, touched: list[int]) -> DataFrame:
    return stored.where(F.col(name).isin(touched))


@dataclass(frozen=True)
class Metrics:
    rows_scanned: int
    rows_loaded: int
    error_count: int
    null_key_rows: int


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], keys: list[str] | None = None, error: Column | None = None) -> Metrics:
    """Write the rows of df that are no errors, and count on the way: scanned, loaded, errors, rows with a null in the key.

    The counts are taken from the rows as they pass to the writer, by the tasks
    whose output is committed; nothing is read a second time.
    """
    scanned, loaded = Observation(), Observation()
    wrong = F.coalesce(error, F.lit(False)) if error is not None else F.lit(False)
    no_key = F.greatest(*[F.col(k).isNull() for k in keys], F.lit(False)) if keys else F.lit(False)
    seen = df.observe(scanned, F.count(F.lit(1)).alias("rows"), F.count_if(wrong).alias("errors"), F.count_if(no_key).alias("null_keys"))
    write(seen.where(~wrong).observe(loaded, F.count(F.lit(1)).alias("rows")))
    got, kept = scanned.get, loaded.get
    return Metrics(got["rows"], kept["rows"], got["errors"], got["null_keys"])


def staging_only(control: DataFrame, known: DataFrame) -> DataFrame:
    """control with strategy, target, promote and error for a run that ends in staging.

    Staging is replaced, never promoted; a blank or unknown staging table (known:
    table_name) is an error, and the integrated table does not stand in for it.
    """
    name = F.nullif(F.trim("staging_table_name"), F.lit(""))
    found = known.select(F.lower("table_name").alias("known_name")).distinct()
    joined = control.withColumn("target", name).join(found, F.lower("target") == F.col("known_name"), "left")
    error = F.when(F.col("target").isNull(), "BLANK_STAGING_TABLE").when(F.col("known_name").isNull(), "UNKNOWN_STAGING_TABLE")
    return joined.select(*control.columns, F.lit("TRUNCATE").alias("strategy"), "target", F.lit(False).alias("promote"), error.alias("error"))


def staged_files(files: DataFrame, order: str = "file_name") -> DataFrame:
    """files (load_id, file_name) with strategy: the first file of a load replaces staging, the others add to it."""
    first = Window.partitionBy("load_id").orderBy(order)
    return files.withColumn("strategy", F.when(F.row_number().over(first) == 1, "TRUNCATE").otherwise("APPEND"))


def current_audit(events: DataFrame, audit_id: str, seq: str, *columns: str) -> DataFrame:
    """The latest event of each audit id, by an aggregation without a sort."""
    return events.groupBy(audit_id).agg(F.max_by(F.struct(*columns), F.struct(seq)).alias("x")).select(audit_id, "x.*")


def unite_ledgers(*ledgers: DataFrame) -> DataFrame:
    """Ledgers of different age as one: a column that an older one lacks is null there."""
    out = ledgers[0]
    for x in ledgers[1:]:
        out = out.unionByName(x, allowMissingColumns=True)
    return out


def ledger_events(spark: SparkSession, audit_id: str, seq: int, status: str, **facts: str | int | None) -> DataFrame:
    """One event row for an append-only ledger: STARTED, then SUCCESS or FAILED of the same audit id, also where no start was written."""
    columns = {"audit_id": audit_id, "seq": seq, "status": status, **facts}
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


def metric_columns(metrics: Metrics) -> dict[str, Column]:
    return {k: F.lit(v).cast("bigint") for k, v in asdict(metrics).items()}
