"""A whole load of one control row: files, checks, staging, promotion, ledger and the files' way out.

    inventory -> STARTED -> read -> map, trim -> issues -> dates, types, lineage
    -> staging (swap) -> target (swap) -> SUCCESS or FAILED -> processed or failed

The functions of this package do the work; this one runs them in order.  Every
step that can be seen from outside is one commit: issues are a folder of the run,
staging and target are versioned tables, the ledger is append-only.  A run that
dies leaves a STARTED event, at most a folder that no manifest names, and its
files where they were, so it can be run again.  If it dies between the commit of
the target and the move of the files, the next run finds their keys in the target
and fails, which the ledger tells; loads without keys replace (TRUNCATE).

What comes to the driver: paths of the load's files, and a row a file for the
ledger and for the order of each date column.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.functions import expr as X
from gatewright.sources.files import inventory, move_files, read_parquet, select_files
from gatewright.sources.loadset import literal_path, load_set
from gatewright.sources.versions import VersionedTable
from gatewright.sources.workbook import read_workbooks

from . import dates, enrich, load
from .validate import Column as Contract
from .validate import contract_frame, date_columns, validate

LEDGER = "audit_id string, seq int, workflow_id string, file_name string, status string, rows_scanned bigint, rows_loaded bigint, error_count bigint, message string, disposition string, at timestamp"


@dataclass(frozen=True)
class Config:
    """What a control row says about a load."""

    workflow_id: str
    folder: str
    contract: tuple[Contract, ...]
    pattern: str | None = None
    several: bool = True
    header_skip_rows: int = 0
    tab: str | None = None
    mapping: str | None = None
    strategy: str = "TRUNCATE"
    keys: tuple[str, ...] = ()
    staging_only: bool = False
    us_dates: bool = False
    null_threshold: float = 0.9
    most_parquet_bytes: int = 512 << 20
    processed: str | None = None
    failed: str | None = None


@dataclass
class Outcome:
    """What a run did; the ledger has the same in rows."""

    run_id: str
    files: list[str] = field(default_factory=list)
    rows_scanned: int = 0
    rows_loaded: int = 0
    error: str | None = None


def choose_files(spark: SparkSession, config: Config) -> list[tuple[str, str]]:
    """(address, name) of the files to load, in order of their names without case; the first only unless several."""
    found = select_files(inventory(spark, config.folder), config.pattern)
    rows = found.orderBy(F.lower("file_name"), "file_name").select("path", "file_name")
    return [(r.path, r.file_name) for r in (rows if config.several else rows.limit(1)).collect()]


def read_files(spark: SparkSession, config: Config, uris: list[str]) -> DataFrame:
    """Rows of files of one kind, with source_file_name."""
    kinds = {r[0] for r in spark.createDataFrame([(u,) for u in uris], "p string").select(X.file_kind(F.col("p"))).distinct().collect()}
    paths = [literal_path(u) for u in uris]
    if kinds == {"csv"}:
        return load_set(spark, paths, config.header_skip_rows)
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("source_file_name")
    if kinds == {"parquet"}:
        for p in paths:
            read_parquet(spark, p, config.most_parquet_bytes)
        return spark.read.option("mergeSchema", True).parquet(*paths).select("*", name)
    if kinds == {"excel"}:
        return read_workbooks(spark, paths, config.tab, config.header_skip_rows)
    raise ValueError(f"files of several or unknown kinds: {sorted(kinds)}")


def text_dates(rows: DataFrame, config: Config) -> list[str]:
    """The text columns of the rows that the contract has as dates or times."""
    texts = {c.lower(): c for c, kind in rows.dtypes if kind == "string"}
    due = date_columns(contract_frame(rows.sparkSession, config.contract)).select("column_name").collect()  # a contract's rows
    return [texts[k] for r in due if (k := r.column_name.strip().lower()) in texts]


def date_evidence(rows: DataFrame, config: Config) -> dict[str, DataFrame | None]:
    """The evidence of each file for each column of text_dates, read once for the checks and the conversion."""
    return {name: dates.known_evidence(dates.order_evidence(rows, name, ["source_file_name"])) for name in text_dates(rows, config)}


def prepare(rows: DataFrame, config: Config, audit_id: str, evidence: dict[str, DataFrame | None] | None = None) -> DataFrame:
    """The contract's columns, typed, with lineage and n_lost; dates by the order of each file."""
    managed = [c for c in ("source_file_name", "excel_tab_name") if c in rows.columns]
    moments = {c.name.strip().lower() for c in config.contract if enrich.spark_type(c) in ("date", "timestamp_ntz")}
    read: dict[str, str] = {}
    for k, name in enumerate(text_dates(rows, config)):
        stays = name.strip().lower() in moments  # the moments are taken as they are, the text only where there is none
        found = dates.normalise_dates(rows, name, f"_date_{k}", us=config.us_dates, by=["source_file_name"], text_out=None if stays else "_text", evidence=(evidence or {}).get(name))
        if stays:
            rows, read[name] = found, f"_date_{k}"
        else:
            rows = found.withColumn(name, F.col("_text")).drop(f"_date_{k}", "_text")
    typed = enrich.typed_projection(rows.withColumn("_lineage", F.struct(*managed)), [*config.contract, Contract("_lineage", "struct")], read=read)
    return typed.select(*[c.name for c in config.contract], *[F.col(f"_lineage.{m}").alias(m) for m in managed], F.lit(audit_id).alias("audit_id"), "n_lost")


def find_issues(rows: DataFrame, config: Config, evidence: dict[str, DataFrame | None] | None = None) -> DataFrame:
    """Issues of the whole load, and of the dates of each file."""
    own = rows.drop("source_file_name", "excel_tab_name")
    contract = contract_frame(rows.sparkSession, config.contract)
    found = validate(own, contract, config.null_threshold)
    for name in text_dates(own, config):
        found = found.unionByName(dates.date_issues(rows, name, us=config.us_dates, by=["source_file_name"], evidence=(evidence or {}).get(name)).drop("source_file_name"))
    return found


def _write_events(spark: SparkSession, ledger: str, rows: list[tuple]) -> None:
    spark.createDataFrame(rows, LEDGER.removesuffix(", at timestamp")).withColumn("at", F.current_timestamp()).write.mode("append").parquet(ledger)


def run_load(spark: SparkSession, config: Config, staging: VersionedTable, target: VersionedTable | None, ledger: str, issues: str) -> Outcome:
    """Run one load; an error ends in the ledger and in the outcome, not in an exception, so that other loads go on.

    Warnings do not stop a load.  Nothing to load is a run without events.
    """
    out = Outcome(uuid.uuid4().hex)
    files = choose_files(spark, config)
    if not files:
        return out
    uris, out.files = [u for u, _ in files], [n for _, n in files]
    ids = {n: f"{out.run_id}-{k}" for k, n in enumerate(out.files)}

    def events(seq: int, status: str, loaded: dict[str, tuple[int, int]], message: str | None, disposition: str | None) -> None:
        counts = {n: loaded.get(n, (0, 0)) for n in out.files}
        _write_events(spark, ledger, [(ids[n], seq, config.workflow_id, n, status, rows, rows, lost, message, disposition) for n, (rows, lost) in counts.items()])

    events(1, "STARTED", {}, None, None)
    rows = None
    try:
        if not config.staging_only and target is None:
            raise ValueError("a load that is promoted needs a target")
        rows = enrich.trim_text(enrich.apply_mapping(read_files(spark, config, uris), config.mapping))
        rows = rows.persist()  # kept for three passes, spilled to disk; lost parts are read again from the files
        evidence = date_evidence(rows, config)
        found = find_issues(rows, config, evidence)
        at = f"{issues}/run={out.run_id}"
        found.withColumn("workflow_id", F.lit(config.workflow_id)).write.parquet(at)
        errors = [r.code for r in spark.read.schema(found.schema).parquet(at).where("severity = 'ERROR'").select("code").distinct().orderBy("code").collect()]
        if errors:
            raise ValueError("VALIDATION_FAILED: " + ", ".join(errors))
        typed = prepare(rows, config, out.run_id, evidence)
        load.swap(staging, typed, "TRUNCATE", list(config.keys) or None)
        staged = staging.read()
        per_file = {r.source_file_name: (r.n, r.lost) for r in staged.groupBy("source_file_name").agg(F.count("*").alias("n"), F.sum("n_lost").alias("lost")).collect()}
        out.rows_scanned = sum(n for n, _ in per_file.values())
        if not config.staging_only:
            load.swap(target, staged.drop("n_lost"), config.strategy, list(config.keys) or None)
        out.rows_loaded = out.rows_scanned
        events(2, "SUCCESS", per_file, None, "processed")
        if config.processed:
            move_files(spark, uris, config.processed)
    except Exception as e:  # the ledger gets whatever went wrong
        out.error = f"{type(e).__name__}: {e}"
        events(2, "FAILED", {}, out.error[:2000], "failed")
        if config.failed:
            move_files(spark, uris, config.failed)
    finally:
        if rows is not None:
            rows.unpersist()
    return out
