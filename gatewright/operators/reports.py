"""What the ledger and the issues of runs say: roll-ups, digests, routes of failures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rollup(audit: DataFrame, workflow: str = "workflow_id", status: str = "status") -> DataFrame:
    """How many entries each workflow has of each status."""
    return audit.groupBy(workflow, status).agg(F.count("*").alias("n"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name, n: how many rows each table has, in one query."""
    parts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def latest(audit: DataFrame, workflow: str, order: str, n: int = 5) -> DataFrame:
    """The last n entries of each workflow; Spark keeps n rows a workflow and task before the shuffle."""
    place = F.row_number().over(Window.partitionBy(workflow).orderBy(F.desc(order)))
    return audit.withColumn("place", place).where(F.col("place") <= n).drop("place")


def detail(audit: DataFrame, message: str = "message", most: int = 300) -> DataFrame:
    """audit with its message on one line and cut to `most` characters; order it where it is shown."""
    return audit.withColumn(message, F.left(F.regexp_replace(F.coalesce(message, F.lit("")), r"[\r\n]", " "), F.lit(most)))


def summary(audit: DataFrame, failed: Column, rows: str) -> DataFrame:
    """processed, failed, rows_loaded and status of a whole run: 0 if nothing failed, else 2."""
    total = audit.agg(F.count("*").alias("processed"), F.count_if(failed).alias("failed"), F.round(F.sum(rows), 2).alias("rows_loaded"))
    return total.withColumn("status", F.when(F.col("failed") == 0, 0).otherwise(2))


def digest(issues: DataFrame, code: str = "code", most: int = 10) -> DataFrame:
    """The most frequent codes, ties by name."""
    return issues.groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "code").limit(most)


def disposition(ok: Column) -> Column:
    """The folder a file goes to after its load."""
    return F.when(ok, "processed").otherwise("failed")


def failure_class(message: Column) -> Column:
    """Which notice a failure gets."""
    return F.when(message.startswith("PRIMARY_KEY_VIOLATION:"), "key_violation").when(message.isNotNull(), "generic")


def format_issue(severity: Column, code: Column, message: Column, details: Column) -> Column:
    tail = F.when(F.coalesce(details, F.lit("")) != "", F.concat(F.lit(" ("), details, F.lit(")"))).otherwise("")
    return F.concat(F.lit("["), severity, F.lit("] "), code, F.lit(": "), message, tail)


def parse_issue(line: Column) -> Column:
    """struct<severity, code, message, tab_name, file_name, duplicates> of an issue's line; what a line lacks is null."""

    def part(pattern: str, k: int = 1) -> Column:
        return F.nullif(F.regexp_extract(line, pattern, k), F.lit(""))

    def named(key: str) -> Column:
        return F.nullif(F.btrim(F.regexp_extract(line, rf"(?i){key}\s*=\s*([^,;\n)]+)", 1), F.lit(" \"'")), F.lit(""))

    head = r"^\[(\w+)\] (\w+): (.*)"
    return F.struct(
        part(head).alias("severity"), part(head, 2).alias("code"), part(r"^\[\w+\] \w+: (.*?)(?: \(.*\))?$").alias("message"), named("excel_tab_name").alias("tab_name"),
        named("source_file_name").alias("file_name"), part(r"(\d+) rows with duplicate").try_cast("bigint").alias("duplicates"),
    )
