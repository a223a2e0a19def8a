"""Checks of a table against its contract; each finding is a row of issues."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column as Column_
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewright.functions import expr as X

from .profile import column_statistics, family
from .samples import with_samples

#: Columns that loads fill themselves, and type names by family.
MANAGED = ("sp_ingest_load_dt", "audit_id", "__$batch_id", "__$job_instance_id")
NUMERIC = ("tinyint", "smallint", "int", "bigint", "decimal", "numeric", "money", "smallmoney", "float", "real")
DATETIME = ("date", "datetime", "datetime2", "smalldatetime", "datetimeoffset", "time")
STRING = ("char", "nchar", "varchar", "nvarchar", "text", "ntext", "uniqueidentifier")


@dataclass(frozen=True)
class Column:
    name: str
    type: str
    char_len: int | None = None
    precision: int | None = None
    scale: int | None = None
    is_key: bool = False


def contract_frame(spark: SparkSession, columns: Iterable[Column]) -> DataFrame:
    rows = [(k + 1, c.name, c.type.lower(), c.char_len, c.precision, c.scale, c.is_key) for k, c in enumerate(columns)]
    df = spark.createDataFrame(rows, "ordinal int, column_name string, data_type string, char_len int, precision int, scale int, is_key boolean")
    t = F.col("data_type")
    kind = F.when(t == "bit", "bool").when(t.isin(*NUMERIC), "numeric").when(t.isin(*DATETIME), "datetime").when(t.isin(*STRING), "string").otherwise("other")
    return df.withColumn("family", kind)


#: What Spark writes beside a text column that was declared with a length; its type in a frame is string.
DECLARED = "__CHAR_VARCHAR_TYPE_STRING"
_LENGTH = re.compile(r"^(varchar|char)\((\d+)\)$")


def contract_columns(table: DataFrame | str, keys: Iterable[str] = (), spark: SparkSession | None = None) -> list[Column]:
    """The contract that a table's own schema states, in its order; a name is looked up in the session's catalog.

    Lengths of char and varchar columns come from what the catalog or the frame's
    schema keeps of their declaration.
    """
    declared = {}
    if isinstance(table, str):
        spark = spark or SparkSession.active()
        declared = {c.name: c.dataType for c in spark.catalog.listColumns(table)}
        table = spark.table(table)
    names = {T.ByteType: "tinyint", T.ShortType: "smallint", T.IntegerType: "int", T.LongType: "bigint", T.BooleanType: "bit", T.FloatType: "real", T.DoubleType: "float", T.DateType: "date", T.TimestampType: "datetime2", T.TimestampNTZType: "datetime2"}
    out = []
    for f in table.schema:
        kind, key = f.dataType, f.name in set(keys)
        sized = _LENGTH.match(f.metadata.get(DECLARED) or declared.get(f.name) or kind.simpleString())
        if sized:
            out.append(Column(f.name, sized[1], char_len=int(sized[2]), is_key=key))
        elif isinstance(kind, T.DecimalType):
            out.append(Column(f.name, "decimal", precision=kind.precision, scale=kind.scale, is_key=key))
        else:
            out.append(Column(f.name, names.get(type(kind), "varchar"), is_key=key))
    return out


def date_columns(contract: DataFrame, managed: tuple[str, ...] = MANAGED) -> DataFrame:
    """The rows of a contract that are dates or times and not managed."""
    return contract.where(F.col("data_type").isin(*DATETIME) & ~F.lower(F.trim("column_name")).isin(*managed))


def source_frame(contract: DataFrame, source: list[str] | DataFrame) -> DataFrame:
    """position, source_name of a source's columns."""
    if isinstance(source, DataFrame):
        return source.select("position", "source_name")
    return contract.sparkSession.createDataFrame([(k + 1, c) for k, c in enumerate(source)], "position int, source_name string")


def schema_issues(contract: DataFrame, source_columns: list[str] | DataFrame, managed: tuple[str, ...] = MANAGED) -> DataFrame:
    """At most one issue each: missing columns in the contract's order, additional ones in the source's, and another order of the shared ones."""
    source = source_frame(contract, source_columns)
    key = F.lower(F.trim("column_name"))
    both = contract.withColumn("k", key).where(~F.col("k").isin(*managed)).join(
        source.withColumn("k", F.lower(F.trim("source_name"))).where(~F.col("k").isin(*managed)), "k", "full_outer"
    )

    def listed(name: str, rule: Column_, by: str) -> Column_:
        return F.transform(F.sort_array(F.collect_list(F.when(rule, F.struct(by, name)))), lambda x: x[name])

    shared = F.col("source_name").isNotNull() & F.col("column_name").isNotNull()
    lists = both.agg(
        listed("column_name", F.col("source_name").isNull(), "ordinal").alias("missing"), listed("source_name", F.col("column_name").isNull(), "position").alias("additional"),
        listed("k", shared, "position").alias("came"), listed("k", shared, "ordinal").alias("due"),
    )
    join = lambda c: F.array_join(c, ",")

    def issue(rule: Column_, severity: str, code: str, names: Column_, detail: Column_) -> Column_:
        return F.when(rule, F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), names.alias("column_name"), detail.alias("detail")))

    found = F.array(
        issue(F.size("missing") > 0, "ERROR", "MISSING_DEST_COLUMNS_IN_SOURCE", join("missing"), F.lit("missing")),
        issue(F.size("additional") > 0, "WARNING", "ADDITIONAL_SOURCE_COLUMNS", join("additional"), F.lit("additional")),
        issue(F.col("came") != F.col("due"), "WARNING", "COLUMN_REORDERING_DETECTED", join("came"), F.concat(F.lit("due "), join("due"))),
    )
    return lists.select(F.inline(F.filter(found, lambda x: x.isNotNull())))


def text_date_issues(df: DataFrame, contract: DataFrame, samples: int = 5) -> DataFrame:
    """One warning for each date column of the contract that holds dates as text: how many, and the smallest few of them."""
    due = {r.k for r in date_columns(contract).select(F.lower(F.trim("column_name")).alias("k")).collect()}  # a contract's rows
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name.strip().lower() in due]
    if not texts:
        return df.sparkSession.createDataFrame([], "severity string, code string, column_name string, detail string")
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), X.strip(F.col(f"`{c}`")).alias("t")) for c in texts])).alias("x")).select("x.*").where(X.is_date_like(F.col("t")))
    counts = cells.groupBy("c").agg(F.count("*").alias("n"))
    return with_samples(counts, cells, ["c"], "t", "s", samples).select(
        F.lit("WARNING").alias("severity"), F.lit("EXCEL_DATETIME_STORED_AS_TEXT").alias("code"), F.col("c").alias("column_name"),
        F.concat(F.lit("count="), F.col("n").cast("string"), F.lit(", samples="), F.array_join("s", ", ")).alias("detail"),
    )


def blocked(issues: DataFrame, *by: str) -> DataFrame:
    """For each load whether an error stops it; warnings do not."""
    return issues.groupBy(*by).agg(F.bool_or(F.col("severity") == "ERROR").alias("blocked"))


def schema_diff(contract: DataFrame, source_columns: list[str] | DataFrame) -> DataFrame:
    """side, column_name of what only one side has, by trimmed name in lower case; managed columns are left out."""
    source = source_frame(contract, source_columns)
    key = F.lower(F.trim("column_name"))
    both = contract.where(~key.isin(*MANAGED)).withColumn("k", key).join(
        source.withColumn("k", F.lower(F.trim("source_name"))).where(~F.col("k").isin(*MANAGED)), "k", "full_outer"
    )
    return both.where("source_name is null or column_name is null").select(
        F.when(F.col("source_name").isNull(), "missing").otherwise("additional").alias("side"), F.coalesce("column_name", "source_name").alias("column_name")
    )


def validate(df: DataFrame, contract: DataFrame, null_threshold: float = 0.9) -> DataFrame:
    """severity, code, column_name, detail of every finding; one scan of df and joins of two tiny tables."""
    stats = column_statistics(df).withColumn("k", F.lower(F.trim("column_name")))
    c = contract.withColumn("k", F.lower(F.trim("column_name"))).where(~F.col("k").isin(*MANAGED))
    both = family(stats.join(F.broadcast(c.select("k", "family", "data_type", "char_len", "precision", "scale")), "k"), df.schema, F.col("family"))
    numeric = (F.col("family") == "numeric") & (F.col("source_family") == "numeric") & ~F.col("data_type").isin("float", "real")
    ratio = F.when(F.col("rows") > 0, F.col("nulls") / F.col("rows")).otherwise(0.0)
    checks = [
        ("ERROR", "TYPE_MISMATCH", F.col("family").isin("numeric", "datetime", "bool") & (F.col("source_family") != "any") & (F.col("source_family") != F.col("family")), F.col("source_family")),
        ("ERROR", "STRING_LENGTH_EXCEEDED", (F.col("source_family") == "string") & (F.col("char_len") > 0) & (F.col("max_len") > F.col("char_len")), F.col("max_len").cast("string")),
        ("ERROR", "NUMERIC_PRECISION_EXCEEDED", numeric & (F.col("precision") > 0) & (F.col("max_total") > F.col("precision")), F.col("max_total").cast("string")),
        ("ERROR", "NUMERIC_SCALE_EXCEEDED", numeric & (F.col("max_fraction") > F.coalesce("scale", F.lit(0))), F.col("max_fraction").cast("string")),
        ("WARNING", "HIGH_NULL_RATIO", ratio >= null_threshold, F.format_string("%.4f", ratio)),
    ]
    found = F.filter(
        F.array(*[F.when(rule, F.struct(F.lit(s).alias("severity"), F.lit(code).alias("code"), F.col("column_name").alias("column_name"), detail.alias("detail"))) for s, code, rule, detail in checks]),
        lambda x: x.isNotNull(),
    )
    return both.select(F.inline(found)).unionByName(schema_issues(contract, df.columns))
