"""Which files belong together, what is not configured yet, and what to propose for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatewright.functions import expr as X
from gatewright.sources.control import normalise_path
from gatewright.sources.files import glob_regex

from .enrich import unique_names
from .profile import code_like, column_statistics, merge_statistics, narrowest_type  # noqa: F401

SKIPPED_FOLDERS = ("processed", "failed", "archive", "_processed", "_failed", "_archive", "processed_", "failed_", "archive_")


def discovery_groups(files: DataFrame) -> DataFrame:
    """files (file_name, kind, columns) with layout, signature and group_id.

    Files of one layout and one stem family are a group; a layout whose files
    carry several families is split into one group for each family.
    """
    layout = F.sha2(F.concat_ws("\u0001", "kind", F.array_join(F.transform("columns", lambda c: F.lower(c)), "\u0002")), 256)
    signature = X.stem_signature(F.col("file_name"))
    return files.withColumns({"layout": layout, "signature": signature}).withColumn("group_id", F.sha2(F.concat_ws("\u0001", "layout", "signature"), 256))


def group_patterns(grouped: DataFrame) -> DataFrame:
    """group_id, pattern, members: one file's own name, else the family's glob (any extension if they differ)."""
    ext = F.lower(F.regexp_extract("file_name", r"\.([^.]*)$", 1))
    g = grouped.groupBy("group_id").agg(F.first("signature").alias("signature"), F.min(ext).alias("ext"), F.max(ext).alias("ext_"), F.min("file_name").alias("one"), F.count("*").alias("members"))
    family = X.family_pattern(F.col("signature"), F.when(F.col("ext") == F.col("ext_"), F.col("ext")).otherwise("*"))
    return g.select("group_id", F.when(F.col("members") == 1, F.col("one")).otherwise(family).alias("pattern"), "members")


def pattern_overlap(grouped: DataFrame, patterns: DataFrame) -> DataFrame:
    """group_id, file_name: files of other groups that a group's pattern would also take.

    A name that fits a pattern holds its longest stretch without wildcards, and
    so the first two characters of that; names meet patterns by those, and only
    patterns of less meet names by one character or all of them.
    """
    names = grouped.select("file_name", F.col("group_id").alias("own")).distinct()
    stretch = F.array_max(F.transform(F.split("pattern", "[*?]+"), lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"]
    p = patterns.select("group_id", "pattern", F.left(stretch, F.lit(2)).alias("part"))
    letters = F.sequence(F.lit(1), F.length("file_name"))
    one, two = (F.transform(letters, lambda k: F.substring(F.col("file_name"), k, F.lit(1))), F.transform(letters, lambda k: F.substring(F.col("file_name"), k, F.lit(2))))
    parts = F.array_distinct(F.concat(F.array(F.lit("")), one, two))
    hit = (F.col("own") != F.col("group_id")) & F.rlike("file_name", glob_regex(F.col("pattern")))
    return names.withColumn("part", F.explode(parts)).join(p, "part").where(hit).select("group_id", "file_name").distinct()


def unconfigured_folders(folders: DataFrame, configured: DataFrame, site: str) -> DataFrame:
    """folders (folder) that no configured folder names, compared as paths below the site without regard to case; result folders are left out."""
    key = lambda c: F.lower(normalise_path(c, site))
    known = configured.select(key(F.col("folder")).alias("k")).distinct()
    last = F.lower(F.element_at(F.split(normalise_path(F.col("folder"), site), "/"), -1))
    return folders.where(~last.isin(*SKIPPED_FOLDERS)).withColumn("k", key(F.col("folder"))).join(known, "k", "left_anti").drop("k")


def profile_files(rows: DataFrame, file: str = "source_file_name", tab: str | None = None) -> DataFrame:
    """Statistics and types of each column of each file; with `tab`, those of its sheets are taken together.  One scan for all files."""
    lineage = [c for c in rows.columns if c.lower() in ("source_file_name", "excel_tab_name")]
    by = [file, tab] if tab else [file]
    columns = [c for c in rows.columns if c not in lineage and c not in by]
    stats = column_statistics(rows, columns, by=by)
    return narrowest_type(merge_statistics(stats.where("filled > 0 or rows > 0"), by=[file]) if tab else stats)


#: Columns that loads add to a destination, in order, with type and nullability; workbooks have the tab first.
SYSTEM_COLUMNS = (
    ("source_file_name", "VARCHAR(255)", "NULL"), ("sp_ingest_load_dt", "DATETIME2(7)", "NOT NULL"), ("audit_id", "BIGINT", "NULL"), ("__$batch_id", "INT", "NULL"), ("__$job_instance_id", "INT", "NULL"),
)
TAB_COLUMN = ("excel_tab_name", "VARCHAR(100)", "NOT NULL")


def emit_contract(profile: DataFrame, keys: list[str], workbook: bool = False) -> DataFrame:
    """ordinal, source_name (null for system columns), column_name, data_type, nullability, is_key of a proposed destination.

    profile: column_name, ordinal, raw_type.  Names become snake_case, with _2,
    _3, ... where two columns would share one; keys are source names.
    """
    system = [*([TAB_COLUMN] if workbook else []), *SYSTEM_COLUMNS]
    taken = [c for c, _, _ in system]
    base = X.snake_case(F.col("column_name"), F.concat(F.lit("column_"), F.col("ordinal").cast("string")))
    own = profile.where(~F.lower("column_name").isin(*taken)).select("ordinal", F.col("column_name").alias("source_name"), base.alias("base"), "raw_type")
    key = F.col("source_name").isin(*keys) if keys else F.lit(False)
    own = own.select("ordinal", "source_name", unique_names(F.col("base"), "ordinal").alias("column_name"), F.col("raw_type").alias("data_type"), F.when(key, "NOT NULL").otherwise("NULL").alias("nullability"), key.alias("is_key"))
    rows = [(10_000 + k, None, c, t, "NOT NULL" if c in keys else n, c in keys) for k, (c, t, n) in enumerate(system)]
    added = profile.sparkSession.createDataFrame(rows, "ordinal int, source_name string, column_name string, data_type string, nullability string, is_key boolean")
    return own.unionByName(added)


def contract_ddl(contract: DataFrame, table: str) -> DataFrame:
    """ddl: the statement that makes the table, on one row."""
    line = F.concat_ws(" ", F.concat(F.lit("["), F.replace("column_name", F.lit("]"), F.lit("]]")), F.lit("]")), "data_type", "nullability")
    lines = F.transform(F.sort_array(F.collect_list(F.struct("ordinal", line.alias("line")))), lambda x: x["line"])
    keys = F.transform(F.sort_array(F.collect_list(F.when(F.col("is_key"), F.struct("ordinal", "column_name")))), lambda x: F.concat(F.lit("["), x["column_name"], F.lit("]")))
    one = contract.agg(lines.alias("lines"), keys.alias("keys"))
    constraint = F.when(F.size("keys") > 0, F.concat(F.lit(f",\n CONSTRAINT [PK_{table.split('.')[-1]}] PRIMARY KEY ("), F.array_join("keys", ", "), F.lit(")"))).otherwise("")
    return one.select(F.concat(F.lit(f"CREATE TABLE {table} (\n "), F.array_join("lines", ",\n "), constraint, F.lit("\n)")).alias("ddl"))


def mapping_rows(contract: DataFrame, object_name: str, source_object: str, updated: Column) -> DataFrame:
    """The mapping sheet: a row for each column of the contract, with ordinal to order it by; the first one carries the comment."""
    kind = F.concat_ws(" ", "data_type", "nullability")
    first = contract.agg(F.min("ordinal").alias("first"))
    return contract.crossJoin(F.broadcast(first)).select(
        "ordinal", F.lit(object_name).alias("Object name"), F.date_format(updated, "dd/MM/yyyy").alias("Last update"), F.lit(source_object).alias("Source object"), F.coalesce("source_name", F.lit("")).alias("Source column"),
        F.col("column_name").alias("Staging column"), kind.alias("Staging type"), F.col("column_name").alias("Integrated column"), kind.alias("Integrated type"), F.when(F.col("is_key"), "Y").otherwise("").alias("Primary key?"),
        F.lit("").alias("Transform"), F.when(F.col("ordinal") == F.col("first"), MAPPING_COMMENT).otherwise("").alias("Comments"),
    )  # fmt: skip  # first is one row


#: Fixed value: the remark in the first row of a mapping sheet.
MAPPING_COMMENT = "Mapping provided manually, it cannot or meant to be generated"


def emit_control(groups: DataFrame, contract: DataFrame, schema: str = "landing") -> DataFrame:
    """A proposed control row for each group (group_id, folder, table_name, pattern, members); contract: group_id and emit_contract's columns.

    With a key files are added (APPEND), without one they replace (TRUNCATE).
    The workflow's id ends in a hash of the group, so that it stays the same.
    """
    named = contract.where("source_name is not null")
    pairs = F.map_from_entries(F.transform(F.sort_array(F.collect_list(F.struct("ordinal", "source_name", "column_name"))), lambda x: F.struct(x["source_name"], x["column_name"])))
    keys = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("is_key"), F.struct("ordinal", "column_name")))), lambda x: x["column_name"]), ",")
    per = named.groupBy("group_id").agg(F.to_json(pairs).alias("column_mapping_json"), keys.alias("merge_key_columns"))
    table = F.concat_ws(".", F.lit(schema), "table_name")
    return groups.join(per, "group_id").select(
        "group_id", F.col("folder").alias("process_folder"), F.concat("folder", F.lit("/Processed")).alias("archive_folder"), F.concat("folder", F.lit("/Failed")).alias("failed_folder"),
        table.alias("staging_table_name"), table.alias("integrated_table_name"), (F.col("members") > 1).alias("multi_file_ingest"), F.lit(True).alias("is_active"), F.lit("REAL").alias("ingestion_scope"),
        F.col("pattern").alias("file_name_pattern"), F.when(F.col("merge_key_columns") != "", "APPEND").otherwise("TRUNCATE").alias("load_strategy"), "merge_key_columns", "column_mapping_json",
        F.concat(F.lit("wf-"), F.lower(F.replace("table_name", F.lit("_"), F.lit("-"))), F.lit("-"), F.left(F.sha2(F.col("group_id"), 256), F.lit(8))).alias("workflow_id"),
    )
