"""Discovery of a folder: which files belong together, and what to propose for each group.

    inventory -> headers -> groups and patterns -> profile -> key -> contract, mapping sheet, control row

The functions of `discovery` and `profile` do the work; this one runs them over
the files of a folder.  One job finds the headers of all delimited files; a group
is then read as one load set, profiled in one scan and its key searched for.  What
comes to the driver: a row a file (path and header), and a row a column of each
group; the number of jobs grows with the groups, not with the files.

Cases: folders of finished files are left out, as are files of unknown kind; a
file without lines has no header and is left out; a group whose rows have no
unique combination of columns gets no key and is replaced at each load.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.functions import expr as X
from gatewright.sources.files import inventory
from gatewright.sources.loadset import column_names, literal_path, load_set, plain_path, short_uri, survey_files

from .discovery import SKIPPED_FOLDERS, discovery_groups, emit_contract, emit_control, group_patterns, mapping_rows, pattern_overlap
from .keys import infer_key, key_candidates
from .profile import column_statistics, narrowest_type

LINEAGE = ("source_file_name", "excel_tab_name")


@dataclass(frozen=True)
class Discovery:
    """files (path, file_name, group_id), contracts (group_id and emit_contract's columns), mappings, control (a row a group), overlap."""

    files: DataFrame
    contracts: DataFrame
    mappings: DataFrame
    control: DataFrame
    overlap: DataFrame


def headers(spark: SparkSession, folder: str, header_skip_rows: int = 0, recursive: bool = False) -> list[tuple[str, str, str, list[str]]]:
    """path, file_name, kind and columns of each delimited or Parquet file."""
    found = inventory(spark, folder, recursive).withColumn("kind", X.file_kind(F.col("file_name"))).where(F.col("kind").isin("csv", "parquet"))
    outside = ~F.exists(F.split(F.lower("path"), "/"), lambda x: x.isin(*SKIPPED_FOLDERS))
    rows = found.where(outside).orderBy(F.lower("file_name"), "path").select("path", "file_name", "kind").collect()
    texts = [literal_path(r.path) for r in rows if r.kind == "csv"]
    known = {plain_path(r.path): r for r in survey_files(spark, texts, header_skip_rows).collect()} if texts else {}
    out = []
    for r in rows:
        if r.kind == "parquet":
            out.append((r.path, r.file_name, r.kind, spark.read.parquet(literal_path(r.path)).columns))  # its footer
        elif (s := known.get(short_uri(r.path))) is not None and s.header is not None:
            out.append((r.path, r.file_name, r.kind, list(column_names(bytes(s.header), s.encoding))))
    return out


def table_name(signature: str, place: int) -> str:
    """A table's name from the family of its files' names."""
    words = re.sub(r"[^a-z0-9]+", "_", re.sub(r"\{n\}", " ", signature.lower())).strip("_")
    return words if words and not words[0].isdigit() else f"table_{words or place}"


def discover(spark: SparkSession, folder: str, header_skip_rows: int = 0, recursive: bool = False, schema: str = "landing") -> Discovery:
    """Propose a destination, a mapping and a control row for each group of files below a folder; nothing is loaded or written."""
    rows = headers(spark, folder, header_skip_rows, recursive)
    if not rows:
        raise ValueError(f"no files to discover in {folder}")
    files = spark.createDataFrame(rows, "path string, file_name string, kind string, columns array<string>")
    grouped = discovery_groups(files)
    patterns = group_patterns(grouped)
    members: dict[str, list] = {}
    for r in grouped.select("group_id", "signature", "kind", "path", "file_name").orderBy(F.lower("file_name"), "path").collect():
        members.setdefault(r.group_id, []).append(r)
    contracts = mappings = None
    named: list[tuple[str, str, str]] = []
    taken: dict[str, int] = {}
    for place, (group, parts) in enumerate(members.items()):
        paths = [literal_path(r.path) for r in parts]
        data = load_set(spark, paths, header_skip_rows) if parts[0].kind == "csv" else spark.read.parquet(*paths)
        own = data.select(*[F.col(f"`{c}`") for c in data.columns if c.lower() not in LINEAGE])
        stats = column_statistics(own)
        key = infer_key(own, key_candidates(own, stats)) or []
        contract = emit_contract(narrowest_type(stats), key)
        base = table_name(parts[0].signature, place)
        taken[base] = taken.get(base, 0) + 1
        name = base if taken[base] == 1 else f"{base}_{taken[base]}"
        named.append((group, name, re.sub(r"/+$", "", parts[0].path.rsplit("/", 1)[0])))
        one, sheet = contract.withColumn("group_id", F.lit(group)), mapping_rows(contract, name, parts[0].file_name, F.current_date()).withColumn("group_id", F.lit(group))
        contracts = one if contracts is None else contracts.unionByName(one)
        mappings = sheet if mappings is None else mappings.unionByName(sheet)
    groups = patterns.join(spark.createDataFrame(named, "group_id string, table_name string, folder string"), "group_id")
    return Discovery(grouped.select("path", "file_name", "group_id"), contracts, mappings, emit_control(groups, contracts, schema), pattern_overlap(grouped, patterns))
