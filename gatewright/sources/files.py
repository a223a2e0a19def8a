"""Files as tables: inventory, encodings, delimited text with preambles, Parquet with a size limit."""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes without a character in Windows-1252; a file that holds one is read as Latin-1.
UNDEFINED_1252 = ("81", "8D", "8F", "90", "9D")
_OWN_1252 = bytes(x for x in range(0x80, 0xA0) if f"{x:02X}" not in UNDEFINED_1252)
_CHARACTERS_1252 = (_OWN_1252.decode("latin-1"), _OWN_1252.decode("cp1252"))


def inventory(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """path, file_name, depth (folders below `folder`), length, modified of each file; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder)
    root = F.regexp_replace(F.lit(folder.rstrip("/")), "^[a-z0-9]+:/*", "/")
    rest = F.split(F.regexp_replace("path", "^[a-z0-9]+:/*", "/"), "/")
    return found.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), (F.size(rest) - F.size(F.split(root, "/")) - 1).alias("depth"),
        "length", F.col("modificationTime").alias("modified"),
    )


def glob_regex(pattern: Column) -> Column:
    """A shell pattern (* and ?) as a regular expression; what else is special loses its meaning."""
    quoted = F.regexp_replace(pattern, r"([\\.^$|()\[\]{}+])", r"\\$1")
    return F.concat(F.lit("(?s)^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def select_files(files: DataFrame, pattern: str | None, default: str | None = None, several: bool = True) -> DataFrame:
    """Files whose name matches the pattern (blank: the default, else all); only the first by name unless `several`."""
    chosen = (pattern or "").strip() or (default or "").strip() or "*"
    hit = files.where(F.rlike(F.col("file_name"), glob_regex(F.lit(chosen))))
    return hit if several else hit.orderBy("file_name").limit(1)


def folders_to(folders: DataFrame, column: str, depth: int) -> DataFrame:
    """folders with depth (how many folders lie above it), down to a depth; none for 0 or less."""
    return folders.withColumn("depth", F.size(F.split(F.btrim(column, F.lit("/")), "/")) - 1).where((F.col("depth") <= depth) & F.lit(depth > 0))


def encodings(spark: SparkSession, path: str) -> DataFrame:
    """path, encoding of each file: utf-8, windows-1252 or iso-8859-1, decided on all its lines.

    Lines are judged where they are read, in parallel within a file; one flag a
    file and task is shuffled.
    """
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    bad = F.hex(F.col("value").cast("binary")).rlike(f"^(?:..)*(?:{'|'.join(UNDEFINED_1252)})")
    each = raw.groupBy("path").agg(F.bool_and(F.is_valid_utf8("value")).alias("utf8"), F.bool_or(bad).alias("no_1252"))
    return each.select("path", F.when(F.col("utf8"), "utf-8").when(F.col("no_1252"), "iso-8859-1").otherwise("windows-1252").alias("encoding"))


def _peek(spark: SparkSession, path: str, skip: int, encoding: str) -> tuple[int, list[str]]:
    """How many of the first `skip` lines hold text, and the names in the first line with text after them."""
    raw, n = spark.read.text(path).select(F.col("value").cast("binary").alias("value")), skip + 1
    while True:
        lines = [bytes(r.value) for r in raw.head(n)]
        header = next((x for x in lines[skip:] if x.strip()), None)
        if header is not None:
            text = header.decode("utf-8-sig" if encoding.lower() == "utf-8" else {"windows-1252": "cp1252"}.get(encoding.lower(), encoding))
            return sum(bool(x.strip()) for x in lines[:skip]), header_names(next(csv.reader([text])))
        if len(lines) < n:
            raise ValueError(f"no header row in {path}")
        n *= 2


def header_names(cells: list[str | None]) -> list[str]:
    """Column names from a header row: a blank one is named by its place, a repeated one gets .1, .2, ..."""
    names, seen = [], {}
    for k, cell in enumerate(cells):
        name = str(cell).strip() if cell is not None and str(cell).strip() else f"Unnamed: {k}"
        n = seen.get(name, 0)
        seen[name] = n + 1
        names.append(f"{name}.{n}" if n else name)
    return names


def read_csv(spark: SparkSession, path: str, header_skip_rows: int = 0, encoding: str | None = None, multiline: bool = False) -> DataFrame:
    """All columns as text and source_file_name, from files of one encoding and layout (loadset.load_set takes files of several).

    Files are split between tasks unless records hold line breaks (multiline).
    A preamble is dropped where a file's first split is read; nothing is
    shuffled for it.  Blank lines are not records.
    """
    skip = max(header_skip_rows, 0)
    encoding = encoding or "utf-8"
    first = path if not (files := spark.read.text(path).inputFiles()) else sorted(files)[0]
    filled, names = _peek(spark, first, skip, encoding)
    return read_layout(spark, path, names, encoding, filled if skip else None, multiline)


def from_latin_1(text: Column) -> Column:
    """Text of Windows-1252 that was read as ISO-8859-1: the two differ in 27 characters."""
    return F.translate(text, *_CHARACTERS_1252)


def read_layout(spark: SparkSession, paths: str | list[str], names: list[str], encoding: str, filled: int | None, multiline: bool = False) -> DataFrame:
    """Delimited files of known column names; filled preamble lines with text stand above the header (None: no preamble at all)."""
    cp1252 = encoding.lower() == "windows-1252"  # which the reader refuses
    schema = ", ".join(f"`c{k}` string" for k in range(len(names)))
    reader = spark.read.schema(schema).option("quote", '"').option("escape", '"').option("encoding", "iso-8859-1" if cp1252 else encoding).option("multiLine", multiline)
    cells = [(from_latin_1(F.col(f"c{k}")) if cp1252 else F.col(f"c{k}")).alias(f"c{k}") for k in range(len(names))]
    name = F.url_decode(F.replace("_metadata.file_name", F.lit("+"), F.lit("%2B"))).alias("source_file_name")  # it comes as in an address
    if filled is None:
        rows = reader.option("header", True).option("enforceSchema", True).csv(paths)
        return rows.select(*cells, name).toDF(*names, "source_file_name")
    rows = reader.csv(paths).select(*cells, name, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: dict[str, int] = {}
        for b in batches:
            start, paths = b.column("_start"), b.column("_path")
            out = b.select([c for c in b.schema.names if c not in ("_path", "_start")])
            if pc.any(pc.equal(start, 0)).as_py():
                keep = []
                for p, s in zip(paths.to_pylist(), start.to_pylist()):
                    n = left.setdefault(p, filled + 1) if s == 0 else 0
                    keep.append(n == 0)
                    if n:
                        left[p] = n - 1
                out = out.filter(pa.array(keep))
            yield out

    return rows.mapInArrow(drop, f"{schema}, source_file_name string").toDF(*names, "source_file_name")


def read_parquet(spark: SparkSession, path: str, most_bytes: int | None = None) -> DataFrame:
    """Parquet; with a limit, larger files raise before any data is read."""
    if most_bytes is not None:
        large = oversize(inventory(spark, path), most_bytes).orderBy("file_name").limit(5).collect()
        if large:
            raise ValueError("PARQUET_FILE_SIZE_LIMIT_EXCEEDED: " + ", ".join(r.file_name for r in large))
    return spark.read.parquet(path)


def oversize(files: DataFrame, most_bytes: int) -> DataFrame:
    return files.where(F.col("length") > most_bytes)


def move_files(spark: SparkSession, paths: list[str], folder: str, replace: bool = True) -> list[str]:
    """Move files (paths as of an inventory) to a folder, which is made if need be; their new names.

    A file of the same name there is replaced, or the new one gets _2, _3, ...
    before its extension.  Each file moves by one rename of the file system; one
    that is gone already is skipped, so that a run after a failure ends the work
    of the one before.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    moved = []
    for name in paths:
        source = path(name)
        if not fs.exists(source):
            continue
        name = source.getName()
        stem, dot, extension = name.rpartition(".") if "." in name else (name, "", "")
        k, target = 1, path(folder, name)
        if replace:
            fs.delete(target, False)
        while fs.exists(target) or not fs.rename(source, target):
            if not fs.exists(target):
                raise OSError(f"{source} could not be moved to {folder}")
            k += 1
            target = path(folder, f"{stem}_{k}{dot}{extension}")
        moved.append(target.getName())
    return moved
