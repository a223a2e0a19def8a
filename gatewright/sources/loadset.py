"""One load from files that differ in header and encoding.

One job over the lines of all files finds each file's encoding and header.  Files
of equal header, encoding and preamble go to one reader, and the readers' rows
are united by column name.  A row a file comes to the driver, as the paths have
to be handed to readers; Spark's own index of files is there too.

Cases: a preamble may hold blank lines, in each file others; the header is the
first line with text behind it, a byte order mark is dropped; names are compared
without case; a column that a file lacks is null in its rows; blank lines are no
records; a file without a header row is an error, one without records gives none;
a header whose names hold line breaks is not supported.
"""

from __future__ import annotations

import csv
import re
import tempfile
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import UNDEFINED_1252, header_names, read_layout


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, spark.checkpoint.dir; without it, local mode takes a temporary one and a cluster raises."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-checkpoint-"))
        folder = sc.getCheckpointDir()
    return folder


def survey_files(spark: SparkSession, paths: str | list[str], header_skip_rows: int = 0) -> DataFrame:
    """path, encoding (utf-8, windows-1252 or iso-8859-1), filled (preamble lines with text) and header (bytes) of each file that has lines.

    The encoding is judged on all lines where they are read, in parallel within a
    file; headers are found in a file's first split.  Each batch of lines gives a
    row a file, so little is shuffled.
    """
    skip = max(header_skip_rows, 0)
    valid = F.is_valid_utf8("value")
    undefined = F.hex(F.col("value").cast("binary")).rlike(f"^(?:..)*(?:{'|'.join(UNDEFINED_1252)})")
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), valid.alias("valid"), F.when(~valid, undefined).otherwise(False).alias("undefined"),
        F.when(F.col("_metadata.file_block_start") == 0, F.col("value").cast("binary")).alias("head"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[str, list[int]] = {}  # lines seen and those with text, of files whose header is still to come
        done: set[str] = set()
        for b in batches:
            out, start = [], 0
            for path, rows in groupby(b.column("path").to_pylist()):
                n = sum(1 for _ in rows)
                part = b.slice(start, n)
                start += n
                filled = header = None
                if path not in done and part.column("head")[0].is_valid:
                    seen = at.setdefault(path, [0, 0])
                    for x in part.column("head"):
                        line = x.as_py()
                        if seen[0] >= skip and line.strip():
                            filled, header = seen[1], line
                            done.add(path)
                            break
                        seen[0] += 1
                        seen[1] += bool(line.strip())
                out.append((path, pc.all(part.column("valid")).as_py(), pc.any(part.column("undefined")).as_py(), filled, header))
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary()))], names=["path", "valid", "undefined", "filled", "header"])

    each = lines.mapInArrow(run, "path string, valid boolean, undefined boolean, filled bigint, header binary").groupBy("path")
    whole = each.agg(F.bool_and("valid").alias("valid"), F.bool_or("undefined").alias("undefined"), F.max("filled").alias("filled"), F.max("header").alias("header"))
    return whole.select("path", F.when(F.col("valid"), "utf-8").when(F.col("undefined"), "iso-8859-1").otherwise("windows-1252").alias("encoding"), "filled", "header")


def column_names(header: bytes, encoding: str) -> tuple[str, ...]:
    text = header.decode("utf-8-sig" if encoding == "utf-8" else {"windows-1252": "cp1252"}.get(encoding, encoding))
    return tuple(header_names(next(csv.reader([text.rstrip("\r\n")]))))


def short_uri(uri: str) -> str:
    """An address without host in its short form, scheme:/path."""
    return re.sub(r"^(\w+):///", r"\1:/", uri)


def plain_path(uri: str) -> str:
    """A path as an inventory has it, from a file's address."""
    return short_uri(unquote(uri))


def literal_path(path: str) -> str:
    """A path for a reader, in which nothing is a pattern."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


def load_set(spark: SparkSession, paths: str | list[str], header_skip_rows: int = 0, multiline: bool = False) -> DataFrame:
    """All records of all files as text, with source_file_name; columns in the order of the first file by name, then of the others."""
    found = survey_files(spark, paths, header_skip_rows).collect()
    if without := {short_uri(p) for p in spark.read.text(paths).inputFiles()} - {short_uri(r.path) for r in found if r.header is not None}:
        raise ValueError(f"no header row in {len(without)} files, among them {sorted(without)[:5]}")
    by_name = sorted(found, key=lambda r: (r.path.rsplit("/", 1)[-1].lower(), r.path))
    groups: dict[tuple, list[str]] = {}
    order: dict[str, str] = {}
    for r in by_name:
        names = column_names(bytes(r.header), r.encoding)
        for c in names:
            order.setdefault(c.lower(), c)
        groups.setdefault((names, r.encoding, r.filled), []).append(literal_path(plain_path(r.path)))
    whole = None
    for (names, encoding, filled), files in groups.items():
        rows = read_layout(spark, files, list(names), encoding, filled if header_skip_rows > 0 else None, multiline)
        whole = rows if whole is None else whole.unionByName(rows, allowMissingColumns=True)
    return whole.select(*[F.col(f"`{c}`") for c in order.values()], "source_file_name")
