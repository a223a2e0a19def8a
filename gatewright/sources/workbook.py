"""Workbooks (zipped XML) as grids of text cells, and grids as tables.

Two passes over the files: one lists the tabs, the other gives each chosen tab to
a task of its own, whatever workbook it is in; tabs that are not wanted are never
parsed.  A number in a cell with a date format is a date, as text.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.functions import expr as X

GRID = "path string, tab_index int, tab_name string, row_no int, cells array<string>"
ALL_TABS = ("*", "ALL", "ALL_SHEETS")


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _text(node: ElementTree.Element) -> str:
    """The text of all runs, without phonetic hints."""
    return "".join(t.text or "" for part in node if _local(part.tag) in ("t", "r") for t in part.iter() if _local(t.tag) == "t")


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]*", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


#: Numbers of the formats for dates and times that every workbook knows.
_DATES, _TIMES = {*range(14, 18), 22, *range(27, 37), *range(50, 59)}, {*range(18, 22), *range(45, 48)}
_QUOTED = re.compile(r'"[^"]*"|\\.|_.|\[[^\]]*\]|General', re.I)


def format_kind(number: int, code: str | None) -> str | None:
    """date, time or None of a number format: by its number, or by the letters of its code outside quotes and brackets."""
    if code is None:
        return "date" if number in _DATES else "time" if number in _TIMES else None
    letters = set(_QUOTED.sub("", code).split(";")[0].lower())
    if letters & set("yd") or ("m" in letters and not letters & set("hs")):
        return "date"
    return "time" if letters & set("hs") else None


def date_text(serial: float, kind: str, from_1904: bool) -> str:
    """A serial number as ISO text: a date, a date and time if it has one, or a time; the 29th of February 1900, which was none, is the 28th."""
    if kind == "time" and 0 <= serial < 1:
        return (dt.datetime(2000, 1, 1) + dt.timedelta(seconds=round(serial * 86400))).strftime("%H:%M:%S")
    origin = dt.datetime(1904, 1, 1) if from_1904 else dt.datetime(1899, 12, 31) if serial < 60 else dt.datetime(1899, 12, 30)
    at = origin + dt.timedelta(seconds=round(serial * 86400))
    return at.strftime("%Y-%m-%d" if at.time() == dt.time() else "%Y-%m-%d %H:%M:%S")


def _sheets(z: zipfile.ZipFile) -> tuple[list[tuple[str, str]], bool]:
    """(name, member) of each tab in order, and whether dates count from 1904."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
    book = ElementTree.fromstring(z.read("xl/workbook.xml"))
    from_1904 = any(_local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true") for e in book.iter())
    found = []
    for sheet in (e for e in book.iter() if _local(e.tag) == "sheet"):
        target = targets[next(v for k, v in sheet.attrib.items() if _local(k) == "id")].lstrip("/")
        found.append((sheet.get("name"), target if target.startswith("xl/") else f"xl/{target}"))
    return found, from_1904


def _styles(z: zipfile.ZipFile) -> list[str | None]:
    """date, time or None of each cell style."""
    if "xl/styles.xml" not in z.namelist():
        return []
    root = ElementTree.fromstring(z.read("xl/styles.xml"))
    codes = {int(e.get("numFmtId")): e.get("formatCode") or "" for e in root.iter() if _local(e.tag) == "numFmt"}
    cells = next((e for e in root if _local(e.tag) == "cellXfs"), ())
    return [format_kind(n := int(x.get("numFmtId") or 0), codes.get(n)) for x in cells]


def sheet_rows(content: bytes, only: int | None = None) -> Iterator[tuple[int, str, int, list[str | None]]]:
    """tab_index, tab_name, row_no (from 0, gaps filled by later padding), cells of one workbook, or of one tab of it; a sheet is parsed as it is read."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = [_text(e) for e in ElementTree.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in z.namelist() else []
        sheets, from_1904 = _sheets(z)
        styles = _styles(z)
        for index, (name, member) in enumerate(sheets):
            if only is not None and index != only:
                continue
            with z.open(member) as f:
                for _, row in ElementTree.iterparse(f):
                    if _local(row.tag) != "row":
                        continue
                    cells: list[str | None] = []
                    for c in row:
                        at = _column(c.get("r") or "") if c.get("r") else len(cells)
                        cells += [None] * (at - len(cells) + 1)
                        value, kind = next((v.text for v in c if _local(v.tag) == "v"), None), c.get("t")
                        if kind == "s" and value is not None:
                            value = shared[int(value)]
                        elif kind == "inlineStr":
                            value = next((_text(v) for v in c if _local(v.tag) == "is"), None)
                        elif kind == "b" and value is not None:
                            value = "TRUE" if value == "1" else "FALSE"
                        elif kind in (None, "n") and value is not None and int(c.get("s") or 0) < len(styles) and (style := styles[int(c.get("s") or 0)]):
                            value = date_text(float(value), style, from_1904) if 0 <= float(value) < 2_958_466 else value
                        cells[at] = value
                    yield index, name, int(row.get("r", 1)) - 1, cells
                    row.clear()


def books_at(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, content of each workbook."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def list_tabs(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, tab_index, tab_name of every tab of every workbook; no sheet is parsed."""
    return tabs_of(books_at(spark, path))


def tabs_of(books: DataFrame) -> DataFrame:

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content in zip(f["path"], f["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    tabs = [n for n, _ in _sheets(z)[0]]
                yield pd.DataFrame({"path": name, "tab_index": range(len(tabs)), "tab_name": tabs})

    return books.mapInPandas(run, "path string, tab_index int, tab_name string")


def sheet_grid(spark: SparkSession, path: str | list[str], wanted: str | None = "*", tasks: int | None = None) -> DataFrame:
    """path, tab_index, tab_name, row_no, cells of every row of the wanted tabs (see tab_matches) of every workbook under path."""
    return grid_of(books_at(spark, path), wanted, tasks)


def grid_of(books: DataFrame, wanted: str | None = "*", tasks: int | None = None) -> DataFrame:
    """sheet_grid() of a frame of books (path, content); paths are unique."""
    chosen = tabs_of(books).where(tab_matches(F.col("tab_name"), F.col("tab_index"), wanted)).select("path", "tab_index")
    each = chosen.join(books, "path").repartition(tasks or int(books.sparkSession.conf.get("spark.sql.shuffle.partitions")), "path", "tab_index")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for name, content, tab in zip(f["path"], f["content"], f["tab_index"]):
                part = []
                for row in sheet_rows(content, tab):
                    part.append((name, *row))
                    if len(part) == 5000:
                        yield pd.DataFrame(part, columns=["path", "tab_index", "tab_name", "row_no", "cells"])
                        part = []
                if part:
                    yield pd.DataFrame(part, columns=["path", "tab_index", "tab_name", "row_no", "cells"])

    return each.select("path", "content", "tab_index").mapInPandas(run, GRID)


def read_workbooks(spark: SparkSession, path: str | list[str], wanted: str | None = None, header_skip_rows: int = 0) -> DataFrame:
    """One table of the wanted tabs of workbooks, with excel_tab_name and source_file_name; no such tab is an error."""
    if not list_tabs(spark, path).where(tab_matches(F.col("tab_name"), F.col("tab_index"), wanted)).limit(1).count():
        raise ValueError(f"no tab matches {wanted!r}")
    rows = tables(sheet_grid(spark, path, wanted), header_skip_rows, "excel_tab_name")
    name = F.url_decode(F.replace(F.element_at(F.split("source_path", "/"), -1), F.lit("+"), F.lit("%2B")))
    return rows.withColumn("source_file_name", name).drop("source_path")


def tab_matches(tab: Column, index: Column, wanted: str | None) -> Column:
    """Blank: the first tab; * or ALL: every tab; REGEX:p: tabs in which p is found; else the tab of that name."""
    w = (wanted or "").strip()
    if not w:
        return index == 0
    if w.upper() in ALL_TABS:
        return F.lit(True)
    if w.upper().startswith("REGEX:"):
        return tab.rlike(w[6:].strip())
    return tab == w


def select_tabs(grid: DataFrame, wanted: str | None) -> DataFrame:
    rows = grid.where(tab_matches(F.col("tab_name"), F.col("tab_index"), wanted))
    if rows.limit(1).count() == 0:
        raise ValueError(f"no tab matches {wanted!r}")
    return rows


def names_of(cells: Column) -> Column:
    """Column names from the cells of a header row: a blank one is named by its place, a repeated one gets .1, .2, ..."""
    named = F.transform(cells, lambda c, k: F.coalesce(F.nullif(X.strip(c), F.lit("")), F.concat(F.lit("Unnamed: "), k.cast("string"))))

    def numbered(x: Column) -> Column:
        def one(name: Column, k: Column) -> Column:
            before = F.size(F.filter(F.slice(x, F.lit(1), k), lambda y: y == name))
            return F.when(before > 0, F.concat(name, F.lit("."), before.cast("string"))).otherwise(name)

        return F.transform(x, one)

    return F.get(F.transform(F.array(named), numbered), F.lit(0))


def tables(grid: DataFrame, header_skip_rows: int = 0, tab_column: str = "tab_name") -> DataFrame:
    """One table of all tabs in grid, by column name; a column that a tab lacks is null in its rows.

    Only the names of the columns come to the driver, in order of place and name.
    Tabs of several layouts meet their header rows by a join, and each cell is
    found by its name's place.  Short rows are padded with nulls, and cells beyond
    the header are cut.
    """
    at = max(header_skip_rows, 0)
    heads = grid.where(F.col("row_no") == at).select("path", "tab_index", names_of(F.col("cells")).alias("_names"))
    found = heads.select("_names").distinct().select(F.posexplode("_names").alias("at", "name")).groupBy("name").agg(F.min("at").alias("at"), F.count("*").alias("n")).orderBy("at", "name").collect()
    if not found:
        raise ValueError("no header row")
    rows = grid.where(F.col("row_no") > at)
    if len({r["at"] for r in found}) == len(found) and all(r["n"] == 1 for r in found):  # one layout
        cells = [F.get("cells", F.lit(r["at"])).alias(r["name"]) for r in found]
    else:
        rows = rows.join(heads, ["path", "tab_index"])
        cells = [F.get("cells", F.array_position("_names", F.lit(r["name"])).cast("int") - 1).alias(r["name"]) for r in found]
    return rows.select(*cells, F.col("tab_name").alias(tab_column), F.col("path").alias("source_path"))
