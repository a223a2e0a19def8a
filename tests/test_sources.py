from __future__ import annotations

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gatewright.sources import control, files, workbook
from gatewright.streaming import ingest


def test_csv_preamble_of_each_file_is_dropped(spark, tmp_path):
    for n in (1, 2):
        (tmp_path / f"f{n}.csv").write_text(f'report {n}\n\nid,name,name,\n{n},"a ""x"", b",c,d\n{n + 10},e,,\n')
    rows = files.read_csv(spark, str(tmp_path), header_skip_rows=2)
    assert rows.columns == ["id", "name", "name.1", "Unnamed: 3", "source_file_name"]
    assert sorted((r.id, r.name, r.source_file_name) for r in rows.select("id", "name", "source_file_name").collect()) == [
        ("1", 'a "x", b', "f1.csv"), ("11", "e", "f1.csv"), ("12", "e", "f2.csv"), ("2", 'a "x", b', "f2.csv")
    ]


def test_csv_without_preamble(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfid,v\n1,x\n")
    rows = files.read_csv(spark, str(tmp_path))
    assert rows.columns == ["id", "v", "source_file_name"] and [tuple(r) for r in rows.collect()] == [("1", "x", "a.csv")]


def test_encodings_are_decided_by_whole_files(spark, tmp_path):
    (tmp_path / "u.csv").write_text("é\n", encoding="utf-8")
    (tmp_path / "w.csv").write_bytes(b"plain\ncaf\xe9 \x80\n")
    (tmp_path / "l.csv").write_bytes(b"\x81\xe9\n")
    got = {r.path[-5:]: r.encoding for r in files.encodings(spark, str(tmp_path)).collect()}
    assert got == {"u.csv": "utf-8", "w.csv": "windows-1252", "l.csv": "iso-8859-1"}
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "w.csv").write_bytes(b"t\xeate,b\n\x80,2\n")
    assert files.read_csv(spark, str(tmp_path / "one"), encoding="windows-1252").columns[0] == "tête"


def test_inventory_patterns_and_sizes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    for name in ("a_1.csv", "a+2.csv", "sub/b.csv"):
        (tmp_path / name).write_text("x" * len(name))
    found = files.inventory(spark, str(tmp_path), recursive=True)
    assert {(r.file_name, r.depth) for r in found.collect()} == {("a_1.csv", 0), ("a+2.csv", 0), ("b.csv", 1)}
    assert {r.file_name for r in files.select_files(found, "a+*.csv").collect()} == {"a+2.csv"}
    assert files.select_files(found, " ", several=False).count() == 1
    assert files.oversize(found, 8).count() == 1


def test_parquet_limit(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "t"))
    assert files.read_parquet(spark, str(tmp_path / "t")).count() == 10
    with pytest.raises(ValueError, match="SIZE_LIMIT"):
        files.read_parquet(spark, str(tmp_path / "t"), most_bytes=10)


def book(path, tabs):
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", '<workbook xmlns:r="r"><sheets>' + "".join(f'<sheet name="{n}" r:id="i{k}"/>' for k, n in enumerate(tabs)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="i{k}" Target="worksheets/s{k}.xml"/>' for k in range(len(tabs))) + "</Relationships>")
        z.writestr("xl/sharedStrings.xml", "<sst><si><t>id</t></si><si><r><t>na</t></r><r><t>me</t></r></si></sst>")
        for k, rows in enumerate(tabs.values()):
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet><sheetData>{rows}</sheetData></worksheet>")


def test_workbook_tabs(spark, tmp_path):
    head = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
    book(tmp_path / "b.xlsx", {"North": head + '<row r="2"><c r="B2" t="inlineStr"><is><t>x</t></is></c></row>', "South": head + '<row r="2"><c r="A2"><v>7</v></c></row>', "Notes": head})
    grid = workbook.sheet_grid(spark, str(tmp_path))
    two = workbook.tables(workbook.select_tabs(grid, "REGEX:th$"))
    assert sorted((r.id or "", r.name or "", r.tab_name) for r in two.collect()) == [("", "x", "North"), ("7", "", "South")]
    assert {r.tab_name for r in workbook.select_tabs(grid, "").collect()} == {"North"}
    assert workbook.select_tabs(grid, "all").select("tab_name").distinct().count() == 3
    with pytest.raises(ValueError):
        workbook.select_tabs(grid, "West")


def test_workbook_tabs_of_several_layouts(spark):
    rows = [
        ("a", 0, "North", 0, ["id", "name"]), ("a", 0, "North", 1, ["1", "x", "beyond"]), ("a", 1, "South", 0, ["name", None, "name"]), ("a", 1, "South", 1, ["y", "u"]),
        ("b", 0, "East", 0, ["id", "name"]), ("b", 0, "East", 2, ["3"]),
    ]
    grid = spark.createDataFrame(rows, workbook.GRID)
    whole = workbook.tables(grid)
    assert whole.columns == ["id", "name", "Unnamed: 1", "name.1", "tab_name", "source_path"]
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(
        [("1", "x", None, None, "North", "a"), (None, "y", "u", None, "South", "a"), ("3", None, None, None, "East", "b")], key=str
    )
    assert workbook.tables(grid.where("tab_name <> 'South'")).columns == ["id", "name", "tab_name", "source_path"]
    with pytest.raises(ValueError, match="no header row"):
        workbook.tables(grid, header_skip_rows=9)


def test_control(spark):
    rows = [(1, 1, "a", "y", None, False), (2, 1, "b", "1", " test ", False), (3, 2, "c", "0", "real", False), (4, 2, "d", "Y", "", True), (5, 2, "e", None, None, None)]
    c = spark.createDataFrame(rows, "id int, process_id int, workflow_id string, is_active string, ingestion_scope string, is_test_data boolean")
    assert [r.id for r in control.select_control(c).orderBy("id").collect()] == [1]
    assert [r.id for r in control.select_control(c, scope="test").orderBy("id").collect()] == [2, 4]
    assert [r.id for r in control.guard_violations(c).orderBy("id").collect()] == [2, 4]
    p = spark.createDataFrame([("https://h/sites/x/Docs/",), ("Docs",), ("/sites/X/Docs",), ("",)], "p string")
    assert [r[0] for r in p.select(control.normalise_path(F.col("p"), "/sites/x")).collect()] == ["/sites/x/Docs", "/sites/x/Docs", "/sites/X/Docs", "/sites/x"]


def test_stream_quarantines_batches_with_known_keys(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    at = {k: str(tmp_path / k) for k in ("checkpoint", "target", "quarantine", "issues")}
    schema = StructType.fromDDL("id string, v string")

    def arrive(name, text):
        (inbox / name).write_text("id,v\n" + text)
        ingest.stream_csv(spark, str(inbox), schema, key=["id"], **at).awaitTermination()

    arrive("a.csv", "1,a\n2,b\n")
    arrive("b.csv", "2,c\n3,d\n")
    arrive("c.csv", "4,e\n")
    arrive("d.csv", "5,e\n5,f\n")
    assert sorted(r.id for r in spark.read.parquet(at["target"]).collect()) == ["1", "2", "4"]
    assert sorted(r.id for r in spark.read.parquet(at["quarantine"]).collect()) == ["2", "3", "5", "5"]
    assert sorted(r.code for r in spark.read.parquet(at["issues"]).collect()) == ["DUPLICATE_IN_LOAD", "KEY_IN_TARGET"]
