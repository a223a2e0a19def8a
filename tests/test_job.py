from __future__ import annotations

from dataclasses import replace

import pytest
from gatewright.operators import dates
from gatewright.operators.job import Config, choose_files, run_load
from gatewright.operators.validate import Column
from gatewright.sources import workbook
from gatewright.sources.files import move_files
from gatewright.sources.versions import VersionedTable
from pyspark.sql import functions as F

from test_sources import book

CONTRACT = (Column("id", "int", is_key=True), Column("day", "date"), Column("amount", "decimal", precision=9, scale=2), Column("note", "varchar", char_len=10))


@pytest.fixture
def place(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    at = {"ledger": str(tmp_path / "ledger"), "issues": str(tmp_path / "issues"), "staging": VersionedTable(spark, str(tmp_path / "staging")), "target": VersionedTable(spark, str(tmp_path / "target"))}
    config = lambda **more: Config("wf", str(inbox), CONTRACT, "*.csv", mapping='{"Id": "id"}', keys=("id",), processed=str(tmp_path / "done"), failed=str(tmp_path / "bad"), **more)
    return inbox, at, config


def events(spark, at):
    return sorted((r.file_name, r.seq, r.status, r.rows_loaded, r.disposition) for r in spark.read.parquet(at["ledger"]).collect())


def test_a_load_goes_from_files_to_target_and_ledger(spark, place, tmp_path):
    inbox, at, config = place
    (inbox / "b.csv").write_text("Id,day,amount,note\n1,13/02/2024, 1.50 ,x\n2,01/02/2024,2,y\n")
    (inbox / "A %[1].csv").write_bytes(b"note,day,amount,Id\ncaf\xe9,2024-03-01,3.25,3\n")
    (inbox / "other.txt").write_text("no")
    assert [n for _, n in choose_files(spark, config())] == ["A %[1].csv", "b.csv"]
    out = run_load(spark, config(strategy="APPEND"), **at)
    assert out.error is None and (out.rows_scanned, out.rows_loaded) == (3, 3)
    rows = sorted((r.id, str(r.day), str(r.amount), r.note, r.source_file_name, r.audit_id == out.run_id) for r in at["target"].read().collect())
    assert rows == [(1, "2024-02-13", "1.50", "x", "b.csv", True), (2, "2024-02-01", "2.00", "y", "b.csv", True), (3, "2024-03-01", "3.25", "café", "A %[1].csv", True)]
    assert events(spark, at) == [("A %[1].csv", 1, "STARTED", 0, None), ("A %[1].csv", 2, "SUCCESS", 1, "processed"), ("b.csv", 1, "STARTED", 0, None), ("b.csv", 2, "SUCCESS", 2, "processed")]
    assert sorted(p.name for p in inbox.iterdir() if not p.name.startswith(".")) == ["other.txt"]
    # the same keys again: the target is untouched, the file goes to the failed ones
    (inbox / "b.csv").write_text("Id,day,amount,note\n3,13/02/2024,1,x\n4,14/02/2024,1,x\n")
    again = run_load(spark, config(strategy="APPEND"), **at)
    assert "PRIMARY_KEY_VIOLATION" in again.error and at["target"].read().count() == 3 and (tmp_path / "bad" / "b.csv").exists()
    (inbox / "b.csv").write_text("Id,day,amount,note\n4,14/02/2024,1,x\n")
    assert run_load(spark, config(strategy="APPEND"), **at).error is None and at["target"].read().count() == 4
    assert {p.name for p in (tmp_path / "done").iterdir() if p.suffix == ".csv"} == {"A %[1].csv", "b.csv"}
    assert run_load(spark, config(), **at).files == []


def test_dates_of_a_load_are_judged_once_and_read_as_moments(spark, place, monkeypatch):
    inbox, at, config = place
    contract = (*CONTRACT[:2], Column("seen", "datetime2"), Column("at", "time"))
    (inbox / "a.csv").write_text("Id,day,seen,at\n1,13/02/2024,2024-02-13 10:05:06.25,13/02/2024\n2, 01/02/2024 ,,\n3,,01/02/2024,\n")
    (inbox / "b.csv").write_text("Id,day,seen,at\n4,02/13/2024,02/13/2024 1:05 pm,02/03/2024\n5,02/01/2024,02/01/2024,02/13/2024\n")
    judged, one = [], dates.order_evidence
    monkeypatch.setattr(dates, "order_evidence", lambda df, column, by=None: (judged.append(column), one(df, column, by))[1])
    out = run_load(spark, replace(config(), contract=contract), **at)
    assert out.error is None and judged == ["day", "seen", "at"]
    rows = [tuple(None if x is None else str(x) for x in r) for r in at["target"].read().orderBy("id").select("id", "day", "seen", "at").collect()]
    assert rows == [
        ("1", "2024-02-13", "2024-02-13 10:05:06.250000", "2024-02-13"), ("2", "2024-02-01", None, None), ("3", None, "2024-02-01 00:00:00", None),
        ("4", "2024-02-13", "2024-02-13 13:05:00", "2024-02-03"), ("5", "2024-02-01", "2024-02-01 00:00:00", "2024-02-13"),
    ]


def test_rows_of_a_file_are_not_sent_to_one_task_for_its_dates(spark, monkeypatch):
    df = spark.createDataFrame([(f"f{k % 5}", f"{13 + k % 9}/02/2024" if k % 2 else f"02/{13 + k % 9}/2024") for k in range(0, 10)] + [(None, "1/2/2024"), ("g", "n/a")], "f string, v string")
    df = df.withColumn("f", F.concat("f", F.substring("v", 1, 1)))
    got = dates.normalise_dates(df, "v", "ts", by=["f"], text_out="t")
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(dates, "GROUPS", 2)  # more groups than that: a join
    assert dates.known_evidence(dates.order_evidence(df, "v", ["f"])) is None
    assert sorted(map(str, dates.normalise_dates(df, "v", "ts", by=["f"], text_out="t").collect())) == sorted(map(str, got.collect()))
    assert sum(r.ts is None for r in got.collect()) == 1


def test_a_load_with_errors_stops_before_staging(spark, place):
    inbox, at, config = place
    (inbox / "a.csv").write_text("Id,day,amount,note\nx,13/02/2024,1,much too long a note\n")
    (inbox / "b.csv").write_text("Id,day,amount,note\n1,13/02/2024,1,a\n2,02/13/2024,1,b\n")
    out = run_load(spark, config(), **at)
    assert out.error == "ValueError: VALIDATION_FAILED: CONFLICTING_DATE_ORDERS, STRING_LENGTH_EXCEEDED, TYPE_MISMATCH"
    assert at["staging"].numbers() == [] and at["target"].numbers() == []
    assert {r.status for r in spark.read.parquet(at["ledger"]).collect()} == {"STARTED", "FAILED"}
    assert spark.read.parquet(at["issues"]).where("severity = 'ERROR'").count() == 3


def test_a_staging_only_load_promotes_nothing(spark, place):
    inbox, at, config = place
    (inbox / "a.csv").write_text("Id,day,amount,note\n1,13/02/2024,1,a\n")
    out = run_load(spark, config(staging_only=True), at["staging"], None, at["ledger"], at["issues"])
    assert out.error is None and at["staging"].read().count() == 1 and at["target"].numbers() == []
    (inbox / "a.csv").write_text("Id,day,amount,note\n1,13/02/2024,1,a\n")
    assert "needs a target" in run_load(spark, config(), at["staging"], None, at["ledger"], at["issues"]).error


def test_files_of_two_kinds_are_an_error(spark, place):
    inbox, at, config = place
    (inbox / "a.csv").write_text("Id\n1\n")
    spark.range(1).write.parquet(str(inbox / "p"))
    part = next((inbox / "p").glob("*.parquet"))
    part.rename(inbox / "b.parquet")
    from dataclasses import replace

    assert "several or unknown kinds" in run_load(spark, replace(config(), pattern="?.*"), **at).error


def test_moved_files_replace_each_other_or_do_not(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(3):
        (tmp_path / "in" / "a b.csv").write_text(str(k))
        assert move_files(spark, [str(tmp_path / "in" / "a b.csv")], str(tmp_path / "out"), replace=False) == [["a b.csv"], ["a b_2.csv"], ["a b_3.csv"]][k]
    assert move_files(spark, [str(tmp_path / "in" / "a b.csv")], str(tmp_path / "out")) == []
    assert (tmp_path / "out" / "a b_3.csv").read_text() == "2"
    (tmp_path / "in" / "a b.csv").write_text("9")
    assert move_files(spark, [str(tmp_path / "in" / "a b.csv")], str(tmp_path / "out")) == ["a b.csv"]
    assert (tmp_path / "out" / "a b.csv").read_text() == "9"


# workbooks


def test_only_wanted_tabs_are_parsed_each_by_its_own(spark, tmp_path):
    head = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
    book(tmp_path / "one book.xlsx", {"North": head + '<row r="2"><c r="A2"><v>1</v></c></row>', "South": head + '<row r="2"><c r="A2"><v>2</v></c></row>', "Broken": "<row><c"})
    book(tmp_path / "two.xlsx", {"South": head + '<row r="2"><c r="A2"><v>3</v></c></row>'})
    assert sorted((r.tab_index, r.tab_name) for r in workbook.list_tabs(spark, str(tmp_path)).collect()) == [(0, "North"), (0, "South"), (1, "South"), (2, "Broken")]
    rows = workbook.read_workbooks(spark, str(tmp_path), "REGEX:th$")
    assert sorted((r.id, r.excel_tab_name, r.source_file_name) for r in rows.collect()) == [("1", "North", "one book.xlsx"), ("2", "South", "one book.xlsx"), ("3", "South", "two.xlsx")]
    parts = workbook.sheet_grid(spark, str(tmp_path), "REGEX:th$", 64).select("path", "tab_index", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(parts) == 3 and len({r.p for r in parts}) > 1
    with pytest.raises(ValueError, match="no tab matches"):
        workbook.read_workbooks(spark, str(tmp_path), "West")
    with pytest.raises(Exception, match="ParseError|no element|unclosed|mismatched|not well-formed"):
        workbook.read_workbooks(spark, str(tmp_path), "Broken").collect()


def test_cells_with_a_date_format_are_dates():
    kinds = {(14, None): "date", (22, None): "date", (21, None): "time", (2, None): None, (165, "dd/mm/yyyy"): "date", (166, "mmm-yy"): "date", (167, '0.00" days"'): None, (168, "[h]:mm:ss"): "time", (169, "#,##0;[Red]-#,##0"): None, (170, "General"): None, (171, "m/d/yyyy h:mm"): "date"}
    assert {k: workbook.format_kind(*k) for k in kinds} == kinds
    assert workbook.date_text(45292, "date", False) == "2024-01-01" and workbook.date_text(45292.75, "date", False) == "2024-01-01 18:00:00"
    assert workbook.date_text(0.5, "time", False) == "12:00:00" and workbook.date_text(1, "date", False) == "1900-01-01" and workbook.date_text(61, "date", False) == "1900-03-01"
    assert workbook.date_text(0, "date", True) == "1904-01-01"


def test_workbook_dates_are_read(spark, tmp_path):
    import zipfile

    path = tmp_path / "d.xlsx"
    book(path, {"S": '<row r="1"><c r="A1" t="inlineStr"><is><t>day</t></is></c><c r="B1" t="inlineStr"><is><t>n</t></is></c></row><row r="2"><c r="A2" s="1"><v>45292</v></c><c r="B2" s="0"><v>45292</v></c></row>'})
    with zipfile.ZipFile(path, "a") as z:
        z.writestr("xl/styles.xml", '<styleSheet><numFmts><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>')
    assert tuple(workbook.read_workbooks(spark, str(tmp_path)).select("day", "n").first()) == ("2024-01-01", "45292")
