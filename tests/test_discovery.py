from __future__ import annotations

from gatewright.operators import discovery as D


def test_groups_patterns_and_overlap(spark):
    rows = [("Sales_2024.csv", "csv", ["A", "b"]), ("sales 2025.csv", "csv", ["a", "B"]), ("sales_x.csv", "csv", ["q"]), ("1_a.csv", "csv", ["a"]), ("2_a.csv", "csv", ["a"]), ("3_a.csv", "csv", ["z"])]
    grouped = D.discovery_groups(spark.createDataFrame(rows, "file_name string, kind string, columns array<string>"))
    patterns = D.group_patterns(grouped)
    assert {(r.pattern, r.members) for r in patterns.collect()} == {("sales_*.csv", 2), ("sales_x.csv", 1), ("*_a.csv", 2), ("3_a.csv", 1)}
    assert sorted(r.file_name for r in D.pattern_overlap(grouped, patterns).collect()) == ["3_a.csv", "sales_x.csv"]


def test_unconfigured_folders(spark):
    folders = spark.createDataFrame([("/sites/x/In",), ("Out",), ("in/Processed",), ("New",)], "folder string")
    configured = spark.createDataFrame([("in/",), ("https://h/sites/x/OUT",)], "folder string")
    assert [r.folder for r in D.unconfigured_folders(folders, configured, "sites/x").collect()] == ["New"]


def test_code_like_of_an_empty_table(spark):
    assert [tuple(r) for r in D.code_like(spark.createDataFrame([], "a string"), ["a"]).collect()] == [("a", False)]


def test_a_folder_is_discovered(spark, tmp_path):
    from gatewright.operators.discover import discover, table_name

    (tmp_path / "sales_202401.csv").write_text("Order Id,Amount,Sold On\nA1,1.50,13/02/2024\nA2,22.25,14/02/2024\n")
    (tmp_path / "sales_202402.csv").write_bytes(b"Order Id,Amount,Sold On\nB1,3,15/02/2024\n")
    (tmp_path / "sales_202403.csv").write_text("Region,Total\nN,1\nN,1\n")
    (tmp_path / "notes.pdf").write_text("no")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "Processed").mkdir()
    (tmp_path / "Processed" / "old.csv").write_text("x\n1\n")
    found = discover(spark, str(tmp_path), recursive=True)
    assert {r.file_name for r in found.files.collect()} == {"sales_202401.csv", "sales_202402.csv", "sales_202403.csv"}
    control = {r.staging_table_name: r for r in found.control.collect()}
    assert set(control) == {"landing.sales", "landing.sales_2"}
    assert control["landing.sales"].merge_key_columns == "order_id" and control["landing.sales"].load_strategy == "APPEND" and control["landing.sales"].multi_file_ingest
    assert control["landing.sales_2"].load_strategy == "TRUNCATE" and control["landing.sales_2"].file_name_pattern == "sales_202403.csv"
    group = control["landing.sales"].group_id
    kinds = {r.column_name: (r.data_type, r.nullability) for r in found.contracts.where("source_name is not null").collect() if r.group_id == group}
    assert kinds == {"order_id": ("VARCHAR(10)", "NOT NULL"), "amount": ("DECIMAL(18,2)", "NULL"), "sold_on": ("DATE", "NULL")}
    sheet = {r["Source column"]: r["Primary key?"] for r in found.mappings.where(found.mappings.group_id == group).collect() if r["Source column"]}
    assert sheet == {"Order Id": "Y", "Amount": "", "Sold On": ""}
    assert {(r.group_id == group, r.file_name) for r in found.overlap.collect()} == {(True, "sales_202403.csv")}
    assert table_name("{n}_{n}", 3) == "table_3" and table_name("2nd-file", 0) == "table_2nd_file"
