from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from gatewright.functions import expr as X
from gatewright.operators import dates, discovery, enrich, keys, load, profile, reports
from gatewright.operators.validate import Column, blocked, contract_columns, contract_frame, date_columns, schema_issues, text_date_issues
from gatewright.sources import fixtures


def text(spark, values, name="v"):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, `{name}` string")


def inferred(spark, values, name="v", **options):
    stats = profile.column_statistics(text(spark, values, name), [name])
    return profile.narrowest_type(stats, **options).first().raw_type


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1/5/2026 0:00", "2/5/2026 0:00"], "DATETIME2(3)"), (["15/04/2026", "4/16/2026"], "VARCHAR(20)"), (["15/04/2026", "4/5/2026"], "DATE"), (["2000000000"], "INT"), (["3000000000", "-1"], "BIGINT"), (["1.5", "2"], "DECIMAL(18,1)"),
        (["1.123456"], "FLOAT"), (["1e3", "2"], "DECIMAL(18,0)"), (["true", "F"], "BIT"), (["0", "1"], "INT"), ([None, None], "VARCHAR(255)"), (["15/04/26"], "VARCHAR(10)"), (["15/04-2026"], "VARCHAR(20)"), (["x" * 7000], "VARCHAR(MAX)"), (["2026-02-30"], "VARCHAR(20)"),
    ],
)
def test_types_of_text(spark, values, kind):
    assert inferred(spark, values) == kind


def test_types_by_name_and_order(spark):
    assert inferred(spark, ["1.0", "2.0"], "short_name") == "VARCHAR(10)"
    assert inferred(spark, ["15/04/2026"], us_dates=True) == "VARCHAR(20)" and inferred(spark, ["04/15/2026"], us_dates=True) == "DATE"


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [("INT", "INT", "INT"), ("INT", "BIGINT", "BIGINT"), ("BIT", "FLOAT", "FLOAT"), ("DATE", "DATETIME2(3)", "DATETIME2(3)"), ("INT", "DATE", "VARCHAR:50"), ("VARCHAR:3", "BIGINT", "VARCHAR:20"), ("VARCHAR:30", "DECIMAL:20:2", "VARCHAR:30"), ("VARCHAR(MAX)", "INT", "VARCHAR:1000000000"),
     ("DECIMAL:18:2", "BIGINT", "DECIMAL:21:2"), ("DECIMAL(18,2)", "DECIMAL:18:5", "DECIMAL:21:5"), ("DECIMAL:38:0", "DECIMAL:18:5", "FLOAT"), ("DECIMAL:18:1", "FLOAT", "FLOAT"), ("DECIMAL:18:1", "DATE", "VARCHAR:50")],
)
def test_merge_types(spark, a, b, both):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(X.merge_types(F.col("a"), F.col("b")), X.merge_types(F.col("b"), F.col("a"))).first() == (both, both)


def test_statistics_add_up(spark):
    df = spark.createDataFrame([(k % 3, str(k * 1.5), f"{k % 28 + 1}/1/2026", None) for k in range(40)], "f int, a string, b string, c string")
    whole = sorted(tuple(r) for r in profile.column_statistics(df, ["a", "b", "c"]).collect())
    parts = profile.merge_statistics(profile.column_statistics(df, ["a", "b", "c"], by=["f"]))
    assert sorted(tuple(r) for r in parts.select(*profile.column_statistics(df, ["a"]).columns).collect()) == whole
    assert [r.rows for r in profile.column_statistics(df.limit(0)).collect()] == [0] * 4


def test_mixed_and_forced_orders(spark):
    rows = text(spark, ["15/04/2026", "4/16/2026", "2026-01-02 3:04 PM", None, ""])
    got = dates.normalise_dates(rows, "v", "ts", mode="mixed").orderBy("k").collect()
    assert [r.ts for r in got] == [datetime(2026, 4, 15), datetime(2026, 4, 16), datetime(2026, 1, 2, 15, 4), None, None]
    assert dates.date_issues(rows, "v").first().code == "CONFLICTING_DATE_ORDERS"
    with pytest.raises(Exception, match="CONFLICTING"):
        dates.normalise_dates(rows, "v", "ts").collect()
    open_ = text(spark, ["4/5/2026", "16/5/2026"])
    assert [r.ts for r in dates.normalise_dates(open_, "v", "ts", mode="mixed").orderBy("k").collect()] == [datetime(2026, 5, 4), datetime(2026, 5, 16)]
    assert dates.date_issues(text(spark, ["4/5/2026"]), "v", mode="mixed").first().code == "AMBIGUOUS_DATES"
    with pytest.raises(Exception, match="FORCED_US"):
        dates.normalise_dates(open_, "v", "ts", us=True).collect()
    kept = dates.normalise_dates(text(spark, ["1/5/2026", "n/a"]), "v", "ts", text_out="t").orderBy("k").collect()
    assert [(r.ts, r.t) for r in kept] == [(None, "1/5/2026"), (None, "n/a")]


def test_order_of_each_file(spark):
    df = spark.createDataFrame([("a", "4/5/2026"), ("a", "16/5/2026"), ("b", "4/5/2026"), ("b", "4/16/2026"), (None, "4/5/2026")], "f string, v string")
    got = {(r.f, r.v): r.ts for r in dates.normalise_dates(df, "v", "ts", by=["f"]).collect()}
    assert got[("a", "4/5/2026")] == datetime(2026, 5, 4) and got[("b", "4/5/2026")] == datetime(2026, 4, 5) and got[(None, "4/5/2026")] == datetime(2026, 5, 4)
    merged = dates.merge_evidence(dates.order_evidence(df, "v", by=["f"]))
    assert merged.first().asDict() == dates.order_evidence(df, "v").first().asDict()


def test_schema_issues(spark):
    contract = contract_frame(spark, [Column("A", "int"), Column("b", "int"), Column("gone", "int"), Column("lost", "int"), Column("audit_id", "int")])
    got = {r.code: r.column_name for r in schema_issues(contract, ["B", " a", "new", "audit_id"]).collect()}
    assert got == {"MISSING_DEST_COLUMNS_IN_SOURCE": "gone,lost", "ADDITIONAL_SOURCE_COLUMNS": "new", "COLUMN_REORDERING_DETECTED": "b,a"}
    assert schema_issues(contract, ["a", "b", "gone", "lost"]).count() == 0


def test_contract_of_a_table_and_text_dates(spark):
    table = spark.createDataFrame([], "id bigint, d date, amount decimal(9,2), name string, audit_id timestamp")
    contract = contract_frame(spark, contract_columns(table, keys=["id"]))
    assert [r.column_name for r in date_columns(contract).collect()] == ["d"]
    df = spark.createDataFrame([("x",), ("1/2/2026",), ("1/2/2026",), ("2026-01-01",)], "D string")
    assert [r.detail for r in text_date_issues(df, contract).collect()] == ["count=3, samples=1/2/2026, 2026-01-01"]
    assert text_date_issues(table, contract).count() == 0


def test_upsert_of_some_columns(spark):
    t = spark.createDataFrame([(1, "x", 1.0), (2, "y", 2.0), (None, "n", 0.0)], "id int, v string, w double")
    s = spark.createDataFrame([(2, 9.0), (3, 8.0), (None, 7.0)], "id int, w double")
    assert sorted(map(str, load.upsert(t, s, ["id"]).collect())) == sorted(map(str, spark.createDataFrame([(1, "x", 1.0), (2, "y", 9.0), (3, None, 8.0), (None, "n", 0.0), (None, None, 7.0)], t.schema).collect()))
    assert load.upsert(t, s.select("id").where("id = 3"), ["id"]).count() == 4
    with pytest.raises(ValueError, match="repeat"):
        load.upsert(t, s.union(s), ["id"])


def test_guarded_writes(spark, tmp_path):
    df, path = spark.createDataFrame([(1, "a")], "id int, v string"), str(tmp_path / "t")
    load.write_truncate(df, path)
    assert load.write_append(df.limit(0), path, ["id"]) is False
    for bad in (df, spark.createDataFrame([(2, "a"), (2, "b")], df.schema)):
        with pytest.raises(ValueError, match="PRIMARY_KEY_VIOLATION"):
            load.write_append(bad, path, ["id"])
    assert load.write_append(df.withColumn("id", F.lit(5)), path, ["id"]) and spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="PRIMARY_KEY_VIOLATION"):
        load.write_swap(spark, df.union(df), str(tmp_path), "9", keys=["id"])


def test_keys_are_found(spark):
    df = spark.createDataFrame([(f"TXN-{k:03d}", "free text here", k % 4, k // 4, None) for k in range(20)], "code string, note string, a int, b int, x_id int")
    assert keys.key_candidates(df) == ["code", "a", "b", "x_id"] and keys.infer_key(df) == ["code"]
    assert keys.infer_key(df.drop("code")) == ["a", "b"] and keys.infer_key(df.select("note")) is None
    tabs = df.select((F.col("a") % 2).alias("a"), F.col("b"), (F.col("a") >= 2).cast("string").alias("excel_tab_name"))
    assert keys.infer_key(tabs, tab="excel_tab_name") == ["a", "b", "excel_tab_name"]
    assert keys.key_report(df.select("note")).first().strategy == "TRUNCATE"
    names = ["id", "x_id", "id_x", "paid", "no", "no_x", "x_no", "a_no_b", "guid_x", "number"]
    assert [r.v for r in text(spark, names).where(F.col("v").rlike(X.KEY_NAME)).orderBy("k").collect()] == ["id", "x_id", "id_x", "no", "no_x", "x_no", "guid_x"]


def test_typed_projection_loses_nothing_silently(spark):
    df = spark.createDataFrame([("1", "1.25", "2/1/2026", "t", "long"), ("x", "1.255", "31/13/2026", "yes", "ok"), (" ", None, None, None, None)], "Id string, amount string, day string, flag string, v string")
    out = enrich.typed_projection(df, [Column("id", "int"), Column("amount", "decimal", precision=5, scale=2), Column("day", "date"), Column("flag", "bit"), Column("v", "varchar", char_len=3), Column("new", "int")])
    assert [tuple(r) for r in out.collect()] == [(1, Decimal("1.25"), date(2026, 1, 2), True, None, None, 1), (None, None, None, None, "ok", None, 4), (None,) * 6 + (0,)]


def test_mapping_and_lineage(spark):
    df = spark.createDataFrame([(1, " ", "x")], "` id ` int, Excel_Tab_Name string, audit_ID string")
    assert enrich.apply_mapping(df, '{"id": "key"}').columns == ["key", "Excel_Tab_Name", "audit_ID"] and enrich.apply_mapping(df, " ").columns[0] == "id"
    with pytest.raises(ValueError):
        enrich.apply_mapping(df, "[1]")
    row = enrich.enrich(df, ["excel_tab_name", "AUDIT_ID", "source_file_name"], F.lit("f.csv"), "Tab", audit_id=F.lit(7)).first().asDict()
    assert row == {" id ": 1, "Excel_Tab_Name": "Tab", "audit_ID": 7, "source_file_name": "f.csv"}


def test_reports(spark):
    line = spark.range(1).select(reports.format_issue(F.lit("ERROR"), F.lit("C_1"), F.lit("text"), F.lit("")).alias("x"))
    assert line.select(reports.parse_issue(F.col("x")).alias("p")).first().p.asDict() == {"severity": "ERROR", "code": "C_1", "message": "text", "tab_name": None, "file_name": None, "duplicates": None}
    issues = spark.createDataFrame([(1, "WARNING"), (2, "WARNING"), (2, "ERROR")], "load int, severity string")
    assert {r.load: r.blocked for r in blocked(issues, "load").collect()} == {1: False, 2: True}
    events = load.unite_ledgers(load.ledger_events(spark, "a", 1, "STARTED"), load.ledger_events(spark, "a", 2, "SUCCESS", rows=5), load.ledger_events(spark, "b", 1, "FAILED"))
    assert {(r.audit_id, r.status, r.rows) for r in load.current_audit(events, "audit_id", "seq", "status", "rows").collect()} == {("a", "SUCCESS", 5), ("b", "FAILED", None)}


def test_discovery_output(spark):
    rows = spark.createDataFrame([("f.xlsx", "s1", "1", "x"), ("f.xlsx", "s2", "2.5", "y"), ("g.csv", None, "3", "z")], "source_file_name string, excel_tab_name string, `Amount $` string, amount string")
    found = discovery.profile_files(rows, tab="excel_tab_name")
    assert {(r.source_file_name, r.column_name): r.raw_type for r in found.collect()} == {("f.xlsx", "Amount $"): "DECIMAL(18,1)", ("f.xlsx", "amount"): "VARCHAR(10)", ("g.csv", "Amount $"): "INT", ("g.csv", "amount"): "VARCHAR(10)"}
    contract = discovery.emit_contract(found.where("source_file_name = 'g.csv'"), ["Amount $"], workbook=True)
    assert [(r.column_name, r.nullability) for r in contract.orderBy("ordinal").collect()][:3] == [("amount", "NOT NULL"), ("amount_2", "NULL"), ("excel_tab_name", "NOT NULL")]
    ddl = discovery.contract_ddl(contract, "s.t").first().ddl
    assert ddl.startswith("CREATE TABLE s.t (\n [amount] INT NOT NULL,") and "PRIMARY KEY ([amount])" in ddl


def test_fixtures_validate(spark):
    wide = fixtures.wide_transactions(spark, 50, extra=2)
    assert len(wide.columns) == 22 and wide.select("TransactionId").distinct().count() == 50
    assert wide.where("NetAmount <> round(Amount - FeeAmount + TaxAmount, 2)").count() == 0
    lines = [r.value for r in fixtures.preamble_lines(fixtures.transactions(spark, 3)).collect()]
    assert len(lines) == 6 and lines[2].startswith("TransactionId,") and lines[3].startswith("TXN000001,")
    c = fixtures.customers(spark, 10)
    assert {r.excel_tab_name for r in c.collect()} == {"Customers_AU", "Customers_US"}
    assert fixtures.repeated_header(c).where("CustomerId = 'CustomerId'").count() == 1
    assert fixtures.inject(c, "CreditLimit", "bad_number", 5, 2, "CustomerId").where("CreditLimit = 'ABC'").count() == 2
    assert fixtures.unique_rows(spark, 100, 5).distinct().count() == 100 and "UnexpectedCode" in fixtures.unknown_column(spark.range(2)).columns
