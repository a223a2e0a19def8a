from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gatewright.functions import expr as X
from gatewright.operators import dates, keys, load, profile
from gatewright.operators.validate import Column, contract_frame, validate


def col(spark, values, kind="string"):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], f"k int, v {kind}")


def run(spark, values, f):
    return [r.x for r in col(spark, values).select("k", f(F.col("v")).alias("x")).orderBy("k").collect()]


def test_strict_bit(spark):
    assert run(spark, ["True", "false", "1", "0", "t", "F", None, "", "Yes"], X.strict_bit) == [True, False, True, False, True, False, None, None, None]
    assert run(spark, ["Yes", "", None, "t"], X.strict_bit_invalid) == [True, False, False, False]


def test_dates(spark):
    assert run(spark, ["13/04/2026", "31/13/2025", "04-03.2026", "3.4.2026 4:05 pm"], lambda c: X.parse_dmy(c, True)) == [datetime(2026, 4, 13), None, None, datetime(2026, 4, 3, 16, 5)]
    assert run(spark, ["2026-05-01", "2025-13-01", "2026/5/1T10:00:01.5"], X.parse_ymd) == [datetime(2026, 5, 1), None, datetime(2026, 5, 1, 10, 0, 1, 500000)]
    assert run(spark, ["45000.5"], X.excel_serial) == [datetime(2023, 3, 15, 12)]


@pytest.mark.parametrize(
    ("values", "order"),
    [(["1/5/2026", "2/5/2026"], "dayfirst"), (["15/04/2026", "4/16/2026"], "conflict"), (["04/05/2026", "4/15/2026"], "monthfirst"), (["2026-01-01"], "none"), ([None, ""], "none")],
)
def test_date_order_does_not_depend_on_the_split(spark, values, order):
    for n in (1, 3):
        got = dates.resolve_order(dates.order_evidence(col(spark, values).repartition(n), "v")).first()
        assert got.date_order == order


def test_free_text_leaves_a_column_unconverted(spark):
    got = dates.normalise_dates(col(spark, ["1/5/2026", "n/a"]), "v", "ts").orderBy("k").collect()
    assert [r.ts for r in got] == [None, None]


def test_digits(spark):
    df = col(spark, ["123456.78", "0.001", "1.0", "-1e3", "abc", "1,000", "00012", None])
    t, f = X.digits_total_and_fraction(F.col("v"))
    assert [tuple(r) for r in df.select(t, f).collect()] == [(8, 2), (3, 3), (2, 1), (4, 0), (None, None), (None, None), (2, 0), (None, None)]


def test_snake_case(spark):
    assert run(spark, ["CustomerId", "HTTPServer name", "  ", "a--b"], lambda c: X.snake_case(c, F.lit("column_1"))) == ["customer_id", "http_server_name", "column_1", "a_b"]


def test_validate(spark):
    df = spark.createDataFrame([("1", "abcdef", "1.234", None), ("x", "a", "2.5", None)], "id string, name string, amount string, note string")
    contract = contract_frame(spark, [Column("ID", "int"), Column("name", "varchar", char_len=3), Column("amount", "decimal", precision=3, scale=2), Column("note", "bit"), Column("gone", "int"), Column("audit_id", "int")])
    assert {(r.code, r.column_name) for r in validate(df, contract).collect()} == {
        ("TYPE_MISMATCH", "id"), ("STRING_LENGTH_EXCEEDED", "name"), ("NUMERIC_PRECISION_EXCEEDED", "amount"), ("NUMERIC_SCALE_EXCEEDED", "amount"), ("HIGH_NULL_RATIO", "note"), ("MISSING_DEST_COLUMNS_IN_SOURCE", "gone"),
    }


def test_keys(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (2, "b")], "a int, b string")
    assert keys.duplicate_summary(df, ["a", "b"]).first().asDict() == {"dup_groups": 1, "dup_rows": 2}
    assert keys.infer_key(df, ["a", "b"]) is None
    assert keys.infer_key(df.where("b is not null"), ["a", "b"]) == ["b"]
    target = spark.createDataFrame([(None, 1), (2, 1)], "a int, x int")
    assert [r.a for r in keys.key_conflicts(df, target, {"a": "a"}).collect()] == [2]


def test_types_and_loads(spark, tmp_path):
    stats = profile.column_statistics(spark.createDataFrame([("1.0", "4/1/2026", "true"), ("2.0", "4/2/2026", "f")], "a string, b string, c string"))
    assert {r.column_name: r.raw_type for r in profile.narrowest_type(stats).collect()} == {"a": "DECIMAL(18,1)", "b": "DATE", "c": "BIT"}
    t = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    s = spark.createDataFrame([(2, "z"), (3, "w")], "id int, v string")
    assert sorted(tuple(r) for r in load.upsert(t, s, ["id"]).collect()) == [(1, "x"), (2, "z"), (3, "w")]
    with pytest.raises(ValueError, match="merge keys"):
        load.upsert(t, s, ["nope"])
    load.write_truncate(t, str(tmp_path / "t"))
    load.write_append(s, str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 4
    assert load.write_swap(spark, s, str(tmp_path), "2").count() == 2
