from __future__ import annotations

import __spark_entry__ as e


def test_entry_has_issues(spark):
    assert {r.code for r in e.entry(spark).collect()} >= {"PRIMARY_KEY_VIOLATION", "MISSING_DEST_COLUMNS_IN_SOURCE"}


def test_sql_belongs_to_queries():
    assert set(e.oracle_sql()) <= set(e.queries())
