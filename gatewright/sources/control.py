"""The control table: which loads to run, and guards on that choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIVE = ("1", "Y")
TEST_SCOPES = ("TEST", "VALIDATION", "PERF_TEST")


def effective_scope(scope: Column, is_test: Column) -> Column:
    """The scope in capitals; a blank one follows the test flag."""
    return F.coalesce(F.nullif(F.upper(F.trim(scope)), F.lit("")), F.when(is_test, "TEST").otherwise("REAL"))


def select_control(control: DataFrame, process_id: int | None = None, workflow_id: str | None = None, scope: str | None = "REAL", active_only: bool = True, order: str | None = "id") -> DataFrame:
    """Rows of control (process_id, workflow_id, is_active, ingestion_scope, is_test_data) to run, in order of their id where there is one."""
    out = control
    if process_id is not None:
        out = out.where(F.col("process_id") == process_id)
    if workflow_id is not None:
        out = out.where(F.col("workflow_id") == workflow_id)
    if active_only:
        out = out.where(F.upper(F.trim(F.col("is_active").cast("string"))).isin(*ACTIVE))
    if scope:
        out = out.where(effective_scope(F.col("ingestion_scope"), F.col("is_test_data")) == scope.upper())
    return out.orderBy(order) if order in control.columns else out


def guard_violations(control: DataFrame) -> DataFrame:
    """Rows that must not run in production: test data by flag or by scope."""
    return control.where(F.coalesce(F.col("is_test_data"), F.lit(False)) | effective_scope(F.col("ingestion_scope"), F.col("is_test_data")).isin(*TEST_SCOPES))


def merge_keys(configured: Column, primary: Column, first_column: Column) -> Column:
    """The keys as an array: configured (comma-separated), else the primary key, else the first column."""
    split = F.filter(F.transform(F.split(configured, ","), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(F.size(F.coalesce(split, F.array())) > 0, split).when(F.size(F.coalesce(primary, F.array())) > 0, primary).otherwise(F.array(first_column))


def promotion_gate(processed: Column, failed: Column, staging_only: Column, configured: Column) -> Column:
    """Staging goes on only after a run that loaded something and failed at nothing."""
    return (processed > 0) & (failed == 0) & ~staging_only & configured


def normalise_path(value: Column, site: str) -> Column:
    """A path below the site, without host and closing slash."""
    p = F.regexp_replace(F.trim(value), r"(?i)^https?://[^/]+", "")
    p = F.concat(F.lit("/"), F.regexp_replace(F.regexp_replace(p, "^/+", ""), "/+$", ""))
    base = "/" + site.strip("/")
    return F.when((F.lower(p) == base.lower()) | F.lower(p).startswith(base.lower() + "/"), p).otherwise(F.concat(F.lit(base), F.when(p == "/", "").otherwise(p)))
