"""From raw columns to those of the destination: names, lineage, types."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatewright.functions import expr as X

from .validate import Column as Contract


def column_mapping(text: str | None) -> dict[str, str]:
    """Source to destination names from a JSON object; blank is none, anything else is an error."""
    found = json.loads(text) if text and text.strip() else {}
    if not isinstance(found, dict):
        raise ValueError("a column mapping must be a JSON object")
    return {str(k): str(v) for k, v in found.items()}


def mappings(text: Column) -> Column:
    """Source to destination names of each row's JSON object, as a map; blank is none, anything else is an error where it is read."""
    filled = F.nullif(F.trim(text), F.lit(""))
    return F.coalesce(F.from_json(filled, "map<string,string>", {"mode": "FAILFAST"}), F.create_map().cast("map<string,string>"))


def apply_mapping(df: DataFrame, mapping: str | None) -> DataFrame:
    """Trimmed headers, then the mapping by exact name; columns without one keep their names."""
    names = column_mapping(mapping)
    return df.toDF(*[names.get(c.strip(), c.strip()) for c in df.columns])


def trim_text(df: DataFrame) -> DataFrame:
    """Every text column without white space at its ends; blank text stays text."""
    return df.select(*[X.strip(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`") for f in df.schema])


def existing_name(columns: Iterable[str], wanted: str) -> str:
    """The column of this name without regard to case and blanks at its ends, else the name itself."""
    return next((c for c in columns if c.strip().lower() == wanted), wanted)


def fill_blank(column: Column, value: str) -> Column:
    """Blank and null text becomes the value, if there is one."""
    return F.coalesce(F.nullif(X.strip(column), F.lit("")), F.lit(value)) if value.strip() else column


def enrich(df: DataFrame, destination: Iterable[str], file_name: Column, tab: str | None = None, load_time: Column | None = None, audit_id: Column | None = None) -> DataFrame:
    """Lineage columns, each only if the destination has it, under the name the table already uses for it.

    source_file_name; excel_tab_name (with `tab`, blank cells only);
    sp_ingest_load_dt (now in UTC); audit_id; __$job_instance_id (null).
    """
    wanted = {c.strip().lower() for c in destination}
    made: dict[str, Column] = {"source_file_name": file_name}
    if tab is not None:
        name = existing_name(df.columns, "excel_tab_name")
        made["excel_tab_name"] = fill_blank(F.col(f"`{name}`"), tab) if name in df.columns else F.lit(tab.strip())
    made["sp_ingest_load_dt"] = load_time if load_time is not None else utc_naive(F.current_timestamp())
    made["audit_id"] = audit_id if audit_id is not None else F.lit(None).cast("bigint")
    made["__$job_instance_id"] = F.lit(None).cast("int")
    return df.withColumns({existing_name(df.columns, k): v for k, v in made.items() if k in wanted})


def utc_naive(instant: Column) -> Column:
    """An instant as the date and time it has in UTC, without a zone."""
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def spark_type(c: Contract) -> str:
    t = c.type.lower()
    if t in ("decimal", "numeric", "money", "smallmoney"):
        return f"decimal({c.precision or 18},{2 if c.scale is None else c.scale})"
    known = {"tinyint": "int", "smallint": "int", "int": "int", "bigint": "bigint", "float": "double", "real": "float", "bit": "boolean", "date": "date", "datetime": "timestamp_ntz", "datetime2": "timestamp_ntz", "smalldatetime": "timestamp_ntz"}
    return known.get(t, "string")


def typed(column: Column, c: Contract, dayfirst: bool = True, read: Column | None = None) -> Column:
    """One text column as its contract's type; what does not fit is null (see typed_projection for the count of it).

    `read` has the moments of dates that were read before; where it is null, the text is.
    """
    kind, text = spark_type(c), F.nullif(X.strip(column.cast("string")), F.lit(""))
    if kind == "boolean":
        return X.strict_bit(text)
    if kind in ("date", "timestamp_ntz"):
        found = X.parse_date(text, F.lit(dayfirst)).cast(kind)
        return found if read is None else F.coalesce(read.cast(kind), found)
    if kind == "string":
        return F.when(F.length(column) <= c.char_len, column) if c.char_len and c.char_len > 0 else column
    value = F.when(X.is_number(text), text).try_cast(kind)
    if kind.startswith("decimal"):  # a cast would round digits away without a word
        return F.when(X.digits_total_and_fraction(text)[1] <= int(kind.rstrip(")").split(",")[1]), value)
    return value


def typed_projection(df: DataFrame, contract: Iterable[Contract], dayfirst: bool = True, read: dict[str, str] | None = None) -> DataFrame:
    """The contract's columns, in its order and types, and n_lost: how many filled cells of the row did not fit and are null.

    `read` names, for columns of df, others that hold their dates as moments (see typed).
    """
    read = read or {}
    at = {c.strip().lower(): c for c in df.columns}
    known = [(c, at.get(c.name.strip().lower())) for c in contract]
    out = df.select(
        *[(typed(F.col(f"`{s}`"), c, dayfirst, F.col(f"`{read[s]}`") if s in read else None) if s else F.lit(None).cast(spark_type(c))).alias(c.name) for c, s in known],
        F.array(*[F.col(f"`{s}`").cast("string") for _, s in known if s]).alias("given_"),
    )
    lost = [(F.coalesce(F.trim(F.get("given_", F.lit(k))), F.lit("")) != "") & F.col(f"`{c.name}`").isNull() for k, (c, _) in enumerate((c, s) for c, s in known if s)]
    return out.withColumn("n_lost", sum((x.cast("int") for x in lost), F.lit(0))).drop("given_")


def backfill(df: DataFrame, pairs: dict[str, str], prefixes: dict[str, str] | None = None) -> DataFrame:
    """Blank columns filled from older ones (new name: old name); table names with an old schema prefix get the new one."""
    blank_null = lambda c: F.nullif(F.trim(c), F.lit(""))
    out = df.withColumns({new: F.coalesce(blank_null(F.col(new)), blank_null(F.col(old))) for new, old in pairs.items()})
    for column, rule in (prefixes or {}).items():
        old, new = rule.split("->")
        out = out.withColumn(column, F.when(F.col(column).startswith(f"{old}."), F.concat(F.lit(f"{new}."), F.substring(column, len(old) + 2, 200))).otherwise(F.col(column)))
    return out


def unique_names(name: Column, order: str) -> Column:
    """name, or name_2, name_3, ... for later rows of the same one."""
    k = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return F.when(k == 1, name).otherwise(F.concat_ws("_", name, k.cast("string")))
