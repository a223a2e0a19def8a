"""Generated tables of any size, as expressions of spark.range, and defects put into tables.

Fixed values: the column names of the sample files that loads are tried with, and
how their ids are written.  Every value is drawn from a hash of the row's number
and the column's name, so that a table is the same in each run, whatever its
partitions, and columns do not depend on each other unless they say so.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape, quoteattr

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _code(prefix: str, number: Column, digits: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))


def _draw(name: str, below: int, row: Column | None = None) -> Column:
    """A number from 0 to below - 1 for a row and a column."""
    return F.pmod(F.xxhash64(F.lit(name), F.col("id") if row is None else row), F.lit(below))


def _one_of(name: str, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (_draw(name, len(values)) + 1).cast("int"))


def _money(name: str, most: int) -> Column:
    """From a cent to most, in two decimals."""
    return ((_draw(name, 100 * most) + 1) / 100).cast("decimal(18,2)")


def _moment(name: str) -> Column:
    """A second of the three years from 2023 on."""
    return F.timestamp_seconds(F.lit(1_672_531_200) + _draw(name, 3 * 365 * 86_400))


def _day(name: str) -> Column:
    return F.date_add(F.lit("2023-01-01").cast("date"), _draw(name, 3 * 365).cast("int"))


def transactions(spark: SparkSession, rows: int, first: int = 1) -> DataFrame:
    """Small transactions of six columns, numbered from `first`."""
    return spark.range(rows).select(
        _code("TXN", F.col("id") + first, 6).alias("TransactionId"), _code("CUST", _draw("customer", 100_000), 5).alias("CustomerId"), F.date_format(_day("day"), "yyyy-MM-dd").alias("TransactionDate"),
        _money("amount", 5000).alias("Amount"), _one_of("currency", ["AUD", "USD"]).alias("Currency"), _one_of("status", ["OPEN", "COMPLETE", "VOID"]).alias("Status"),
    )


def wide_transactions(spark: SparkSession, rows: int, extra: int = 0, first: int = 1) -> DataFrame:
    """Transactions of twenty columns, as of a large delimited file, and `extra` more of text, extra_col_01, ..."""
    amount, fee, tax = _money("amount", 5000), _money("fee", 50), _money("tax", 500)
    moment = _moment("moment")
    return spark.range(rows).select(
        _code("TXN", F.col("id") + first, 7).alias("TransactionId"), _code("CUST", _draw("customer", 100_000), 5).alias("CustomerId"), F.date_format(moment, "yyyy-MM-dd").alias("TransactionDate"), amount.alias("Amount"),
        _one_of("currency", ["AUD", "USD"]).alias("Currency"), _one_of("status", ["OPEN", "COMPLETE", "VOID"]).alias("Status"), (_draw("quantity", 40) + 1).alias("Quantity"),
        (_draw("discount", 3000) / 10_000).cast("decimal(9,4)").alias("DiscountRate"), fee.alias("FeeAmount"), tax.alias("TaxAmount"), (amount + tax - fee).cast("decimal(18,2)").alias("NetAmount"),
        _one_of("channel", ["WEB", "PHONE", "SHOP"]).alias("Channel"), _one_of("region", ["NORTH", "SOUTH", "WEST"]).alias("Region"), _one_of("system", ["S1", "S2"]).alias("SourceSystem"), _code("B", _draw("batch", 1000), 4).alias("BatchId"),
        F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("EventTimestamp"), _one_of("priority", ["Y", "N"]).alias("IsPriority"), _code("R", _draw("reference", 10**9), 9).alias("ReferenceCode"), _code("L", _draw("ledger", 1000), 3).alias("LedgerCode"),
        F.concat(F.lit("comment "), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 12)).alias("CommentText"), *_extra_columns(extra),
    )


def _extra_columns(extra: int) -> list[Column]:
    return [F.hex(F.xxhash64(F.lit(k), "id")).alias(f"extra_col_{k:02d}") for k in range(1, extra + 1)]


def wide_parquet(spark: SparkSession, rows: int, width: int = 22, first: int = 1) -> DataFrame:
    """Transactions of 22 typed columns, as of a large Parquet file, and text up to the width."""
    amount, tax, fee = _money("amount", 5000), _money("tax", 500), _money("fee", 50)
    moment = _moment("moment")
    return spark.range(rows).select(
        _code("TXN", F.col("id") + first, 10).alias("transaction_id"), _code("CUST", _draw("customer", 100_000), 5).alias("customer_id"), _code("ACC", _draw("account", 10**6), 6).alias("account_id"), _code("M", _draw("merchant", 5000), 4).alias("merchant_id"),
        F.date_format(moment, "yyyy-MM-dd").alias("transaction_date"), F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss").alias("transaction_timestamp"), amount.cast("double").alias("amount"), tax.cast("double").alias("tax_amount"), fee.cast("double").alias("fee_amount"),
        (amount + tax - fee).cast("double").alias("net_amount"), _one_of("currency", ["AUD", "USD"]).alias("currency"), _one_of("status", ["OPEN", "COMPLETE", "VOID"]).alias("status"), _one_of("method", ["CARD", "CASH", "TRANSFER"]).alias("payment_method"),
        _one_of("channel", ["WEB", "PHONE", "SHOP"]).alias("channel"), _one_of("country", ["AU", "US", "NZ"]).alias("country_code"), _one_of("region", ["NORTH", "SOUTH", "WEST"]).alias("region_code"), _one_of("system", ["S1", "S2"]).alias("source_system"),
        _code("B", _draw("batch", 1000), 4).alias("batch_reference"), (_draw("refund", 25) == 0).alias("is_refund"), (_draw("risk", 10_000) / 10_000).alias("risk_score"), F.hex(F.xxhash64(F.lit("device"), "id")).alias("device_id"),
        F.concat(F.lit("about "), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 20)).alias("description"), *_extra_columns(max(width - 22, 0)),
    )


def customers(spark: SparkSession, rows: int, regions: tuple[str, ...] = ("AU", "US")) -> DataFrame:
    """Customers with the sheet they belong to: one for each region, dealt in turn."""
    region = F.element_at(F.array(*[F.lit(r) for r in regions]), (F.col("id") % len(regions) + 1).cast("int"))
    return spark.range(rows).select(
        (F.col("id") + 1).alias("CustomerId"), F.concat(F.lit("Name "), F.substring(F.sha2(F.col("id").cast("string"), 256), 1, 8)).alias("CustomerName"), F.date_format(_day("signup"), "yyyy-MM-dd").alias("SignupDate"),
        _money("limit", 20_000).alias("CreditLimit"), region.alias("Region"), F.concat(F.lit("Customers_"), region).alias("excel_tab_name"),
    )


def unique_rows(spark: SparkSession, rows: int, first: int = 0, seed: int = 7) -> DataFrame:
    """Rows with unique ids and seeded values, to fill files of a size."""
    return spark.range(first, first + rows).select(F.col("id"), F.sha2(F.concat_ws("-", F.lit(str(seed)), F.col("id").cast("string")), 256).alias("payload"), F.round(F.rand(seed), 6).alias("value"))


def preamble_lines(table: DataFrame, lines: int = 2) -> DataFrame:
    """value: the lines of a delimited file, after so many lines of preamble and the header; write with text() from one task."""
    head = [*[f"line {k + 1} above the header" for k in range(lines)], ",".join(table.columns)]
    top = table.sparkSession.createDataFrame([(k, x) for k, x in enumerate(head)], "n long, value string")
    row = F.concat_ws(",", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in table.columns])
    return top.unionByName(table.select((F.monotonically_increasing_id() + lines + 1).alias("n"), row.alias("value"))).orderBy("n").select("value")


def preamble_files(table: DataFrame, lines: list[str]) -> DataFrame:
    """value: the lines of delimited files, of which each (one a task) begins with the preamble and a header; write with text()."""
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"')) for c in table.columns]
    head = [*lines, ",".join(table.columns)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(head)], names=["value"])
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("value")], names=["value"])

    return table.select(F.concat_ws(",", *quoted).alias("value")).mapInArrow(run, "value string")


def workbooks(rows: DataFrame, book: str, tab: str, columns: list[str]) -> DataFrame:
    """path, content: a workbook for each value of `book`, with a sheet for each value of `tab` in it; every cell is text.

    A book's rows meet in one task, so `book` has to bound them.
    """
    names = rows.select(F.col(book).cast("string").alias("_book"), F.col(tab).cast("string").alias("_tab"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns])

    def make(group: pd.DataFrame) -> pd.DataFrame:
        out, tabs = io.BytesIO(), sorted(group["_tab"].unique())

        def row(values: list[str]) -> str:
            return "<row>" + "".join(f'<c t="inlineStr"><is><t>{escape(v)}</t></is></c>' for v in values) + "</row>"

        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("xl/workbook.xml", '<workbook xmlns:r="r"><sheets>' + "".join(f'<sheet name={quoteattr(t)} r:id="i{k}"/>' for k, t in enumerate(tabs)) + "</sheets></workbook>")
            z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="i{k}" Target="worksheets/s{k}.xml"/>' for k in range(len(tabs))) + "</Relationships>")
            for k, t in enumerate(tabs):
                cells = group[group["_tab"] == t][columns].itertuples(index=False)
                lines = [row(columns), *[row(list(x)) for x in cells]]
                numbered = "".join(x.replace("<row>", f'<row r="{n}">', 1) for n, x in enumerate(lines, 1))
                z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet><sheetData>{numbered}</sheetData></worksheet>")
        return pd.DataFrame({"path": [f"{group['_book'].iloc[0]}.xlsx"], "content": [out.getvalue()]})

    return names.groupBy("_book").applyInPandas(make, "path string, content binary")


#: What a defect puts into a cell.
DEFECTS = {"bad_number": "ABC", "date_as_number": "2025-03-01", "bad_date": "not-a-date", "impossible_date": "31/13/2025", "blank": "", "too_long": "X" * 400, "precision": "1234567890123456789", "scale": "123.456", "text_date": "31/01/2025"}


def inject(df: DataFrame, column: str, defect: str, every: int, at: int, row_id: str) -> DataFrame:
    """df with a defect in the rows whose number leaves `at` when divided by `every`; the column becomes text."""
    return df.withColumn(column, F.when(F.col(row_id) % every == at, F.lit(DEFECTS[defect])).otherwise(F.col(column).cast("string")))


def drop_column(df: DataFrame, column: str) -> DataFrame:
    return df.drop(column)


def unknown_column(df: DataFrame, name: str = "UnexpectedCode", row_id: str = "id") -> DataFrame:
    return df.withColumn(name, _code("UNMAPPED_", F.col(row_id), 3))


def repeated_header(df: DataFrame) -> DataFrame:
    """A second header row amid the data, as from two tables in one sheet; all columns become text."""
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    return text.unionByName(df.sparkSession.range(1).select(*[F.lit(c).alias(c) for c in df.columns]))
