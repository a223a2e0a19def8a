"""Registered queries of whole loads: files written from the given tables to the shared folder, read, checked, stored and merged."""

from __future__ import annotations

import uuid
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.operators import dates, job, keys, load, profile
from gatewright.operators.discover import discover
from gatewright.operators.validate import Column as Contract
from gatewright.operators.validate import contract_columns as columns_of
from gatewright.operators.validate import contract_frame, date_columns, validate
from gatewright.sources import fixtures, workbook
from gatewright.sources.files import read_csv, read_parquet
from gatewright.sources.loadset import load_set, shared_folder
from gatewright.sources.versions import VersionedTable

from .catalog import query, read


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


#: For each remainder of doc_id by 6: the columns of its files, and the encoding they are written in.
_OLD, _NEW = ["doc_id", "lang", "note", "digest"], ["Digest", "doc_id", "n_chars", "note"]


@query("""
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang, CASE WHEN doc_id % 2 = 1 THEN CAST(n_chars AS VARCHAR) END AS n_chars,
 CASE doc_id % 3 WHEN 0 THEN 'Ωé' WHEN 1 THEN '€é' ELSE 'é' || chr(129) END || source AS note, sha256(coalesce(text, '')) AS digest FROM documents
""")
def union_files(spark, d):
    folder, docs = scratch(spark, "union"), read(spark, d, "documents")
    for k in range(6):
        # Windows-1252 is written as the characters that have its bytes in ISO-8859-1
        encoding, sign = [("UTF-8", "Ωé"), ("ISO-8859-1", "\u0080é"), ("ISO-8859-1", "é\u0081")][k % 3]
        rows = docs.where(F.col("doc_id") % 6 == k).withColumns({"note": F.concat(F.lit(sign), F.col("source")), "digest": F.sha2(F.coalesce("text", F.lit("")), 256)})
        names = _NEW if k % 2 else _OLD
        rows.select(*[F.col(c).alias(c) for c in names]).write.option("header", True).option("encoding", encoding).csv(f"{folder}/part{k}")
    return load_set(spark, f"{folder}/*").select("doc_id", "lang", "n_chars", "note", "digest")


@query("SELECT doc_id, sha256(replace(replace(coalesce(text, ''), chr(13), ' '), chr(0), ' ')) AS digest, source FROM documents")
def csv_scan_quoted(spark, d):
    folder = scratch(spark, "quoted")
    text = F.translate(F.coalesce("text", F.lit("")), "\r\0", "  ")  # a reader makes one line end of several
    rows = read(spark, d, "documents").select("doc_id", text.alias("text"), "source")
    whole = rows.write.option("header", True).option("quoteAll", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    whole.option("emptyValue", "").csv(folder)
    back = read_csv(spark, folder, multiline=True)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "source")


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, 'say \"' || o_orderpriority || '\", twice' AS remark FROM orders")
def csv_skip_rows(spark, d):
    folder = scratch(spark, "preamble")
    rows = read(spark, d, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit('say "'), F.col("o_orderpriority"), F.lit('", twice')).alias("remark"))
    fixtures.preamble_files(rows.repartition(3), ["made for a test, with commas", "", "third line"]).write.text(folder)
    return read_csv(spark, folder, header_skip_rows=3).drop("source_file_name")


@query("SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem")
def parquet_scan(spark, d):
    return read_parquet(spark, f"{d}/lineitem.parquet", most_bytes=1 << 40).select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


_TYPES = """SELECT CAST(ordinal_position AS INT) AS ordinal, column_name, CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'float' WHEN 'VARCHAR' THEN 'varchar' WHEN 'DATE' THEN 'date'
 WHEN 'TIMESTAMP' THEN 'datetime2' WHEN 'TIMESTAMP WITH TIME ZONE' THEN 'datetime2' WHEN 'BOOLEAN' THEN 'bit' ELSE lower(regexp_replace(data_type, '[(].*', '')) END AS data_type FROM information_schema.columns WHERE table_name = '{0}'"""


def _contract(spark: SparkSession, d: str, name: str) -> DataFrame:
    return contract_frame(spark, columns_of(read(spark, d, name)))


@query(_TYPES.format("lineitem"))
def contract_columns(spark, d):
    return _contract(spark, d, "lineitem").select("ordinal", "column_name", "data_type")


@query(f"SELECT * FROM ({_TYPES.format('orders')}) WHERE data_type IN ('date', 'datetime2')")
def contract_date_columns(spark, d):
    return date_columns(_contract(spark, d, "orders")).select("ordinal", "column_name", "data_type")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 1")
def load_truncate(spark, d):
    path, o = scratch(spark, "truncate"), read(spark, d, "orders").select("o_orderkey", "o_custkey")
    load.write_truncate(o.where("o_orderkey % 2 = 0"), path)
    load.write_truncate(o.where("o_orderkey % 2 = 1"), path)
    return spark.read.parquet(path)


@query("SELECT o_orderkey, o_custkey FROM orders")
def load_append(spark, d):
    path, o = scratch(spark, "append"), read(spark, d, "orders").select("o_orderkey", "o_custkey")
    load.write_truncate(o.where("o_orderkey % 3 = 0"), path)
    load.write_append(o.where("o_orderkey % 3 <> 0"), path, ["o_orderkey"])
    load.write_append(o.limit(0), path, ["o_orderkey"])
    return spark.read.parquet(path)


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL")
def staging_only_reload(spark, d):
    """Two runs of a load of a file for each market segment: staging holds what the last run brought, and nothing is promoted."""
    table, c = VersionedTable(spark, scratch(spark, "staging")), read(spark, d, "customer").select("c_custkey", "c_mktsegment")
    segments = c.select(F.lit(1).alias("load_id"), F.concat("c_mktsegment", F.lit(".csv")).alias("file_name")).where("file_name is not null").distinct()
    for _ in range(2):
        for r in load.staged_files(segments).orderBy("file_name").collect():  # a row a file
            load.swap(table, c.where(F.concat("c_mktsegment", F.lit(".csv")) == r.file_name), r.strategy)
    return table.read()


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0")
def swap_load(spark, d):
    """A table replaced in two chunks, then added to; the version that was live in between stays readable."""
    table, o = VersionedTable(spark, scratch(spark, "swap")), read(spark, d, "orders").select("o_orderkey", "o_totalprice")
    load.swap(table, o.where("o_orderkey % 4 = 0"), keys=["o_orderkey"])
    load.swap(table, [o.where("o_orderkey % 4 = 1"), o.where("o_orderkey % 4 = 2")], keys=["o_orderkey"])
    load.swap(table, o.where("o_orderkey % 4 = 3"), "APPEND", ["o_orderkey"])
    return table.read()


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 50 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders
UNION ALL SELECT o_orderkey + 100000000, o_totalprice + 1 FROM orders WHERE o_custkey % 100 = 0
""")
def merge_partitioned(spark, d):
    path, o = scratch(spark, "buckets"), read(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_totalprice").alias("price"))
    load.write_buckets(o.drop("o_custkey"), path, ["o_orderkey"], 16)
    changed = o.where("o_custkey % 50 = 0").withColumn("price", F.col("price") + 1)
    new = changed.where("o_custkey % 100 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 100000000)
    load.merge_buckets(changed.unionByName(new).drop("o_custkey"), path, ["o_orderkey"])
    return load.read_buckets(spark, path)


@query("""
SELECT l_returnflag AS audit_id, 'SUCCESS' AS status, count(*) AS rows_scanned, count(*) FILTER (WHERE l_linenumber % 7 <> 3) AS rows_loaded, count(*) FILTER (WHERE l_linenumber % 7 = 3) AS error_count,
 count(*) FILTER (WHERE l_orderkey % 11 = 0) AS null_key_rows FROM lineitem GROUP BY 1
""")
def load_metrics(spark, d):
    """Loads of lineitem by return flag: counted while they are written, and the counts in the ledger."""
    rows = read(spark, d, "lineitem").select("l_returnflag", F.when(F.col("l_orderkey") % 11 != 0, F.col("l_orderkey")).alias("key"), "l_linenumber")
    folder, ledger = scratch(spark, "metrics"), None
    for r in rows.select("l_returnflag").distinct().collect():  # a row a load
        part = rows.where(F.col("l_returnflag") == r.l_returnflag)
        found = load.write_observed(part, lambda df, to=f"{folder}/{r.l_returnflag}": load.write_truncate(df, to), ["key"], F.col("l_linenumber") % 7 == 3)
        event = load.ledger_events(spark, r.l_returnflag, 2, "SUCCESS").withColumns(load.metric_columns(found))
        ledger = event if ledger is None else load.unite_ledgers(ledger, event)
    return load.current_audit(ledger, "audit_id", "seq", "status", "rows_scanned", "rows_loaded", "error_count", "null_key_rows")


_CANDIDATES = ["l_linenumber", "l_suppkey", "l_partkey", "l_orderkey", "l_shipdate"]
_COMBOS = [c for n in (1, 2, 3) for c in combinations(_CANDIDATES, n)]


@query("SELECT CASE " + " ".join(f"WHEN (SELECT count(*) = count(DISTINCT ({', '.join(c)})) AND {' AND '.join(f'count(*) = count({x})' for x in c)} FROM lineitem) THEN '{','.join(c)}'" for c in _COMBOS) + " ELSE '' END AS pk_columns")
def key_search_levels(spark, d):
    found = keys.infer_key(read(spark, d, "lineitem"), _CANDIDATES)
    return spark.range(1).select(F.lit(",".join(found or [])).alias("pk_columns"))


@query("""
WITH t AS (SELECT o_orderstatus, CASE WHEN o_orderkey % 9 = 4 THEN 'bad ' || o_orderkey % 90 ELSE '01/02/2024' END AS v FROM orders)
SELECT o_orderstatus, count(*) FILTER (WHERE v LIKE 'bad%') AS n_invalid, (SELECT coalesce(string_agg(v, ';' ORDER BY v), '') FROM (SELECT DISTINCT v FROM t u WHERE u.o_orderstatus = t.o_orderstatus AND v LIKE 'bad%' ORDER BY v LIMIT 5)) AS invalid FROM t GROUP BY o_orderstatus
""")
def invalid_date_samples(spark, d):
    rows = read(spark, d, "orders").select("o_orderstatus", F.when(F.col("o_orderkey") % 9 == 4, F.concat(F.lit("bad "), (F.col("o_orderkey") % 90).cast("string"))).otherwise("01/02/2024").alias("v"))
    return dates.invalid_samples(rows, "v", ["o_orderstatus"]).withColumn("invalid", F.array_join("invalid", ";"))


@query("""
WITH g AS (SELECT l_returnflag, l_suppkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL), s AS (SELECT *, CASE WHEN n > 1 THEN l_suppkey || '|' || l_linenumber END AS key FROM g)
SELECT l_returnflag, count(key) AS dup_groups, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS dup_rows,
 (SELECT coalesce(string_agg(key, ';' ORDER BY key), '') FROM (SELECT key FROM s u WHERE u.l_returnflag = s.l_returnflag AND key IS NOT NULL ORDER BY key LIMIT 5)) AS samples FROM s GROUP BY l_returnflag
""")
def duplicate_key_samples(spark, d):
    found = keys.duplicate_samples(read(spark, d, "lineitem"), ["l_suppkey", "l_linenumber"], ["l_returnflag"])
    return found.withColumn("samples", F.array_join("samples", ";"))


@query("""
SELECT 'o_orderkey' AS column_name, count(*) AS rows, true AS close, count(DISTINCT o_orderkey) = count(*) AS may_be_key FROM orders UNION ALL SELECT 'o_custkey', count(*), true, count(DISTINCT o_custkey) >= 0.9 * count(*) FROM orders
""")
def distinct_sketches(spark, d):
    """Sketches of the orders of each status, merged: close to the count over all orders, without reading them again."""
    o = read(spark, d, "orders").select("o_orderstatus", "o_orderkey", "o_custkey")
    merged = profile.key_bounds(profile.merge_sketches(profile.column_sketches(o, by=["o_orderstatus"])))
    exact = o.select(F.inline(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in ("o_orderkey", "o_custkey")]))).groupBy("c").agg(F.count_distinct("v").alias("exact"))
    both = merged.join(exact, F.col("c") == F.col("column_name"))
    return both.select("column_name", "rows", (F.abs(F.col("n_distinct") - F.col("exact")) <= 0.1 * F.col("exact")).alias("close"), "may_be_key")


@query("""
WITH t AS (SELECT max(length(CAST(o_orderkey AS VARCHAR))) AS digits FROM orders)
SELECT 'ERROR' AS severity, 'STRING_LENGTH_EXCEEDED' AS code, 'digits' AS column_name, CAST(digits AS VARCHAR) AS detail FROM t WHERE digits > 1
UNION ALL SELECT 'ERROR', 'STRING_LENGTH_EXCEEDED', 'days', '10' FROM (SELECT count(*) AS n FROM orders) WHERE n > 0 UNION ALL SELECT 'ERROR', 'STRING_LENGTH_EXCEEDED', 'bits', '5' FROM (SELECT count(*) AS n FROM orders WHERE o_orderkey % 2 = 1) WHERE n > 0
UNION ALL SELECT 'ERROR', 'TYPE_MISMATCH', 'day_as_number', 'string' FROM (SELECT count(*) AS n FROM orders) WHERE n > 0 UNION ALL SELECT 'ERROR', 'TYPE_MISMATCH', 'number_as_day', 'numeric' FROM (SELECT count(*) AS n FROM orders) WHERE n > 0
""")
def destination_family(spark, d):
    """Text of digits, dates and bits is text where the destination is; native types go before text, and a number without value is one."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = read(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("digits"), day.alias("days"), F.when(F.col("o_orderkey") % 2 == 0, "true").otherwise("false").alias("bits"), day.alias("day_as_number"),
        F.col("o_orderkey").alias("number_as_day"), F.when(F.col("o_orderkey") % 2 == 0, F.lit(float("nan"))).otherwise(F.col("o_totalprice").cast("double")).alias("amount"),
    )
    kinds = [Contract("digits", "varchar", char_len=1), Contract("days", "varchar", char_len=5), Contract("bits", "varchar", char_len=4), Contract("day_as_number", "int"), Contract("number_as_day", "date"), Contract("amount", "float")]
    return validate(rows, contract_frame(spark, kinds))


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment AS tab, 'customers_' || c_nationkey || '_' || c_custkey // 5000 || '.xlsx' AS book FROM customer WHERE c_mktsegment LIKE '%E%Y' OR c_mktsegment LIKE '%BILE'")
def sheet_select_regex(spark, d):
    """Workbooks of customers by nation, 5,000 of them at most, with a sheet for each market segment; two segments are chosen by pattern."""
    c = read(spark, d, "customer").withColumn("book", F.concat(F.lit("customers_"), F.col("c_nationkey").cast("string"), F.lit("_"), F.floor(F.col("c_custkey") / 5000).cast("string")))
    books = fixtures.workbooks(c.where("c_mktsegment is not null"), "book", "c_mktsegment", ["c_custkey", "c_name"])
    return workbook.tables(workbook.grid_of(books, "REGEX:E.*Y$|BILE$"), tab_column="tab").withColumnRenamed("source_path", "book")


@query("""
SELECT o_orderkey, CAST(round(o_totalprice, 2) AS DECIMAL(12, 2)) AS price, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS status FROM orders
""")
def load_job(spark, d):
    """Orders as files of two layouts, one with a preamble of its own and days first, loaded from the folder to the target by one control row."""
    place, o = scratch(spark, "job"), read(spark, d, "orders")
    rows = o.select("o_orderkey", F.round("o_totalprice", 2).cast("decimal(12,2)").cast("string").alias("price"), "o_orderdate", F.col("o_orderstatus").alias("status"))
    even = rows.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("Order Key"), "price", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "status")
    odd = rows.where("o_orderkey % 2 = 1").select(F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"), F.col("o_orderkey").alias("Order Key"), "price")
    fixtures.preamble_files(even, ["export, of today"]).write.mode("append").text(f"{place}/in")
    fixtures.preamble_files(odd, [""]).write.mode("append").text(f"{place}/in")
    contract = (Contract("o_orderkey", "bigint", is_key=True), Contract("price", "decimal", precision=12, scale=2), Contract("day", "date"), Contract("status", "varchar", char_len=10))
    config = job.Config("orders", f"{place}/in", contract, "part-*.txt", header_skip_rows=1, mapping='{"Order Key": "o_orderkey"}', keys=("o_orderkey",), strategy="APPEND")
    target = VersionedTable(spark, f"{place}/target")
    done = job.run_load(spark, config, VersionedTable(spark, f"{place}/staging"), target, f"{place}/ledger", f"{place}/issues")
    if done.error:
        raise ValueError(done.error)
    return target.read().select("o_orderkey", "price", "day", "status")


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "key", c_name AS "Unnamed: 1", CASE WHEN c_custkey % 3 = 0 THEN CAST(c_nationkey AS VARCHAR) END AS "key.1", c_mktsegment AS tab FROM customer WHERE c_mktsegment IS NOT NULL
""")
def grid_to_table(spark, d):
    """Sheets with a title row above the header, a blank and a repeated header, short rows and cells beyond the header."""
    c = read(spark, d, "customer").where("c_mktsegment is not null")
    key = F.col("c_custkey").cast("string")
    long, short = F.array(key, F.col("c_name"), F.col("c_nationkey").cast("string"), F.lit("beyond")), F.array(key, F.col("c_name"))
    body = c.select(F.col("c_mktsegment").alias("tab_name"), (F.col("c_custkey") + 2).cast("int").alias("row_no"), F.when(F.col("c_custkey") % 3 == 0, long).otherwise(short).alias("cells"))
    top = F.inline(F.array(F.struct(F.lit(0).alias("row_no"), F.array(F.lit("a title")).alias("cells")), F.struct(F.lit(1).alias("row_no"), F.array(F.lit(" key "), F.lit(None), F.lit("key")).alias("cells"))))
    grid = body.unionByName(c.select(F.col("c_mktsegment").alias("tab_name")).distinct().select("tab_name", top)).withColumns({"path": F.lit("book"), "tab_index": F.hash("tab_name")})
    return workbook.tables(grid, header_skip_rows=1, tab_column="tab").drop("source_path")


@query("SELECT CASE " + " ".join(f"WHEN (SELECT count(*) = count(DISTINCT ({', '.join(c)})) AND {' AND '.join(f'count(*) = count({x})' for x in c)} FROM orders) THEN '{','.join(c)}'" for n in (1, 2, 3) for c in combinations(["o_orderstatus", "o_custkey", "o_orderdate", "o_orderkey"], n)) + " ELSE '' END AS pk_columns")
def key_search_profiles(spark, d):
    """The key of orders that lie in a file for each status, pruned by the sketches of the files' profiles."""
    o = read(spark, d, "orders").select("o_orderstatus", "o_custkey", "o_orderdate", "o_orderkey").withColumn("file", F.col("o_orderstatus"))
    stored = profile.merge_sketches(profile.column_sketches(o, by=["file"]))
    found = keys.infer_key(o.drop("file"), ["o_orderstatus", "o_custkey", "o_orderdate", "o_orderkey"], sketches=stored)
    return spark.range(1).select(F.lit(",".join(found or [])).alias("pk_columns"))


_INT = "CASE WHEN max(abs({0})) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END"
_TEXT = "'VARCHAR(' || CAST(greatest(10, ceil(max(length({0})) * 1.2 / 10) * 10) AS INT) || ')'"


def _proposed(table: str, where: str, columns: dict[str, str], key: str) -> str:
    kinds = [f"SELECT '{where}' AS kind, '{c}' AS column_name, {t.format(c)} AS data_type, {str(c == key).lower()} AS is_key FROM {table}" for c, t in columns.items()]
    return " UNION ALL ".join(kinds)


@query(
    _proposed("orders", "APPEND", {"o_orderkey": _INT, "o_orderpriority": _TEXT, "o_orderdate": "max('DATE')"}, "o_orderkey")
    + " UNION ALL " + _proposed("orders", "TRUNCATE", {"o_orderstatus": _TEXT, "o_orderpriority": _TEXT}, "")
)
def discover_folder(spark, d):
    """Orders as files of two layouts in one folder: types, keys and strategies as they are proposed for each group."""
    place, o = scratch(spark, "discover"), read(spark, d, "orders")
    one = o.select("o_orderkey", "o_orderpriority", F.date_format("o_orderdate", "dd/MM/yyyy").alias("o_orderdate"))
    for rows in (one, o.select("o_orderstatus", "o_orderpriority")):
        rows.repartition(3).write.mode("append").option("header", True).csv(f"{place}/in")
    found = discover(spark, f"{place}/in")
    kinds = found.control.select("group_id", F.col("load_strategy").alias("kind"))
    return found.contracts.where("source_name is not null").join(kinds, "group_id").select("kind", "column_name", "data_type", "is_key")
