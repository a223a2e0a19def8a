"""Registered queries of control tables, discovery and run reports; they join those of catalog."""

from __future__ import annotations

from pyspark.sql import functions as F

from gatewright.functions import expr as X
from gatewright.operators import discovery, enrich, load, profile, reports
from gatewright.operators.validate import Column as Contract
from gatewright.operators.validate import blocked, contract_frame, validate
from gatewright.sources import control, fixtures
from gatewright.sources.files import folders_to, select_files

from .catalog import files, query, read

_SCOPE = "CASE c_custkey % 5 WHEN 0 THEN ' test ' WHEN 1 THEN 'REAL' WHEN 2 THEN 'perf_test' WHEN 3 THEN '' END"
_CONTROL = f"""WITH c AS (SELECT c_custkey AS id, c_nationkey AS process_id, CASE c_custkey % 3 WHEN 0 THEN 'y' WHEN 1 THEN '1' ELSE '0' END AS is_active, {_SCOPE} AS ingestion_scope, c_custkey % 7 = 0 AS is_test_data FROM customer),
e AS (SELECT *, coalesce(nullif(upper(trim(ingestion_scope)), ''), CASE WHEN is_test_data THEN 'TEST' ELSE 'REAL' END) AS scope FROM c)"""


def control_rows(spark, d):
    active = F.expr("CASE c_custkey % 3 WHEN 0 THEN 'y' WHEN 1 THEN '1' ELSE '0' END")
    return read(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("process_id"), active.alias("is_active"), F.expr(_SCOPE).alias("ingestion_scope"), (F.col("c_custkey") % 7 == 0).alias("is_test_data")
    )


@query(_CONTROL + " SELECT id, process_id FROM e WHERE scope = 'REAL' AND is_active <> '0' AND process_id = 7")
def fetch_configs(spark, d):
    return control.select_control(control_rows(spark, d), process_id=7).select("id", "process_id")


@query(_CONTROL + " SELECT id FROM e WHERE is_test_data OR scope IN ('TEST', 'VALIDATION', 'PERF_TEST')")
def guard_violations(spark, d):
    return control.guard_violations(control_rows(spark, d)).select("id")


@query("SELECT user_id, count(*) > 0 AND count(*) FILTER (WHERE event_type = 'error') = 0 AND user_id % 2 = 0 AS promoted FROM events GROUP BY user_id")
def promotion_gate(spark, d):
    runs = read(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("failed"))
    return runs.select("user_id", control.promotion_gate(F.col("n"), F.col("failed"), F.lit(False), F.col("user_id") % 2 == 0).alias("promoted"))


@query("SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'a|b' WHEN 1 THEN 'c_custkey' ELSE 'c_name' END AS keys FROM customer")
def merge_keys_resolve(spark, d):
    configured, primary = F.expr("CASE c_custkey % 3 WHEN 0 THEN ' a , b,' WHEN 1 THEN ' ' END"), F.expr("CASE WHEN c_custkey % 3 = 1 THEN array('c_custkey') END")
    return read(spark, d, "customer").select("c_custkey", F.array_join(control.merge_keys(configured, primary, F.lit("c_name")), "|").alias("keys"))


@query("SELECT c_custkey, '/sites/data/' || c_mktsegment || CASE WHEN c_custkey % 3 = 1 THEN '' ELSE '/in' END AS path FROM customer")
def path_normalise(spark, d):
    raw = F.expr("CASE c_custkey % 3 WHEN 0 THEN concat('https://host/sites/data/', c_mktsegment, '/in//') WHEN 1 THEN c_mktsegment ELSE concat('//', c_mktsegment, '/in/') END")
    return read(spark, d, "customer").select("c_custkey", control.normalise_path(raw, "/sites/data/").alias("path"))


@query("SELECT DISTINCT source AS folder FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 100 = 0)")
def unconfigured_folders(spark, d):
    docs = read(spark, d, "documents")
    configured = docs.where("doc_id % 100 = 0").select(F.concat(F.lit("/sites/data/"), F.upper("source"), F.lit("/")).alias("folder"))
    return discovery.unconfigured_folders(docs.select(F.col("source").alias("folder")).distinct(), configured, "sites/data")


@query("""
SELECT members, count(*) AS groups FROM (SELECT count(*) AS members FROM documents GROUP BY regexp_replace(lower(source), '[0-9]+', '{n}', 'g'), doc_id % 4, lang) GROUP BY members
""")
def discovery_groups(spark, d):
    f = files(spark, d).join(read(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    grouped = discovery.discovery_groups(f.withColumns({"kind": (F.col("doc_id") % 4).cast("string"), "columns": F.array("lang")}))
    return grouped.groupBy("group_id").agg(F.count("*").alias("members")).groupBy("members").agg(F.count("*").alias("groups"))


_CODE = r"""SELECT '{0}' AS column_name, max(length(v)) <= 50 AND NOT bool_or(regexp_matches(v, '\s')) AND coalesce(stddev_samp(length(v)), 0) / avg(length(v)) <= 0.4
 AND avg(CAST(regexp_matches(v, '^[A-Za-z0-9][A-Za-z0-9_./-]*$') AS INT)) >= 0.8 AND avg(CAST(regexp_matches(v, '[A-Za-z]') AND regexp_matches(v, '[0-9]') AS INT)) >= 0.7 AS code_like
 FROM (SELECT nullif(trim(CAST({0} AS VARCHAR)), '') AS v FROM part)"""


@query(" UNION ALL ".join(_CODE.format(c) for c in ("p_name", "p_brand", "p_partkey")))
def code_like(spark, d):
    return discovery.code_like(read(spark, d, "part"), ["p_name", "p_brand", "p_partkey"])


@query("SELECT event_type AS code, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, code LIMIT 10")
def issue_digest(spark, d):
    return reports.digest(read(spark, d, "events"), "event_type")


@query("SELECT user_id AS load_id, bool_or(event_type = 'error') AS blocked FROM events GROUP BY 1")
def blocking_status(spark, d):
    return blocked(read(spark, d, "events").select(F.col("user_id").alias("load_id"), F.upper("event_type").alias("severity")), "load_id")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'processed' END AS folder FROM events")
def file_disposition(spark, d):
    return read(spark, d, "events").select("event_id", reports.disposition(F.col("event_type") != "error").alias("folder"))


_MESSAGE = "CASE WHEN event_type = 'error' THEN 'PRIMARY_KEY_VIOLATION: ' || event_id || ' rows with duplicate keys' WHEN event_type <> 'view' THEN 'line one' || chr(10) || repeat('x', 350) END"


def messages(spark, d):
    return read(spark, d, "events").select("event_id", "event_type", F.expr(_MESSAGE).alias("message"))


@query(f"SELECT event_id, CASE WHEN {_MESSAGE} LIKE 'PRIMARY_KEY_VIOLATION:%' THEN 'key_violation' WHEN {_MESSAGE} IS NOT NULL THEN 'generic' END AS class FROM events")
def failure_class(spark, d):
    return messages(spark, d).select("event_id", reports.failure_class(F.col("message")).alias("class"))


@query(f"SELECT event_id, event_type, left(replace(coalesce({_MESSAGE}, ''), chr(10), ' '), 300) AS message FROM events")
def audit_detail(spark, d):
    return reports.detail(messages(spark, d))


@query("""
SELECT event_id, 'ERROR' AS severity, upper(event_type) AS code, 'found ' || event_id || ' rows with duplicate keys' AS message, 'tab ' || user_id AS tab_name, CASE WHEN event_id % 2 = 0 THEN 'f' || user_id || '.csv' END AS file_name, event_id AS duplicates FROM events
""")
def issue_parse(spark, d):
    details = F.concat(F.lit("excel_tab_name = 'tab "), F.col("user_id").cast("string"), F.lit("'"), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(", source_file_name=f"), F.col("user_id").cast("string"), F.lit(".csv"))).otherwise(""))
    line = reports.format_issue(F.lit("ERROR"), F.upper("event_type"), F.concat(F.lit("found "), F.col("event_id").cast("string"), F.lit(" rows with duplicate keys")), details)
    return read(spark, d, "events").select("event_id", reports.parse_issue(line).alias("x")).select("event_id", "x.*")


@query("SELECT event_id, event_type AS status, CASE WHEN event_id % 3 <> 0 THEN value END AS records FROM events")
def ledger_schema_evolution(spark, d):
    e = read(spark, d, "events").select("event_id", F.col("event_type").alias("status"), F.col("value").alias("records"))
    return load.unite_ledgers(e.where("event_id % 3 = 0").drop("records"), e.where("event_id % 3 <> 0"))


@query("SELECT event_id, TIMESTAMP '2024-01-01' + to_seconds(event_id * 61) AS loaded FROM events")
def utc_naive(spark, d):
    instant = F.timestamp_seconds(F.lit(1704067200) + F.col("event_id") * 61)
    return read(spark, d, "events").select("event_id", enrich.utc_naive(instant).alias("loaded"))


@query("SELECT c_custkey, c_name, c_mktsegment || '.csv' AS source_file_name, TIMESTAMP '2024-05-06 07:08:09' AS sp_ingest_load_dt, c_custkey + 7 AS audit_id, CASE WHEN c_custkey % 4 = 0 THEN 'Sheet1' ELSE c_name END AS EXCEL_TAB_NAME FROM customer")
def enrich_lineage(spark, d):
    c = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.when(F.col("c_custkey") % 4 != 0, F.col("c_name")).otherwise(" ").alias("EXCEL_TAB_NAME"))
    rows = enrich.enrich(c, ["c_custkey", "source_file_name", "Excel_Tab_Name", "sp_ingest_load_dt", "audit_id"], F.concat("c_mktsegment", F.lit(".csv")), "Sheet1", F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"), F.col("c_custkey") + 7)
    return rows.drop("c_mktsegment")


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE c_mktsegment END AS to_address, 'landing.' || lower(c_mktsegment) AS table_name FROM customer
""")
def backfill_coalesce(spark, d):
    c = read(spark, d, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.concat(F.lit(" "), F.col("c_mktsegment"))).when(F.col("c_custkey") % 2 == 0, "  ").alias("to_address"), F.col("c_name").alias("old_address"),
        F.concat(F.when(F.col("c_custkey") % 2 == 0, "staging.").otherwise("landing."), F.lower("c_mktsegment")).alias("table_name"),
    )
    return enrich.backfill(c, {"to_address": "old_address"}, {"table_name": "staging->landing"}).drop("old_address")


@query("""
SELECT c_custkey, 'TRUNCATE' AS strategy, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS target, CASE WHEN c_custkey % 4 = 0 THEN 'BLANK_STAGING_TABLE' WHEN lower(c_mktsegment) NOT IN (SELECT lower(c_mktsegment) FROM customer WHERE c_nationkey < 2) OR c_mktsegment IS NULL THEN 'UNKNOWN_STAGING_TABLE' END AS error FROM customer
""")
def staging_only(spark, d):
    c = read(spark, d, "customer")
    control_rows = c.select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).otherwise(" ").alias("staging_table_name"))
    known = c.where("c_nationkey < 2").select(F.lower("c_mktsegment").alias("table_name"))
    return load.staging_only(control_rows, known).select("c_custkey", "strategy", "target", "error")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price, o_orderstatus AS status FROM orders UNION ALL SELECT o_orderkey + 100000000, o_totalprice + 1, NULL FROM orders WHERE o_orderkey % 8 = 0")
def upsert_partial(spark, d):
    target = read(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    changed = target.where("o_orderkey % 4 = 0").select("o_orderkey", (F.col("price") + 1).alias("price"))
    new = changed.where("o_orderkey % 8 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 100000000)
    return load.upsert(target, changed.unionByName(new), ["o_orderkey"])


_TYPED = "CASE WHEN o_orderkey % 13 = 5 THEN 'ABC' WHEN o_orderkey % 13 = 6 THEN '' ELSE CAST(o_totalprice AS {0}) END"


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 13 NOT IN (5, 6) THEN o_totalprice END AS price, CAST(CASE WHEN o_orderkey % 7 <> 3 THEN o_orderdate END AS DATE) AS day, CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag,
 CAST(o_orderkey % 13 = 5 AS INT) + CAST(o_orderkey % 7 = 3 AS INT) + CAST(o_orderkey % 3 = 2 AS INT) AS n_lost FROM orders
""")
def typed_projection(spark, d):
    o = read(spark, d, "orders").select(
        F.when(F.col("o_orderkey") % 7 == 3, "31/13/2025").otherwise(F.date_format("o_orderdate", "d/M/yyyy")).alias("Day"), F.expr(_TYPED.format("STRING")).alias("price"),
        F.expr("CASE o_orderkey % 3 WHEN 0 THEN ' True' WHEN 1 THEN '0' ELSE 'Yes' END").alias("flag"), F.col("o_orderkey").cast("string").alias("o_orderkey"), F.lit("x").alias("other"),
    )
    return enrich.typed_projection(o, [Contract("o_orderkey", "bigint"), Contract("price", "float"), Contract("day", "date"), Contract("flag", "bit")])


def _stat(c: str, kind: str) -> str:
    return f"SELECT f, '{c}' AS column_name, {kind} AS raw_type FROM o GROUP BY f"


_INT, _DEC = "CASE WHEN max(abs({0})) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END", "'DECIMAL(18,' || max(length(split_part(CAST({0} AS VARCHAR), '.', 2))) || ')'"
_VAR = "'VARCHAR(' || CAST(greatest(10, ceil(max(length({0})) * 1.2 / 10) * 10) AS INT) || ')'"
_FILES = "WITH o AS (SELECT o_orderstatus || '.csv' AS f, * FROM orders)"


@query(_FILES + " UNION ALL ".join([_stat("o_orderkey", _INT.format("o_orderkey")), _stat("o_totalprice", _DEC.format("o_totalprice")), _stat("o_orderdate", "'DATE'"), _stat("o_orderpriority", _VAR.format("o_orderpriority"))]))
def profile_files(spark, d):
    o = read(spark, d, "orders").select(F.concat("o_orderstatus", F.lit(".csv")).alias("f"), "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "M/d/yyyy").alias("o_orderdate"), "o_orderpriority")
    return discovery.profile_files(o, "f").select("f", "column_name", "raw_type")


@query("SELECT 'o_totalprice' AS column_name, count(*) AS rows, max(length(split_part(CAST(o_totalprice AS VARCHAR), '.', 2))) AS max_fraction, max(o_totalprice) AS max_abs FROM orders UNION ALL SELECT 'o_orderkey', count(*), 0, max(o_orderkey) FROM orders")
def merge_profiles(spark, d):
    stats = profile.column_statistics(read(spark, d, "orders").select("o_orderstatus", "o_totalprice", "o_orderkey"), by=["o_orderstatus"])
    return profile.merge_statistics(stats).select("column_name", "rows", F.col("max_fraction").cast("bigint").alias("max_fraction"), "max_abs")


_KINDS = ["BIT", "INT", "BIGINT", "FLOAT", "DATE", "DATETIME2(3)", "DECIMAL:20:2"]


@query("""
WITH t AS (SELECT p_partkey, ['BIT','INT','BIGINT','FLOAT','DATE','DATETIME2(3)','DECIMAL:20:2'] AS k, p_partkey % 7 + 1 AS i, p_partkey // 7 % 7 + 1 AS j FROM part)
SELECT p_partkey, CASE WHEN i = j THEN k[i] WHEN 7 IN (i, j) THEN CASE WHEN 4 IN (i, j) THEN 'FLOAT' WHEN least(i, j) IN (5, 6) THEN 'VARCHAR:50' WHEN least(i, j) = 3 THEN 'DECIMAL:21:2' ELSE 'DECIMAL:20:2' END
 WHEN (i <= 4) = (j <= 4) THEN k[greatest(i, j)] ELSE 'VARCHAR:50' END AS merged FROM t
""")
def merge_types(spark, d):
    kinds = F.array(*[F.lit(x) for x in _KINDS])
    at = lambda c: kinds[c.cast("int")]
    return read(spark, d, "part").select("p_partkey", X.merge_types(at(F.col("p_partkey") % 7), at(F.floor(F.col("p_partkey") / 7) % 7)).alias("merged"))


@query("SELECT p_partkey, p_partkey % 5 IN (0, 1, 3) AS hint FROM part")
def pk_name_hint(spark, d):
    name = F.expr("CASE p_partkey % 5 WHEN 0 THEN concat('part_', 'ID') WHEN 1 THEN 'no_of_part' WHEN 2 THEN 'paid_note' WHEN 3 THEN concat('x_guid_', p_size) ELSE 'a_no_b' END")
    return read(spark, d, "part").select("p_partkey", name.rlike(X.KEY_NAME).alias("hint"))


@query("SELECT doc_id, doc_id % 4 = 0 AS mismatch, CASE WHEN doc_id % 2 = 0 THEN 'xls_ole2' ELSE 'xlsx_zip' END AS kind FROM documents")
def payload_mismatch(spark, d):
    name = F.when(F.col("doc_id") % 4 == 0, "a.XLSX").when(F.col("doc_id") % 4 == 2, "a.xls").otherwise("b.xlsm")
    content = F.concat(F.when(F.col("doc_id") % 2 == 0, F.unhex(F.lit(X.OLE2_MAGIC))).otherwise(F.unhex(F.lit("504B0304"))), F.col("text").cast("binary"))
    return read(spark, d, "documents").select("doc_id", X.payload_mismatch(name, content).alias("mismatch"), X.payload_kind(content).alias("kind"))


@query("SELECT page_id, depth FROM (SELECT page_id, len(string_split(rtrim(split_part(url, '?', 1), '/'), '/')) - 3 AS depth FROM pages) WHERE depth <= 2")
def folders_to_depth(spark, d):
    path = F.regexp_replace(F.split("url", r"\?")[0], "^https?://", "")
    return folders_to(read(spark, d, "pages").select("page_id", path.alias("folder")), "folder", 2).select("page_id", "depth")


@query("SELECT doc_id FROM documents WHERE source LIKE 'src1%' AND doc_id % 4 = 0")
def file_inventory_select(spark, d):
    return select_files(files(spark, d), "src1*.csv").select("doc_id")


@query("""
SELECT 'ERROR' AS severity, 'NUMERIC_SCALE_EXCEEDED' AS code, 'o_totalprice' AS column_name, CAST(greatest(3, max(length(split_part(CAST(o_totalprice AS VARCHAR), '.', 2)))) AS VARCHAR) AS detail FROM orders WHERE o_orderkey % 100 <> 7
UNION ALL SELECT 'ERROR', 'TYPE_MISMATCH', 'o_custkey', 'string' WHERE (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 3) > 0
UNION ALL SELECT 'ERROR', 'STRING_LENGTH_EXCEEDED', 'o_orderpriority', '400' WHERE (SELECT count(*) FROM orders WHERE o_orderkey % 70 = 1) > 0
UNION ALL SELECT 'WARNING', 'ADDITIONAL_SOURCE_COLUMNS', 'UnexpectedCode', 'additional'
""")
def injected_defects(spark, d):
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    for column, defect, every, at in (("o_totalprice", "scale", 100, 7), ("o_custkey", "bad_number", 50, 3), ("o_orderpriority", "too_long", 70, 1)):
        o = fixtures.inject(o, column, defect, every, at, "o_orderkey")
    contract = [Contract("o_orderkey", "bigint"), Contract("o_custkey", "int"), Contract("o_totalprice", "decimal", precision=18, scale=2), Contract("o_orderpriority", "varchar", char_len=20)]
    return validate(fixtures.unknown_column(o, row_id="o_orderkey"), contract_frame(spark, contract))


def _contract(spark, d):
    c = read(spark, d, "customer").select(F.col("c_custkey").alias("CustomerKey"), F.col("c_mktsegment").alias("Market Segment"), F.col("c_acctbal").alias("market-segment"))
    return discovery.emit_contract(profile.narrowest_type(profile.column_statistics(c)), ["CustomerKey"])


_CONTRACT = f"""SELECT 1 AS ordinal, 'CustomerKey' AS source_name, 'customer_key' AS column_name, {_INT.format('c_custkey')} AS data_type, 'NOT NULL' AS nullability FROM customer
UNION ALL SELECT 2, 'Market Segment', 'market_segment', {_VAR.format('c_mktsegment')}, 'NULL' FROM customer UNION ALL SELECT 3, 'market-segment', 'market_segment_2', {_DEC.format('c_acctbal')}, 'NULL' FROM customer
UNION ALL SELECT * FROM (VALUES (10000, NULL, 'source_file_name', 'VARCHAR(255)', 'NULL'), (10001, NULL, 'sp_ingest_load_dt', 'DATETIME2(7)', 'NOT NULL'), (10002, NULL, 'audit_id', 'BIGINT', 'NULL'), (10003, NULL, '__$batch_id', 'INT', 'NULL'), (10004, NULL, '__$job_instance_id', 'INT', 'NULL'))"""


@query(_CONTRACT)
def emit_contract(spark, d):
    return _contract(spark, d).drop("is_key")


@query(f"""SELECT ordinal, 'customer' AS object, coalesce(source_name, '') AS source_column, column_name AS staging_column, data_type || ' ' || nullability AS staging_type, CASE WHEN ordinal = 1 THEN 'Y' ELSE '' END AS pk,
 CASE WHEN ordinal = 1 THEN 'Mapping provided manually, it cannot or meant to be generated' ELSE '' END AS comments FROM ({_CONTRACT})""")
def mapping_rows(spark, d):
    rows = discovery.mapping_rows(_contract(spark, d), "customer", "customer drops", F.current_date())
    return rows.select("ordinal", F.col("Object name").alias("object"), F.col("Source column").alias("source_column"), F.col("Staging column").alias("staging_column"), F.col("Staging type").alias("staging_type"), F.col("Primary key?").alias("pk"), F.col("Comments").alias("comments"))


@query("""
SELECT g AS group_id, '/in/' || g AS process_folder, 'landing.t_' || g AS staging_table_name, 'APPEND' AS load_strategy, 'customer_key' AS merge_key_columns, n > 1 AS multi_file_ingest,
 '{"CustomerKey":"customer_key","Market Segment":"market_segment","market-segment":"market_segment_2"}' AS column_mapping_json, 'wf-t-' || lower(g) || '-' || left(sha256(g), 8) AS workflow_id FROM (SELECT c_mktsegment AS g, count(*) AS n FROM customer GROUP BY 1)
""")
def emit_control_row(spark, d):
    groups = read(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("group_id")).agg(F.count("*").alias("members"))
    groups = groups.select("group_id", F.concat(F.lit("/in/"), F.col("group_id")).alias("folder"), F.concat(F.lit("t_"), F.col("group_id")).alias("table_name"), F.lit("*.csv").alias("pattern"), "members")
    contract = _contract(spark, d).crossJoin(F.broadcast(groups.select("group_id")))  # a group for each market segment
    return discovery.emit_control(groups, contract).select("group_id", "process_folder", "staging_table_name", "load_strategy", "merge_key_columns", "multi_file_ingest", "column_mapping_json", "workflow_id")


@query(r"""
SELECT 'c_name' AS column_name, CASE WHEN bool_or(TRY_CAST(c_name AS DOUBLE) IS NULL) THEN 'string' ELSE 'numeric' END AS source_family FROM customer UNION ALL SELECT 'c_custkey', CASE WHEN bool_and(TRY_CAST(c_custkey AS DOUBLE) IS NOT NULL) THEN 'numeric' ELSE 'string' END FROM customer
UNION ALL SELECT 'flag', CASE WHEN bool_and(c_custkey % 2 IN (0, 1)) THEN 'bool' ELSE 'string' END FROM customer UNION ALL SELECT 'none', CASE WHEN count(c_custkey) > 0 THEN 'any' END FROM customer
""")
def semantic_family(spark, d):
    c = read(spark, d, "customer").select("c_name", "c_custkey", F.expr("CASE c_custkey % 2 WHEN 0 THEN 'T' ELSE 'false' END").alias("flag"), F.lit(None).cast("string").alias("none"))
    return profile.family(profile.column_statistics(c)).select("column_name", "source_family")


@query(r"""
WITH f AS (SELECT DISTINCT source || '_' || CAST(doc_id % 50 AS VARCHAR) || CASE doc_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.PARQUET' WHEN 2 THEN '.xlsx' ELSE '.bin' END AS file_name, doc_id % 3 AS g FROM documents),
p AS (SELECT * FROM (VALUES (0, 'src1*'), (1, '*_7.*'), (2, '*.csv')) t(group_id, pattern))
SELECT group_id, count(DISTINCT file_name) AS n FROM (SELECT p.group_id, f.file_name FROM p JOIN f ON f.g <> p.group_id AND f.file_name LIKE replace(replace(pattern, '_', '^_'), '*', '%') ESCAPE '^') GROUP BY group_id
""")
def pattern_overlap(spark, d):
    grouped = files(spark, d).select("file_name", (F.col("doc_id") % 3).cast("int").alias("group_id"))
    patterns = spark.createDataFrame([(0, "src1*"), (1, "*_7.*"), (2, "*.csv")], "group_id int, pattern string")
    return discovery.pattern_overlap(grouped, patterns).groupBy("group_id").agg(F.count("*").alias("n"))
