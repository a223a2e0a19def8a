"""The registered queries over the given tables, each with the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatewright.functions import expr as X
from gatewright.operators import dates, enrich, keys, load, profile, reports
from gatewright.operators.validate import Column, contract_frame, schema_diff, schema_issues, validate
from gatewright.operators.validate import text_date_issues as validate_text_dates
from gatewright.sources.files import oversize
from gatewright.sources.workbook import tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


LINE_KEY = ["l_orderkey", "l_linenumber"]
#: lineitem with text in every column, as a CSV reader would give it
LINE_CONTRACT = [
    Column("l_orderkey", "bigint", is_key=True), Column("l_partkey", "bigint"), Column("l_suppkey", "bigint"), Column("l_linenumber", "int", is_key=True),
    Column("l_quantity", "decimal", precision=5, scale=2), Column("l_extendedprice", "decimal", precision=6, scale=2), Column("l_discount", "decimal", precision=9, scale=1),
    Column("l_tax", "decimal", precision=9, scale=2), Column("l_returnflag", "varchar", char_len=1), Column("l_linestatus", "int"), Column("l_shipdate", "date"), Column("l_comment", "varchar", char_len=40),
]


def line_text(spark: SparkSession, d: str) -> DataFrame:
    df = read(spark, d, "lineitem")
    return df.select(*[(F.date_format(c, "yyyy-MM-dd") if c == "l_shipdate" else F.col(c).cast("string")).alias(c) for c in df.columns])


@query("""
SELECT count(*) AS dup_groups FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
""")
def dup_key_groups(spark, d):
    return keys.duplicate_summary(read(spark, d, "lineitem"), LINE_KEY).select("dup_groups")


@query("""
WITH g AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
SELECT count(*) AS dup_groups, CAST(sum(n) AS BIGINT) AS dup_rows,
 (SELECT string_agg(l_orderkey || ':' || l_linenumber, ',' ORDER BY l_orderkey, l_linenumber) FROM (SELECT * FROM g ORDER BY 1, 2 LIMIT 5)) AS samples FROM g
""")
def dup_key_rows(spark, d):
    groups = keys.duplicate_groups(read(spark, d, "lineitem"), LINE_KEY)
    first = groups.orderBy(*LINE_KEY).limit(5).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(*LINE_KEY))), lambda x: F.concat_ws(":", x["l_orderkey"].cast("string"), x["l_linenumber"].cast("string"))), ",").alias("samples"))
    return groups.agg(F.count("*").alias("dup_groups"), F.sum("n").alias("dup_rows")).crossJoin(F.broadcast(first))


@query("SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)")
def key_conflicts(spark, d):
    return keys.key_conflicts(read(spark, d, "lineitem"), read(spark, d, "orders"), {"l_orderkey": "o_orderkey"})


@query("""
SELECT 'DUPLICATE_IN_LOAD' AS code, coalesce(CAST(sum(n) AS BIGINT), 0) AS n FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'KEY_IN_TARGET', count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)
""")
def append_guard(spark, d):
    return keys.append_guard(read(spark, d, "lineitem"), read(spark, d, "orders"), {"l_orderkey": "o_orderkey"})


@query("""
WITH b AS (SELECT l_orderkey, l_linenumber, l_orderkey % 4 AS batch, l_partkey FROM lineitem),
k AS (SELECT l_partkey, min(batch) AS first_batch FROM b GROUP BY 1)
SELECT batch, count(DISTINCT b.l_partkey) AS seen_before FROM b JOIN k ON b.l_partkey = k.l_partkey AND batch > first_batch GROUP BY batch
""")
def cross_batch_duplicates(spark, d):
    b = read(spark, d, "lineitem").select("l_partkey", (F.col("l_orderkey") % 4).alias("batch"))
    return keys.seen_before(b, ["l_partkey"], "batch").groupBy("batch").agg(F.count("*").alias("seen_before"))


@query("""
SELECT 'l_orderkey,l_linenumber' AS combo, 0 AS null_rows, count(*) AS distinct_keys, CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS BIGINT) AS duplicate_rows FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def pk_combo_test(spark, d):
    t = keys.test_combination(read(spark, d, "lineitem"), LINE_KEY)
    return t.select(F.lit(",".join(LINE_KEY)).alias("combo"), F.col("null_rows").cast("int").alias("null_rows"), "distinct_keys", "duplicate_rows")


@query("""
SELECT CASE WHEN count(DISTINCT conv_id) = count(*) THEN 'conv_id' WHEN count(DISTINCT turn) = count(*) THEN 'turn' WHEN count(DISTINCT (conv_id, turn)) = count(*) THEN 'conv_id,turn' ELSE '' END AS pk_columns,
 CASE WHEN count(DISTINCT (conv_id, turn)) = count(*) THEN 'APPEND' ELSE 'TRUNCATE' END AS strategy, count(*) AS n_rows FROM conversations
""")
def pk_inference(spark, d):
    return keys.key_report(read(spark, d, "conversations"))


_DIGITS = """CASE WHEN {0} = 0 THEN 1 ELSE greatest(length(ltrim(replace(CAST({0} AS VARCHAR), '.', ''), '0')), length(split_part(CAST({0} AS VARCHAR), '.', 2)), 1) END"""


@query(f"""
SELECT 'l_extendedprice' AS column_name, max({_DIGITS.format('l_extendedprice')}) AS max_total, max(length(split_part(CAST(l_extendedprice AS VARCHAR), '.', 2))) AS max_fraction FROM lineitem
UNION ALL SELECT 'l_discount', max({_DIGITS.format('l_discount')}), max(length(split_part(CAST(l_discount AS VARCHAR), '.', 2))) FROM lineitem
UNION ALL SELECT 'l_quantity', max({_DIGITS.format('l_quantity')}), max(length(split_part(CAST(l_quantity AS VARCHAR), '.', 2))) FROM lineitem
""")
def numeric_digits(spark, d):
    s = profile.column_statistics(read(spark, d, "lineitem"), ["l_extendedprice", "l_discount", "l_quantity"])
    return s.select("column_name", F.col("max_total").cast("bigint").alias("max_total"), F.col("max_fraction").cast("bigint").alias("max_fraction"))


@query("""
SELECT 'l_returnflag' AS column_name, max(length(l_returnflag)) AS max_len, count(*) AS rows FROM lineitem
UNION ALL SELECT 'l_shipdate', 10, count(*) FROM lineitem UNION ALL SELECT 'l_linenumber', max(length(CAST(l_linenumber AS VARCHAR))), count(*) FROM lineitem
""")
def max_len(spark, d):
    s = profile.column_statistics(line_text(spark, d), ["l_returnflag", "l_shipdate", "l_linenumber"])
    return s.select("column_name", F.col("max_len").cast("bigint").alias("max_len"), "rows")


_DIRTY = "CASE WHEN c_custkey % 7 = 3 THEN NULL WHEN c_custkey % 7 = 4 THEN '' ELSE c_name END"


@query(f"""
SELECT 'c_name' AS column_name, count(*) FILTER (WHERE v IS NULL) AS nulls, round(count(*) FILTER (WHERE v IS NULL) / count(*), 6) AS null_ratio FROM (SELECT {_DIRTY} AS v FROM customer)
""")
def null_ratio(spark, d):
    s = profile.column_statistics(read(spark, d, "customer").select(F.expr(_DIRTY).alias("c_name")))
    return s.select("column_name", "nulls", F.round(F.col("nulls") / F.col("rows"), 6).alias("null_ratio"))


@query("""
SELECT 'ERROR' AS severity, 'TYPE_MISMATCH' AS code, 'l_linestatus' AS column_name, 'string' AS detail WHERE (SELECT count(*) FROM lineitem WHERE TRY_CAST(l_linestatus AS DOUBLE) IS NULL) > 0
UNION ALL SELECT 'ERROR', 'MISSING_DEST_COLUMNS_IN_SOURCE', 'l_comment', 'missing' WHERE (SELECT count(*) FROM information_schema.columns WHERE table_name = 'lineitem' AND column_name = 'l_comment') = 0
UNION ALL SELECT 'ERROR', 'NUMERIC_PRECISION_EXCEEDED', 'l_extendedprice', CAST(m AS VARCHAR) FROM (SELECT max(length(replace(CAST(l_extendedprice AS VARCHAR), '.', ''))) AS m FROM lineitem) WHERE m > 6
UNION ALL SELECT 'ERROR', 'NUMERIC_SCALE_EXCEEDED', 'l_discount', CAST(m AS VARCHAR) FROM (SELECT max(length(split_part(CAST(l_discount AS VARCHAR), '.', 2))) AS m FROM lineitem) WHERE m > 1
""")
def validate_contract(spark, d):
    return validate(line_text(spark, d), contract_frame(spark, LINE_CONTRACT))


def _issues(spark, d, code: str) -> DataFrame:
    return validate_contract(spark, d).where(F.col("code") == code)


@query("SELECT 'ERROR' AS severity, 'NUMERIC_PRECISION_EXCEEDED' AS code, 'l_extendedprice' AS column_name, CAST(m AS VARCHAR) AS detail FROM (SELECT max(length(replace(CAST(l_extendedprice AS VARCHAR), '.', ''))) AS m FROM lineitem) WHERE m > 6")
def numeric_precision_exceeded(spark, d):
    return _issues(spark, d, "NUMERIC_PRECISION_EXCEEDED")


@query("SELECT 'ERROR' AS severity, 'NUMERIC_SCALE_EXCEEDED' AS code, 'l_discount' AS column_name, CAST(m AS VARCHAR) AS detail FROM (SELECT max(length(split_part(CAST(l_discount AS VARCHAR), '.', 2))) AS m FROM lineitem) WHERE m > 1")
def numeric_scale_exceeded(spark, d):
    return _issues(spark, d, "NUMERIC_SCALE_EXCEEDED")


@query("SELECT 'ERROR' AS severity, 'TYPE_MISMATCH' AS code, 'l_linestatus' AS column_name, 'string' AS detail FROM lineitem WHERE l_linestatus SIMILAR TO '[A-Z]' LIMIT 1")
def type_mismatch(spark, d):
    return _issues(spark, d, "TYPE_MISMATCH")


@query("SELECT 'ERROR' AS severity, 'STRING_LENGTH_EXCEEDED' AS code, 'p_name' AS column_name, CAST(m AS VARCHAR) AS detail FROM (SELECT max(length(p_name)) AS m FROM part) WHERE m > 5")
def string_length_exceeded(spark, d):
    return validate(read(spark, d, "part").select("p_name"), contract_frame(spark, [Column("p_name", "varchar", char_len=5)]))


@query("SELECT 'WARNING' AS severity, 'HIGH_NULL_RATIO' AS code, 'v' AS column_name, printf('%.4f', r) AS detail FROM (SELECT count(*) FILTER (WHERE o_orderkey % 20 <> 0) / count(*) AS r FROM orders) WHERE r >= 0.9")
def high_null_ratio(spark, d):
    df = read(spark, d, "orders").select(F.when(F.col("o_orderkey") % 20 == 0, F.col("o_orderstatus")).alias("v"))
    return validate(df, contract_frame(spark, [Column("v", "varchar", char_len=10)]))


#: The columns of a contract and of a source as rows of customer: names of the one and of the other, in different orders.
_SIDES = """WITH c AS (SELECT lower(trim(c_name)) AS k, c_name AS column_name, c_custkey AS ordinal FROM customer WHERE c_custkey % 3 <> 0),
s AS (SELECT lower(trim(c_name)) AS k, upper(c_name) AS source_name, 1000000 - c_custkey AS position FROM customer WHERE c_custkey % 5 <> 0)"""


def sides(spark, d) -> tuple[DataFrame, DataFrame]:
    c = read(spark, d, "customer")
    contract = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").cast("int").alias("ordinal"), F.concat(F.col("c_name"), F.lit(" ")).alias("column_name"))
    return contract, c.where("c_custkey % 5 <> 0").select((1000000 - F.col("c_custkey")).cast("int").alias("position"), F.upper("c_name").alias("source_name"))


@query(_SIDES + """
SELECT 'missing' AS side, column_name FROM c WHERE k NOT IN (SELECT k FROM s) UNION ALL SELECT 'additional', source_name FROM s WHERE k NOT IN (SELECT k FROM c)
""")
def schema_diff_customer(spark, d):
    contract, source = sides(spark, d)
    return schema_diff(contract, source).withColumn("column_name", F.trim("column_name"))


@query(_SIDES + """
SELECT 'ERROR' AS severity, 'MISSING_DEST_COLUMNS_IN_SOURCE' AS code, sha256(string_agg(column_name, ',' ORDER BY ordinal)) AS names FROM c WHERE k NOT IN (SELECT k FROM s)
UNION ALL SELECT 'WARNING', 'ADDITIONAL_SOURCE_COLUMNS', sha256(string_agg(source_name, ',' ORDER BY position)) FROM s WHERE k NOT IN (SELECT k FROM c)
UNION ALL SELECT 'WARNING', 'COLUMN_REORDERING_DETECTED', sha256(string_agg(s.k, ',' ORDER BY position)) FROM s JOIN c USING (k) HAVING string_agg(s.k, ',' ORDER BY position) <> string_agg(s.k, ',' ORDER BY ordinal)
""")
def column_reordering(spark, d):
    contract, source = sides(spark, d)
    return schema_issues(contract.withColumn("column_name", F.trim("column_name")), source).select("severity", "code", F.sha2("column_name", 256).alias("names"))


_SCALE = "max(length(split_part(CAST({0} AS VARCHAR), '.', 2)))"


@query(f"""
SELECT 'l_orderkey' AS column_name, CASE WHEN max(abs(l_orderkey)) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END AS raw_type FROM lineitem
UNION ALL SELECT 'l_quantity', 'DECIMAL(18,' || {_SCALE.format('l_quantity')} || ')' FROM lineitem
UNION ALL SELECT 'l_returnflag', 'VARCHAR(' || CAST(greatest(10, ceil(max(length(l_returnflag)) * 1.2 / 10) * 10) AS INT) || ')' FROM lineitem
UNION ALL SELECT 'l_shipdate', CASE WHEN bool_or(l_shipdate <> date_trunc('day', l_shipdate)) THEN 'DATETIME2(3)' ELSE 'DATE' END FROM lineitem
UNION ALL SELECT 'l_linenumber', CASE WHEN max(abs(l_linenumber)) <= 2147483647 THEN 'INT' ELSE 'BIGINT' END FROM lineitem
""")
def infer_types(spark, d):
    s = profile.column_statistics(line_text(spark, d), ["l_orderkey", "l_quantity", "l_returnflag", "l_shipdate", "l_linenumber"])
    return profile.narrowest_type(s).select("column_name", "raw_type")


@query("""
SELECT p_partkey, n, CASE WHEN t > 8000 THEN 'VARCHAR(MAX)' ELSE 'VARCHAR(' || t || ')' END AS final_type
FROM (SELECT p_partkey, n, greatest(10, CAST(ceil(greatest(1000, n * 120) / 1000) * 10 AS INT)) AS t FROM (SELECT p_partkey, length(p_name) * (p_partkey % 700) AS n FROM part))
""")
def finalise_type(spark, d):
    n = (F.length("p_name") * (F.col("p_partkey") % 700)).cast("bigint")
    return read(spark, d, "part").select("p_partkey", n.alias("n")).select("p_partkey", "n", X.padded_varchar(F.col("n")).alias("final_type"))


_US = "CASE WHEN o_orderkey % 11 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%-m/%-d/%Y') END"


def us_dates(spark, d, dirty: bool = False) -> DataFrame:
    o = read(spark, d, "orders")
    text = F.when(F.col("o_orderkey") % 11 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    if dirty:
        text = F.when(F.col("o_orderkey") % 13 == 5, F.lit("pending")).otherwise(text)
    return o.select("o_orderkey", text.alias("t"))


_SPLIT = r"regexp_extract(t, '^(\d{1,2})/(\d{1,2})/(\d{4})$', 1)"
_A, _B, _Y = (rf"TRY_CAST(regexp_extract(t, '^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})$', {k}) AS INT)" for k in (1, 2, 3))


@query(rf"""
WITH s AS (SELECT o_orderkey, {_US} AS t FROM orders), p AS (SELECT *, {_A} AS a, {_B} AS b, {_Y} AS y FROM s)
SELECT o_orderkey, t, CASE WHEN y IS NOT NULL THEN TRY_CAST(y || '-' || b || '-' || a AS TIMESTAMP) END AS as_dmy, CASE WHEN y IS NOT NULL THEN TRY_CAST(y || '-' || a || '-' || b AS TIMESTAMP) END AS as_mdy FROM p
""")
def parse_dmy_mdy(spark, d):
    return us_dates(spark, d).select("o_orderkey", "t", X.parse_dmy(F.col("t"), True).alias("as_dmy"), X.parse_dmy(F.col("t"), False).alias("as_mdy"))


@query(rf"WITH s AS (SELECT o_orderkey, {_US} AS t FROM orders) SELECT o_orderkey, CASE WHEN t LIKE '____-%' THEN CAST(t AS TIMESTAMP) END AS ts FROM s")
def parse_ymd(spark, d):
    return us_dates(spark, d).select("o_orderkey", X.parse_ymd(F.col("t")).alias("ts"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%-d.%-m.%Y') || CASE o_orderkey % 3 WHEN 0 THEN ' 4:05 pm' WHEN 1 THEN 'T14:05:06.25' ELSE '' END AS t, CASE o_orderkey % 3 WHEN 0 THEN '4:05 PM' WHEN 1 THEN '14:05:06.25' END AS suffix FROM orders")
def time_suffix(spark, d):
    k = F.col("o_orderkey") % 3
    t = F.concat(F.date_format("o_orderdate", "d.M.yyyy"), F.when(k == 0, " 4:05 pm").when(k == 1, "T14:05:06.25").otherwise(""))
    return read(spark, d, "orders").select("o_orderkey", t.alias("t")).select("o_orderkey", "t", X.time_suffix(F.col("t")).alias("suffix"))


@query(rf"WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 13 = 5 THEN 'pending' ELSE {_US} END AS t FROM orders) SELECT o_orderkey, t <> 'pending' AS like_date FROM s")
def is_date_like(spark, d):
    return us_dates(spark, d, dirty=True).select("o_orderkey", X.is_date_like(F.col("t")).alias("like_date"))


_EVIDENCE = rf"""
WITH s AS (SELECT o_orderkey, {_US} AS t FROM orders), p AS (SELECT *, {_A} AS a, {_B} AS b FROM s),
e AS (SELECT count(*) AS n_values, count(*) FILTER (WHERE a > 12) AS n_dmy, count(*) FILTER (WHERE b > 12) AS n_mdy, count(*) FILTER (WHERE a <= 12 AND b <= 12) AS n_ambiguous, count(*) FILTER (WHERE a IS NULL) AS n_ymd, 0 AS n_invalid, false AS has_time FROM p)
"""


@query(rf"""
WITH s AS (SELECT CASE WHEN o_orderkey % 13 = 5 THEN 'pending' ELSE {_US} END AS t FROM orders), p AS (SELECT *, {_A} AS a, {_B} AS b FROM s)
SELECT count(*) AS n_values, count(*) FILTER (WHERE a > 12) AS n_dmy, count(*) FILTER (WHERE b > 12) AS n_mdy, count(*) FILTER (WHERE a <= 12 AND b <= 12) AS n_ambiguous, count(*) FILTER (WHERE t LIKE '____-%') AS n_ymd,
 count(*) FILTER (WHERE a IS NULL AND t NOT LIKE '____-%') AS n_invalid, bool_or(t LIKE '%:%') AS has_time, min(CASE WHEN a IS NULL AND t NOT LIKE '____-%' THEN t END) AS invalid_sample FROM p
""")
def date_order_evidence(spark, d):
    return dates.order_evidence(us_dates(spark, d, dirty=True), "t")


@query(_EVIDENCE + "SELECT CASE WHEN n_dmy > 0 AND n_mdy > 0 THEN 'conflict' WHEN n_dmy > 0 THEN 'dayfirst' WHEN n_mdy > 0 THEN 'monthfirst' WHEN n_ambiguous > 0 THEN 'dayfirst' ELSE 'none' END AS date_order FROM e")
def date_order_resolve(spark, d):
    return dates.resolve_order(dates.order_evidence(us_dates(spark, d), "t")).select("date_order")


@query("SELECT o_orderkey, date_trunc('day', o_orderdate) AS ts FROM orders")
def normalise_dates_csv(spark, d):
    return dates.normalise_dates(us_dates(spark, d), "t", "ts").select("o_orderkey", "ts")


@query("SELECT o_orderkey, date_trunc('day', o_orderdate) AS ts FROM orders")
def normalise_dates_forced_us(spark, d):
    return dates.normalise_dates(us_dates(spark, d), "t", "ts", us=True).select("o_orderkey", "ts")


@query(rf"SELECT o_orderkey, CASE WHEN (SELECT count(*) FROM orders WHERE o_orderkey % 13 = 5) = 0 THEN o_orderdate END AS ts, CASE WHEN o_orderkey % 13 = 5 THEN 'pending' ELSE {_US} END AS kept FROM orders")
def date_passthrough_guard(spark, d):
    return dates.normalise_dates(us_dates(spark, d, dirty=True), "t", "ts", text_out="kept").select("o_orderkey", "ts", "kept")


#: Each value can be read one way only, but some have the day first and some the month.
_MIXED = "CASE WHEN day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%Y/%m/%d 10:30') WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%-d.%-m.%Y') ELSE strftime(o_orderdate, '%-m/%-d/%Y') END"


def mixed_dates(spark, d) -> DataFrame:
    day = F.dayofmonth("o_orderdate") <= 12
    text = F.when(day, F.date_format("o_orderdate", "yyyy/MM/dd' 10:30'")).when(F.col("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "d.M.yyyy")).otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    return read(spark, d, "orders").select("o_orderkey", text.alias("t"))


@query(f"SELECT o_orderkey, {_MIXED} AS t, date_trunc('day', o_orderdate) + CASE WHEN day(o_orderdate) <= 12 THEN INTERVAL 630 MINUTE ELSE INTERVAL 0 MINUTE END AS ts FROM orders")
def normalise_dates_mixed(spark, d):
    return dates.normalise_dates(mixed_dates(spark, d), "t", "ts", mode="mixed").select("o_orderkey", "t", "ts")


@query("""
WITH n AS (SELECT count(*) FILTER (WHERE day(o_orderdate) > 12 AND o_orderkey % 2 = 0) AS dmy, count(*) FILTER (WHERE day(o_orderdate) > 12 AND o_orderkey % 2 = 1) AS mdy FROM orders)
SELECT 'ERROR' AS severity, 'CONFLICTING_DATE_ORDERS' AS code, 't' AS column_name, 'day first ' || dmy || ', month first ' || mdy || ', either 0' AS detail FROM n WHERE dmy > 0 AND mdy > 0
UNION ALL SELECT 'ERROR', 'FORCED_US_BUT_DAY_FIRST', 't', 'day first ' || dmy || ', month first ' || mdy || ', either 0' FROM n WHERE dmy > 0
""")
def date_order_issues(spark, d):
    df = mixed_dates(spark, d)
    return dates.date_issues(df, "t").unionByName(dates.date_issues(df, "t", us=True))


@query(rf"""
WITH s AS (SELECT CASE WHEN o_orderkey % 13 = 5 THEN 'pending' ELSE {_US} END AS t FROM orders), f AS (SELECT t FROM s WHERE t <> 'pending')
SELECT 'WARNING' AS severity, 'EXCEL_DATETIME_STORED_AS_TEXT' AS code, 't' AS column_name, 'count=' || (SELECT count(*) FROM f) || ', samples=' || (SELECT string_agg(t, ', ' ORDER BY t) FROM (SELECT DISTINCT t FROM f ORDER BY t LIMIT 5)) AS detail
""")
def text_date_issues(spark, d):
    return validate_text_dates(us_dates(spark, d, dirty=True), contract_frame(spark, [Column("o_orderkey", "bigint"), Column("T", "datetime2")]))


@query("SELECT o_orderkey, TIMESTAMP '1899-12-30' + to_microseconds(CAST(round((40000 + o_orderkey % 5000 + 0.25) * 86400 * 1000000) AS BIGINT)) AS ts FROM orders")
def excel_serial_date(spark, d):
    return read(spark, d, "orders").select("o_orderkey", X.excel_serial(40000 + F.col("o_orderkey") % 5000 + 0.25).alias("ts"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%d-%m-%Y') AS au FROM orders")
def au_date_text(spark, d):
    return read(spark, d, "orders").select("o_orderkey", X.au_text(F.col("o_orderdate")).alias("au"))


@query("SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal AS credit_limit, c_mktsegment FROM customer")
def apply_column_mapping(spark, d):
    return enrich.apply_mapping(read(spark, d, "customer"), '{"c_custkey": "customer_id", "c_name": "customer_name", "c_acctbal": "credit_limit"}')


@query("SELECT c_custkey, c_name AS v FROM customer")
def trim_strings(spark, d):
    return enrich.trim_text(read(spark, d, "customer").select("c_custkey", F.concat(F.lit(" \t"), F.col("c_name"), F.lit(" \n")).alias("v")))


_BIT = "CASE c_custkey % 6 WHEN 0 THEN '1' WHEN 1 THEN 'True' WHEN 2 THEN 'f' WHEN 3 THEN '' WHEN 4 THEN 'Yes' END"


@query(f"SELECT c_custkey, {_BIT} AS t, CASE c_custkey % 6 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false END AS bit, c_custkey % 6 = 4 AS invalid FROM customer")
def strict_bit(spark, d):
    df = read(spark, d, "customer").select("c_custkey", F.expr(_BIT).alias("t"))
    return df.select("*", X.strict_bit(F.col("t")).alias("bit"), X.strict_bit_invalid(F.col("t")).alias("invalid"))


@query(f"SELECT c_custkey, c_custkey % 6 IN (0, 1, 4) AS enabled FROM customer")
def flag_truthy(spark, d):
    return read(spark, d, "customer").select("c_custkey", X.flag_enabled(F.expr(_BIT)).alias("enabled"))


@query("SELECT n_nationkey, n_name, CASE WHEN n_regionkey % 2 = 0 THEN 'sheet' ELSE n_name END AS tab FROM nation")
def fill_blank_tab(spark, d):
    tab = F.when(F.col("n_regionkey") % 2 == 0, F.lit("  ")).otherwise(F.col("n_name"))
    return read(spark, d, "nation").select("n_nationkey", "n_name", enrich.fill_blank(tab, "sheet").alias("tab"))


@query("SELECT c_nationkey AS tab, count(*) AS rows, round(sum(CASE WHEN c_nationkey % 2 = 0 THEN c_acctbal END), 2) AS credit FROM customer GROUP BY 1")
def union_sheets(spark, d):
    """A sheet for each nation, of two layouts: the odd ones lack the balance."""
    even = F.col("c_nationkey") % 2 == 0
    c = read(spark, d, "customer").select("c_nationkey", even.alias("even"), F.when(even, F.array(F.col("c_custkey").cast("string"), F.col("c_acctbal").cast("string"))).otherwise(F.array(F.col("c_custkey").cast("string"))).alias("cells"))
    head = F.when(F.col("even"), F.array(F.lit("key"), F.lit("credit"))).otherwise(F.array(F.lit("key")))
    heads = c.select("c_nationkey", "even").distinct().select("c_nationkey", F.lit(0).alias("row_no"), head.alias("cells"))
    grid = heads.unionByName(c.select("c_nationkey", F.lit(1).alias("row_no"), "cells"))
    rows = tables(grid.select(F.lit("book").alias("path"), F.col("c_nationkey").cast("int").alias("tab_index"), F.col("c_nationkey").cast("string").alias("tab_name"), "row_no", "cells"))
    return rows.groupBy(F.col("tab_name").cast("bigint").alias("tab")).agg(F.count("*").alias("rows"), F.round(F.sum(F.col("credit").cast("double")), 2).alias("credit"))


@query("SELECT p_partkey, 'part_' || replace(lower(p_name), ' ', '_') || '_id' AS snake FROM part")
def snake_case(spark, d):
    camel = F.concat(F.lit("Part"), F.replace(F.initcap("p_name"), F.lit(" "), F.lit("")), F.lit("ID"))
    return read(spark, d, "part").select("p_partkey", X.snake_case(camel, F.concat(F.lit("column_"), F.col("p_partkey"))).alias("snake"))


@query("""
SELECT p_partkey, CASE WHEN k = 1 THEN b ELSE b || '_' || k END AS name FROM (SELECT p_partkey, b, row_number() OVER (PARTITION BY b ORDER BY p_partkey) AS k
 FROM (SELECT p_partkey, lower(regexp_replace(p_brand, '[^0-9A-Za-z]+', '_', 'g')) AS b FROM part))
""")
def snake_case_mapping(spark, d):
    base = read(spark, d, "part").select("p_partkey", X.snake_case(F.col("p_brand"), F.lit("column")).alias("b"))
    return base.select("p_partkey", enrich.unique_names(F.col("b"), "p_partkey").alias("name"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price FROM orders UNION ALL SELECT o_orderkey + 100000000, o_totalprice + 1 FROM orders WHERE o_orderkey % 3 = 0")
def upsert_merge(spark, d):
    target = read(spark, d, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    changed = target.where("o_orderkey % 3 = 0").withColumn("price", F.col("price") + 1)
    return load.upsert(target, changed.unionByName(changed.withColumn("o_orderkey", F.col("o_orderkey") + 100000000)), ["o_orderkey"])


@query("SELECT c_name, c_custkey, CAST(NULL AS VARCHAR) AS note FROM customer")
def promote_common_columns(spark, d):
    staged = read(spark, d, "customer").withColumnsRenamed({"c_custkey": "C_CUSTKEY"})
    target = spark.createDataFrame([], "c_name string, c_custkey bigint, note string")
    return load.promote(staged, target, "TRUNCATE")


@query("""
SELECT CAST(user_id AS BIGINT) AS audit_id, arg_max(event_type, event_id) AS status, max(event_id) AS last_event FROM events GROUP BY user_id
""")
def audit_current_state(spark, d):
    e = read(spark, d, "events")
    now = load.current_audit(e.withColumn("last_event", F.col("event_id")), "user_id", "event_id", "event_type", "last_event")
    return now.select(F.col("user_id").alias("audit_id"), F.col("event_type").alias("status"), "last_event")


@query("SELECT user_id AS workflow_id, event_type AS status, count(*) AS n FROM events GROUP BY 1, 2")
def audit_rollup(spark, d):
    return reports.rollup(read(spark, d, "events").select(F.col("user_id").alias("workflow_id"), F.col("event_type").alias("status")))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k <= 5")
def audit_latest(spark, d):
    return reports.latest(read(spark, d, "events").select("event_id", "user_id", "event_type"), "user_id", "event_id")


@query("SELECT count(*) AS processed, count(*) FILTER (WHERE event_type = 'error') AS failed, round(sum(value), 2) AS rows_loaded, CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN 0 ELSE 2 END AS status FROM events")
def run_summary(spark, d):
    return reports.summary(read(spark, d, "events"), F.col("event_type") == "error", "value")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def mapping_json(spark, d):
    return read(spark, d, "events").select("event_id", F.element_at(enrich.mappings(F.col("props")), "k").cast("bigint").alias("k"))


@query("""
SELECT 'customer' AS table_name, count(*) AS n FROM customer UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'supplier', count(*) FROM supplier
""")
def table_counts(spark, d):
    names = ("customer", "events", "lineitem", "nation", "orders", "part", "region", "supplier")
    return reports.row_counts({t: read(spark, d, t) for t in names})


_FILE = "source || '_' || CAST(doc_id % 50 AS VARCHAR) || CASE doc_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.PARQUET' WHEN 2 THEN '.xlsx' ELSE '.bin' END"


def files(spark, d) -> DataFrame:
    return read(spark, d, "documents").select("doc_id", F.expr(_FILE.replace("VARCHAR", "STRING")).alias("file_name"), "n_chars")


@query(f"SELECT doc_id, {_FILE} AS file_name, CASE doc_id % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'parquet' WHEN 2 THEN 'excel' ELSE 'other' END AS kind FROM documents")
def file_kind(spark, d):
    return files(spark, d).select("doc_id", "file_name", X.file_kind(F.col("file_name")).alias("kind"))


@query("SELECT doc_id, regexp_replace(lower(source), '[0-9]+', '{n}', 'g') || '_{n}' AS signature FROM documents")
def stem_signature(spark, d):
    return files(spark, d).select("doc_id", X.stem_signature(F.col("file_name")).alias("signature"))


@query("SELECT doc_id % 4 AS ext, 'src*_*.' || CASE doc_id % 4 WHEN 0 THEN 'csv' WHEN 1 THEN 'parquet' WHEN 2 THEN 'xlsx' ELSE 'bin' END AS pattern, count(*) AS members FROM documents GROUP BY 1, 2")
def family_pattern(spark, d):
    ext = F.lower(F.regexp_extract("file_name", r"\.([^.]*)$", 1))
    f = files(spark, d).select((F.col("doc_id") % 4).alias("ext"), X.family_pattern(X.stem_signature(F.col("file_name")), ext).alias("pattern"))
    return f.groupBy("ext", "pattern").agg(F.count("*").alias("members"))


@query("SELECT page_id, 'html_or_xml' AS kind FROM pages WHERE html LIKE '<!DOCTYPE%'")
def payload_kind(spark, d):
    return read(spark, d, "pages").select("page_id", X.payload_kind(F.col("html")).alias("kind"))


@query("SELECT doc_id, n_chars FROM documents WHERE n_chars > 5000")
def oversize_files(spark, d):
    return oversize(files(spark, d).withColumnRenamed("n_chars", "length"), 5000).select("doc_id", F.col("length").alias("n_chars"))


@query("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'TRUNCATE' WHEN 1 THEN 'APPEND' WHEN 2 THEN 'TRUNCATE' WHEN 3 THEN 'TRUNCATE' ELSE 'INVALID' END AS strategy FROM orders")
def load_strategy_resolve(spark, d):
    raw = F.expr("CASE o_orderkey % 5 WHEN 0 THEN 'truncate-reload' WHEN 1 THEN ' append ' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE 'merge' END")
    return read(spark, d, "orders").select("o_orderkey", X.load_strategy(raw).alias("strategy"))


for _table in (QUERIES, ORACLES):  # the key of the inventory; the function of that name is the operator
    _table["schema_diff"] = _table.pop("schema_diff_customer")
