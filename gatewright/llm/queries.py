"""The registered queries of this folder and their SQL, for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import round_trip
from .decontaminate import decontaminate
from .fill_in_middle import fill_in_middle, restored
from .html_extract import extract
from .line_dedup import apply_bitmaps, keep_bitmaps
from .minhash import near_duplicates
from .prefix_trie import conversation_trie
from .quality_rules import quality_rules
from .secrets_scan import as_text, find_secrets
from .simhash import simhash_duplicates
from .suffix_dedup import suffix_dedup
from .token_output import read_segments, write_segments
from .toxicity import score, train


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("bigint"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = train(docs, labels.where(~held_out))
    scored = score(docs, model).select("doc_id", "score", "offending")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.to_json("offending").alias("offending")
    )


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_segments(write_segments(table(spark, sf_dir, "documents")))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))

    def of(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = apply_bitmaps(docs, keep_bitmaps(docs, min_docs=10))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    digests = {"output_sha256": F.sha2("output", 256), "restored_sha256": F.sha2(restored(F.col("output"), F.col("form")), 256)}
    return made.withColumns(digests).drop("output")


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_bpe": op2_bpe,
    "op3_decontaminate": op3_decontaminate,
    "op4_toxicity": op4_toxicity,
    "op5_token_output": op5_token_output,
    "op6_secrets": op6_secrets,
    "op7_minhash": op7_minhash,
    "op8_line_dedup": op8_line_dedup,
    "op9_suffix_array": op9_suffix_array,
    "op10_quality_rules": op10_quality_rules,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_simhash": op13_simhash,
}

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
_STRIPPED = r"regexp_replace(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')"

ORACLES: dict[str, str] = {
    "op3_decontaminate": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
items AS (SELECT item_id, w, least(len(w), 10) AS m FROM b WHERE len(w) > 0),
wins AS (SELECT item_id, m, array_to_string(w[s + 1 : s + m], ' ') AS g FROM (SELECT item_id, w, m, unnest(range(0, len(w) - m + 1)) AS s FROM items)),
sizes AS (SELECT DISTINCT m FROM wins),
grams AS (SELECT doc_id, s, m, array_to_string(w[s + 1 : s + m], ' ') AS g FROM (SELECT doc_id, w, m, unnest(range(0, len(w) - m + 1)) AS s FROM d, sizes WHERE len(w) >= m)),
hit AS (SELECT DISTINCT doc_id, s, grams.m, item_id FROM grams JOIN wins ON grams.g = wins.g AND grams.m = wins.m),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + m)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
""",
    "op8_line_dedup": rf"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents),
k AS (SELECT doc_id, line, p, {_STRIPPED.format('line')} AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY doc_id
""",
    "op10_quality_rules": rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT doc_id, s, array_to_string(w[s + 1 : s + 5], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS s FROM w WHERE len(w) >= 5)),
r AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT g.doc_id, unnest(range(s, s + 5)) AS p FROM g JOIN r ON g.doc_id = r.doc_id AND g.g = r.g) GROUP BY doc_id),
l AS (SELECT doc_id, source, {_STRIPPED.format('x')} AS key FROM (SELECT doc_id, source, unnest(ls) AS x FROM w)),
f AS (SELECT source, key FROM (SELECT source, key, count(DISTINCT doc_id) AS n_docs FROM l GROUP BY source, key) WHERE n_docs >= 10),
lost AS (SELECT doc_id, sum(length(regexp_replace(l.key, '[\x20\x09-\x0D]+', '', 'g'))) AS c FROM l JOIN f ON l.source = f.source AND l.key = f.key GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
 CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, CAST(coalesce(lost.c, 0) AS BIGINT) AS removed_chars
 FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id LEFT JOIN lost ON w.doc_id = lost.doc_id),
v AS (SELECT *, word_chars > 0 AND word_chars - removed_chars < 0.3 * word_chars AS depleted, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, removed_chars, depleted, base_failed, NOT base_failed AND NOT depleted AS kept FROM v
""",
    "op11_fill_in_middle": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
 CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
""",
    "op12_prefix_trie": r"""
WITH t AS (SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, l, xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: list_concat([CAST(ascii(x) AS BIGINT)], [-1, -1, -1, -1, -1, -1, -1, -1])))),
 lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) % 9 AS h FROM t),
r AS (SELECT h.c, list_concat(coalesce(b.l, [])[1:h], h.l[h + 1:]) AS l FROM h LEFT JOIN t b ON b.c = h.c - h.c % 5),
m AS (SELECT c, d, l[1:d] AS k, d = len(l) AS ends FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM r)),
n AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '') AS e FROM m GROUP BY k, d),
w AS (SELECT n.*, (n_convs - 1) * CASE WHEN d = 0 THEN 0 ELSE strlen(n.k[d].t) END AS own, coalesce(ch.n, 0) AS n_children FROM n LEFT JOIN (SELECT k[1:d - 1] AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY 1) ch ON n.k = ch.k),
s AS (SELECT k[1:a] AS k, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(own) AS saved FROM (SELECT k, own, n_children, unnest(range(0, d + 1)) AS a FROM w) GROUP BY 1)
SELECT w.conv_id, CAST(w.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(w.e) AS ends_sha256
FROM w JOIN s ON w.k = s.k LEFT JOIN n p ON w.d > 0 AND p.k = w.k[1:w.d - 1]
""",
}
