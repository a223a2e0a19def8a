from __future__ import annotations

import os
import signal
import subprocess
import sys
from itertools import combinations
from pathlib import Path

import pytest
from gatewright.operators import dates, keys, load, profile, samples
from gatewright.operators.validate import Column, contract_columns, contract_frame, text_date_issues, validate
from gatewright.sources.files import read_csv
from gatewright.sources.loadset import load_set, shared_folder, survey_files
from gatewright.sources.versions import CommitConflict, VersionedTable
from pyspark.sql import functions as F


# files of several layouts and encodings


def test_load_set_of_layouts_encodings_and_preambles(spark, tmp_path):
    (tmp_path / "B one.csv").write_bytes(b"\xef\xbb\xbfid,name\n1,\xc3\xa9\n")
    (tmp_path / "a[2].csv").write_bytes(b"name,ID,extra\ncaf\xe9 \x80,2,x\n")
    (tmp_path / "c.csv").write_bytes(b"id,name\n3,\x81\xe9\n\n")
    (tmp_path / "d.csv").write_bytes(b"id,name\n")
    rows = load_set(spark, str(tmp_path))
    assert rows.columns == ["name", "ID", "extra", "source_file_name"]  # of the first file by name without case
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([("é", "1", None, "B one.csv"), ("café €", "2", "x", "a[2].csv"), ("\x81é", "3", None, "c.csv")], key=str)


def test_load_set_counts_the_preamble_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("made today\n\nid,v\n1,x\n")
    (tmp_path / "b.csv").write_text("made today\nby me\n\nid,v\n2,y\n")  # a blank line between preamble and header
    (tmp_path / "c.csv").write_text("\n\nid,v\n3,z\n")
    assert sorted((r.id, r.v) for r in load_set(spark, str(tmp_path), header_skip_rows=2).collect()) == [("1", "x"), ("2", "y"), ("3", "z")]
    found = {r.path[-5:]: (r.filled, bytes(r.header)) for r in survey_files(spark, str(tmp_path), 2).collect()}
    assert found == {"a.csv": (1, b"id,v"), "b.csv": (2, b"id,v"), "c.csv": (0, b"id,v")}


def test_load_set_of_split_files_and_line_breaks(spark, tmp_path):
    (tmp_path / "big.csv").write_text("id,v\n" + "".join(f"{k},value {k}\n" for k in range(20_000)))
    (tmp_path / "small.csv").write_text('v,id\n"two\nlines",x\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        assert load_set(spark, str(tmp_path / "big.csv")).agg(F.sum("id"), F.count("v")).first()[:] == (sum(range(20_000)), 20_000)
        both = load_set(spark, str(tmp_path), multiline=True)
        assert both.count() == 20_001 and both.where("id = 'x'").first().v == "two\nlines"
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_load_set_without_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,v\n1,x\n")
    (tmp_path / "b.csv").write_text("\n \n")
    with pytest.raises(ValueError, match="no header row in 1 files"):
        load_set(spark, str(tmp_path))


def test_csv_of_windows_1252_leaves_the_session_as_it_is(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes(b"t\xeate,b\n\x80\x93,2\n")
    before = spark.conf.get("spark.sql.legacy.javaCharsets", None)
    rows = read_csv(spark, str(tmp_path), encoding="windows-1252")
    assert rows.columns[0] == "tête" and rows.first()[0] == "€“"
    assert spark.conf.get("spark.sql.legacy.javaCharsets", None) == before


# key search


def by_hand(rows: list[dict], candidates: list[str], most: int = 3) -> list[str] | None:
    for n in range(1, most + 1):
        for combo in combinations(candidates, n):
            values = [tuple(r[c] for c in combo) for r in rows]
            if len(set(values)) == len(rows) and all(x is not None for v in values for x in v):
                return list(combo)
    return None


@pytest.mark.parametrize("sample_rows", [1, 40, 20_000])
def test_key_search_of_twelve_candidates_equals_brute_force(spark, sample_rows):
    names = [f"c{k}" for k in range(12)]
    rows = [{c: (i * (k + 3) + i // (k + 2)) % (k + 4) if k < 9 else i // 40 if k == 9 else i % 40 if k == 10 else (None if i == 7 else i) for k, c in enumerate(names)} for i in range(400)]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], ", ".join(f"{c} long" for c in names))
    assert by_hand(rows, names) is not None
    assert keys.infer_key(df, names, sample_rows=sample_rows) == by_hand(rows, names)
    assert keys.infer_key(df, names[:4], sample_rows=sample_rows) == by_hand(rows, names[:4])


def test_key_search_takes_two_jobs_a_level_at_most(spark):
    df = spark.range(3000).select(*[(F.col("id") % n).alias(f"m{n}") for n in (50, 51, 53, 7, 11, 13, 17, 19)])
    tracker, group = spark.sparkContext.statusTracker(), "key search"
    spark.sparkContext.setJobGroup(group, group)
    found = keys.infer_key(df, df.columns, sample_rows=500)
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "other")
    assert found == by_hand([r.asDict() for r in df.collect()], df.columns)
    assert jobs <= 2 + 2 * 3 * 3  # two levels; with adaptive plans a query is up to three jobs


def test_key_search_sends_no_row_once_a_combination(spark, monkeypatch):
    # pairs of equal values are everywhere but rare, so a sample of 100 rows holds none
    n, sent = 20_000, []
    df = spark.range(n).select(*[F.floor((F.col("id") * k % n) / 2).alias(f"c{k}") for k in (1, 3, 7, 9, 11, 13)], F.col("id").alias("z"))
    one, test = keys.repeated, keys._witnesses
    monkeypatch.setattr(keys, "repeated", lambda df, combos: (sent.append(df.count() * len(combos)), one(df, combos))[1])
    monkeypatch.setattr(keys, "_witnesses", lambda df, combo, rows: (sent.append(rows), test(df, combo, rows))[1])
    assert keys.infer_key(df, df.columns, sample_rows=100) == ["z"]
    assert max(sent) <= n and sum(sent) < 3 * n


def test_one_doubled_row_costs_one_test_of_all_rows(spark, monkeypatch):
    df = spark.range(8000).select(F.col("id").alias("a"), F.col("id").cast("string").alias("b c"), (F.col("id") * 3).alias("d"))
    tested, test = [], keys._witnesses
    monkeypatch.setattr(keys, "_witnesses", lambda df, combo, rows: (tested.append(combo), test(df, combo, rows))[1])
    assert keys.infer_key(df.union(df.where("a = 77")), df.columns, sample_rows=50) is None
    assert len(tested) <= 1
    # twice the row, but told apart by one column
    assert keys.infer_key(df.withColumn("e", F.lit(1)).union(df.where("a = 77").withColumn("e", F.lit(2))), ["a", "b c", "e"], sample_rows=50) == ["a", "e"]
    # half of the rows hold one value
    half = df.select("d", F.when(F.col("a") % 2 == 0, F.col("a")).otherwise(1).alias("h"))
    assert keys.infer_key(half, ["h", "d"], sample_rows=50) == ["d"]


def test_a_share_of_values_refutes_and_never_accuses_a_key(spark):
    df = spark.range(50_000).select(F.floor(F.col("id") / 2).alias("a"), (F.col("id") % 2).cast("int").alias("b"), F.col("id").cast("string").alias("c d"))
    combos = [("a",), ("c d",), ("a", "b"), ("b",)]
    assert keys.repeated_in_share(df, combos[:3], 1 / 64) == {("a",)}
    assert keys.repeated_in_share(df, combos, 1.0) == {("a",), ("b",)}
    assert keys._witnesses(df, ("c d",), 50_000) is None and keys._witnesses(df, ("a", "b"), 50_000) is None
    rows = keys._witnesses(df, ("a",), 50_000)
    assert rows.count() == 2 * keys.WITNESSES and keys.repeated(rows, [("a",), ("a", "b")]) == {("a",)}


def test_key_search_by_stored_sketches(spark):
    df = spark.range(3000).select((F.col("id") % 2).alias("file"), (F.col("id") % 60).alias("a"), F.floor(F.col("id") / 60).alias("b"), F.when(F.col("id") > 0, F.col("id")).alias("c"))
    stored = profile.merge_sketches(profile.column_sketches(df, by=["file"]))
    assert keys.infer_key(df, ["c", "a", "b"], sketches=stored) == keys.infer_key(df, ["c", "a", "b"]) == ["a", "b"]
    with pytest.raises(ValueError, match="no sketches of"):
        keys.infer_key(df, ["file"], sketches=stored)


def test_repeated_names_the_combinations(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "x", 3)], "a int, `b c` string, d int")
    assert keys.repeated(df, [("a",), ("b c",), ("a", "b c"), ("d",), ("d", "a")]) == {("a",), ("b c",)}
    assert keys.repeated(df, []) == set()


# metrics


def test_metrics_are_counted_as_rows_pass(spark, tmp_path):
    df = spark.range(1000, numPartitions=5).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("k"), F.col("id").alias("v"))
    got = load.write_observed(df, lambda rows: load.write_truncate(rows, str(tmp_path / "t")), ["k"], F.col("v") < 100)
    assert got == load.Metrics(1000, 900, 100, 100)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 900
    assert load.write_observed(df.limit(0), lambda rows: load.write_truncate(rows, str(tmp_path / "e"))) == load.Metrics(0, 0, 0, 0)
    event = load.ledger_events(spark, "a", 2, "SUCCESS").withColumns(load.metric_columns(got)).first()
    assert (event.rows_scanned, event.rows_loaded, event.error_count, event.null_key_rows) == (1000, 900, 100, 100)


# versioned tables


def numbers(df) -> list[int]:
    return sorted(r[0] for r in df.collect())


def test_swap_replaces_adds_and_keeps_readers(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no version"):
        table.read()
    assert load.swap(table, [spark.range(3), spark.range(3, 5)], keys=["id"]) == 1
    old = table.read()
    assert load.swap(table, spark.range(10, 12)) == 2
    assert load.swap(table, spark.range(12, 13), "APPEND", ["id"]) == 3
    assert numbers(table.read()) == [10, 11, 12] and numbers(old) == [0, 1, 2, 3, 4] and numbers(table.read(1)) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="keys in target"):
        load.swap(table, spark.range(12, 14), "APPEND", ["id"])
    with pytest.raises(ValueError, match="duplicates"):
        load.swap(table, [spark.range(5), spark.range(4, 6)], keys=["id"])
    assert table.orphans() == [] and numbers(table.read()) == [10, 11, 12]
    load.swap(table, spark.range(0))
    assert table.read().columns == ["id"] and table.read().count() == 0
    assert len(table.expire(keep=1)) == 3 and table.numbers() == [4]


def test_a_commit_on_an_older_version_is_refused(spark, tmp_path):
    one, two = VersionedTable(spark, str(tmp_path / "t")), VersionedTable(spark, str(tmp_path / "t"))
    begun = one.stage(spark.range(2))
    load.swap(two, spark.range(5))
    with pytest.raises(CommitConflict):
        one.commit(begun, spark.range(2).schema, after=0)
    two.numbers = lambda: []  # as if it had not seen the other's commit
    with pytest.raises(CommitConflict):
        two.commit(begun, spark.range(2).schema)
    assert numbers(one.read()) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError, match="is committed"):
        one.discard(one.manifest()["folders"][0])
    with pytest.raises(ValueError, match="columns differ"):
        one.commit(one.stage(spark.range(1).toDF("x")), spark.range(1).toDF("x").schema, "APPEND")


def test_a_killed_writer_leaves_an_orphan_only(spark, tmp_path):
    folder = str(tmp_path / "t")
    table = VersionedTable(spark, folder)
    load.swap(table, spark.range(4))
    code = f"""
import os, signal
from pyspark.sql import SparkSession
from gatewright.sources.versions import VersionedTable
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
VersionedTable(spark, {folder!r}).stage(spark.range(100, 200))
os.kill(os.getpid(), signal.SIGKILL)
"""
    ended = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, env=os.environ, timeout=240, check=False)
    assert ended.returncode == -signal.SIGKILL
    assert numbers(table.read()) == [0, 1, 2, 3] and len(table.orphans()) == 1
    assert table.remove_orphans(3_600_000) == []  # it may be a writer at work
    assert len(table.remove_orphans(0)) == 1 and table.orphans() == []
    load.swap(table, spark.range(4, 6), "APPEND", ["id"])
    assert numbers(table.read()) == [0, 1, 2, 3, 4, 5]


# merge into buckets


def test_merge_replaces_only_the_folders_of_touched_keys(spark, tmp_path):
    path = str(tmp_path / "t")
    target = spark.range(200).select("id", F.lit("old").alias("v"), F.col("id").alias("w"))
    load.write_buckets(target, path, ["id"], 8)
    files = lambda: {p: p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}
    before = files()
    source = spark.createDataFrame([(3, "new"), (1003, "new"), (None, "none")], "id long, v string")
    touched = load.merge_buckets(source, path, ["id"])
    after = files()
    assert 1 <= touched <= 3 and len({p.parent for p in before if p not in after}) <= touched
    assert sum(p in after and after[p] == t for p, t in before.items()) >= 8 - touched
    want = sorted([*((i, "new" if i == 3 else "old", i) for i in range(200)), (1003, "new", None), (None, "none", None)], key=str)
    assert sorted(map(tuple, load.read_buckets(spark, path).collect()), key=str) == want
    assert load.merge_buckets(source.limit(0), path, ["id"]) == 0
    stored = spark.read.parquet(path)
    plan = load.touched_rows(stored, "_bucket_of_8", [2, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "IN (2,5)" in plan.replace("INSET", "IN").replace("2, 5", "2,5")
    with pytest.raises(ValueError, match="repeat in source"):
        load.merge_buckets(source.union(source), path, ["id"])


# samples and sketches


def test_smallest_distinct_values_of_groups(spark):
    df = spark.range(20_000, numPartitions=8).select((F.col("id") % 2).alias("g"), F.concat(F.lit("v"), F.lpad((F.col("id") % 50).cast("string"), 2, "0")).alias("t")).withColumn("t", F.when(F.col("g") == 0, F.col("t")))
    assert sorted(map(tuple, samples.smallest(df, ["g"], "t", 3).collect())) == [(0, "v00"), (0, "v02"), (0, "v04")]
    plan = samples.smallest(df, ["g"], "t", 3)._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
    both = samples.with_samples(df.groupBy("g").agg(F.count("*").alias("n")), df, ["g"], "t", "s", 2)
    assert sorted((r.g, r.n, r.s) for r in both.collect()) == [(0, 10_000, ["v00", "v02"]), (1, 10_000, [])]
    one = samples.with_samples(df.agg(F.count("*").alias("n")), df, [], "t", "s", 1).first()
    assert (one.n, one.s) == (20_000, ["v00"])


def test_invalid_dates_and_duplicate_keys_are_sampled(spark):
    df = spark.createDataFrame([("a", "1/2/2024"), ("a", "x"), ("a", "y"), ("a", "x"), ("b", None), ("b", " "), (None, "z")], "f string, t string")
    got = {r.f: (r.n_invalid, r.invalid) for r in dates.invalid_samples(df, "t", ["f"], 1).collect()}
    assert got == {"a": (3, ["x"]), "b": (0, []), None: (1, ["z"])}
    assert tuple(dates.invalid_samples(df, "t").first()) == (4, ["x", "y", "z"])
    dup = {r.f: (r.dup_groups, r.dup_rows, r.samples) for r in keys.duplicate_samples(df, ["t"], ["f"]).collect()}
    assert dup == {"a": (1, 2, ["x"]), "b": (0, 0, []), None: (0, 0, [])}


def test_text_dates_are_counted_and_sampled(spark):
    df = spark.range(1000).select(F.concat(F.lit("2024-01-"), F.lpad((F.col("id") % 20 + 1).cast("string"), 2, "0")).alias("day"))
    found = text_date_issues(df, contract_frame(spark, [Column("day", "date")])).first()
    assert found.detail == "count=1000, samples=" + ", ".join(f"2024-01-0{k}" for k in range(1, 6))


def test_sketches_add_up(spark):
    df = spark.range(30_000).select((F.col("id") % 3).alias("f"), "id", (F.col("id") % 100).alias("few"), F.when(F.col("id") > 0, F.col("id")).alias("gap"))
    sketches = profile.column_sketches(df, by=["f"])
    merged = {r.column_name: r for r in profile.key_bounds(profile.merge_sketches(sketches)).collect()}
    assert abs(merged["id"].n_distinct - 30_000) < 3000 and merged["few"].n_distinct == 100
    assert {c: r.may_be_key for c, r in merged.items()} == {"id": True, "few": False, "gap": False} and merged["gap"].nulls == 1


# contracts


@pytest.mark.parametrize(("value", "length"), [("2024-01-31", 5), ("12345678", 5), ("false", 2), ("abcdefgh", 5)])
def test_text_is_checked_for_length_whatever_it_looks_like(spark, value, length):
    df = spark.createDataFrame([(value,)], "v string")
    found = validate(df, contract_frame(spark, [Column("v", "varchar", char_len=length)])).collect()
    assert [(r.code, r.detail) for r in found] == [("STRING_LENGTH_EXCEEDED", str(len(value)))]


def test_native_types_go_before_text_and_families_follow_the_destination(spark):
    df = spark.createDataFrame([(float("nan"), True, 1, "1", "1", "1")], "a double, b boolean, c int, d string, e string, f string")
    kinds = [Column("a", "float"), Column("b", "bit"), Column("c", "bit"), Column("d", "bit"), Column("e", "int"), Column("f", "date")]
    found = validate(df, contract_frame(spark, kinds)).collect()
    assert sorted((r.column_name, r.detail) for r in found) == [("c", "numeric"), ("f", "string")]


def test_contract_of_a_catalog_table_has_its_lengths(spark):
    spark.sql("CREATE TABLE lengths (a VARCHAR(7), b CHAR(3), c STRING, d DECIMAL(9,2), e INT) USING parquet")
    try:
        want = [("a", "varchar", 7), ("b", "char", 3), ("c", "varchar", None), ("d", "decimal", None), ("e", "int", None)]
        assert [(c.name, c.type, c.char_len) for c in contract_columns("lengths")] == want
        assert [(c.name, c.type, c.char_len) for c in contract_columns(spark.table("lengths"))] == want
    finally:
        spark.sql("DROP TABLE lengths")


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
