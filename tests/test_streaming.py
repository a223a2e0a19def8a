from __future__ import annotations

from gatewright.streaming import ingest
from pyspark.sql.types import StructType


def test_keys_are_watched_over_batches_and_restarts(spark, tmp_path):
    inbox, out = tmp_path / "in", str(tmp_path / "out")
    inbox.mkdir()
    schema = StructType.fromDDL("id string, v string")

    def arrive(name: str, text: str) -> set:
        (inbox / name).write_text("id,v\n" + text)
        rows = spark.readStream.schema(schema).option("header", True).csv(str(inbox))
        ingest.watch_keys(rows, ["id"], str(tmp_path / "checkpoint"), out).awaitTermination()  # a new query each time, from the checkpoint
        return {(r.id, r.n, r["_batch"]) for r in spark.read.parquet(out).collect()}

    assert arrive("a.csv", "1,a\n2,b\n") == set()
    assert arrive("b.csv", "2,c\n3,d\n,x\n") == {("2", 2, 1)}
    assert arrive("c.csv", "2,e\n4,f\n4,g\n,y\n") == {("2", 2, 1), ("2", 3, 2), ("4", 2, 2), (None, 2, 2)}
    assert arrive("d.csv", "5,a\n") == {("2", 2, 1), ("2", 3, 2), ("4", 2, 2), (None, 2, 2)}


def test_repeats_within_a_delay_are_dropped(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    (inbox / "a.csv").write_text("1,2024-01-01 00:00:00\n1,2024-01-01 00:00:05\n2,2024-01-01 00:00:01\n")
    rows = spark.readStream.schema("id string, at timestamp").csv(str(inbox))
    first = ingest.first_within(rows, ["id"], "at", "1 minute")
    first.writeStream.format("parquet").option("path", str(tmp_path / "t")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["1", "2"]


def test_the_number_of_buckets_is_the_callers(spark, tmp_path):
    at = [str(tmp_path / k) for k in ("target", "quarantine", "issues")]
    rows = spark.range(100).select("id")
    assert ingest.load_batch(rows, 0, *at, ["id"], buckets=7)
    assert not ingest.load_batch(spark.range(99, 101), 1, *at, ["id"], buckets=7)
    assert ingest.load_batch(spark.range(100, 120), 2, *at, ["id"], buckets=7)
    assert spark.read.parquet(at[0]).select("_bucket").distinct().count() == 7


def test_dates_of_a_stream_follow_their_files(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()
    at = {k: str(tmp_path / k) for k in ("checkpoint", "target", "quarantine", "issues")}
    schema = StructType.fromDDL("id string, day string")

    def arrive(**files: str) -> None:
        for name, text in files.items():
            (inbox / f"{name}.csv").write_text("id,day\n" + text)
        ingest.stream_csv(spark, str(inbox), schema, key=["id"], **at, **ingest.dates_by_file(["day"])).awaitTermination()

    arrive(au="1,13/02/2024\n2,01/02/2024\n", us="3,02/13/2024\n4,01/02/2024\n", free="5,soon\n6,01/02/2024\n")
    arrive(both="7,13/02/2024\n8,02/13/2024\n")
    arrive(late="9,2024-03-01\n")
    loaded = {r.id: (r.day, r.source_file_name) for r in spark.read.parquet(at["target"]).collect()}
    assert loaded["1"] == ("2024-02-13", "au.csv") and loaded["2"][0] == "2024-02-01" and loaded["4"][0] == "2024-01-02" and loaded["9"][0] == "2024-03-01"
    assert loaded["5"][0] == "soon" and loaded["6"][0] == "01/02/2024" and len(loaded) == 7
    assert {(r.id, r.day) for r in spark.read.parquet(at["quarantine"]).collect()} == {("7", "13/02/2024"), ("8", "02/13/2024")}
    assert [r.code for r in spark.read.parquet(at["issues"]).collect()] == ["CONFLICTING_DATE_ORDERS"]
