"""CSV, JSON and streaming files."""

import pytest
from pyspark.sql import functions as F

from brightloom.functions import maths, text
from brightloom.sources import io
from brightloom.sources.snapshots import Conflict, SnapshotTable
from brightloom.streaming import files


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "quoted"\nline', [1])], "CustomerID string, note string, listed array<int>")
    io.write_csv(df, str(tmp_path / "csv"))
    back = io.read_csv(spark, str(tmp_path / "csv"), multiline=True)
    assert back.columns == ["CustomerID", "note"] and back.first()["note"] == 'a "quoted"\nline'
    with pytest.raises(ValueError, match=r"\['InvoiceDate', 'Quantity', 'UnitPrice'\]"):
        io.read_transactions(spark, str(tmp_path / "csv"))
    found, is_fallback = io.load_dataset(spark, str(tmp_path / "none"), df)
    assert is_fallback and found.count() == 1
    assert io.load_dataset(spark, str(tmp_path / "csv"), df)[1] is False
    with pytest.raises(FileNotFoundError):
        io.load_dataset(spark, str(tmp_path / "none"))


def test_datasets_keep_quoted_line_breaks(spark, tmp_path):
    columns = ["InvoiceDate", "Quantity", "UnitPrice", "CustomerID", "note"]
    df = spark.createDataFrame([("d", "1", "2", "c", "one\ntwo"), ("e", "3", "4", "f", 'a "b"\n\nc')], columns)
    io.write_csv(df, str(tmp_path / "csv"))
    expected = sorted(map(tuple, df.collect()))
    found, is_fallback = io.load_dataset(spark, str(tmp_path / "csv"))
    assert not is_fallback and sorted(map(tuple, found.collect())) == expected
    assert sorted(map(tuple, io.read_transactions(spark, str(tmp_path / "csv")).collect())) == expected


def test_responses_csv(spark, tmp_path):
    records = spark.createDataFrame([("e", "p", {"a": "b"})], "experiment_id string, prompt_id string, metadata map<string,string>")
    io.write_responses_csv(records, str(tmp_path / "csv"))
    assert io.read_csv(spark, str(tmp_path / "csv")).columns == list(io.RESPONSE_COLUMNS)


def test_experiment_export(spark, tmp_path):
    experiments = spark.createDataFrame([("e", "n"), ("f", "m")], "experiment_id string, name string")
    results = spark.createDataFrame([("e", i, f"r{i}") for i in range(7)], "experiment_id string, seq long, response string")
    io.write_experiments(experiments, {"results": results}, str(tmp_path / "json"))
    back = spark.read.schema(results.schema).json(str(tmp_path / "json" / "results"))
    assert sorted(back.collect()) == sorted(results.collect())
    assert spark.read.json(str(tmp_path / "json" / "experiments")).count() == 2
    with pytest.raises(ValueError):
        io.write_experiments(experiments, {"other": spark.range(1)}, str(tmp_path / "more"))


def test_stateless_operators_on_a_file_stream(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = "id long, body string, mark string"

    def operator(df):
        return df.select("id", text.word_count(F.col("body")).alias("words"), maths.grade_band(F.col("mark")).alias("g"))

    spark.createDataFrame([(1, "a b", "95"), (2, "", "x")], schema).write.mode("append").parquet(source)
    files.run_available(files.read_files(spark, source, schema), operator, out, checkpoint).awaitTermination()
    spark.createDataFrame([(3, "c", "5")], schema).write.mode("append").parquet(source)
    files.run_available(files.read_files(spark, source, schema), operator, out, checkpoint).awaitTermination()
    rows = spark.read.parquet(out).orderBy("id").collect()
    assert [(r["id"], r["words"], r["g"]["grade"]) for r in rows] == [(1, 2, "A1"), (2, 0, "invalid"), (3, 1, "lowest")]


def test_snapshots_switch_whole(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long").schema
    table = SnapshotTable(spark, f"file://{tmp_path}/t", schema, "k", buckets=4)
    assert table.version() == 0 and table.read().count() == 0 and table.get("a").count() == 0
    rows = [(f"k{i}", i) for i in range(40)] + [(None, 7)]
    assert table.put(spark.createDataFrame(rows, schema)) == 1
    files = {p.name for p in (tmp_path / "t" / "data").rglob("*.parquet")}
    assert table.put(spark.createDataFrame([("k3", 300), ("k3", 301), (None, 8)], schema)) == 2
    found = sorted(map(str, (tuple(r) for r in table.read().collect())))
    expected = [r for r in rows if r[0] not in ("k3", None)] + [("k3", 300), ("k3", 301), (None, 8)]
    assert found == sorted(map(str, expected))
    assert sorted(r["v"] for r in table.get("k3").collect()) == [300, 301]
    assert files <= {p.name for p in (tmp_path / "t" / "data").rglob("*.parquet")} and table.read(1).count() == 41
    assert table.put(spark.createDataFrame([("k3", 9), ("k4", 500)], schema), "v") == 3
    assert [r["v"] for r in table.get("k3").collect()] == [301] and table.get("k4").first()["v"] == 500


def test_a_failed_save_leaves_the_old_state(spark, tmp_path):
    schema = spark.createDataFrame([], "k string, v long").schema
    table = SnapshotTable(spark, f"file://{tmp_path}/t", schema, "k")
    table.put(spark.createDataFrame([("a", 1)], schema))
    broken = spark.range(5).select(
        F.lit("a").alias("k"), F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")).alias("v")
    )
    with pytest.raises(Exception, match="lost"):
        table.put(broken)
    assert table.version() == 1 and [tuple(r) for r in table.read().collect()] == [("a", 1)]
    # A second writer of a version that is there already changes nothing.
    table.put(spark.createDataFrame([("b", 2)], schema))
    with pytest.raises(Conflict):
        table.put(spark.createDataFrame([("a", 3)], schema), version=1)
    assert {tuple(r) for r in table.read().collect()} == {("a", 1), ("b", 2)}
    held = table.read()
    table.clear()
    assert table.read().count() == 0 and held.count() == 2
