"""Schemas by aggregate, the schema ledger, and compaction by size."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import compaction, swap
from tidemark.sinks.partitions import replace_partition
from tidemark.sources import schema_facts as sf


def land(path, *payloads):
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(f"{path.replace('file:', '')}/a.jsonl", "w") as f:
        f.writelines(f'{{"_airbyte_ab_id":"x","_airbyte_data":{p}}}\n' for p in payloads)


def test_widening():
    order = [None, "INT64", "FLOAT64", "BOOLEAN", "RECORD", "STRING"]
    for a in order:
        assert sf.widest_of(a, None) == sf.widest_of(None, a) == sf.widest_of(a, a) == a
        assert sf.widest_of(a, "STRING") == "STRING"
        for b in order:
            assert sf.widest_of(a, b) == sf.widest_of(b, a)
            for c in order:
                assert sf.widest_of(sf.widest_of(a, b), c) == sf.widest_of(a, sf.widest_of(b, c))


def test_fields_of_all_tables(spark, tmp_shared):
    land(f"{tmp_shared}/a b", '{"ID":1,"x":null}', '{"id":"1"}', "{}", "null")
    land(f"{tmp_shared}/c", '{"x":1,"y":{"z":[1]},"big":123456789012345678901,"e":1e3,"l":[1]}', '{"x":1.5,"y":null}')
    got = {(r.table_name, r.field): tuple(r)[2:] for r in sf.observed_fields(spark, [f"{tmp_shared}/a b", f"{tmp_shared}/c"]).collect()}
    assert got == {
        ("a b", "id"): ("STRING", 4, 2, 0, ["INT64", "STRING"], True), ("a b", "x"): (None, 4, 0, 1, [], False),
        ("c", "x"): ("FLOAT64", 2, 2, 0, ["FLOAT64", "INT64"], False), ("c", "y"): ("RECORD", 2, 1, 1, ["RECORD"], False),
        ("c", "big"): ("FLOAT64", 2, 1, 0, ["FLOAT64"], False), ("c", "e"): ("FLOAT64", 2, 1, 0, ["FLOAT64"], False),
        ("c", "l"): ("STRING", 2, 1, 0, ["STRING"], False)}


def test_malformed_lines_fail(spark, tmp_shared):
    land(f"{tmp_shared}/a", '{"id":', '{"id":1}')
    with pytest.raises(Exception, match="(?i)malformed"):
        sf.observed_fields(spark, f"{tmp_shared}/a").collect()


def test_ledger_versions(spark, tmp_shared):
    note = lambda fields, run: sf.note_fields(spark, f"{tmp_shared}/l", "t", fields, run)
    assert note({"a": "INT64", "n": None}, "r1") == 1
    assert note({"A": "INT64", "b": "BOOLEAN"}, "r2") == 1  # a new field needs no version
    assert note({"a": "FLOAT64"}, "r3") == 2
    assert note({"a": "INT64"}, "r1") == 2  # a narrower type changes nothing
    assert note({"n": "INT64"}, "r4") == 3
    rows = sf.read_ledger(spark, f"{tmp_shared}/l", "t")
    assert [(r.field, r.type, r.first_run, r.last_run) for r in rows if r.version == 3] == [
        ("a", "FLOAT64", "r1", "r1"), ("b", "BOOLEAN", "r2", "r2"), ("n", "INT64", "r1", "r4")]
    assert [(r.field, r.type) for r in rows if r.version == 1] == [("a", "INT64"), ("b", "BOOLEAN"), ("n", None)]
    assert sf.read_ledger(spark, f"{tmp_shared}/l", "other") == []


def test_staged_drops(spark, tmp_shared):
    stage = lambda run, *payloads: (land(f"{tmp_shared}/{run}/t", *payloads), sf.stage_drop(
        spark, f"{tmp_shared}/{run}/t", f"{tmp_shared}/stage", f"{tmp_shared}/ledger", "t", run))[1]
    read = lambda: sorted(map(tuple, sf.read_staged(
        spark, f"{tmp_shared}/stage", f"{tmp_shared}/ledger", "t").select("run", "id", "v").collect()), key=str)
    assert stage("r1", '{"id":1,"v":1}') == 1
    assert stage("r2", '{"id":2}', '{"ID":3,"v":2.5}') == 2
    assert read() == [("r1", 1, 1.0), ("r2", 2, None), ("r2", 3, 2.5)]
    assert stage("r1", '{"id":9}') == 2  # repeated with other rows, now under version 2
    assert read() == [("r1", 9, None), ("r2", 2, None), ("r2", 3, 2.5)]
    assert stage("r3", '{"id":4,"v":{"x":1}}') == 3
    assert read()[-1] == ("r3", 4, '{"x":1}')


def files(spark, path):
    return {r.path: r.length for r in compaction.data_files(spark, path).collect()}


def table(spark, path, days=("a:b c", "2"), n=8):
    for day in days:
        for i in range(n):
            df = spark.createDataFrame([(i, str(day))], "id int, day string").coalesce(1)
            (df.withColumn("late", F.lit(1)) if i % 2 else df).write.mode("append").partitionBy("day").parquet(path)


def rows(spark, path):
    return sorted(((r.day, r.id, r.late) for r in spark.read.option("mergeSchema", True).parquet(path).collect()), key=str)


def test_bins(spark):
    sizes = [10, 20, 30, 40, 50, 60, 99, 100, 500]
    plan = compaction.packed(spark.createDataFrame([(f"f{s}", s, "d") for s in sizes] + [("g", 1, "e")],
                                                   "path string, length long, folder string"), 100, 100)
    got = {}
    for r in plan.collect():
        got.setdefault((r.folder, r.bin), []).append(r.length)
    assert {k: sorted(v) for k, v in got.items()} == {("d", 0): [10, 20, 30, 40], ("d", 1): [50, 60]}


def test_compaction_rewrites_small_files_only(spark, tmp_shared):
    path = f"{tmp_shared}/t"
    table(spark, path)
    spark.range(200_000).select(F.col("id").cast("int"), F.lit(2).alias("late"), F.lit("2").alias("day")).coalesce(1) \
        .write.mode("append").partitionBy("day").parquet(path)
    before, held = files(spark, path), rows(spark, path)
    big = max(before, key=before.get)
    assert compaction.compact(spark, path, target=100_000, small_below=50_000, batch_files=10) == 16
    after = files(spark, path)
    assert rows(spark, path) == held and len(after) == 3 and big in after
    assert compaction.compact(spark, path, target=100_000, small_below=50_000) == 0
    assert files(spark, path) == after


def test_compaction_survives_a_dead_run(spark, tmp_shared, monkeypatch):
    path = f"{tmp_shared}/t"
    table(spark, path, days=("1",))
    held, before = rows(spark, path), files(spark, path)

    def die(*args):
        raise KeyboardInterrupt

    # dead before the journal: nothing has happened
    with monkeypatch.context() as m:
        m.setattr(compaction, "journal_moves", die)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, path)
    assert files(spark, path) == before

    # dead in the exchange, after the old files are gone: the next one finishes it, a writer of the table too
    with monkeypatch.context() as m:
        m.setattr(swap, "_rename", die)
        with pytest.raises(KeyboardInterrupt):
            compaction.compact(spark, path)
    assert files(spark, path) == {}
    replace_partition(spark.createDataFrame([(5,)], "id int").coalesce(1), path, "day", "2")
    assert [r for r in rows(spark, path) if str(r[0]) == "1"] == [(1, i, x) for _, i, x in held]
    assert len(files(spark, path)) == 2 and swap.finish_moves(spark, path) == 0


def test_compaction_raises_for_types_that_differ(spark, tmp_shared):
    path = f"{tmp_shared}/t"
    spark.createDataFrame([(1,)], "id int").write.parquet(path)
    spark.createDataFrame([("x",)], "id string").write.mode("append").parquet(path)
    before = files(spark, path)
    with pytest.raises(Exception, match="(?i)merge"):
        compaction.compact(spark, path)
    assert files(spark, path) == before
