"""Bad landing lines are split off, good ones load."""

import datetime as dt
import json
import os

import pytest

from tidemark.operators.typed import Field, typed_projection
from tidemark.plans import jobs
from tidemark.sources.files import read_envelope_jsonl
from tidemark.sources.quarantine import judged_lines, split_lines

D = dt.date(2024, 1, 5)
FIELDS = [Field("id", "INT64", "REQUIRED"), Field("n", "INT64", "NULLABLE"), Field("x", "FLOAT64", "NULLABLE"),
          Field("b", "BOOLEAN", "NULLABLE"), Field("d", "DATE", "NULLABLE"), Field("ts", "DATETIME", "REQUIRED"),
          Field("i", "TIMESTAMP", "NULLABLE"), Field("y", "BYTES", "NULLABLE"), Field("s", "STRING", "NULLABLE")]
GOOD = {"ID": "1", "ts": "2024-01-05T01:02:03.1234567Z"}


def land(path, payloads):
    path = path.replace("file:", "")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        for p in payloads:
            fh.write((p if isinstance(p, str) else json.dumps({"_airbyte_ab_id": "a", "_airbyte_emitted_at": 0, "_airbyte_data": p})) + "\n")


CASES = [
    ({}, []), ({"n": ""}, []), ({"n": " 7 "}, []), ({"n": "2.5"}, []), ({"n": 9223372036854775807}, []), ({"n": "9223372036854775808"}, ["n: not INT64"]),
    ({"n": "1e"}, ["n: not INT64"]), ({"n": "0x1"}, ["n: not INT64"]), ({"x": "1e5"}, []), ({"x": "abc"}, ["x: not FLOAT64"]), ({"b": "TRUE"}, []),
    ({"b": "yes"}, ["b: not BOOLEAN"]), ({"d": "2024-01-05T00:00:00Z"}, []), ({"d": ""}, []), ({"d": "2024-02-30T00:00:00Z"}, ["d: not DATE"]),
    ({"i": "2024-01-05T00:00:00Z"}, []), ({"i": "now"}, ["i: not TIMESTAMP"]), ({"y": "QUI="}, []), ({"s": "any ünï"}, []),
    ({"ts": None}, ["ts: required"]), ({"ts": ""}, ["ts: not DATETIME"]), ({"ID": ""}, ["id: required"]),
    ({"ID": "x", "x": "y"}, ["id: not INT64", "x: not FLOAT64"])]


def test_reasons_agree_with_the_strict_load(spark, tmp_shared):  # T5, D3, D4, D7
    for i, (change, _) in enumerate(CASES):
        land(f"{tmp_shared}/in/{i:02}.jsonl", [GOOD | change])
    land(f"{tmp_shared}/in/90.jsonl", ['{"_airbyte_ab_id": "a", "_airbyte', "[1]", "", "nothing", '{"other": 1}'])
    got = {}
    for r in judged_lines(spark, f"{tmp_shared}/in/*.jsonl", FIELDS).collect():
        got.setdefault(r.path.rsplit("/", 1)[1][:2], []).append(list(r.reasons))
    assert got == {f"{i:02}": [reasons] for i, (_, reasons) in enumerate(CASES)} | {"90": [["malformed"]] * 4}
    # the strict load takes the good ones and raises for values that are not of their type
    for i, (_, reasons) in enumerate(CASES):
        rows = typed_projection(read_envelope_jsonl(spark, f"{tmp_shared}/in/{i:02}.jsonl"), FIELDS)
        if any("not" in x for x in reasons):
            with pytest.raises(Exception):
                rows.collect()
        else:
            assert len(rows.collect()) == 1


def test_load_up_to_the_limit(spark, tmp_shared):
    land(f"{tmp_shared}/in/a b.jsonl", [GOOD | {"ID": str(i)} for i in range(8)] + [GOOD | {"n": "?"}, "{"])
    load = lambda most: jobs.quarantined_load(spark, f"{tmp_shared}/in/*", FIELDS, D, D, f"{tmp_shared}/t", f"{tmp_shared}/r", most)
    rows = lambda: sorted(r.id for r in spark.read.parquet(f"{tmp_shared}/t").collect())
    assert load(0.2) == 2 and rows() == list(range(8))
    rejects = spark.read.parquet(f"{tmp_shared}/r").collect()
    assert sorted(r.reasons[0] for r in rejects) == ["malformed", "n: not INT64"] and {r.path.rsplit("/", 1)[1] for r in rejects} == {"a b.jsonl"}
    # a worse delivery is not loaded: the day stays, its rejects can be seen
    land(f"{tmp_shared}/in/c.jsonl", ["{"])
    with pytest.raises(jobs.TooManyRejects):
        load(0.2)
    assert rows() == list(range(8)) and spark.read.parquet(f"{tmp_shared}/r").count() == 3
    assert load(0.5) == 3 and rows() == list(range(8))


def test_a_line_is_parsed_once_in_each_plan(spark, tmp_shared):
    """A filter on the reasons that reaches the scan would repeat the parse for every mention of a value."""
    land(f"{tmp_shared}/in/a.jsonl", [GOOD])
    for part in split_lines(spark, f"{tmp_shared}/in/*", FIELDS):
        assert part._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
