"""Sources and sinks: skip rules, positions, errors (hand-made JSON)."""

import json
import os

import pytest

from zonepulse.sources import records as R
from zonepulse.sources import sinks


def write(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w") as f:
        f.write(text)
    return p


RECS = [
    {"_id": "a", "coordinates": {"latitude": -1.29, "longitude": 36.82},
     "isoDate": "2024-01-05T10:00:00.000Z", "dateInSeconds": 1704448800},
    {"_id": "b", "coordinates": None, "isoDate": "2024-01-05T11:00:00.000Z"},
    "not a record",
    {"_id": "d", "coordinates": {"latitude": 0.5, "longitude": 35.0}},
    {"_id": "e", "coordinates": {"latitude": 1.0, "longitude": 36.0}, "isoDate": "not a date"},
    {"_id": "f", "coordinates": {"latitude": 2.0, "longitude": 37.0},
     "isoDate": "2024-02-29T23:59:59.999999Z"},
]


def test_flatten_validate_keeps_positions_and_rejects(spark, tmp_dir):
    p = write(tmp_dir, "a.json", json.dumps(RECS))
    recs, rej = R.scan_flatten_validate(spark, p)
    got = {r["record_id"]: r for r in recs.collect()}
    assert sorted(got) == [0, 5]
    assert got[0]["latitude"] == -1.29 and got[0]["date_seconds"] == 1704448800
    assert str(got[5]["datetime"]).startswith("2024-02-29 23:59:59.999999")
    reasons = {r["record_id"]: r["reason"] for r in rej.collect()}
    assert reasons == {1: "missing_field", 2: "malformed", 3: "missing_field", 4: "bad_time"}


@pytest.mark.parametrize("text", ["[]", '{"a": 1}', "[{broken"])
def test_flatten_validate_errors(spark, tmp_dir, text):
    p = write(tmp_dir, "bad.json", text)
    with pytest.raises(ValueError):
        R.scan_flatten_validate(spark, p)


def test_missing_path(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        R.scan_json_array(spark, os.path.join(tmp_dir, "nope.json"))
    with pytest.raises(FileNotFoundError):
        R.scan_flatten_validate(spark, os.path.join(tmp_dir, "nope.json"))


def test_scan_array_and_sorted(spark, tmp_dir):
    good = [r for r in RECS if isinstance(r, dict)]
    p = write(tmp_dir, "g.json", json.dumps(good))
    df = R.scan_json_array(spark, p)
    assert df.count() == len(good)
    s = R.scan_sorted(spark, p, renumber=True).collect()
    assert [r["position"] for r in s] == list(range(len(good)))
    times = [r["datetime"] for r in s if r["datetime"] is not None]
    assert times == sorted(times)


def test_json_lines_and_sinks(spark, tmp_dir):
    p = write(tmp_dir, "l.jsonl", "\n".join(json.dumps(dict(r, record_id=i))
                                             for i, r in enumerate(RECS) if isinstance(r, dict)))
    recs, _ = R.scan_flatten_validate(spark, p, "json_lines")
    assert sorted(r["record_id"] for r in recs.collect()) == [0, 5]
    out = os.path.join(tmp_dir, "csv")
    sinks.sink_csv(recs, out, head=1, order=["record_id"])
    back = spark.read.option("header", True).csv(out).collect()
    assert len(back) == 1 and back[0]["record_id"] == "0"
    with pytest.raises(ValueError):
        sinks.sink_csv(recs, out, head=1)
    sinks.sink_json(recs, os.path.join(tmp_dir, "js"))
    assert spark.read.json(os.path.join(tmp_dir, "js")).count() == 2


def test_model_save_load_refuses_unfitted(tmp_dir):
    with pytest.raises(ValueError):
        sinks.save_model(None, os.path.join(tmp_dir, "m"), {})


def test_positions_go_on_through_several_array_files(spark, tmp_dir):
    rec = {"coordinates": {"latitude": -1.0, "longitude": 36.0}, "isoDate": "2024-01-05T10:00:00.000Z"}
    for name in ("a.json", "b.json"):
        write(tmp_dir, name, json.dumps([rec] * 3))
    recs, _ = R.scan_flatten_validate(spark, os.path.join(tmp_dir, "*.json"))
    assert sorted(r["record_id"] for r in recs.collect()) == list(range(6))


def test_broken_lines_and_null_ids_are_rejected(spark, tmp_dir):
    good = {"coordinates": {"latitude": -1.0, "longitude": 36.0}, "isoDate": "2024-01-05T10:00:00.000Z"}
    p = write(tmp_dir, "r.jsonl", "\n".join([json.dumps({**good, "record_id": 7}), "{broken", json.dumps(good)]))
    recs, rej = R.scan_flatten_validate(spark, p, "json_lines")
    assert [r["record_id"] for r in recs.collect()] == [7]
    assert sorted(r["reason"] for r in rej.collect()) == ["malformed", "missing_id"]


def test_renumbered_scan_is_sorted(spark, tmp_dir):
    rows = [{"record_id": i, "isoDate": f"2024-01-{1 + (i * 7) % 28:02d}T10:00:00.000Z" if i % 9 else None} for i in range(300)]
    p = write(tmp_dir, "s.jsonl", "\n".join(json.dumps(r) for r in rows))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = R.scan_sorted(spark, p, "json_lines", renumber=True).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert [r["position"] for r in got] == list(range(300))
    keys = [(r["datetime"] is None, str(r["datetime"]), r["record_id"]) for r in got]
    assert keys == sorted(keys)


NASTY = ["}{][,\\\"", 3, None, [1, {"a": "}"}], {}, "plain", {"t": "\\\\"}, {"u": "é}\u2028\"{[", "v": {"w": [{"x": {}}, []]}}, [], {"y": "\n"}, True]


@pytest.mark.parametrize("split", [64, 1000, 1 << 27])
@pytest.mark.parametrize("indent", [None, 2])
def test_array_files_are_read_in_splits(spark, tmp_dir, split, indent):
    """Any cut of the file gives the elements that a whole parse gives, at the same positions."""
    import random
    rnd, docs = random.Random(split), []
    for name in ("a.json", "b.json", "c.json"):
        docs.append([rnd.choice(NASTY) for _ in range(rnd.choice([1, 40, 120]))] if name != "b.json" else [])
        write(tmp_dir, name, json.dumps(docs[-1], indent=indent, ensure_ascii=False))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        got = R._array_elements(spark, os.path.join(tmp_dir, "*.json")).orderBy("record_id").collect()
        if split == 64:
            assert R._pieces(spark, os.path.join(tmp_dir, "*.json")).select("_file", "_block").distinct().count() > 10
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = [e for d in docs for e in d]
    assert [r["record_id"] for r in got] == list(range(len(want)))
    for r, e in zip(got, want):
        assert r["e"] == e if isinstance(e, str) else (r["e"] is None if e is None else json.loads(r["e"]) == e)


@pytest.mark.parametrize("text", ["", "  ", "[1, 2", "[1,]", '[{"a": 1},]', '[{"a": 1} {"b": 2}]', '[{"a": 1}], {"b": 2}]', '{"a": [1]}', '[{"a": "}]', "null"])
def test_files_that_are_no_arrays(spark, tmp_dir, text):
    write(tmp_dir, "good.json", '[{"a": 1}]')
    write(tmp_dir, "bad.json", text)
    with pytest.raises(ValueError):
        R._array_elements(spark, os.path.join(tmp_dir, "*.json"))


def test_array_records_are_parsed_once(spark, tmp_dir):
    """Records and rejects read what was parsed; a filter on them doesn't parse again."""
    recs, rejects = R.scan_flatten_validate(spark, write(tmp_dir, "once.json", json.dumps(RECS)))
    for df in (recs, rejects):
        assert "from_json" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert recs.count() == 2 and rejects.count() == 4
