"""Incremental ingestion gives the same rows as the batch clean plan."""

import json
import os

from zonepulse.streaming.ingest import ingest


def test_stream_ingest_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    recs = [{"coordinates": {"latitude": -1.0 + 0.1 * i, "longitude": 36.0},
             "isoDate": f"2024-01-0{1 + i % 9}T10:00:00Z", "record_id": i} for i in range(20)]
    recs.append({"coordinates": None, "isoDate": "2024-01-01T00:00:00Z", "record_id": 99})
    recs.append({"coordinates": {"latitude": 50.0, "longitude": 36.0},
                 "isoDate": "2024-01-01T00:00:00Z", "record_id": 98})
    with open(os.path.join(src, "part1.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))
    out = os.path.join(tmp_dir, "out")
    q = ingest(spark, src, out, checkpoint=os.path.join(tmp_dir, "ck"))
    q.awaitTermination(120)
    got = sorted(r["record_id"] for r in spark.read.parquet(out).collect())
    assert got == list(range(20))


def test_two_ingests_side_by_side_keep_rejects(spark, tmp_dir):
    from zonepulse.streaming.ingest import progress_folder
    outs = []
    for name in ("one", "two"):
        src = os.path.join(tmp_dir, name)
        os.makedirs(src)
        with open(os.path.join(src, "p.json"), "w") as f:
            f.write("\n".join(json.dumps(r) for r in [
                {"coordinates": {"latitude": -1.0, "longitude": 36.0}, "isoDate": "2024-01-01T10:00:00Z", "record_id": 1},
                {"coordinates": None, "isoDate": "2024-01-01T10:00:00Z", "record_id": 2},
                {"coordinates": {"latitude": -1.0, "longitude": 36.0}, "isoDate": "never", "record_id": 3}]))
        outs.append((ingest(spark, src, f"{tmp_dir}/{name}-out", rejects_path=f"{tmp_dir}/{name}-rejects"), name))
    for queries, name in outs:
        for q in queries:
            q.awaitTermination(120)
        assert [r["record_id"] for r in spark.read.parquet(f"{tmp_dir}/{name}-out").collect()] == [1]
        assert {r["record_id"]: r["reason"] for r in spark.read.parquet(f"{tmp_dir}/{name}-rejects").collect()} == {
            2: "missing_field", 3: "bad_time"}
    assert progress_folder(spark, "a", "b") != progress_folder(spark, "a", "c")
