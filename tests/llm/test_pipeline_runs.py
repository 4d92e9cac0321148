"""The pipeline from end to end on awkward tables, and who deletes which scratch files."""

import os
import random

import pytest

pytest.importorskip("zonepulse.llm")
SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def folders(spark):
    from zonepulse.session import ensure_checkpoint_dir
    at = ensure_checkpoint_dir(spark).removeprefix("file:") + "/tables"
    return set(os.listdir(at)) if os.path.isdir(at) else set()


def test_run_on_a_messy_table(spark):
    import corpus_pipeline
    from pyspark.sql import functions as F
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) for _ in range(80)) + ".\nA second line."
    hot = text()
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, text(), "en", "b", 1), (None, None, "en", "b", 1), (3, "x" * 200000, "de", None, 9)]
    rows += [(10, hot, "en", "a", 1)] * 30 + [(100 + i, text(), "en", "ab"[i % 2], 1) for i in range(40)]
    clash = ["key", "row_", "cell", "label", "score", "size", "i_", "copies", "cls", "place", "line", "predicted"]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in clash})
    got = corpus_pipeline.run_on(spark, docs, SF).collect()
    assert set(got[0].asDict()) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert {r["doc_id"] for r in got} <= {r[0] for r in rows}
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, SF)
        assert out.columns == docs.columns, name
        kept = spark.createDataFrame(out.collect(), docs.schema)


def test_run_on_an_empty_table_and_on_the_table(spark):
    import corpus_pipeline
    empty = spark.createDataFrame([], SCHEMA)
    assert corpus_pipeline.run_on(spark, empty, SF).count() == 0
    before = folders(spark)
    got = corpus_pipeline.run(spark, SF)
    assert got.count() > 0
    stages = [x for x in folders(spark) - before if x.startswith("pipeline-")]
    assert len(stages) == 1 and "mix_sources" in stages[0]      # what the lazy result reads


def test_a_stage_leaves_other_results_alone(spark):
    import corpus_pipeline
    from zonepulse.llm.common import drop_scratch, owned, scratch_table
    from zonepulse.llm.exact_dedup import exact_dedup
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    unread = exact_dedup(docs)
    corpus_pipeline.near_stage(spark, docs.limit(50), SF)
    corpus_pipeline.mix_stage(spark, docs.limit(50), SF)
    assert unread.count() == docs.count()
    with owned("mine"):
        mine = scratch_table(spark.range(3).toDF("x"), "mine")
    other = scratch_table(spark.range(4).toDF("x"), "other")
    drop_scratch("mine")
    assert other.count() == 4 and not any(x.startswith("mine-") for x in folders(spark))
    with pytest.raises(Exception):
        mine.count()
