"""The corpus pipeline: five stages over ``documents``, each written as Parquet and reread by the next.

Each stage keeps its operator's treatment of nulls, empty and very long texts, ties, repeated
rows, empty tables and clashing column names (see the operators): documents without words pass
line dedup, near dedup and mixing unless they are rejected for quality, rows that repeat id and
text count as one document from line dedup on, and an empty table stays empty.
"""

from __future__ import annotations

import functools
import threading

from pyspark.sql import functions as F

from zonepulse.llm.common import drop_scratch, owned, scratch_folder, unpacked
from zonepulse.llm.line_dedup import without_copies
from zonepulse.llm.mixing import mix
from zonepulse.llm.near_dedup import one_of_each
from zonepulse.llm.piece_codec import encode_digest
from zonepulse.llm.quality import keep_good
from zonepulse.llm.queries import tokenizer_path


def stage(fn):
    """A stage owns the scratch tables made in it.  It starts when its predecessor's result is written, so that one's may go."""
    @functools.wraps(fn)
    def run_stage(spark, docs, sf_dir):
        owner = f"stage-{threading.get_ident()}"
        drop_scratch(owner)
        with owned(owner):
            return fn(spark, docs, sf_dir)
    return run_stage


@stage
def quality_stage(spark, docs, sf_dir):
    """The documents that the quality classifier accepts."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


@stage
def line_stage(spark, docs, sf_dir):
    """The documents without later copies of repeated line runs; wholly repeated documents go."""
    return without_copies(docs)


@stage
def near_stage(spark, docs, sf_dir):
    """One document of each near-duplicate group (five-word shingles, similarity 0.8)."""
    return one_of_each(docs)


@stage
def mix_stage(spark, docs, sf_dir):
    """Each document as often as the mix takes it; documents without words come through once."""
    mixed = mix(docs, whole_rows=True)
    times = F.when(F.col("size") > 0, F.col("copies")).otherwise(1).cast("int")
    return unpacked(mixed.where(times > 0).withColumn("i_", F.explode(F.sequence(F.lit(1), times))), docs.columns)


@stage
def encode_stage(spark, docs, sf_dir):
    """The documents' ids and round trips as digests."""
    return encode_digest(docs, tokenizer_path())


STAGES = [("quality_classifier", quality_stage), ("line_dedup", line_stage), ("near_dedup", near_stage),
          ("mix_sources", mix_stage), ("sentencepiece", encode_stage)]
ORACLE_SQL = None


def run_on(spark, docs, sf_dir, stages=None):
    """All stages on ``docs``; returns the last one's rows.  A stage's files go when its successor's are written."""
    stages = stages or STAGES
    read = None
    for k, (name, fn) in enumerate(stages):
        out = fn(spark, docs, sf_dir)
        if k == len(stages) - 1:
            return out              # lazy: it reads the files of the stage before, which stay until the driver exits
        path = scratch_folder(spark, f"pipeline-{k}-{name}")
        out.write.parquet(path)
        if read:
            drop_scratch(path=read)
        read, docs = path, spark.read.parquet(path)


def run(spark, sf_dir):
    """All stages on ``documents``; returns the last one's rows."""
    return run_on(spark, spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), sf_dir)
