"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal.

A text is cut into tokens (words and runs of punctuation).  Its features are
hashed one- and two-token grams, of the lower-case tokens and of their shapes
(case, digits, punctuation, "same as before"), weighted 1 + log(count) and
scaled to unit length: a sparse vector of ``2**BITS`` cells.  A score is the sparse
dot product with the weights, through the logistic function.

Training reads at most ``max_train`` labelled rows, those with the smallest hash
of their id; rows with crc32(id as text) mod ``FOLDS`` = 0 are held out.  The
bounded sample is gathered in one task, which makes ``EPOCHS`` passes of
follow-the-regularised-leader updates; the weights (``2**BITS`` numbers) are sent
to the tasks that score.  Scores use the text alone.

Edge cases: null text is empty and scores by the bias; null labels and labels of
unknown ids are ignored; ids that occur twice train with each of their rows;
without any label all scores are 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, text_batches

BITS = 18
FOLDS = 5
MAX_TRAIN = 8000
EPOCHS = 3
THRESHOLD = 0.3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
TOKENS = re.compile(r"\w+|[^\w\s]+")
MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
KNOWN_TOKENS = 1 << 16


def _shape(w: str) -> str:
    if not (w[0].isalnum() or w[0] == "_"):
        return "p" + w[:3]
    if w.isdigit():
        return "9"
    size = "s" if len(w) <= 3 else "m" if len(w) <= 8 else "l" if len(w) <= 14 else "x"
    if w.islower():
        return "a" + size
    if w.isupper():
        return "A" + size
    return ("T" if w[:1].isupper() and w[1:].islower() else "M") + size


class Hasher:
    """Text -> (cells, values); keeps the hashes of frequent tokens, bounded."""

    def __init__(self, bits: int = BITS):
        self.known: dict[str, tuple[int, int]] = {}
        self.mask = np.uint64((1 << bits) - 1)

    def token(self, w: str) -> tuple[int, int]:
        import xxhash
        got = xxhash.xxh3_64_intdigest(w.lower().encode("utf-8", "replace")), xxhash.xxh3_64_intdigest(b"\0" + _shape(w).encode("utf-8", "replace"))
        if len(self.known) >= KNOWN_TOKENS:
            self.known.clear()
        self.known[w] = got
        return got

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = TOKENS.findall(text or "")
        if not words:
            return np.zeros(0, np.int64), np.zeros(0)
        known, token = self.known, self.token
        pairs = np.array([known.get(w) or token(w) for w in words], np.uint64)
        word, shape = pairs[:, 0], pairs[:, 1].copy()
        shape[1:][word[1:] == word[:-1]] = np.uint64(7)       # the same token again
        grams = [word, shape]
        for a in (word, shape):
            grams.append((a[:-1] * MIX1) ^ (a[1:] * MIX2))
        if len(shape) > 2:
            grams.append((shape[:-2] * MIX2) ^ (shape[1:-1] * MIX1) ^ shape[2:])
        cells, counts = np.unique(((np.concatenate(grams) * MIX1) >> np.uint64(40)) & self.mask, return_counts=True)
        values = 1.0 + np.log(counts)
        return cells.astype(np.int64), values / np.sqrt((values * values).sum())


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias by FTRL-proximal over (cells, values, label) in the given order."""
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)
    bz = bn = 0.0
    bias = 0.0
    for _ in range(epochs):
        for cells, values, y in rows:
            zi, ni = z[cells], n[cells]
            w = np.where(np.abs(zi) <= L1, 0.0, -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2))
            p = 1 / (1 + np.exp(-np.clip(w @ values + bias, -35, 35)))
            g = (p - y) * values
            s = (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA
            z[cells] += g - s * w
            n[cells] += g * g
            s = (np.sqrt(bn + (p - y) ** 2) - np.sqrt(bn)) / ALPHA
            bz += (p - y) - s * bias
            bn += (p - y) ** 2
            bias = -bz / ((BETA + np.sqrt(bn)) / ALPHA)
    w = np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))
    return w.astype(np.float32), float(bias)


def held_out(doc_id: str = "doc_id"):
    """Whether an id belongs to the rows that never train."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> tuple[np.ndarray, float]:
    """Weights and bias learnt from the labelled rows outside the held-out fold."""
    known = (pick(labels, "doc_id", "quality").where("quality IS NOT NULL AND doc_id IS NOT NULL")
             .where(~held_out()).withColumn("at", F.xxhash64("doc_id", "quality"))
             .orderBy("at", "doc_id").limit(max_train))
    rows = pick(docs, "doc_id", "text").join(F.broadcast(known), "doc_id").select("at", "doc_id", "quality", "text")

    def features(batches):
        import pandas as pd
        make = Hasher()
        for b in batches:
            got = [make(t) for t in b["text"]]
            yield pd.DataFrame({"at": b["at"], "doc_id": b["doc_id"], "y": (b["quality"] > 0).astype("int32"),
                                "cells": [c.astype(np.int32).tobytes() for c, _ in got],
                                "vals": [v.astype(np.float32).tobytes() for _, v in got]})

    def learn(pdf):
        import pandas as pd
        pdf = pdf.sort_values(["at", "doc_id", "cells"])
        data = [(np.frombuffer(c, np.int32), np.frombuffer(v, np.float32), int(y))      # views: nothing is copied
                for c, v, y in zip(pdf["cells"], pdf["vals"], pdf["y"])]
        w, bias = train(data)
        return pd.DataFrame({"w": [w.tobytes()], "bias": [bias]})

    sample = text_batches(rows).mapInPandas(features, "at bigint, doc_id bigint, y int, cells binary, vals binary")
    model = sample.groupBy(F.lit(1).alias("all")).applyInPandas(learn, "w binary, bias double").collect()
    if not model:
        return np.zeros(1 << BITS, np.float32), 0.0
    return np.frombuffer(bytes(model[0]["w"]), np.float32), model[0]["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text") -> DataFrame:
    """``docs`` with ``score``, the likelihood of label 1, from its column ``text``."""
    w, bias = model
    sent = docs.sparkSession.sparkContext.broadcast((w, bias))
    from pyspark.sql.types import DoubleType, StructField, StructType
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])

    def run(batches):
        import pyarrow as pa
        weights, b0 = sent.value
        make = Hasher()
        for b in batches:
            out = []
            for t in b.column(text).to_pylist():
                cells, values = make(t)
                x = float(np.dot(weights[cells], values)) + b0
                out.append(1 / (1 + np.exp(-min(max(x, -35.0), 35.0))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.float64())], [*b.schema.names, "score"])
    return text_batches(docs).mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted for every row of ``docs``."""
    scored = score(pick(docs, "doc_id", "text"), fit(docs, labels, max_train)).drop("text")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with its own columns, without the rows that score below ``threshold``."""
    names = docs.columns
    at = names.index("text") if "text" in names else [c.lower() for c in names].index("text")
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    scored = score(plain, fit(docs, labels, max_train), f"c{at}")
    return scored.where(F.col("score") >= threshold).drop("score").toDF(*names)
