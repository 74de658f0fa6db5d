"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakemart.llm.common import add_columns, as_bytes

WORD = re.compile(rb"[0-9a-z'\x80-\xff]+")
BITS = 20
#: At most so many labelled rows are learned from, the first by a hash of their id.
SAMPLE_ROWS = 24_000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.6, 1.0, 8.0, 0.1
THRESHOLD = 0.3
CACHE_WORDS = 400_000


class Features:
    """Distinct hashed features of a text: words, word pairs, and pairs with one word between."""

    def __init__(self):
        self.hashes: dict[bytes, int] = {}

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = WORD.findall(text.lower()) if text else []
        if len(self.hashes) > CACHE_WORDS:
            self.hashes.clear()
        known = self.hashes
        codes = np.empty(len(words), dtype=np.uint32)
        for i, word in enumerate(words):
            code = known.get(word)
            if code is None:
                code = known[word] = crc32(word)
            codes[i] = code
        pairs = codes[:-1] * np.uint32(0x9E3779B1) ^ codes[1:] + np.uint32(0x7F4A7C15)
        skips = codes[:-2] * np.uint32(0x85EBCA6B) ^ codes[2:] + np.uint32(0x165667B1)
        every = np.concatenate([codes, pairs, skips]) * np.uint32(0xC2B2AE35)
        return every >> np.uint32(32 - BITS)


def fit_ftrl(rows: list[tuple[np.ndarray, int]], epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias. Per-coordinate rates come from summed squared gradients; a coordinate whose
    summed gradient stays within L1 has weight zero. The bias starts at the smoothed base rate."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    rate = (sum(y for _, y in rows) + 0.1) / (len(rows) + 1.0)
    bias, bias_n = math.log(rate / (1 - rate)), 0.0
    for _ in range(epochs):
        for index, label in rows:
            own, grown = z[index], n[index]
            w = _weights(own, grown)
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + w.sum()))))
            g = p - label
            sigma = (np.sqrt(grown + g * g) - np.sqrt(grown)) / ALPHA
            z[index] = own + g - sigma * w
            n[index] = grown + g * g
            bias_n += g * g
            bias -= ALPHA * g / (BETA + math.sqrt(bias_n))
    return _weights(z, n), bias


def _weights(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0)
    return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)


def train_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                   sample_rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> tuple[list[int], list[float], float]:
    """Indexes and values of the non-zero weights, and the bias.

    Learns from at most ``sample_rows`` labelled documents (a documented bound), taken by a hash of
    the id and in that order, so a repeat gives the same model. Rows whose id or label is null are
    left out. Their texts are turned into features in parallel; one task learns from the features.
    Without labelled rows there are no weights and the bias stands for a rate of one tenth.
    """
    chosen = labels.filter(F.col(key).isNotNull() & F.col(label).isNotNull()) \
        .select(F.col(key).alias("k"), (F.col(label) > 0).cast("int").alias("y"), F.xxhash64(key).alias("o")) \
        .orderBy("o", "k", "y").limit(sample_rows)
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    joined = texts.join(F.broadcast(chosen), "k")  # at most sample_rows rows of 20 bytes
    featured = add_columns(joined, ["t"], "f binary", _featurizer).select("o", "y", "f")

    def learn(batches):
        rows = []
        for batch in batches:
            for y, f in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                rows.append((np.frombuffer(f, dtype=np.uint32).astype(np.int64), y))
        w, bias = fit_ftrl(rows, epochs)
        index = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array([index.astype(np.int32).tobytes()]), pa.array([w[index].tobytes()]), pa.array([bias])],
            names=["index", "value", "bias"])

    model = featured.repartition(1).sortWithinPartitions("o", "y", "f") \
        .mapInArrow(learn, "index binary, value binary, bias double").first()
    if model is None:  # an empty frame may have no task at all
        return [], [], fit_ftrl([])[1]
    return (np.frombuffer(model["index"], np.int32).tolist(), np.frombuffer(model["value"], np.float64).tolist(),
            model["bias"])


def _featurizer():
    features = Features()

    def work(texts):
        return [[np.unique(features(t)).tobytes() for t in as_bytes(texts)]]
    return work


def score_toxicity(docs: DataFrame, model: tuple[list[int], list[float], float], text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1). Null and empty texts get the score of the bias alone.

    The weights are broadcast: at most 2 ** BITS of them, in practice some thousand. Every text is
    scored whole; an existing ``score`` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        index, value, bias = shared.value
        weights = np.zeros(1 << BITS)
        weights[index] = value
        features = Features()

        def work(texts):
            scores = []
            for body in as_bytes(texts):
                found = features(body)
                found = np.unique(found[weights[found] != 0])
                total = bias + float(weights[found].sum())
                scores.append(1 / (1 + math.exp(-max(-35.0, min(35.0, total)))))
            return [scores]
        return work

    return add_columns(docs, [text], "score double", start)


def held_out(key: str = "doc_id"):
    """Rows that are never learned from: crc32 of the id as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 4 == 2, F.lit(False))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction per document, learned from the labels that are not held out.
    A document without an id is not held out."""
    model = train_toxicity(docs, labels.filter(~held_out()))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Documents whose score stays below the threshold, columns as they came."""
    model = train_toxicity(docs, labels.filter(~held_out()))
    return score_toxicity(docs.withColumnRenamed("score", "_kept_score"), model).filter(F.col("score") < threshold) \
        .drop("score").withColumnRenamed("_kept_score", "score").select(*docs.columns)
