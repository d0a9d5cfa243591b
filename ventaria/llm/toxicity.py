"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the *distinct* hashed words, word pairs and skip pairs
(one word left out) of its lower-cased letter and digit runs, so a long text is
not diluted. The trainer keeps one rate per coordinate and an L1 term, which
leaves only the coordinates with lasting evidence: these few (index, weight)
rows are the model, and only they travel to the scoring tasks.

Training reads a bounded sample of labelled rows (``max_rows``, the rows with
the smallest hash of their id); features are extracted in parallel and one task
runs the sequential updates over them. Scoring is one scan without a shuffle.

Defined results: a null or empty text scores the model's bias; a null id is
scored and never trained on; repeated labels of one id count once (largest);
repeated documents are scored once per row; without usable labels every score
is 0 (predicted 0).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T

BITS = 24


@dataclass(frozen=True)
class Settings:
    max_rows: int = 20_000
    epochs: int = 2
    alpha: float = 1.0
    beta: float = 1.0
    l1: float = 4.0
    l2: float = 0.0
    folds: int = 5


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of every occurrence."""
    words = T.words_of(batch, T.ALNUM, lower=True)
    text, h = words.of(), words.hashes
    found = [(text, h)]
    for gap, salt in ((1, 0xA24BAED4963EE407), (2, 0x9FB21C651E98DF25)):
        if len(h) > gap:
            same = text[gap:] == text[:-gap]
            found.append((text[:-gap][same], T.mix(h[:-gap] * np.uint64(salt) + h[gap:])[same]))
    index = np.concatenate([f for _, f in found]) >> np.uint64(64 - BITS)
    return np.concatenate([t for t, _ in found]), index.astype(np.int64)


def distinct_features(batch: pa.RecordBatch) -> pa.RecordBatch:
    text, index = features(batch)
    pairs = np.unique((text.astype(np.int64) << BITS) | index)
    cuts = np.searchsorted(pairs >> BITS, np.arange(batch.num_rows + 1))
    values = (pairs & ((1 << BITS) - 1)).astype(np.int32)
    return T.named_batch(doc_id=batch.column("doc_id"), label=batch.column("label"),
                         features=pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values)))


def fit(rows: list[tuple[np.ndarray, int]], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights that are not zero; index 2 ** BITS is the bias, which bears no penalty."""
    z, n = np.zeros((1 << BITS) + 1, np.float32), np.zeros((1 << BITS) + 1, np.float32)
    bias = 1 << BITS

    def weights(at: np.ndarray) -> np.ndarray:
        l1 = np.where(at == bias, 0.0, settings.l1)
        shrunk = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -shrunk / ((settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2)

    for _ in range(settings.epochs):
        for at, label in rows:
            at = np.append(at, bias)
            w = weights(at)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / settings.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    used = np.flatnonzero(n)
    w = weights(used)
    return used[w != 0], w[w != 0]


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, np.ndarray]:
    """Learn from at most ``max_rows`` labelled rows outside the held-out fold."""
    marks = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (T.crc_fold(F.col("doc_id"), settings.folds) != 0))
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.max_rows))
    sample = T.id_and_text(docs).join(F.broadcast(marks), "doc_id")  # at most max_rows small rows
    found = T.scan(sample, distinct_features, "doc_id long, label int, features array<int>")
    found = found.groupBy("doc_id", "label").agg(F.min("features").alias("features"))  # one row for each id, of at most 2 ** BITS indexes

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            values, cuts = batch.column("features").flatten().to_numpy(), np.diff(batch.column("features").offsets.to_numpy()).cumsum()
            rows += zip(np.split(values, cuts[:-1]), batch.column("label").to_pylist())
        if rows:
            index, weight = fit(rows, settings)
            yield T.named_batch(index=index.astype(np.int64), weight=weight.astype(np.float64))

    ordered = found.repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", F.hash("features"))
    model = ordered.mapInArrow(learn, "index long, weight double").toPandas().sort_values("index")  # sparse by L1
    return model["index"].to_numpy(np.int64), model["weight"].to_numpy(np.float64)


def score(docs: DataFrame, index: np.ndarray, weight: np.ndarray, folds: int = 5) -> DataFrame:
    spark = docs.sparkSession
    model = spark.sparkContext.broadcast((index, weight))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, w = model.value
        total = np.zeros(batch.num_rows)
        if len(at):
            table = np.zeros((1 << BITS) // 8, np.uint8)
            known = at[at < 1 << BITS]
            np.bitwise_or.at(table, known >> 3, (1 << (known & 7)).astype(np.uint8))
            text, found = features(batch)
            hit = np.flatnonzero((table[found >> 3] >> (found & 7).astype(np.uint8)) & 1)
            pairs = np.unique((text[hit].astype(np.int64) << BITS) | found[hit])
            total += np.bincount(pairs >> BITS, w[np.searchsorted(at, pairs & ((1 << BITS) - 1))], batch.num_rows)
            if at[-1] == 1 << BITS:
                total += w[-1]
            value = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        else:
            value = total
        return T.named_batch(doc_id=batch.column("doc_id"), score=value)

    scored = T.scan(T.id_and_text(docs), step, "doc_id long, score double")
    return scored.select("doc_id", (T.crc_fold(F.col("doc_id"), folds) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return score(docs, *train(docs, labels, settings), settings.folds)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
