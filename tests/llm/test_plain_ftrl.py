"""Toxicity scores against a plain FTRL-proximal regression over unhashed features."""

import math
import zlib
from collections import defaultdict

import pytest
from cases import frame, prose
from pyspark.sql import functions as F

from ventaria.llm import toxicity

BIAS = "bias"
SETTINGS = toxicity.Settings()


def plain_features(text):
    words = text.lower().split()
    return {*words, *zip(words, words[1:], ["next"] * len(words)), *zip(words, words[2:], ["skip"] * len(words))}


class PlainModel:
    """One coordinate at a time, with dictionaries in double precision."""

    def __init__(self):
        self.z, self.n = defaultdict(float), defaultdict(float)

    def weight(self, f):
        l1 = 0.0 if f == BIAS else SETTINGS.l1
        if abs(self.z[f]) <= l1:
            return 0.0
        rate = (SETTINGS.beta + math.sqrt(self.n[f])) / SETTINGS.alpha + SETTINGS.l2
        return -(self.z[f] - math.copysign(l1, self.z[f])) / rate

    def probability(self, found):
        return 1 / (1 + math.exp(-sum(self.weight(f) for f in [*found, BIAS])))

    def learn(self, found, label):
        g = self.probability(found) - label
        for f in [*found, BIAS]:
            w = self.weight(f)
            self.z[f] += g - (math.sqrt(self.n[f] + g * g) - math.sqrt(self.n[f])) / SETTINGS.alpha * w
            self.n[f] += g * g


@pytest.mark.parametrize("noise", [0, 9])
def test_scores_equal_a_plain_regression(spark, noise):
    texts = {i: prose(i, 30, 25) + (" Awful trash heap" if i % 4 == 0 else " fine Day") + " " + prose(i + 1000, 5, 25) for i in range(300)}
    marks = {i: int(i % 4 == 0) ^ int(noise > 0 and i % noise == 1) for i in texts}
    labels = spark.createDataFrame([(i, 1, m) for i, m in marks.items()], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.toxicity(frame(spark, texts.items()), labels).collect()}

    order = [r.doc_id for r in spark.range(300).select(F.col("id").alias("doc_id")).orderBy(F.xxhash64("doc_id")).collect()]
    held = {i for i in texts if zlib.crc32(str(i).encode()) % 5 == 0}
    model = PlainModel()
    for _ in range(SETTINGS.epochs):
        for i in order:
            if i not in held:
                model.learn(plain_features(texts[i]), marks[i])
    assert {i for i, r in got.items() if r.held_out} == held
    for i, text in texts.items():
        assert got[i].score == pytest.approx(model.probability(plain_features(text)), abs=2e-3), i
    assert len({round(r.score, 3) for r in got.values()}) > (5 if noise else 1)
