"""Leaks of edited items, scores that do not depend on the parts, and labelled ids with many rows."""

import random

import pytest
from cases import frame, prose
from pyspark.sql import functions as F

from ventaria.llm import decontam, rules, text, toxicity


def edited(item, n, seed):
    r = random.Random(seed)
    words = item.split()
    for k in r.sample(range(len(words)), min(n, len(words))):
        words[k] = "".join(r.choice("qwxzkv") for _ in range(7))
    return " ".join(words)


@pytest.mark.parametrize("n, least", [(0, 1.0), (1, 0.95), (2, 0.9)])
def test_recall_by_number_of_edits(spark, n, least):
    text.importable(spark)
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in items.select("item_id", "text").collect() if r.text]
    docs = frame(spark, [(k, prose(k, 100) + " " + edited(t, n, k) + " " + prose(k + 999, 100)) for k, (_, t) in enumerate(rows)])
    found = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    hit = sum((k, i) in found for k, (i, _) in enumerate(rows))
    same = {i: t for i, t in rows}
    assert hit >= least * len(rows), f"{hit} of {len(rows)}"
    assert all(same[i] == rows[k][1] for k, i in found), "an item that was not planted"


def test_clean_documents_stay(spark):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rows = [r.text for r in items.collect() if r.text]
    r = random.Random(4)
    bags = []
    for k in range(60):  # an item's words in another order, between words of other items
        words = r.choice(rows).split() + r.choice(rows).split()[:10]
        r.shuffle(words)
        bags.append((k, prose(k, 60) + " " + " ".join(words) + " " + prose(k + 500, 60)))
    assert decontam.contaminated(frame(spark, bags), items).count() == 0


def test_scores_do_not_depend_on_parts(spark):
    items = spark.createDataFrame([(k, prose(300 + k, 20 + k, 90)) for k in range(12)] + [(50, None), (None, "x"), (51, "")], "item_id long, text string")
    docs = frame(spark, [(k, prose(k, 50) + " " + edited(prose(300 + k, 20 + k, 90), k % 3, k)) for k in range(12)])
    told = []
    for size in (1, 5, 256):
        rows = decontam.contaminated(docs, items, decontam.Settings(part_items=size, part_bytes=2_000 * size, parts_per_pass=3)).collect()
        told.append(sorted((r.doc_id, r.item_id, round(r.score, 9)) for r in rows))
    assert told[0] == told[1] == told[2] and len(told[0]) >= 12


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.randrange(6) for _ in range(r.randrange(0, 15))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.aligned(a, b) == table[-1][-1]


def test_rows_of_one_labelled_id_count_once(spark):
    text.importable(spark)
    pairs = [(k, prose(k, 80) + (" vile words" if k % 2 else " kind words")) for k in range(1, 60)]
    labels = spark.createDataFrame([(k, k % 3 and 1, k % 2) for k in range(1, 60)], "doc_id long, quality int, toxic int")
    docs = frame(spark, pairs)
    many = docs.unionByName(docs.where("doc_id = 7").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy"))
    one, other = (toxicity.train(d, labels) for d in (docs, many))
    assert one[0].tolist() == other[0].tolist() and one[1].tolist() == other[1].tolist()
    rows, _ = rules.labelled_bins(many, labels, rules.Settings())
    assert rows.count() <= 59
