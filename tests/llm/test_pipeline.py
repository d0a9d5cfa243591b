"""The pipeline's stages against plain versions, and the registration of every query."""

import re

import corpus_pipeline
from cases import frame, prose

import __spark_entry__
from ventaria.llm import secrets, text


def test_every_query_is_registered():
    names = __spark_entry__.queries()
    for n in range(1, 11):
        assert len([q for q in names if re.match(rf"op{n}_", q)]) == 1
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "secret_scan", "token_ids"]


def test_stages_on_planted_documents(spark, tmp_path):
    text.importable(spark)
    item = prose(1000, 40)
    good = [(k, prose(2000 + k, 120)) for k in range(60)]
    junk = [(100 + k, " ".join(w + "$$$" for w in prose(3000 + k, 120).split())) for k in range(60)]
    edited = good[3][1].split()
    edited[50] = "different"
    pairs = good + junk + [(200, "too short"), (201, good[1][1]), (202, " ".join(edited)), (203, prose(4000, 100) + " " + item), (204, None), (205, ""),
                           (206, prose(4001, 90) + ' token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" ' + prose(4002, 20))]
    docs = frame(spark, pairs).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k < 100), 0) for k, _ in good + junk], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left, at = [], spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        at = spark.read.parquet(f"{tmp_path}/stage{k}")
        left.append({r.doc_id for r in at.select("doc_id").collect()})
        assert k == 4 or at.columns == docs.columns
    kept = {k for k, _ in good}
    assert left[0] == kept | {201, 202, 203, 206}
    assert left[1] == kept | {203, 206}
    assert left[2] == left[3] == left[4] == kept | {206}
    clean = spark.read.parquet(f"{tmp_path}/stage3").where("doc_id = 206").first().text
    assert clean == secrets.redact(docs).where("doc_id = 206").first().text and "24be6443" not in clean
    assert {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "decoded").collect()} == {tuple(r) for r in at.select("doc_id", "decoded").collect()}


def test_stages_on_an_empty_table(spark, tmp_path):
    frame(spark, [(1, "x")]).select("doc_id", "text", "lang", "source", "n_chars").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_from_four_fifths_on_are_dropped(spark, tmp_path):
    def shingles(t):
        w = t.split()
        return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}

    one = prose(5000, 120, 5_000)
    two = one.split()
    two[40], two[80] = "different", "another"
    two = " ".join(two)
    three = two.split()
    three[20], three[60] = "further", "apart"
    pairs = [(1, one), (2, two), (3, prose(5001, 120, 5_000)), (4, prose(5002, 120, 5_000))]
    both = len(shingles(one) & shingles(two)) / len(shingles(one) | shingles(two))
    assert 0.81 < both < 0.85
    docs = frame(spark, pairs).select("doc_id", "text", "lang", "source", "n_chars")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert {r.doc_id for r in stage(spark, docs, str(tmp_path)).select("doc_id").collect()} == {1, 3, 4}
    far = frame(spark, [(1, one), (2, " ".join(three))]).select("doc_id", "text", "lang", "source", "n_chars")
    assert stage(spark, far, str(tmp_path)).count() == 2
