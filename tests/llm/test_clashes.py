"""Words that a polynomial hash cannot tell apart, and rows of one id with different texts, in op7, op8 and op9."""

import numpy as np
import pyarrow as pa
import pytest
from cases import frame, prose

from ventaria.llm import fm_index, minhash, suffix
from ventaria.llm import text as T


def thue_morse(n):
    made = "a"
    while len(made) < n:
        made += made.translate(str.maketrans("ab", "ba"))
    return made


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_long_words_have_their_own_hashes(n):
    one = thue_morse(n)
    two = one.translate(str.maketrans("ab", "ba"))
    words = T.words_of(pa.RecordBatch.from_arrays([pa.array([f"{one} {two} {one}x {one[1:]}", one])], names=["text"]))
    assert len(set(words.hashes.tolist())) == 4 and words.hashes[0] == words.hashes[4]


def test_hash_depends_on_the_word_alone():
    words = "a aa aaa b ab ba abcdefgh abcdefghi abcdefgh\x00 \x00 \x00\x00 é ééééééééé abcdefghabcdefgh ijklmnopabcdefgh abcdefghijklmnop".split(" ")
    told = {}
    for shift in range(20):
        batch = pa.RecordBatch.from_arrays([pa.array(["x" * shift + " " + " ".join(words), None, "", *words])], names=["text"])
        found = T.words_of(batch)
        spelled = [found.data[s:e].tobytes() for s, e in zip(found.starts, found.ends)]
        for word, h in zip(spelled, found.hashes.tolist()):
            assert told.setdefault(word, h) == h
    assert len(set(told.values())) == len(told)
    assert T.range_hashes(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64)).size == 0


def test_texts_that_differ_in_one_long_word(spark):
    T.importable(spark)
    one = thue_morse(2048)
    two = one.translate(str.maketrans("ab", "ba"))
    head, tail = prose(1, 30), prose(2, 30)
    docs = frame(spark, [(1, f"{head} {one} {tail}"), (2, f"{head} {two} {tail}"), (3, f"{head} {one} {tail}")])
    assert sorted((r.doc_id, r.n_removed) for r in fm_index.dedup_words(docs).collect()) == [(1, 0), (2, 0), (3, 61)]
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()) == [(1, 1), (2, 2), (3, 1)]


CLASH = [(1, prose(3, 3_200, 5_000)), (1, "short text of another row"), (2, prose(3, 3_200, 5_000)), (2, prose(4, 200)), (2, prose(4, 200)), (5, prose(4, 200) + " end"),
         (None, prose(4, 200)), (7, None), (7, ""), (7, "short text of another row")]


def by_text(df, pairs, column):
    made = sorted((r.doc_id is None, r.doc_id or 0, r[column]) for r in df.collect())
    assert len(made) == len(pairs)
    return made


def test_two_texts_of_one_id(spark):
    T.importable(spark)
    docs = frame(spark, CLASH)
    words = fm_index.dedup_words(docs).collect()
    assert len(words) == len(CLASH)
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in words if r.doc_id in (1, 2) and r.n_words > 1_000) == [(1, 3200, 0), (2, 3200, 3200)]
    assert [(r.n_words, r.n_removed) for r in words if r.doc_id == 5] == [(201, 200)]
    bytes_ = suffix.dedup_bytes(docs).collect()
    assert len(bytes_) == len(CLASH)
    size = len(CLASH[0][1].encode())
    assert sorted((r.doc_id, r.n_removed) for r in bytes_ if r.n_bytes == size) == [(1, 0), (2, size)]
    assert [r.n_removed for r in bytes_ if r.doc_id == 5] == [len(prose(4, 200))]
    near = minhash.near_duplicates(docs).collect()
    assert len(near) == len(CLASH)
    assert sorted((r.doc_id, r.component_id) for r in near if r.n_shingles > 1_000) == [(1, 1), (2, 1)]
    assert [r.component_id for r in near if r.doc_id == 5] == [2]
    kept = sorted((r.doc_id if r.doc_id is not None else -1, (r.text or "")[:5]) for r in minhash.drop_near_duplicates(docs).collect())
    assert kept == sorted([(1, CLASH[0][1][:5]), (1, "short"), (2, CLASH[3][1][:5]), (2, CLASH[3][1][:5]), (-1, CLASH[3][1][:5]), (7, ""), (7, "")])


def test_ids_stay_where_none_clash(spark):
    docs = frame(spark, [(3, "a"), (3, "a"), (4, "a"), (None, "b"), (None, "c")])
    told, named = T.unclashed(docs)
    assert named is None and told.count() == 5
