"""Exact duplicates by block naming: against plain grouping, hard rows, shared hashes, ties."""

import hashlib
import re
from collections import defaultdict

import pytest
from cases import HARD, SCHEMA, frame, prose

from ventaria.llm import block_names as B


def plain(pairs):
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in pairs]
    groups = defaultdict(list)
    for (i, _), t in zip(pairs, texts):
        groups[t].append(i)
    least = {t: min((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    return sorted(((i, least[t], len(groups[t]), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(pairs, texts)), key=str)


def told(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=str)


SMALL_BLOCKS = B.Settings(block_bytes=16)


@pytest.mark.parametrize("settings", [B.Settings(), SMALL_BLOCKS, B.Settings(block_bytes=16, hash_bits=4)], ids=["usual", "small", "contested"])
def test_hard_rows(spark, settings):
    assert told(B.group_copies(frame(spark, HARD), settings)) == plain(HARD)


@pytest.mark.parametrize("bits", [64, 3])
def test_near_texts_stay_apart(spark, bits):
    base = prose(5, 120)
    texts = [base, base + "x", base[:-1], base[1:], base[:64] + "?" + base[65:], base, base.replace(" ", "\n \t"), base * 2, base * 3, base * 2,
             "a" * 64, "a" * 63, "a" * 65, "a" * 128, "a" * 64, "", " ", "\n", None, "ab" * 40, "ba" * 40]
    pairs = list(enumerate(texts, 1))
    assert told(B.group_copies(frame(spark, pairs), B.Settings(block_bytes=16, hash_bits=bits))) == plain(pairs)


def test_hot_text_and_hot_block(spark):
    pairs = [(i, "head " * 40 + ("same" if i % 3 else f"tail {i % 7}")) for i in range(1, 600)]
    assert told(B.group_copies(frame(spark, pairs), SMALL_BLOCKS)) == plain(pairs)


def test_one_row_of_each_text_stays(spark):
    pairs = [(3, "t"), (2, "t"), (2, "t"), (None, "t"), (None, "u"), (None, "u"), (7, "one id"), (7, "two texts"), (8, "two texts")]
    rows = B.group_copies(frame(spark, pairs)).collect()
    kept = [r for r in rows if r.kept]
    assert len(rows) == len(pairs) and len(kept) == len({t for _, t in pairs})
    assert sorted((r.doc_id, r.group_size) for r in kept if r.doc_id is not None) == [(2, 4), (7, 1), (7, 2)]
    assert [r.group_size for r in kept if r.doc_id is None] == [2]


def test_empty_table(spark):
    made = B.group_copies(spark.createDataFrame([], SCHEMA))
    assert made.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"] and made.count() == 0


def test_no_python_in_the_plan(spark, small):
    plan = B.op11_exact_dedup(spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
