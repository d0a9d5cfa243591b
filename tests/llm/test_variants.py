"""Spelling variants: the whole query against a plain version, the composition against all pairs, partitions, hard rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from cases import HARD, SCHEMA, frame

from ventaria.llm import variants as V

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_counts(pairs, settings=V.Settings()):
    counts = Counter()
    for i, t in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % settings.loss == 0:
                k = h % len(w)
                w = w[:k] + w[k + 1:]
            counts[w] += 1
    return {w: n for w, n in counts.items() if len(w) >= settings.least_length and n >= settings.least_count}


def is_near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return any(v[:k] + v[k + 1:] == u for k in range(len(v)))


def plain(pairs, settings=V.Settings()):
    n = plain_counts(pairs, settings)
    shared = defaultdict(set)  # words that agree when one symbol is left out
    for w in n:
        for k in range(len(w)):
            shared[w[:k] + w[k + 1:]].add(w)
        shared[w].add(w)
    near = defaultdict(set)
    for group in shared.values():
        for u in group:
            near[u] |= {v for v in group if v not in near[u] and is_near(u, v)}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= settings.form_factor * n[w] else None
    rows = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(rows)


def told(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def made_up(seed, letters, words, texts):
    r = random.Random(seed)
    stems = ["".join(r.choice(letters) for _ in range(r.randrange(5, 12))) for _ in range(words)]
    return [(i, " ".join(r.choices(stems, [1 / (k + 1) for k in range(words)], k=300)) + r.choice(["", "ÉtéRUNs", "x" * 90, "ab1cdefghij"])) for i in range(1, texts + 1)]


@pytest.mark.parametrize("letters", ["ab", "abéÿ", "abcdefgh"])
@pytest.mark.parametrize("most", [2, 2_000])
def test_equals_a_plain_version(spark, letters, most):
    pairs = made_up(len(letters), letters, 60, 40)
    assert told(V.group_variants(frame(spark, pairs), V.Settings(most_words=most))) == plain(pairs)


def test_whole_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert told(V.group_variants(docs)) == plain([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])


def test_hard_rows(spark):
    pairs = [*HARD, (21, "À×÷ÿÃletters " * 3), (22, "touching"), (23, "touching"), (24, "A" * 500 + " " + "a" * 500 + " " + "a" * 501)]
    assert told(V.group_variants(frame(spark, pairs))) == plain(pairs)


def test_loss_by_document(spark):
    pairs = [(i, "vocabulary Vocabulary grammarís") for i in range(200)]
    rows = told(V.group_variants(frame(spark, pairs)))
    assert rows == plain(pairs) and any(r[1] == "vocabulary" for r in rows)


@pytest.mark.parametrize("seed", range(40))
def test_composition_accepts_the_near_pairs(seed):
    r = random.Random(seed)
    words = sorted({"".join(r.choice("abc"[:1 + seed % 3]) for _ in range(r.randrange(0, 7))) for _ in range(r.randrange(1, 60))})
    found = [tuple(sorted((a, b))) for a, b, _ in V.Acceptor(words).composed()]
    assert sorted(found) == [(a, b) for a in range(len(words)) for b in range(a + 1, len(words)) if is_near(words[a], words[b])]


def test_acceptor_is_minimal():
    machine = V.Acceptor(sorted(["talking", "walking", "stalking", "talked", "walked", "stalked"]))
    rights = set()

    def right(state):
        return frozenset(([""] if machine.final[state] else []) + [c + w for c, to in machine.arcs[state] for w in right(to)])

    for state in range(len(machine.arcs)):
        rights.add(right(state))
    assert len(rights) == len(machine.arcs)


def test_chains_end_at_the_root(spark):
    pairs = [(1, " ".join(["roundabout"] * 2_000 + ["roundabouts"] * 180 + ["rountabouts"] * 15))]
    rows = {r[0]: r for r in told(V.group_variants(frame(spark, pairs), V.Settings(loss=1 << 31)))}
    assert rows["rountabouts"][1:3] == ("roundabouts", "roundabout") and rows["roundabouts"][2] == "roundabout"


def test_empty_table(spark):
    assert V.group_variants(spark.createDataFrame([], SCHEMA)).count() == 0
