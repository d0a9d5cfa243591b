"""Benchmark decontamination: a BM25 index of test items, queried by every training passage.

Items are documents of a BM25 index; scores are divided by the score an item
gets for its own text, so one threshold holds for items of any length. A
training text is cut into cells of at least 64 words (or the longest item of the
index part); a passage is two neighbouring cells, so every copy of an item lies
whole inside some passage. Search is block-max WAND: posting lists are cut into
blocks of items with the largest impact of each; the block bounds of all
passages are added up at once, only blocks that can reach the threshold are
entered, and there the lists are walked by pivot. Every item above the threshold
is then verified: three quarters of its words must stand in the passage in the
item's order (longest common subsequence), so must 0.4 of its word pairs side by
side, and half of the words of its question and of its answer.

Document frequencies and the mean length are counted once over all items, so a
score does not depend on how the items are cut. Tasks build the index of parts
of at most 256 items (less for long ones) and write them; the driver passes
``parts_per_pass`` of them at a time on to the scan of the texts, which shuffles
nothing; larger benchmarks take further passes.

An item's answer is what follows an ``Answer:`` mark, else its last line, else
its last sentence; with none of these, question and answer are both the whole.
Defined results: null or empty texts and items match nothing; repeated items are
reported each; repeated texts too; an item of one word has one pair, the word
itself; other columns are ignored.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.llm.minhash import each_group
from ventaria.operators.ordering import number_rows
from ventaria.session import settle


@dataclass(frozen=True)
class Settings:
    least_score: float = 0.6
    least_overlap: float = 0.75  # of the item's words, in order
    least_pairs: float = 0.4  # of the item's neighbouring words
    least_half: float = 0.5  # of the words of the question, and of the answer
    cell: int = 64
    k1: float = 1.2
    b: float = 0.75
    part_items: int = 256
    part_bytes: int = 2_000_000
    parts_per_pass: int = 8


BLOCK = 4  # items of one posting block
ANSWER = re.compile(r"(?i)\banswer\s*:|\n(?=[^\n]*\S[^\n]*\s*\Z)|(?<=[.!?])\s+(?=[^.!?]*[.!?]?\s*\Z)")


def question_and_answer(text: str) -> tuple[str, str]:
    marks = [m for m in ANSWER.finditer(text) if text[:m.start()].strip() and text[m.end():].strip()]
    named = [m for m in marks if ":" in m[0]]
    if not marks:
        return text, text
    cut = (named or [m for m in marks if "\n" in m[0]] or marks)[-1]
    return text[:cut.start()], text[cut.end():]


def hashes_of(texts: list[str]) -> list[np.ndarray]:
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])
    words = T.words_of(batch, T.ALNUM, lower=True)
    return np.split(words.hashes, words.first[1:-1])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    size = max(1, min(size, len(words)))
    return np.unique(T.windows_of(words, np.array([0, len(words)]), size)[0])


def aligned(item: list[int], span: list[int]) -> int:
    """Length of the longest common subsequence, one bit for each word of the item."""
    masks: dict[int, int] = {}
    for k, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << k
    whole = row = (1 << len(item)) - 1
    for word in span:
        if word in masks:
            used = row & masks[word]
            row = ((row + used) | (row - used)) & whole
    return len(item) - row.bit_count()


@dataclass(frozen=True)
class Statistics:
    """What a score takes from the whole benchmark."""

    items: int
    mean: float  # words of an item
    counts: dict[int, int]  # items that have a term


class Index:
    """BM25 index of one part of the items; built and read by the tasks."""

    def __init__(self, ids: list[int], texts: list[str], settings: Settings, known: Statistics | None = None):
        self.settings, self.ids = settings, ids
        words = hashes_of(texts)
        halves = [question_and_answer(t) for t in texts]
        self.words, self.question, self.answer = words, hashes_of([q for q, _ in halves]), hashes_of([a for _, a in halves])
        self.cell = max([settings.cell, *map(len, words)])
        self.terms = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
        n = len(words)
        known = known or Statistics(n, float(np.mean([len(w) for w in words] or [1])), {})
        mean = max(1.0, known.mean)
        impacts: list[tuple[int, int, float]] = []
        held = [np.unique(np.searchsorted(self.terms, w), return_counts=True) for w in words]
        df = np.bincount(np.concatenate([t for t, _ in held] + [np.zeros(0, np.int64)]).astype(np.int64), minlength=len(self.terms))
        df = np.array([known.counts.get(t, d) for t, d in zip(self.terms.view(np.int64).tolist(), df.tolist())], float)
        idf = np.log(1 + (known.items - df + 0.5) / (df + 0.5))
        for item, (terms, tf) in enumerate(held):
            part = idf[terms] * tf * (settings.k1 + 1) / (tf + settings.k1 * (1 - settings.b + settings.b * len(words[item]) / mean))
            impacts += [(t, item, v) for t, v in zip(terms.tolist(), (part / part.sum() if len(part) else part).tolist())]
        impacts.sort()
        self.term = np.array([t for t, _, _ in impacts], np.int64)
        self.item = np.array([i for _, i, _ in impacts], np.int64)
        self.impact = np.array([v for _, _, v in impacts])
        self.blocks = -(-n // BLOCK)
        self.bound = np.zeros((len(self.terms), self.blocks), np.float32)  # largest impact in each block
        np.maximum.at(self.bound, (self.term, self.item // BLOCK), np.nextafter(self.impact.astype(np.float32), np.float32(2)))
        self.items, self.impacts = self.item.tolist(), self.impact.tolist()
        key = self.term * (self.blocks + 1) + self.item // BLOCK
        every = np.arange(len(self.terms))[:, None] * (self.blocks + 1) + np.arange(self.blocks + 1)
        self.place = np.searchsorted(key, every)  # where each block of each list begins
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self.terms >> np.uint64(44)] = True

    def known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, term) of the words that any item has."""
        at = np.flatnonzero(self.sieve[hashes >> np.uint64(44)])
        term = np.minimum(np.searchsorted(self.terms, hashes[at]), len(self.terms) - 1)
        same = self.terms[term] == hashes[at]
        return at[same], term[same]

    def wand(self, terms: np.ndarray, blocks: np.ndarray) -> list[tuple[int, float]]:
        """Items of the given blocks whose score for a passage's distinct terms reaches the threshold.

        Inside a block the posting lists are walked by pivot: with the lists in
        order of their current item, the first item at which the lists' block
        bounds add up to the threshold is the next that can qualify; lists
        behind it skip forward, and only an item that all of them share with
        enough bound is scored.
        """
        least, out = self.settings.least_score, []
        for block in blocks.tolist():
            low, high = self.place[terms, block], self.place[terms, block + 1]
            used = np.flatnonzero(high > low)
            lists = [[self.items[k], k, end, bound] for k, end, bound in zip(
                low[used].tolist(), high[used].tolist(), self.bound[terms[used], block].tolist())]  # item, place, end, bound
            while lists:
                lists.sort()
                total, pivot = 0.0, -1
                for k, entry in enumerate(lists):
                    total += entry[3]
                    if total >= least:
                        pivot = k
                        break
                if pivot < 0:
                    break
                item = lists[pivot][0]
                if lists[0][0] == item:
                    score = sum(self.impacts[entry[1]] for entry in lists if entry[0] == item)
                    if score >= least - 1e-9:
                        out.append((item, score))
                    item += 1
                for entry in lists:
                    while entry[1] < entry[2] and self.items[entry[1]] < item:
                        entry[1] += 1
                    entry[0] = self.items[entry[1]] if entry[1] < entry[2] else -1
                lists = [entry for entry in lists if entry[0] >= 0]
        return out

    def leaks(self, words: T.Words) -> dict[tuple[int, int], tuple[float, float, float, float, int]]:
        """(text, item) -> best (score, shares of item, question and answer, first word of the passage)."""
        at, term = self.known(words.hashes)
        if not len(at):
            return {}
        text = np.searchsorted(words.first, at, "right") - 1
        cells = -(-words.counts // self.cell)
        start = np.concatenate([[0], np.cumsum(cells + 1)])  # one empty cell between texts
        cell = start[text] + (at - words.first[text]) // self.cell
        pairs = np.sort(cell * len(self.terms) + term, kind="stable")  # nearly in order
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])]
        cell, term = pairs // len(self.terms), pairs % len(self.terms)
        edges = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        bound = np.zeros((start[-1] + 1, self.blocks), np.float32)
        for k in range(0, len(edges), 4096):  # rows of the bound table are gathered in small runs
            here = edges[k:k + 4096]
            stop = edges[k + 4096] if k + 4096 < len(edges) else len(cell)
            bound[cell[here]] = np.add.reduceat(self.bound[term[here[0]:stop]], here - here[0])
        passages = np.flatnonzero((bound[:-1] + bound[1:]).max(axis=1) >= self.settings.least_score - 1e-4)
        found: dict[tuple[int, int], tuple[float, float, float, float, int]] = {}
        for p in passages.tolist():
            row = int(np.searchsorted(start, p, "right") - 1)
            terms = np.unique(term[np.searchsorted(cell, p):np.searchsorted(cell, p + 2)])
            hits = self.wand(terms, np.flatnonzero(bound[p] + bound[p + 1] >= self.settings.least_score - 1e-4))
            if not hits:
                continue
            low = int(words.first[row] + (p - start[row]) * self.cell)
            span = words.hashes[low:min(low + 2 * self.cell, int(words.first[row + 1]))]
            for item, score in hits:
                pairs_found = self.share(self.words[item], span, 2)
                if pairs_found < self.settings.least_pairs:
                    continue
                order = aligned(self.words[item].tolist(), span.tolist()) / len(self.words[item])
                shares = [order, self.share(self.question[item], span, 1), self.share(self.answer[item], span, 1)]
                if order >= self.settings.least_overlap and min(shares) >= self.settings.least_half:
                    made = (score, *shares, low - int(words.first[row]))
                    old = found.get((row, item))
                    if old is None or (made[1:4], -made[4]) > (old[1:4], -old[4]):
                        found[row, item] = made
        return found

    def share(self, part: np.ndarray, span: np.ndarray, size: int) -> float:
        """Share of the part's distinct shingles that occur in the passage."""
        size = min(size, len(part))
        if not size or size > len(span):
            return 0.0
        return len(np.intersect1d(shingles(part, size), shingles(span, size), assume_unique=True)) / len(shingles(part, size))


def items_of(benchmark: DataFrame) -> DataFrame:
    return benchmark.where(F.col("text").isNotNull() & F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))


def statistics(items: DataFrame) -> DataFrame:
    """term, n: items that have each term; under term null their number, and under ``words`` the words of all."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = hashes_of(T.texts_of(batch))
        terms, n = np.unique(np.concatenate([np.unique(w) for w in words]), return_counts=True)
        return T.named_batch(term=pa.array([None, *terms.view(np.int64).tolist()], pa.int64()), n=np.append(len(words), n).astype(np.int64),
                             words=np.append(sum(map(len, words)), np.zeros(len(n), np.int64)).astype(np.int64))

    return T.scan(items, step, "term long, n long, words long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("words").alias("words"))


def built_parts(benchmark: DataFrame, settings: Settings) -> DataFrame:
    """(part, index) of all parts, built in tasks; a part's items bring along the counts of their own terms only."""
    items = settle(items_of(benchmark))
    counted = settle(statistics(items))
    total = counted.where("term is null").first()
    if total is None:
        return items.select(F.lit(0).alias("part"), F.lit(b"").alias("index")).where("false")

    def terms_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [np.unique(w) for w in hashes_of(T.texts_of(batch))]
        each = pa.array(np.repeat(np.arange(len(words)), [len(w) for w in words]))
        return T.named_batch(at=batch.column("at").take(each), part=batch.column("part").take(each), term=np.concatenate(words).view(np.int64))

    longest = F.ceil(F.octet_length("text") / (settings.part_bytes // settings.part_items))
    room = number_rows(items.withColumn("size", F.greatest(F.lit(1), F.least(longest, F.lit(settings.part_items))).cast("long")),
                       "item_id, text", position="at", running=("size", "reach"))
    placed = settle(room.select("at", "item_id", "text", F.floor((F.col("reach") - 1) / settings.part_items).cast("int").alias("part")))
    terms = T.scan(placed.select("at", "part", "text"), terms_of, "at long, part int, term long").select("part", "term").distinct()
    known = terms.join(counted, "term").select("part", F.lit(None).cast("long").alias("item_id"), F.lit(None).cast("string").alias("text"), "term", "n")
    rows = placed.select("part", "item_id", "text", F.lit(None).cast("long").alias("term"), F.lit(None).cast("long").alias("n")).unionByName(known)
    mean = total["words"] / total["n"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_group(batches, "part"):
            held = [r for r in batch.to_pylist()]
            counts = {r["term"]: r["n"] for r in held if r["term"] is not None}
            own = sorted((r["item_id"], r["text"]) for r in held if r["item_id"] is not None)
            index = Index([i for i, _ in own], [t for _, t in own], settings, Statistics(total["n"], mean, counts))
            yield T.named_batch(part=pa.array([held[0]["part"]], pa.int32()), index=pa.array([pickle.dumps(index)], pa.binary()))

    return settle(rows.repartition("part").sortWithinPartitions("part").mapInArrow(build, "part int, index binary"))


def passes(benchmark: DataFrame, settings: Settings) -> Iterator[list[Index]]:
    """The indexes of one pass at a time; the driver holds ``parts_per_pass`` of them."""
    parts = built_parts(benchmark, settings)
    last = parts.agg(F.max("part")).first()[0]
    for first in range(0, 0 if last is None else last + 1, settings.parts_per_pass):
        rows = parts.where(F.col("part").between(first, first + settings.parts_per_pass - 1)).orderBy("part").collect()
        yield [pickle.loads(r["index"]) for r in rows]


LEAKS = "doc_id long, item_id long, score double, item_overlap double, question_overlap double, answer_overlap double, first_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row for each text and item that leaks into it, with the best passage."""
    spark = docs.sparkSession
    result = spark.createDataFrame([], LEAKS)
    for indexes in passes(benchmark, settings):
        result = result.union(one_pass(docs, spark.sparkContext.broadcast(indexes)))  # at most parts_per_pass parts
    return result


def one_pass(docs: DataFrame, indexes) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = T.words_of(batch, T.ALNUM, lower=True)
        rows = [(row, index.ids[item], *made) for index in indexes.value for (row, item), made in index.leaks(words).items()]
        rows.sort()
        columns = list(zip(*rows)) or [()] * 7
        shares = {name: pa.array(c, pa.float64()) for name, c in zip(("score", "item_overlap", "question_overlap", "answer_overlap"), columns[2:])}
        return T.named_batch(doc_id=batch.column("doc_id").take(pa.array(columns[0], pa.int64())),
                             item_id=pa.array(columns[1], pa.int64()), **shares, first_word=pa.array(columns[6], pa.int64()))

    return T.scan(T.id_and_text(docs), step, LEAKS)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The documents without any leak; all columns stay, and no text is shuffled."""
    for indexes in passes(benchmark, settings):
        docs = clean_pass(docs, docs.sparkSession.sparkContext.broadcast(indexes))
    return docs


def clean_pass(docs: DataFrame, indexes) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = T.words_of(batch, T.ALNUM, lower=True)
        bad = {row for index in indexes.value for row, _ in index.leaks(words)}
        return batch.take(pa.array([k for k in range(batch.num_rows) if k not in bad], pa.int64()))

    return T.scan(docs, step, docs.schema)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(T.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
