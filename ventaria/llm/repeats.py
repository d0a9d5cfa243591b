"""Search for windows of symbols that occur more than once: content-chosen anchors and who shares them.

A window of ``window`` symbols (bytes or words) contains ``window - gram + 1``
grams; the one of smallest hash (leftmost of equals) is its anchor. Equal windows
have equal anchors at equal offsets, so a window can only repeat if its anchor's
gram does. Windows with one anchor are neighbours and travel as one *run*
``(anchor, low, high)``: the windows that start at low..high, whose symbols
``low .. high + window`` are the run's context. About two runs begin in each
``window - gram`` symbols, in place of every window.

Inside a slice of texts, runs of equal context are folded at once: only the
first of them travels on, and the rest are already known to repeat. So a line or
copy of any frequency sends one row per slice, and no key collects a hot group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.llm.minhash import grouped

FOLD_BYTES = 1_000_000  # texts among which equal runs are folded before the shuffle


@dataclass(frozen=True)
class Grain:
    """What a symbol is, and how long windows and anchors are."""

    window: int
    gram: int
    symbols: Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]  # hashes of symbols, first symbol of each text
    other_document: bool  # whether the earlier occurrence has to lie in another document


def byte_symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = T.text_bytes(batch)
    return T._spread[data], offsets


def word_symbols(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    words = T.words_of(batch)
    return words.hashes, words.first


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(values)] = values
    padded = padded.reshape(blocks, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1:width - 1 + n])


@dataclass
class Runs:
    """Runs of a slice; places count from the slice's first symbol."""

    text: np.ndarray
    anchor: np.ndarray
    low: np.ndarray
    high: np.ndarray
    gram: np.ndarray
    context: np.ndarray

    def take(self, at: np.ndarray) -> Runs:
        return Runs(*(getattr(self, k)[at] for k in self.__dataclass_fields__))


def runs_of(values: np.ndarray, first: np.ndarray, grain: Grain) -> Runs:
    n = len(values)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values * T.powers(T.BASE, n), out=total[1:])
    back = T.powers(T.BASE_INVERSE, n + 1)
    if n < grain.window:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    grams = T.mix((total[grain.gram:] - total[:-grain.gram]) * back[:n - grain.gram + 1])
    keyed = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_least(keyed, grain.window - grain.gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    whole = np.flatnonzero(text[:len(anchor)] == text[grain.window - 1:])  # windows inside one text
    anchor = anchor[whole]
    edge = np.flatnonzero(np.append(True, (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1] + 1))) if len(whole) else np.zeros(0, np.int64)
    low, high = whole[edge], whole[np.append(edge[1:], len(whole)) - 1] if len(whole) else whole
    anchor = anchor[edge]
    context = T.mix((total[high + grain.window] - total[low]) * back[low]) ^ T.mix(((anchor - low) * 100_003 + (high - low)).astype(np.uint64))
    return Runs(text[low], anchor, low, high, grams[anchor], context)


def fold(runs: Runs, ids: np.ndarray, first: np.ndarray, grain: Grain) -> tuple[np.ndarray, np.ndarray]:
    """(runs that travel on, runs whose every window repeats): of equal contexts the first run travels.

    Where the earlier occurrence must lie in another document, further runs of
    the first document share the first run's fate and are in neither part; so
    are the runs of a row that repeats an id and its text.
    """
    place, owner = runs.low - first[runs.text], ids[runs.text]
    order = np.lexsort((place, owner, runs.context))
    same = np.append(False, runs.context[order][1:] == runs.context[order][:-1])[:len(order)]
    lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else order
    later = owner[order] > owner[lead]
    if not grain.other_document:
        later |= (owner[order] == owner[lead]) & (place[order] > place[lead])
    return order[~same], order[later]


def packed(anchor: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A run in one number: its anchor, and how far before it the first and the last window begin."""
    return (anchor << 16) | ((anchor - low) << 8) | (anchor - high)


def unpacked(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    anchor = place >> 16
    return anchor, anchor - ((place >> 8) & 255), anchor - (place & 255)


def covered(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A range known to repeat, as a negative number."""
    return -1 - ((start << 31) | end)


def range_of(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (-1 - place) >> 31, (-1 - place) & ((1 << 31) - 1)


def anchored(docs: DataFrame, grain: Grain) -> DataFrame:
    """(key, doc_id, place), places counted from the text's first symbol: runs under their gram, and covered ranges."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        values, first = grain.symbols(batch)
        ids = batch.column("doc_id").to_numpy()
        runs = runs_of(values, first, grain)
        travel, repeat = fold(runs, ids, first, grain)
        sent, known = runs.take(travel), runs.take(repeat)
        text, start, end = merged(known.text, known.low, known.high + grain.window)
        place = np.concatenate([packed(*(x - first[sent.text] for x in (sent.anchor, sent.low, sent.high))),
                                covered(start - first[text], end - first[text])])
        doc = np.concatenate([ids[sent.text], ids[text]])
        key = np.concatenate([sent.gram, T.mix(doc[len(travel):].astype(np.uint64) ^ start.astype(np.uint64))])
        return T.named_batch(key=key.view(np.int64), doc_id=doc, place=place)

    return T.scan(T.id_and_text(docs).where("doc_id is not null"), step, "key long, doc_id long, place long", limit=FOLD_BYTES)


def merged(text: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of ranges within each text; places are distinct over the slice, and texts never touch a common range."""
    if not len(start):
        return text, start, end
    order = np.lexsort((start, text))
    text, start, end = text[order], start[order], end[order]
    reach = np.maximum.accumulate(end)  # places rise from text to text
    edge = np.flatnonzero(np.append(True, (start[1:] > reach[:-1]) | (text[1:] != text[:-1])))
    return text[edge], start[edge], reach[np.append(edge[1:], len(start)) - 1]


def shared(rows: DataFrame) -> DataFrame:
    """(doc_id, place): runs whose gram another run has, and the covered ranges; one shuffle by gram, streamed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, "key"):
            key, live = batch.column("key").to_numpy(), batch.column("place").to_numpy() >= 0
            group = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
            many = np.bincount(group, live)[group] > 1
            yield batch.filter(pa.array(~live | many)).select(["doc_id", "place"])

    return rows.repartition("key").sortWithinPartitions("key").mapInArrow(run, "doc_id long, place long")


def candidates(docs: DataFrame, found: DataFrame) -> DataFrame:
    """(doc_id, text, places) of the documents that have shared runs."""
    runs = found.where("place >= 0").groupBy("doc_id").agg(F.collect_set("place").alias("places"))  # bounded by the text
    return texts_with(docs, found.where("place >= 0").select("doc_id")).join(runs, "doc_id")


BITS = 25


def id_sieve(ids: DataFrame) -> np.ndarray:
    """A table of 2 ** 25 bits (4 MB, whatever the input) in which every id's bit is set."""
    spot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITS))
    words = ids.select(F.shiftright(spot, 5).cast("int").alias("w"), F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(doc_id), {1 << BITS}), 32) as int))").alias("b"))
    table = np.zeros(1 << (BITS - 5), np.uint32)
    found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toPandas()
    table[found["w"].to_numpy(np.int64)] = found["b"].to_numpy(np.int64).astype(np.uint32)
    return table


def in_sieve(table: np.ndarray, spots: np.ndarray) -> np.ndarray:
    return (table[spots >> 5] >> (spots & 31).astype(np.uint32)) & 1 > 0


def with_spot(docs: DataFrame) -> DataFrame:
    return T.id_and_text(docs).withColumn("spot", F.pmod(F.xxhash64("doc_id"), F.lit(1 << BITS)))


def texts_with(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, text) of the documents whose id may be among ``ids``; others are passed over before any shuffle."""
    table = docs.sparkSession.sparkContext.broadcast(id_sieve(ids))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(in_sieve(table.value, batch.column("spot").to_numpy()))).select(["doc_id", "text"])

    return T.scan(with_spot(docs), step, "doc_id long, text string")


def texts_without(docs: DataFrame, ids: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``step`` over all other documents, in place."""
    table = docs.sparkSession.sparkContext.broadcast(id_sieve(ids))
    return T.scan(with_spot(docs), lambda batch: step(batch.filter(pa.array(~in_sieve(table.value, batch.column("spot").to_numpy())))), schema)
