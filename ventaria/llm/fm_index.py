"""Substring dedup of word windows with an FM-index per shard.

A word goes if a window of 50 consecutive words that covers it also occurs in a
document of smaller id. Runs of windows that may repeat come from
:mod:`ventaria.llm.repeats`; all runs whose anchors share a gram meet in the
shard of that gram's hash. A shard folds equal contexts into the one of the
smallest id, and builds a compressed FM-index over the contexts that are left
and share their gram: a Burrows-Wheeler transform held in a wavelet matrix of
bit vectors with popcount ranks. Documents' contexts are streamed against it by
backward search, all windows of the shard at once: a window is given up as soon
as only its own context matches, and a full match counts if the smallest id in
its suffix interval is smaller than the document's own.

Shards are sized by the number of candidates, not by the machine. Defined
results: null and empty texts have no words; rows that repeat an id and its text
are one document; rows with a null id are kept whole and are no source; other
columns are ignored. Words are compared by 64-bit hashes.
Two texts of one id are two documents, in the order of the id and then of a hash
of the text. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import repeats as R
from ventaria.llm import text as T
from ventaria.llm.minhash import each_group
from ventaria.session import settle

WINDOW, GRAM = 50, 16
MOST = 2 * WINDOW - GRAM  # words of the longest context
WORDS = R.Grain(WINDOW, GRAM, R.word_symbols, other_document=True)
RUN_CONTEXTS, SHARD_CONTEXTS = 40_000, 25_000


class WaveletMatrix:
    """Ranks of symbols below ``2 ** levels`` in a sequence; one bit vector a level."""

    def __init__(self, sequence: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.bits: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in reversed(range(self.levels)):
            bit = (sequence >> level) & 1
            packed = np.packbits(bit.astype(np.uint8), bitorder="little")
            packed = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view("<u8")
            self.bits.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))]).astype(np.int32))
            self.zeros.append(len(sequence) - int(bit.sum()))
            sequence = np.concatenate([sequence[bit == 0], sequence[bit == 1]])

    def ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word, rest = at >> 6, (at & 63).astype(np.uint64)
        inside = self.bits[level][word] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.counts[level][word] + np.bitwise_count(inside)

    def down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where each prefix length ends up in the last level; two such places differ by a count of the symbol."""
        for level in range(self.levels):
            ones = self.ones(level, at)
            one = (symbols >> (self.levels - 1 - level)) & 1
            at = np.where(one == 1, self.zeros[level] + ones, at - ones)
        return at


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes ordered by at least their first ``depth`` symbols, by prefix doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        nxt = np.zeros(len(rank), np.int64)
        nxt[:-step] = rank[step:] + 1
        key = rank * (int(rank.max()) + 2) + nxt
        order = np.argsort(key, kind="stable")
        fresh = np.append(False, key[order][1:] != key[order][:-1])
        rank = np.empty(len(rank), np.int64)
        rank[order] = np.cumsum(fresh)
        if rank[order[-1]] == len(rank) - 1:
            return order
        step *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Backward search over contexts that are kept apart by a separator (symbol 0)."""

    def __init__(self, contexts: np.ndarray, sizes: np.ndarray, owner: np.ndarray):
        inside = np.arange(contexts.shape[1]) < sizes[:, None]
        self.alphabet = np.unique(contexts[inside])
        self.symbols = np.where(inside, np.searchsorted(self.alphabet, contexts) + 1, 0)
        spread = np.arange(contexts.shape[1] + 1) <= sizes[:, None]  # each context and one separator
        text = np.concatenate([self.symbols, np.zeros((len(sizes), 1), np.int64)], axis=1)[spread]
        order = suffix_order(text, 2 * WINDOW)
        sequence = text[order - 1]
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(self.alphabet) + 1))])  # symbols smaller than each
        self.matrix = WaveletMatrix(sequence, len(self.alphabet) + 1)
        self.start = self.matrix.down(np.arange(len(self.alphabet) + 1), np.zeros(len(self.alphabet) + 1, np.int64))
        self.owner = np.append(np.repeat(owner, sizes + 1)[order], 0)  # in suffix order, and one place beyond

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after one more symbol to the left."""
        shift = self.before[symbols] - self.start[symbols]
        return shift + self.matrix.down(symbols, low), shift + self.matrix.down(symbols, high)

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest owner in each interval; intervals of one pattern length are equal or disjoint, so each place is read once."""
        names, back = np.unique(low * len(self.owner) + high, return_inverse=True)
        edges = np.stack([names // len(self.owner), names % len(self.owner)], axis=1).ravel()
        return np.minimum.reduceat(self.owner, edges)[::2][back] if len(edges) else low

    def windows_elsewhere(self, context: np.ndarray, first: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Which windows (context number, first word) occur in a context of smaller owner."""
        found = np.zeros(len(context), bool)
        live = np.arange(len(context))
        low, high = np.zeros(len(context), np.int64), np.full(len(context), len(self.owner) - 1, np.int64)
        for k in reversed(range(WINDOW)):
            low, high = self.extend(self.symbols[context[live], first[live] + k], low, high)
            many = high - low > 1  # a window's own context is always one
            live, low, high = live[many], low[many], high[many]
            if not len(live):
                return found
        found[live] = self.smallest(low, high) < owner[live]
        return found


class Contexts:
    """Runs with their words: doc_id, first word, anchor and last window counted from it, and padded word hashes."""

    def __init__(self, doc, low, anchor, last, words):
        self.doc, self.low, self.anchor, self.last, self.words = doc, low, anchor, last, words

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, at: np.ndarray) -> Contexts:
        return Contexts(self.doc[at], self.low[at], self.anchor[at], self.last[at], self.words[at])

    @staticmethod
    def join(parts: list[Contexts]) -> Contexts:
        return Contexts(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("doc", "low", "anchor", "last", "words")))

    def blob(self) -> bytes:
        flat = self.words[np.arange(MOST) < (self.last + WINDOW)[:, None]]
        return b"".join(x.tobytes() for x in (self.doc.astype("<i8"), self.low.astype("<i4"), self.anchor.astype("u1"), self.last.astype("u1"), flat.astype("<u8")))

    @staticmethod
    def of(blob: bytes, n: int) -> Contexts:
        doc, low = np.frombuffer(blob, "<i8", n), np.frombuffer(blob, "<i4", n, 8 * n)
        anchor, last = np.frombuffer(blob, "u1", n, 12 * n).astype(np.int64), np.frombuffer(blob, "u1", n, 13 * n).astype(np.int64)
        words = np.zeros((n, MOST), np.uint64)
        words[np.arange(MOST) < (last + WINDOW)[:, None]] = np.frombuffer(blob, "<u8", -1, 14 * n)
        return Contexts(doc.astype(np.int64), low.astype(np.int64), anchor, last, words)

    def keys(self) -> np.ndarray:
        """One hash for each context, equal for equal words, anchors and windows."""
        weights = T.mix(np.arange(1, MOST + 1, dtype=np.uint64) * np.uint64(T.GOLDEN)) | np.uint64(1)
        return T.mix((T.mix(self.words) * weights).sum(axis=1, dtype=np.uint64) + (self.anchor * 256 + self.last).astype(np.uint64))

    def grams(self) -> np.ndarray:
        value = np.zeros(len(self), np.uint64)
        rows = np.arange(len(self))
        for k in range(GRAM):
            value = value * T.BASE + self.words[rows, self.anchor + k]
        return T.mix(value)

    def fold(self) -> tuple[Contexts, Contexts]:
        """(contexts of the smallest id, equal ones of larger ids); an id's further places share its first one's fate."""
        key = self.keys()
        order = np.lexsort((self.low, self.doc, key))
        same = np.append(False, key[order][1:] == key[order][:-1])[:len(order)]
        lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else order
        return self.take(order[~same]), self.take(order[self.doc[order] > self.doc[lead]])

    def whole(self) -> np.ndarray:
        """All windows, as a mask."""
        return (1 << (self.last + 1)) - 1


def contexts_of(batch: pa.RecordBatch) -> Contexts:
    words = T.words_of(batch)
    lists = batch.column("places")
    text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    anchor, low, high = R.unpacked(lists.flatten().to_numpy())
    padded = np.concatenate([words.hashes, np.zeros(MOST, np.uint64)])
    at = (words.first[text] + low)[:, None] + np.arange(MOST)
    held = np.where(np.arange(MOST) < (high - low + WINDOW)[:, None], padded[at], 0)
    return Contexts(batch.column("doc_id").to_numpy()[text], low, anchor - low, high - low, held)


def marks(c: Contexts, mask: np.ndarray) -> np.ndarray:
    return np.stack([c.doc, c.low, mask])


def sent_contexts(ready: DataFrame, shards: int) -> DataFrame:
    """(shard, n, blob) contexts by shard, and, with shard < 0, lists of windows that are settled."""

    def flush(parts: list[Contexts]) -> pa.RecordBatch:
        lead, later = Contexts.join(parts).fold()
        shard = ((lead.grams() >> np.uint64(33)).astype(np.int64) * shards) >> 31
        order = np.argsort(shard, kind="stable")
        edges = np.append(np.flatnonzero(np.append(True, np.diff(shard[order]) != 0)), len(order))
        rows = [(int(shard[order[a]]), b - a, lead.take(order[a:b]).blob()) for a, b in zip(edges.tolist(), edges[1:].tolist())]
        if len(later):
            rows.append((-1 - int(later.doc[0] % shards), len(later), marks(later, later.whole()).astype("<i8").tobytes()))
        shard, n, blob = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), pa.array(n, pa.int32()), pa.array(blob, pa.binary())], names=["shard", "n", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Contexts] = []
        for batch in batches:
            for piece in T.slices(batch):
                held.append(contexts_of(piece))
                if sum(map(len, held)) >= RUN_CONTEXTS:
                    yield flush(held)
                    held = []
        if sum(map(len, held)):
            yield flush(held)

    return ready.mapInArrow(run, "shard int, n int, blob binary")


def windows_in_shard(c: Contexts) -> np.ndarray:
    """(doc_id, first word of the run, mask of its windows that occur in a smaller id), for one shard."""
    lead, later = c.fold()
    out = [marks(later, later.whole())]
    gram = np.unique(lead.grams(), return_inverse=True)[1]
    rival = np.flatnonzero(np.bincount(gram)[gram] > 1)
    if len(rival):
        lead = lead.take(rival)
        index = FMIndex(lead.words, lead.last + WINDOW, lead.doc)
        context = np.repeat(np.arange(len(lead)), lead.last + 1)
        first = np.arange(len(context)) - np.repeat(np.cumsum(lead.last + 1) - lead.last - 1, lead.last + 1)
        found = index.windows_elsewhere(context, first, lead.doc[context])
        mask = np.zeros(len(lead), np.int64)
        np.bitwise_or.at(mask, context[found], 1 << first[found])
        hit = np.flatnonzero(mask)
        out.append(marks(lead.take(hit), mask[hit]))
    return np.concatenate(out, axis=1)


def searched(pieces: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_group(batches, "shard"):
            counts, blobs = batch.column("n").to_pylist(), [b.as_py() for b in batch.column("blob")]
            if batch.column("shard")[0].as_py() < 0:
                doc, low, mask = np.concatenate([np.frombuffer(b, "<i8").reshape(3, n) for b, n in zip(blobs, counts)], axis=1)
            else:
                doc, low, mask = windows_in_shard(Contexts.join([Contexts.of(b, n) for b, n in zip(blobs, counts)]))
            if len(doc):
                yield T.named_batch(doc_id=doc.astype(np.int64), low=low.astype(np.int64), mask=mask.astype(np.int64))

    return pieces.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "doc_id long, low long, mask long")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, low, mask): windows low + k, for each bit k, that occur in a smaller id; mask -e: the words low .. e - 1."""
    found = settle(R.shared(R.anchored(docs, WORDS)))
    shards = max(1, found.where("place >= 0").count() // SHARD_CONTEXTS)
    made = settle(searched(sent_contexts(R.candidates(docs, found), shards)))
    at = -1 - F.col("place")
    known = found.where("place < 0").select("doc_id", F.shiftright(at, 31).alias("low"), (-at.bitwiseAND((1 << 31) - 1)).alias("mask"))
    return made.union(known)


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def cut(batch: pa.RecordBatch, lists: list[list]) -> pa.RecordBatch:
    """Counts and digest of each text without the repeated words; equal runs of one text share their windows' fate."""
    words = T.words_of(batch)
    raw = words.data
    runs = R.runs_of(words.hashes, words.first, WORDS) if any(lists) else None
    rows = []
    for k, marked in enumerate(lists):
        a, b = int(words.first[k]), int(words.first[k + 1])
        change = np.zeros(b - a + 1, np.int64)
        if marked:
            low, mask = np.array(marked, np.int64).reshape(-1, 2).T
            known = mask < 0
            np.add.at(change, low[known], 1)
            np.add.at(change, -mask[known], -1)
            low, mask = low[~known], mask[~known]
            if len(low):
                mine = slice(*np.searchsorted(runs.text, [k, k + 1]))
                place, context = runs.low[mine] - a, runs.context[mine]
                names, group = np.unique(context, return_inverse=True)
                fate = np.zeros(len(names), np.int64)
                np.bitwise_or.at(fate, group[np.searchsorted(place, low)], mask)
                for bit in range(WINDOW - GRAM + 1):
                    starts = place[(fate[group] >> bit) & 1 > 0] + bit
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + WINDOW, -1)
        kept = np.flatnonzero(np.cumsum(change)[:-1] == 0) + a
        digest = hashlib.sha256(b" ".join(raw[s:e].tobytes() for s, e in zip(words.starts[kept].tolist(), words.ends[kept].tolist()))).hexdigest()
        rows.append((b - a, b - a - len(kept), digest))
    n, removed, digest = zip(*rows) if rows else ((),) * 3
    return T.named_batch(doc_id=batch.column("doc_id"), n_words=pa.array(n, pa.int64()), n_removed=pa.array(removed, pa.int64()),
                         kept_sha256=pa.array(digest, pa.string()))


def dedup_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    docs, named = T.unclashed(docs)
    windows = settle(repeated_windows(docs))
    mine = windows.groupBy("doc_id").agg(F.collect_list(F.array("low", "mask")).alias("marked"))  # bounded by the text
    touched = R.texts_with(docs, windows).join(mine, "doc_id", "left")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return cut(batch, [x or [] for x in batch.column("marked").to_pylist()])

    whole = R.texts_without(docs, windows, lambda batch: cut(batch, [[]] * batch.num_rows), RESULT)
    return T.with_ids(whole.union(T.scan(touched, step, RESULT)), named, "doc_id")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(T.documents(spark, sf_dir))


OP8_SQL = r"""
WITH cut AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 48)) AS p, unnest(list_transform(range(1, len(w) - 48), lambda i: md5(array_to_string(w[i:i + 49], ' ')))) AS k
  FROM cut WHERE len(w) >= 50
), firsts AS (SELECT k, min(doc_id) AS d FROM windows GROUP BY k),
hits AS (SELECT doc_id, list(p) AS ps FROM windows JOIN firsts USING (k) WHERE doc_id > d GROUP BY doc_id),
gone AS (SELECT doc_id, list_distinct(flatten(list_transform(ps, lambda p: range(p, p + 50)))) AS g FROM hits),
kept AS (
  SELECT cut.doc_id, w, coalesce(len(g), 0) AS n, CASE WHEN g IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(g, i)), lambda i: w[i]) END AS v
  FROM cut LEFT JOIN gone ON cut.doc_id = gone.doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, n::BIGINT AS n_removed, sha256(array_to_string(v, ' ')) AS kept_sha256 FROM kept
"""
