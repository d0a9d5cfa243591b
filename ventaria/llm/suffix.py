"""Suffix-array dedup of byte strings: a distributed merge sort that knows common prefixes.

A byte goes if a 100-byte string that covers it also starts earlier (smaller
doc_id, or the same document further left). Only suffixes that can matter are
sorted: those at the anchors of :mod:`ventaria.llm.repeats` whose gram occurs
again, cut off where their run's last window ends.

Each task sorts its suffixes into runs and sends them front-coded (length of the
prefix shared with the one before, then the rest), split by ranges of the
anchor's hash, so ranges are even without sampling. The receiving task merges
the runs of a range with a loser tree: each run carries the length of the prefix
it shares with the last winner, the longer one wins unseen, and only equal
lengths are compared, from that place on. The merge thus yields the common-prefix
array, from which every window length is a run of neighbours; the bytes left of
an anchor are ranked likewise, and a window repeats if both classes agree.

Work follows the repeated text; copies are folded by slice, by run and by range.
A range is sized by the count of candidates, not by the machine. Defined
results: null and empty texts have no bytes; rows that repeat an id and its text
are one document; rows with a null id are kept whole and are no source; other
columns are ignored.
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

WINDOW, GRAM = 100, 24
LEFT = WINDOW - GRAM
BYTES = R.Grain(WINDOW, GRAM, R.byte_symbols, other_document=False)
RUN_SUFFIXES, RANGE_SUFFIXES = 150_000, 120_000


class Suffixes:
    """Suffixes at anchors with what stands left of them, as padded rows."""

    def __init__(self, right, right_size, left, left_size, doc, anchor):
        self.right, self.right_size, self.left, self.left_size, self.doc, self.anchor = right, right_size, left, left_size, doc, anchor

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, at: np.ndarray) -> Suffixes:
        return Suffixes(*(x[at] for x in (self.right, self.right_size, self.left, self.left_size, self.doc, self.anchor)))

    @staticmethod
    def join(parts: list[Suffixes]) -> Suffixes:
        return Suffixes(*(np.concatenate([getattr(p, k) for p in parts]) for k in ("right", "right_size", "left", "left_size", "doc", "anchor")))


def suffixes_of(batch: pa.RecordBatch) -> Suffixes:
    data, offsets = T.text_bytes(batch)
    lists = batch.column("places")
    text = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
    anchor, low, high = R.unpacked(lists.flatten().to_numpy())
    begin = offsets[text]
    right_size, left_size = high + WINDOW - anchor, anchor - low
    padded = np.concatenate([np.zeros(LEFT, np.uint8), data, np.zeros(WINDOW, np.uint8)])
    at = (begin + anchor + LEFT)[:, None]
    right = np.where(np.arange(WINDOW) < right_size[:, None], padded[at + np.arange(WINDOW)], 0)
    left = np.where(np.arange(LEFT) < left_size[:, None], padded[at - 1 - np.arange(LEFT)], 0)  # nearest byte first
    return Suffixes(right, right_size.astype(np.uint8), left, left_size.astype(np.uint8), batch.column("doc_id").to_numpy()[text], anchor)


def rows_as_keys(*parts: np.ndarray) -> np.ndarray:
    """Rows of bytes as fixed strings; the last column must not be zero."""
    joined = np.ascontiguousarray(np.concatenate([p if p.ndim == 2 else p[:, None] for p in parts], axis=1))
    return joined.view(f"S{joined.shape[1]}").ravel()


def common(rows: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Length of the prefix each row shares with the one before; 0 for the first."""
    if len(rows) < 2:
        return np.zeros(len(rows), np.int64)
    differ = rows[1:] != rows[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return np.concatenate([[0], np.minimum(first, np.minimum(sizes[1:], sizes[:-1]))]).astype(np.int64)


def sorted_run(s: Suffixes) -> tuple[Suffixes, Suffixes]:
    """(suffixes in order, suffixes equal with all their surroundings to an earlier one)."""
    keys = rows_as_keys(s.right, s.right_size, s.left, s.left_size + np.uint8(1))
    order = np.lexsort((s.anchor, s.doc))
    order = order[np.argsort(keys[order], kind="stable")]
    s, keys = s.take(order), keys[order]
    same = np.append(False, keys[1:] == keys[:-1])[:len(keys)]
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(keys))))
    later = same & ((s.doc > s.doc[lead]) | (s.anchor > s.anchor[lead]))
    return s.take(np.flatnonzero(~same)), s.take(np.flatnonzero(later))


def front_coded(s: Suffixes) -> bytes:
    shared = common(s.right, s.right_size)
    rest = (np.arange(WINDOW) >= shared[:, None]) & (np.arange(WINDOW) < s.right_size[:, None])
    left = np.arange(LEFT) < s.left_size[:, None]
    return b"".join(x.tobytes() for x in (shared.astype(np.uint8), s.right_size, s.left_size, s.doc.astype("<i8"), s.anchor.astype("<i8"), s.right[rest], s.left[left]))


class CodedRun:
    """A front-coded run as it arrives."""

    def __init__(self, blob: bytes, n: int):
        raw = np.frombuffer(blob, np.uint8)
        self.shared, self.right_size, self.left_size = (raw[k * n:(k + 1) * n] for k in range(3))
        self.doc, self.anchor = (np.frombuffer(blob, "<i8", n, 3 * n + k * 8 * n) for k in range(2))
        sizes = self.right_size.astype(np.int64) - self.shared
        self.ends = np.cumsum(sizes)
        at = 19 * n
        self.rest = blob[at:at + int(self.ends[-1])]
        flat = raw[at + int(self.ends[-1]):]
        self.left = np.zeros((n, LEFT), np.uint8)
        self.left[np.arange(LEFT) < self.left_size[:, None]] = flat

    def strings(self) -> Iterator[tuple[int, bytes]]:
        """(shared prefix length, whole suffix) in order."""
        before, start = b"", 0
        for shared, end in zip(self.shared.tolist(), self.ends.tolist()):
            before = before[:shared] + self.rest[start:end]
            start = end
            yield shared, before


def prefix_from(a: bytes, b: bytes, start: int) -> int:
    """Length of the common prefix of two strings that agree up to ``start``."""
    end = min(len(a), len(b))
    if a[start:end] == b[start:end]:
        return end
    while start < end and a[start] == b[start]:
        start += 1
    return start


def loser_tree_merge(runs: list[Iterator[tuple[int, bytes]]]) -> tuple[list[int], list[int]]:
    """Order of the runs' heads in the merged sequence, and the common-prefix array.

    ``known[r]`` is the length of the prefix that run r's head shares with the
    last winner. Of two heads the one with the longer known prefix is smaller;
    its rival's known prefix stays right. Only on a tie are bytes compared, from
    the known length on.
    """
    leaves = 1
    while leaves < len(runs):
        leaves *= 2
    heads: list[bytes | None] = [None] * leaves
    known = [-1] * leaves  # an empty run loses against all

    def fetch(r: int) -> None:
        got = next(runs[r], None)
        known[r], heads[r] = got if got is not None else (-1, None)

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser)."""
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        if heads[a] is None:
            return a, b
        x, y = heads[a], heads[b]
        length = prefix_from(x, y, known[a])
        if x < y or (x == y and a < b):
            known[b] = length
            return a, b
        known[a] = length
        return b, a

    for r in range(len(runs)):
        fetch(r)
        if heads[r] is not None:
            known[r] = 0
    losers = [0] * leaves
    winners = list(range(leaves))
    level = leaves
    while level > 1:
        level //= 2
        played = [play(winners[2 * k], winners[2 * k + 1]) for k in range(level)]
        winners = [w for w, _ in played]
        losers[level:2 * level] = [x for _, x in played]
    winner = winners[0]
    order, shared = [], []
    while heads[winner] is not None:
        order.append(winner)
        shared.append(known[winner])
        fetch(winner)
        node = (winner + leaves) // 2
        while node:
            winner, losers[node] = play(winner, losers[node])
            node //= 2
    return order, shared


def repeated(s: Suffixes, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc_id, start, end) of bytes that repeat, from suffixes in order and their common-prefix array."""
    gram = np.cumsum(shared < GRAM)
    keep = np.bincount(gram)[gram] > 1
    part = np.flatnonzero(keep)
    if not len(part):
        return s.doc[:0], s.anchor[:0], s.anchor[:0]
    shared, s = shared[part], s.take(part)  # dropped neighbours shared less than a gram with any that stay
    order = np.lexsort((s.anchor, s.doc))
    fresh = np.append(True, (np.diff(s.doc[order]) != 0) | (np.diff(s.anchor[order]) != 0))
    age = np.empty(len(s), np.int64)
    age[order] = np.cumsum(fresh)
    names, rank = np.unique(rows_as_keys(s.left, s.left_size + np.uint8(1)), return_inverse=True)
    sample = np.zeros(len(names), np.int64)
    sample[rank] = np.arange(len(s))
    left_shared = common(s.left[sample], s.left_size[sample])
    least, most = np.full(len(s), LEFT + 1), np.full(len(s), -1)
    for o in range(LEFT + 1):
        at = np.flatnonzero((s.right_size >= WINDOW - o) & (s.left_size >= o))
        if len(at) < 2:
            continue
        right_class = np.cumsum(shared < WINDOW - o)[at]
        key = right_class * (len(names) + 1) + np.cumsum(left_shared < o)[rank[at]]
        by = np.lexsort((age[at], key))
        edge = np.append(True, key[by][1:] != key[by][:-1])
        oldest = age[at][by][np.maximum.accumulate(np.where(edge, np.arange(len(by)), 0))]
        hit = at[by[age[at][by] > oldest]]
        least[hit] = np.minimum(least[hit], o)
        most[hit] = o
    found = np.flatnonzero(most >= 0)
    return s.doc[found], s.anchor[found] - most[found], s.anchor[found] - least[found] + WINDOW


def sent_runs(ready: DataFrame, ranges: int) -> DataFrame:
    """(part, n, blob) pieces of sorted runs by range, and, with part < 0, (doc_id, start, end) lists that are settled."""

    def flush(parts: list[Suffixes]) -> pa.RecordBatch:
        run, equal = sorted_run(Suffixes.join(parts))
        value = np.zeros(len(run), np.uint64)
        for k in range(GRAM):
            value = value * T.BASE + T._spread[run.right[:, k]]
        part = ((T.mix(value) >> np.uint64(33)).astype(np.int64) * ranges) >> 31
        order = np.argsort(part, kind="stable")
        edges = np.append(np.flatnonzero(np.append(True, np.diff(part[order]) != 0)), len(order)) if len(order) else np.zeros(1, np.int64)
        rows = [(int(part[order[a]]), b - a, front_coded(run.take(order[a:b]))) for a, b in zip(edges.tolist(), edges[1:].tolist())]
        if len(equal):
            low, high = equal.anchor - equal.left_size, equal.anchor + equal.right_size  # the run's whole context
            rows.append((-1 - int(equal.doc[0] % ranges), len(equal), b"".join(x.astype("<i8").tobytes() for x in (equal.doc, low, high))))
        part, n, blob = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(n, pa.int32()), pa.array(blob, pa.binary())], names=["part", "n", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Suffixes] = []
        for batch in batches:
            for piece in T.slices(batch):
                held.append(suffixes_of(piece))
                if sum(map(len, held)) >= RUN_SUFFIXES:
                    yield flush(held)
                    held = []
        if sum(map(len, held)):
            yield flush(held)

    return ready.mapInArrow(run, "part int, n int, blob binary")


def merge_runs(pieces: DataFrame) -> DataFrame:
    """(doc_id, start, end) of repeated bytes; each range is merged by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_group(batches, "part"):
            counts, blobs = batch.column("n").to_pylist(), batch.column("blob")
            if batch.column("part")[0].as_py() < 0:
                lists = [np.frombuffer(b.as_py(), "<i8").reshape(3, n) for b, n in zip(blobs, counts)]
                doc, start, end = np.concatenate(lists, axis=1)
            else:
                runs = [CodedRun(b.as_py(), n) for b, n in zip(blobs, counts)]
                order, shared = loser_tree_merge([r.strings() for r in runs])
                first = np.concatenate([[0], np.cumsum(counts)])
                order = np.array(order, np.int64)
                seen = np.argsort(order, kind="stable")  # the k-th head of each run, run after run
                at = np.empty(len(order), np.int64)
                at[seen] = np.arange(first[-1])
                right_size, left_size, left, doc, anchor = (np.concatenate([getattr(r, k) for r in runs])[at]
                                                            for k in ("right_size", "left_size", "left", "doc", "anchor"))
                doc, start, end = repeated(Suffixes(right_size, right_size, left, left_size, doc, anchor), np.array(shared, np.int64))
            if len(doc):
                yield T.named_batch(doc_id=doc.astype(np.int64), start=start.astype(np.int64), end=end.astype(np.int64))

    dealt = pieces.repartition("part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "doc_id long, start long, end long")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, start, end): ranges of bytes that repeat; ranges of one document may overlap."""
    found = settle(R.shared(R.anchored(docs, BYTES)))
    ranges = max(1, found.where("place >= 0").count() // RANGE_SUFFIXES)
    made = settle(merge_runs(sent_runs(R.candidates(docs, found), ranges)))
    at = -1 - F.col("place")
    known = found.where("place < 0").select("doc_id", F.shiftright(at, 31).alias("start"), at.bitwiseAND((1 << 31) - 1).alias("end"))
    return made.union(known)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def cut(batch: pa.RecordBatch, ranges: list[np.ndarray]) -> pa.RecordBatch:
    """Counts and digest of each text without the union of its ranges."""
    data, offsets = T.text_bytes(batch)
    rows = []
    for k, spans in enumerate(ranges):
        text = data[offsets[k]:offsets[k + 1]]
        change = np.zeros(len(text) + 1, np.int64)
        if len(spans):
            np.add.at(change, spans[:, 0], 1)
            np.add.at(change, spans[:, 1], -1)
        gone = np.cumsum(change)[:-1] > 0
        starts = int(np.count_nonzero(gone & ~np.append(False, gone[:-1])[:len(gone)]))
        rows.append((len(text), int(gone.sum()), starts, hashlib.sha256(text[~gone].tobytes()).hexdigest()))
    n_bytes, n_removed, n_spans, digest = zip(*rows) if rows else ((),) * 4
    return T.named_batch(doc_id=batch.column("doc_id"), n_bytes=pa.array(n_bytes, pa.int64()), n_removed=pa.array(n_removed, pa.int64()),
                         n_spans=pa.array(n_spans, pa.int64()), kept_sha256=pa.array(digest, pa.string()))


def dedup_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    docs, named = T.unclashed(docs)
    ranges = settle(repeated_ranges(docs))
    mine = ranges.groupBy("doc_id").agg(F.collect_list(F.array("start", "end")).alias("spans"))  # bounded by the text
    touched = R.texts_with(docs, ranges).join(mine, "doc_id", "left")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        return cut(batch, [np.array(x or [], np.int64).reshape(-1, 2) for x in batch.column("spans").to_pylist()])

    whole = R.texts_without(docs, ranges, lambda batch: cut(batch, [np.zeros((0, 2), np.int64)] * batch.num_rows), RESULT)
    return T.with_ids(whole.union(T.scan(touched, step, RESULT)), named, "doc_id")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(T.documents(spark, sf_dir))
