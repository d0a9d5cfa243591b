"""Spelling variants: the vocabulary acceptor composed with a one-edit transducer and the acceptor again.

Words are counted over whole texts, in slices, with a deterministic loss of one
letter in a few occurrences (see :func:`tokens`). Two words are near if one
inserted, deleted or replaced code point turns one into the other. The pairs are
those accepted by A o T o A, where A is the minimised acceptor of the vocabulary
and T copies symbols, makes one edit and copies the rest.

Partitions. A pair of lengths (s, s) or (s, s + 1) agrees before the edit or
behind it: on its first s // 2 symbols or on the others. So each word goes to the
partitions (s, prefix) and (s, suffix): the composition restricted to the states
that A reaches by the prefix, or from which it accepts by the suffix. A
partition of more than ``most_words`` words is split by the same argument, within
the symbols that are still open, until it is small or one symbol is open, where
the alphabet of 90 letters bounds it. So no prefix or suffix, whatever share of the
words it has, makes a large task, and no pair is lost: the common prefix of a
pair decides the one partition that reports it. Each task emits a count and a
best partner per word, not the pairs.

Forms. A word's form is its most frequent near word, if that is ten times as
frequent. The chain from a word to its root has at most 19 steps, as counts grow
tenfold; pointers are doubled until none moves.

Defined results: null and empty texts have no words; a null id is an empty id;
repeated rows and rows of one id with different texts each count; a run of any
length is a word; ties of count go to the smaller word in code-point order; an
empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.session import settle

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
LATIN = 0xC3  # first byte of U+00C0 .. U+00FF; the second one follows in every valid text
LONG_RUN = 64  # bytes; the checksum of longer runs is taken one by one


@dataclass(frozen=True)
class Settings:
    least_length: int = 7
    least_count: int = 2
    loss: int = 31  # one in so many occurrences, by checksum, loses a letter
    form_factor: int = 10
    most_words: int = 2_000  # of a partition before it is split


def crc_table() -> np.ndarray:
    """Checksum table of one byte, from its defining rule."""
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & np.uint32(1), np.uint32(0xEDB88320) ^ (value >> np.uint32(1)), value >> np.uint32(1))
    return value


CRC = crc_table()


def checksums(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """crc32 of each range of bytes, continued from the checksum of what stands before it."""
    state = seeds ^ np.uint32(0xFFFFFFFF)
    open_ = np.flatnonzero(ends - starts <= LONG_RUN)
    step = 0
    while len(open_):
        byte = data[starts[open_] + step]
        state[open_] = CRC[(state[open_] ^ byte) & np.uint32(0xFF)] ^ (state[open_] >> np.uint32(8))
        step += 1
        open_ = open_[starts[open_] + step < ends[open_]]
    made = state ^ np.uint32(0xFFFFFFFF)
    for k in np.flatnonzero(ends - starts > LONG_RUN):
        made[k] = zlib.crc32(data[starts[k]:ends[k]].tobytes(), int(seeds[k]))
    return made


def tokens(batch: pa.RecordBatch, settings: Settings) -> pa.Array:
    """Runs of letters of a slice, A-Z lower-cased, after the loss, of ``least_length`` code points or more.

    An occurrence whose crc32 of ``<doc_id>:<run>`` the number ``loss`` divides
    loses its code point at that checksum modulo its length.
    """
    data, offsets = T.text_bytes(batch)
    data = T.LOWER[data]
    second = np.zeros(len(data), bool)
    second[1:] = data[:-1] == LATIN
    inside = LETTER[data] | (data == LATIN) | second
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = np.unique(cuts[inside[cuts] & inside[cuts - 1]])  # texts that touch
    starts = np.sort(np.concatenate([np.flatnonzero(edge == 1), cuts]))
    ends = np.sort(np.concatenate([np.flatnonzero(edge == -1), cuts]))
    symbols = np.concatenate([[0], np.cumsum(inside & ~second)])
    lengths = symbols[ends] - symbols[starts]
    some = lengths >= settings.least_length
    starts, ends, lengths = starts[some], ends[some], lengths[some]
    of = np.searchsorted(offsets, starts, "right") - 1
    heads = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in batch.column("doc_id").to_pylist()], np.uint32)
    sums = checksums(data, starts, ends, heads[of])
    hit = np.flatnonzero(sums % np.uint32(settings.loss) == 0)
    first = np.flatnonzero(inside & ~second)
    gone = first[symbols[starts[hit]] + (sums[hit] % lengths[hit].astype(np.uint32)).astype(np.int64)]
    delta = np.zeros(len(data) + 1, np.int32)
    delta[starts] += 1
    delta[ends] -= 1
    keep = np.cumsum(delta[:-1]) > 0
    keep[gone] = False
    keep[gone[data[gone] == LATIN] + 1] = False
    before = np.concatenate([[0], np.cumsum(keep)])
    lengths[hit] -= 1
    borders = np.append(before[starts], before[-1:]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(borders), pa.py_buffer(np.ascontiguousarray(data[keep])))
    return words.filter(pa.array(lengths >= settings.least_length))


def counted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, n: every word of the texts that occurs ``least_count`` times; counts are folded per slice, then per task."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        counts = tokens(batch, settings).value_counts()
        return T.named_batch(word=counts.field("values"), n=counts.field("counts"))

    parts = T.scan(T.id_and_text(docs), step, "word string, n long", 4 * T.SLICE_BYTES)
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= settings.least_count)


class Acceptor:
    """Minimised acceptor of some sorted words: a state is its id, with its arcs and whether it accepts; words are numbered by rank."""

    def __init__(self, words: list[str]):
        self.arcs: list[tuple[tuple[str, int], ...]] = []
        self.final: list[bool] = []
        self.size: list[int] = []  # words accepted from a state, so that ranks need no states of their own
        self._known: dict[tuple, int] = {}
        self._next: list[dict[str, int]] = []
        self.words = words
        self.start = self._state(0, len(words), 0)

    def _state(self, low: int, high: int, depth: int) -> int:
        words = self.words
        accepts = len(words[low]) == depth
        at, arcs = low + accepts, []
        while at < high:
            symbol, end = words[at][depth], at + 1
            while end < high and words[end][depth] == symbol:
                end += 1
            if end - at == 1:
                arcs.append((symbol, self._tail(words[at], depth + 1)))
            else:
                arcs.append((symbol, self._state(at, end, depth + 1)))
            at = end
        return self._intern(accepts, tuple(arcs))

    def _tail(self, word: str, depth: int) -> int:
        state = self._intern(True, ())
        for symbol in reversed(word[depth:]):
            state = self._intern(False, ((symbol, state),))
        return state

    def _intern(self, accepts: bool, arcs: tuple[tuple[str, int], ...]) -> int:
        key = (accepts, arcs)
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(accepts)
            self.size.append(accepts + sum(self.size[s] for _, s in arcs))
            self._next.append(dict(arcs))
        return state

    def both(self, p: int, q: int, memo: dict) -> list[tuple[int, int]]:
        """Ranks below p and below q of every ending that both states accept."""
        if p == q:
            return [(k, k) for k in range(self.size[p])]
        found = memo.get((p, q))
        if found is None:
            found = [(0, 0)] if self.final[p] and self.final[q] else []
            other = self._next[q]
            if not other.keys().isdisjoint(self._next[p]):
                ranks = self.ranks(q)
                below = int(self.final[p])
                for symbol, to in self.arcs[p]:
                    if symbol in other:
                        here = ranks[symbol]
                        found += [(below + a, here + b) for a, b in self.both(to, other[symbol], memo)]
                    below += self.size[to]
            memo[(p, q)] = found
        return found

    def ranks(self, state: int) -> dict[str, int]:
        below, made = int(self.final[state]), {}
        for symbol, to in self.arcs[state]:
            made[symbol] = below
            below += self.size[to]
        return made

    def composed(self) -> Iterator[tuple[int, int, int]]:
        """Accepted pairs of A o T o A as (rank, rank, symbols copied before the edit); a longer word stands second."""
        memo: dict = {}
        todo = [(self.start, 0, 0)]
        while todo:
            state, rank, depth = todo.pop()
            if self.size[state] < 2:
                continue
            arcs, below = self.arcs[state], rank + self.final[state]
            places = []
            for symbol, to in arcs:
                places.append((symbol, to, below))
                todo.append((to, below, depth + 1))
                below += self.size[to]
            for k, (symbol, to, at) in enumerate(places):
                for _, other, there in places[k + 1:]:  # replace
                    for a, b in self.both(to, other, memo):
                        yield at + a, there + b, depth
                for a, b in self.both(state, to, memo):  # insert; only where the copy could not go on
                    if self.words[rank + a][depth:depth + 1] != symbol:
                        yield rank + a, at + b, depth


def near_words(words: list[str], short: int, agreed: int, behind: int) -> Iterator[tuple[int, int]]:
    """Near pairs of a partition by rank: its words, sorted, agree on ``agreed`` first and ``behind`` last symbols.

    Reported are pairs of lengths (short, short) and (short, short + 1) whose
    common prefix ends within the open symbols: no other partition reports them.
    """
    machine = Acceptor([w[agreed:len(w) - behind] for w in words])
    last = short - behind - agreed if behind else short + 2
    for a, b, depth in machine.composed():
        if len(words[a]) == short and depth < last:
            yield a, b


def partners(partitions: DataFrame) -> DataFrame:
    """word, n_near, best (n, word): each partition's share of a word's near words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            whole = pa.Table.from_batches([b for b in (rest, batch) if b is not None]).combine_chunks().to_batches()[0]
            borders = key_borders(whole)
            yield told(whole, borders[:-1])
            rest = whole.slice(borders[-2])
        if rest is not None:
            yield told(rest, np.array([0, rest.num_rows]))

    def key_borders(batch: pa.RecordBatch) -> np.ndarray:
        differs = np.zeros(max(0, batch.num_rows - 1), bool)
        for name in ("short", "agreed", "behind", "head", "tail"):
            column = batch.column(name)
            differs |= pa.compute.not_equal(column.slice(1), column.slice(0, batch.num_rows - 1)).to_numpy(zero_copy_only=False)
        return np.concatenate([[0], np.flatnonzero(differs) + 1, [batch.num_rows]])

    def told(batch: pa.RecordBatch, borders: np.ndarray) -> pa.RecordBatch:
        found: list[tuple[str, int, int, str]] = []
        sizes = np.diff(borders)
        for low, size in zip(borders[:-1][sizes > 1].tolist(), sizes[sizes > 1].tolist()):
            part = batch.slice(low, size)
            short, agreed, behind = (part.column(c)[0].as_py() for c in ("short", "agreed", "behind"))
            words, counts = part.column("word").to_pylist(), part.column("n").to_pylist()
            order = sorted(range(size), key=lambda k: words[k][agreed:len(words[k]) - behind])
            words, counts = [words[k] for k in order], [counts[k] for k in order]
            many: dict[int, int] = {}
            best: dict[int, int] = {}
            for pair in near_words(words, short, agreed, behind):
                for one, other in (pair, pair[::-1]):
                    many[one] = many.get(one, 0) + 1
                    b = best.get(one)
                    if b is None or (-counts[other], words[other]) < (-counts[b], words[b]):
                        best[one] = other
            found += [(words[k], many[k], counts[best[k]], words[best[k]]) for k in many]
        columns = list(zip(*found)) or [[], [], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return T.named_batch(**{name: pa.array(c, kind) for name, c, kind in zip(("word", "near", "best_n", "best"), columns, kinds)})

    keys = ["short", "agreed", "behind", "head", "tail"]
    dealt = partitions.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(run, "word string, near long, best_n long, best string")


def keyed(words: DataFrame) -> DataFrame:
    return words.withColumns({"head": F.expr("left(word, agreed)"), "tail": F.expr("right(word, behind)")})


def partitions_of(vocabulary: DataFrame, settings: Settings) -> DataFrame:
    """Every word in every partition that may hold a near word of it; none but bounded ones is larger than ``most_words``."""
    length = F.length("word")
    shorts = F.filter(F.array(length, length - 1), lambda s: s >= settings.least_length)
    words = vocabulary.select("word", "n", F.explode(shorts).alias("short"))
    half = F.floor(F.col("short") / 2).cast("int")
    sides = F.array(F.struct(half.alias("agreed"), F.lit(0).alias("behind")), F.struct(F.lit(0).alias("agreed"), (F.col("short") - half).alias("behind")))
    open_ = keyed(words.select("word", "n", "short", F.inline(sides)))
    keys = ["short", "agreed", "behind", "head", "tail"]
    ready = None
    while True:
        large = settle(open_.groupBy(*keys).count().where((F.col("count") > settings.most_words) & (F.col("short") - F.col("agreed") - F.col("behind") > 1)).drop("count"))
        small = large.isEmpty()
        part = open_ if small else open_.join(large, keys, "left_anti")
        ready = part if ready is None else ready.unionByName(part)
        if small:
            return ready
        gap = F.col("short") - F.col("agreed") - F.col("behind")
        half = F.floor(gap / 2).cast("int")
        sides = F.array(F.struct((F.col("agreed") + half).alias("agreed"), F.col("behind")),
                        F.struct(F.col("agreed"), (F.col("behind") + gap - half).alias("behind")))
        open_ = settle(keyed(open_.join(large, keys, "left_semi").select("word", "n", "short", F.inline(sides))))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of words that have a form: pointers are doubled until none moves."""
    links = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = settle(links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        links = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return links


def group_variants(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the vocabulary."""
    vocabulary = settle(counted(docs, settings))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    near = partners(partitions_of(vocabulary, settings)).groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    known = vocabulary.join(near, "word", "left")
    enough = -F.col("best.less") >= settings.form_factor * F.col("n")
    known = settle(known.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n")))
    ends = roots(known.where(F.col("form").isNotNull()))
    return known.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_variants(T.documents(spark, sf_dir))
