"""MinHash near-duplicates with b-bit signatures.

A document's set is its distinct five-word shingles (ASCII letters lower-cased).
Documents with equal sets are folded into one class by an order-free digest of
the set before anything else moves, so copies never meet in a bucket. Every
class has 128 minima; 25 bands of five minima give bucket keys (a pair at the
threshold 0.85 shares no bucket with probability 4e-7, one at 0.8 with 5e-5), and the lowest two bits
of all minima are packed into 32 bytes, from which a bucket estimates the
similarity of two members by counting unequal bit pairs, corrected for the
quarter of pairs that agree by chance.

Links are confirmed on full sets, in two rounds. First each bucket member is
paired with one leader of its bucket (a star, linear in the bucket). The
confirmed links give components; then, in buckets whose members lie in several
components, every member with a possible link across them (estimate within 5
standard errors of the threshold) is written as the difference of its set from
one pivot's set, which is small among near copies, and the members of a pivot
are compared exactly from these differences, block by block. Only links that
join components are emitted, so a group of near copies gives no more links than
members, and no bucket is capped.

Defined results: null, empty and blank texts have no shingles and are alone;
texts of fewer words than a shingle have one shingle, the whole sequence;
repeated rows are copies; a row without an id gets the component of its set and
no verdict, and is no member itself; other columns are ignored.
Two texts of one id are two documents, in the order of the id and then of a hash
of the text. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.llm import text as T
from ventaria.llm.components import components
from ventaria.session import settle


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 85
    minima: int = 128
    rows: int = 5
    bands: int = 25
    star_margin: float = 0.03
    pair_margin: float = 0.2  # 5 standard errors of the estimate at the threshold; 0.22 at 80 percent
    block: int = 4096  # members compared at once


_rng = np.random.default_rng(20_240_917)
MULTIPLY = (_rng.integers(0, 1 << 31, 128, np.int64) * 2 + 1).astype(np.uint32)
FLIP = _rng.integers(0, 1 << 32, 128, np.int64).astype(np.uint32)
EVEN_BITS = np.uint64(0x5555555555555555)


def shingle_sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = T.words_of(batch, lower=True)
    value, text = T.windows_of(words.hashes, words.first, size)
    cuts = np.searchsorted(text, np.arange(batch.num_rows + 1))
    sets = []
    for k, n in enumerate(words.counts):
        if 0 < n < size:
            whole = words.hashes[words.first[k]:words.first[k + 1]]
            sets.append(T.mix(np.bitwise_xor.reduce(T.mix(whole * T.powers(T.BASE, 8)[1:n + 1])).reshape(1) + np.uint64(n)))
        else:
            sets.append(np.unique(value[cuts[k]:cuts[k + 1]]))
    return sets


def minima_of(shingles: np.ndarray) -> np.ndarray:
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(128, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(short), 2048):
        np.minimum(least, ((short[at:at + 2048, None] ^ FLIP) * MULTIPLY).min(axis=0), out=least)
    return least


def packed(minima: np.ndarray) -> bytes:
    """The lowest two bits of each minimum, 32 to a word."""
    pairs = (minima & np.uint32(3)).astype(np.uint64).reshape(4, 32) << (2 * np.arange(32, dtype=np.uint64))
    return np.bitwise_or.reduce(pairs, axis=1).astype("<u8").tobytes()


def estimate(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarity of one packed signature (4 words) to many, corrected for chance agreement of two bits."""
    unequal = one ^ many
    unequal = np.bitwise_count((unequal | (unequal >> np.uint64(1))) & EVEN_BITS).sum(axis=1)
    return (1 - unequal / 128 - 0.25) / 0.75


def fingerprints(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, n (set size), digest of the set, packed signature and band keys; keys are null for empty sets."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch, settings.words)
        n = np.array([len(s) for s in sets], np.int64)
        low = np.array([s.sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        high = np.array([T.mix(s ^ np.uint64(T.GOLDEN)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
        minima = [minima_of(s) if len(s) else None for s in sets]
        weights = T.powers(T.BASE, settings.rows + 1)
        bands = [None if m is None else T.mix(
            (m[:settings.rows * settings.bands].reshape(settings.bands, settings.rows).astype(np.uint64) * weights[:-1]).sum(axis=1, dtype=np.uint64)
            + np.arange(settings.bands, dtype=np.uint64) * weights[-1]).view(np.int64) for m in minima]
        return T.named_batch(doc_id=batch.column("doc_id"), n=n, low=low, high=high,
                             signature=pa.array([None if m is None else packed(m) for m in minima], pa.binary()),
                             bands=pa.array(bands, pa.list_(pa.int64())))

    return T.scan(T.id_and_text(docs), step, "doc_id long, n long, low long, high long, signature binary, bands array<long>")


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of sorted rows that never cut a run of equal keys."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        edges = np.flatnonzero(keys[1:] != keys[:-1]) + 1
        if rest and rest[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            rest = []
        if len(edges):
            rest.append(batch.slice(0, edges[-1]))
            yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]
            rest = [batch.slice(edges[-1])]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def each_group(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """One batch for each key of sorted rows."""
    for batch in grouped(batches, key):
        keys = batch.column(key).to_numpy()
        edges = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])).tolist() + [len(keys)]
        for start, end in zip(edges, edges[1:]):
            yield batch.slice(start, end - start)


def runs(keys: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of runs of two or more equal keys."""
    edges = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])
    wide = np.flatnonzero(np.diff(edges) > 1)
    return list(zip(edges[wide].tolist(), edges[wide + 1].tolist()))


def signatures_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("signature").to_pylist()), "<u8").reshape(-1, 4)


def star_members(buckets: DataFrame, settings: Settings) -> DataFrame:
    """Members of shared buckets, each with the leader it should link to (null: it leads)."""
    least = settings.percent / 100 - settings.star_margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, "band"):
            found = runs(batch.column("band").to_numpy())
            if not found:
                continue
            ids, n, signs = batch.column("id").to_numpy(), batch.column("n").to_numpy(), signatures_of(batch)
            rows, chiefs = [], []
            for start, end in found:
                leads = np.empty(end - start, np.int64)
                count = 0
                for k in range(start, end):
                    best, chief = least, -1
                    if count:
                        at = leads[:count]
                        like = estimate(signs[k], signs[at])
                        like[100 * np.minimum(n[at], n[k]) < settings.percent * np.maximum(n[at], n[k])] = 0
                        top = int(like.argmax())
                        if like[top] >= best:
                            chief = int(ids[at[top]])
                    if chief < 0:
                        leads[count] = k
                        count += 1
                    rows.append(k)
                    chiefs.append(None if chief < 0 else chief)
            kept = batch.take(pa.array(rows))
            yield T.named_batch(band=kept.column("band"), id=kept.column("id"), n=kept.column("n"), signature=kept.column("signature"),
                                leader=pa.array(chiefs, pa.int64()))

    dealt = buckets.repartition("band").sortWithinPartitions("band", "id")
    return dealt.mapInArrow(run, "band long, id long, n long, signature binary, leader long")


def open_members(members: DataFrame, settings: Settings) -> DataFrame:
    """Members of a bucket with a possible link into another component, next to one pivot of the bucket."""
    least = settings.percent / 100 - settings.pair_margin

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, "band"):
            ids, n, part = (batch.column(k).to_numpy() for k in ("id", "n", "component"))
            signs = signatures_of(batch)
            for start, end in runs(batch.column("band").to_numpy()):
                if (part[start:end] == part[start]).all():
                    continue
                open_ = np.zeros(end - start, bool)
                for k in range(start + 1, end):
                    other = np.flatnonzero((part[start:k] != part[k])
                                           & (100 * np.minimum(n[start:k], n[k]) >= settings.percent * np.maximum(n[start:k], n[k])))
                    near = other[estimate(signs[k], signs[start + other]) >= least]
                    open_[near] = True
                    open_[k - start] |= len(near) > 0
                took = np.flatnonzero(open_) + start
                if len(took):
                    yield T.named_batch(pivot=np.full(len(took), ids[took[0]]), id=ids[took], component=part[took])

    dealt = members.repartition("band").sortWithinPartitions("band", "id")
    return dealt.mapInArrow(run, "pivot long, id long, component long").distinct()


def against_pivot(rows: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Each member's set as its difference from the pivot's set: shingles it has more, and shingles it lacks."""
    texts = T.id_and_text(docs)
    one = rows.join(texts, rows["id"] == texts["doc_id"]).select("pivot", "id", "component", F.col("text").alias("own"))
    both = one.join(texts, one["pivot"] == texts["doc_id"]).select("pivot", "id", "component", "own", "text")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("pivot").to_numpy()
        new = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))
        right = shingle_sets(batch.take(pa.array(new)).select(["text"]), settings.words)
        left = shingle_sets(pa.RecordBatch.from_arrays([batch.column("own")], names=["text"]), settings.words)
        at = np.searchsorted(new, np.arange(len(ids)), "right") - 1
        more = [np.setdiff1d(x, right[k], assume_unique=True).view(np.int64) for x, k in zip(left, at)]
        less = [np.setdiff1d(right[k], x, assume_unique=True).view(np.int64) for x, k in zip(left, at)]
        return T.named_batch(pivot=batch.column("pivot"), id=batch.column("id"), component=batch.column("component"),
                             n=np.array([len(x) for x in left], np.int64), whole=np.array([len(right[k]) for k in at], np.int64),
                             more=pa.array(more, pa.list_(pa.int64())), less=pa.array(less, pa.list_(pa.int64())))

    return T.scan(both, step, "pivot long, id long, component long, n long, whole long, more array<long>, less array<long>")


def links_in_block(rows: pa.RecordBatch, percent: int) -> list[tuple[int, int]]:
    """Links that join different components of one block, exact from the differences; at most one for each join."""
    ids, n, side = (rows.column(k).to_numpy() for k in ("id", "n", "side"))
    lists = []
    for name, flip in (("more", 0), ("less", 1)):
        column = rows.column(name)
        values = column.flatten().to_numpy()
        lists.append((np.repeat(np.arange(len(ids)), np.diff(column.offsets.to_numpy())), T.mix(values.view(np.uint64) + np.uint64(flip))))
    owner, value = (np.concatenate(x) for x in zip(*lists))
    names, element = np.unique(value, return_inverse=True)
    order = np.lexsort((owner, element))
    post, first = owner[order], np.searchsorted(element[order], np.arange(len(names) + 1))
    mine = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[mine], np.arange(len(ids) + 1))
    lacks = np.diff(rows.column("less").offsets.to_numpy())
    root = np.unique(rows.column("component").to_numpy(), return_inverse=True)[1]
    found = []
    whole = int(rows.column("whole")[0].as_py())
    crossed = len(np.unique(side)) > 1
    for k in range(len(ids)):
        if crossed and side[k] != side.min():
            continue
        held = element[mine[cuts[k]:cuts[k + 1]]]
        both = np.bincount(np.concatenate([post[first[e]:first[e + 1]] for e in held.tolist()] or [post[:0]]), minlength=len(ids))
        common = whole - lacks[k] - lacks + both  # shingles of the pivot that neither lacks, and shared additions
        near = np.flatnonzero((100 * common >= percent * (n + n[k] - common)) & (root != root[k]))
        for other in near.tolist():
            if root[other] != root[k]:
                found.append((int(ids[k]), int(ids[other])))
                root[root == root[other]] = root[k]
    return found


def links_of_open(differences: DataFrame, settings: Settings) -> DataFrame:
    """Links among the members of each pivot; groups beyond ``block`` members are compared block by block."""
    sizes = differences.groupBy("pivot").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = differences.join(sizes, "pivot").withColumn("side", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
        "part", F.xxhash64("pivot", F.least("side", "other"), F.greatest("side", "other"))).drop("other", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in grouped(batches, "part"):
            key = batch.column("part").to_numpy()
            for start, end in runs(key):
                made = links_in_block(batch.slice(start, end - start), settings.percent)
                if made:
                    yield T.named_batch(a=np.array([a for a, _ in made]), b=np.array([b for _, b in made]))

    return dealt.repartition("part").sortWithinPartitions("part", "id").mapInArrow(run, "a long, b long").distinct()


def confirmed(pairs: DataFrame, docs: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) whose full sets reach the threshold."""
    texts = T.id_and_text(docs)
    one = pairs.join(texts, pairs["a"] == texts["doc_id"]).select("a", "b", F.col("text").alias("other"))
    both = one.join(texts, one["b"] == texts["doc_id"]).select("a", "b", "other", "text")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column("b").to_numpy()
        new = np.flatnonzero(np.append(True, ids[1:] != ids[:-1]))  # rows come sorted by b, whose set is made once
        right = shingle_sets(batch.take(pa.array(new)).select(["text"]), settings.words)
        left = shingle_sets(pa.RecordBatch.from_arrays([batch.column("other")], names=["text"]), settings.words)
        at = np.searchsorted(new, np.arange(len(ids)), "right") - 1
        common = np.array([len(np.intersect1d(x, right[k], assume_unique=True)) for x, k in zip(left, at)])
        total = np.array([len(x) + len(right[k]) for x, k in zip(left, at)]) - common
        good = np.flatnonzero((100 * common >= settings.percent * total) & (common > 0))
        return batch.select(["a", "b"]).take(pa.array(good))

    return T.scan(both, step, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept."""
    docs, named = T.unclashed(docs)
    return T.with_ids(judged(docs, settings), named, "doc_id", "component_id")


def judged(docs: DataFrame, settings: Settings) -> DataFrame:
    """The same for documents of which no id has two texts."""
    prints = settle(fingerprints(docs, settings))
    classes = settle(prints.where("n > 0 and doc_id is not null").groupBy("low", "high", "n").agg(
        F.min("doc_id").alias("id"), F.min_by("signature", "doc_id").alias("signature"), F.min_by("bands", "doc_id").alias("bands")))
    buckets = classes.select(F.explode("bands").alias("band"), "id", "n", "signature")
    members = settle(star_members(buckets, settings))
    stars = members.where("leader is not null").select(F.col("id").alias("a"), F.col("leader").alias("b")).distinct()
    links = settle(confirmed(stars, docs, settings))
    parts = settle(components(links))
    placed = members.drop("leader").join(parts, members["id"] == parts["node"], "left").select(
        "band", "id", "n", "signature", F.coalesce("component", "id").alias("component"))
    still = settle(open_members(placed, settings))
    if not still.isEmpty():
        extra = settle(links_of_open(settle(against_pivot(still, docs, settings)), settings))
        if not extra.isEmpty():
            parts = settle(components(links.union(extra)))
    owners = classes.join(parts, classes["id"] == parts["node"], "left").select("low", "high", "n", F.coalesce("component", "id").alias("component_id"))
    return prints.join(owners, ["low", "high", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("n") > 0, F.col("doc_id") == F.col("component_id")).otherwise(F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One document of each component stays, the one with the smallest id; all columns stay."""
    told, named = T.unclashed(docs)
    gone = judged(told, settings).where(~F.col("kept")).select(F.col("doc_id").alias("_gone"))
    if named is None:
        return docs.join(settle(gone), docs["doc_id"].cast("long") == F.col("_gone"), "left_anti")
    sha = lambda text: F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)
    lost = told.join(settle(gone), F.col("doc_id") == F.col("_gone"), "left_semi").join(named, F.col("doc_id") == F.col("number"))
    lost = settle(lost.select(F.col("own_id").alias("_gone"), sha(F.col("text")).alias("_sha")).distinct())
    return docs.join(lost, (docs["doc_id"].cast("long") == F.col("_gone")) & (sha(docs["text"]) == F.col("_sha")), "left_anti")


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(T.documents(spark, sf_dir))


OP9_SQL = r"""
WITH RECURSIVE cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM cut
), rows AS (SELECT doc_id, unnest(s) AS k FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM rows a JOIN rows b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs JOIN sets p ON p.doc_id = x JOIN sets q ON q.doc_id = y WHERE 100 * c >= 85 * (len(p.s) + len(q.s) - c)
), ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (SELECT x, y FROM ways UNION SELECT r.x, w.y FROM reach r JOIN ways w ON r.y = w.x)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, least(doc_id, coalesce(m, doc_id)) = doc_id AS kept
FROM sets LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) ON x = doc_id
"""
