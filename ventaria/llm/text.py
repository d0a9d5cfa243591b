"""Shared helpers: whole texts in Arrow batches, words as byte ranges, hashes of words and of word sequences.

Every operator reads (doc_id, text) through :func:`scan`, in slices of a few
megabytes, so that a task's memory follows the longest single text and not the
batch. Words are runs of ``[^\\x20\\x09-\\x0D]`` unless another byte class is
given. A null text is an empty text.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ventaria.operators.ordering import positions
from ventaria.session import settle

SLICE_BYTES = 500_000
BATCH_BYTES = 8 << 20
BASE, BASE_INVERSE = np.uint64(0x9E3779B97F4A7C15), np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
GOLDEN = 0x9E3779B97F4A7C15


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers on this machine import the package (a cluster ships it with ``--py-files``), in small Arrow batches."""
    size = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(size).rstrip("b") in ("-1", str(64 << 20)):  # unless the user chose one
        spark.conf.set(size, str(BATCH_BYTES))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns every operator reads; other columns, also clashing ones, never reach Python."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into pieces of about ``limit`` bytes of text; a longer text is a piece of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def scan(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """Apply ``step`` to slices of the rows; ``df`` has a column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit):
                made = step(piece)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return pc.fill_null(batch.column("text"), "").to_pylist()


def text_bytes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a slice as one byte array, and where each begins (one more entry than texts)."""
    column = pc.fill_null(batch.column("text"), "").cast(pa.large_string())
    if column.offset:
        column = pa.concat_arrays([column])
    data, ends = column.buffers()[2], column.buffers()[1]
    offsets = np.frombuffer(ends, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and offsets[-1] else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: dict[str, np.ndarray] = {}


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    key = str(base)
    have = _powers.get(key, np.ones(1, np.uint64))
    while len(have) < n:
        have = np.concatenate([have, have * (have[-1:] * base)])
    _powers[key] = have
    return have[:n]


SPACE = np.ones(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
_spread = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(GOLDEN))


@dataclass
class Words:
    """Words of a slice: byte range and hash of each, and the first word of each text."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # one more entry than texts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each range of bytes: every eight bytes are mixed with their place, so no rule of cancelling terms makes two ranges equal."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    chunks = (ends - starts + 7) >> 3
    first = np.cumsum(chunks) - chunks
    place = np.arange(first[-1] + chunks[-1]) - np.repeat(first, chunks)
    at = np.repeat(starts, chunks) + 8 * place
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    spare = (8 * np.maximum(0, at + 8 - np.repeat(ends, chunks))).astype(np.uint64)
    value = (eights[at] << spare) >> spare
    mixed = mix(mix(value ^ (place.astype(np.uint64) * np.uint64(GOLDEN))) + place.astype(np.uint64))
    return mix(np.add.reduceat(mixed, first) + (ends - starts).astype(np.uint64) * np.uint64(GOLDEN))


def words_of(batch: pa.RecordBatch, inside: np.ndarray = SPACE, lower: bool = False) -> Words:
    data, offsets = text_bytes(batch)
    if lower:
        data = LOWER[data]
    word = inside[data]
    before = np.empty_like(word)
    after = np.empty_like(word)
    if len(word):
        before[1:], after[:-1] = word[:-1], word[1:]
        begins = offsets[:-1][offsets[:-1] < len(word)]
        before[begins] = False
        stops = offsets[1:][offsets[1:] > 0] - 1
        after[stops] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    hashes = range_hashes(data, starts, ends)
    return Words(data, starts, ends, hashes, np.searchsorted(starts, offsets))


def windows_of(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside one text, and the text of each."""
    n = len(hashes) - size + 1
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value = np.zeros(n, np.uint64)
    for k in range(size):
        value = value * BASE + hashes[k:k + n]
    whole = text[:n] == text[size - 1:]
    return mix(value[whole]), text[:n][whole]


def named_batch(**columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def unclashed(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """doc_id and text with one text for each id, and how to read the ids.

    Where no id has two texts, these are the documents themselves and None. Else
    every distinct (id, text) gets a number of its own, rising with the id, in
    place of the id; the second part is (number, own_id). Rows that repeat an id
    and its text share a number; null ids stay null.
    """
    rows = id_and_text(docs)
    text = F.coalesce("text", F.lit(""))
    marked = rows.select("*", F.xxhash64(text).alias("one"), F.xxhash64(F.lit(1), text).alias("two"))
    least = marked.where("doc_id is not null").groupBy("doc_id").agg(*[f(c).alias(f"{c}_{f.__name__}") for c in ("one", "two") for f in (F.min, F.max)])
    if least.where("one_min <> one_max or two_min <> two_max").isEmpty():
        return rows, None
    keys = ["doc_id", "one", "two"]
    named = positions(marked.where("doc_id is not null").select(*keys).distinct(), [F.col(k) for k in keys], "number")
    numbered = marked.join(named, keys, "left").select(F.col("number").alias("doc_id"), "text")
    return settle(numbered), settle(named.select("number", F.col("doc_id").alias("own_id")))


def with_ids(rows: DataFrame, named: DataFrame | None, *columns: str) -> DataFrame:
    """``rows`` with the numbers in ``columns`` read as ids again."""
    if named is None:
        return rows
    names = rows.columns
    for k, column in enumerate(columns):
        rows = rows.join(named.select(F.col("number").alias(f"_n{k}"), F.col("own_id").alias(f"_o{k}")), F.col(column) == F.col(f"_n{k}"), "left")
        rows = rows.withColumn(column, F.col(f"_o{k}")).drop(f"_n{k}", f"_o{k}")
    return rows.select(*names)


def crc_fold(column, folds: int = 5):
    """crc32 of the id as text, modulo the folds; a null id counts as fold 1."""
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % folds, F.lit(1))
