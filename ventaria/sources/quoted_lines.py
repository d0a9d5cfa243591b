r"""CSV records with line breaks inside quotes, read by many tasks.

Spark cuts a file into byte ranges at line ends, and a line alone does not tell
whether it starts inside a quoted field.  So every line has two outcomes, one
for each way it may start, and outcomes compose: a task follows both through
its byte range, one small row per range then gives the state in which each range
really starts, and with it each line's state.  Lines that are whole records are
parsed where they are; only lines of broken records are moved and put together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ventaria.session import settle

# A text that ends inside a quoted field: whole fields, then a quote that nothing closes. Possessive, so linear.
_WHOLE = r'(?:"(?:[^"]++|"")*+"[^,]*+|[^",][^,]*+)?+'
_OPEN = rf'^(?:{_WHOLE},)*+"(?:[^"]++|"")*+\z'
_CLOSING = r'^(?:[^"]++|"")*+"'
_FOLLOWED = ("before0", "before1", "after0", "after1", "start0", "start1")
_LINES = "_file string, _block long, value string, _at long, " + ", ".join(f"{c} long" for c in _FOLLOWED)


def outcomes(line: Column) -> tuple[Column, Column]:
    """Does a line end inside quotes if it starts outside, and if it starts inside?"""
    rest = F.concat(F.lit('""'), F.regexp_replace(line, _CLOSING, ""))  # what comes after the closing quote comes after a whole field
    return line.rlike(_OPEN), ~line.rlike(_CLOSING) | rest.rlike(_OPEN)


def _through(ends: tuple[np.ndarray, np.ndarray], state: int) -> np.ndarray:
    """State after each line: the last line with one outcome decides, each later line with two swaps it or keeps it."""
    fixed, swaps = ends[0] == ends[1], np.cumsum(ends[0] & ~ends[1])
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(fixed)), -1))
    known = last >= 0
    return np.where(known, ends[0][last] ^ ((swaps - swaps[last]) & 1), state ^ (swaps & 1)).astype(np.int64)


def _follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each line in its byte range, states and the last record start for both states of the range's start."""
    where, at, states, starts = None, 0, [0, 1], [-1, -1]
    for batch in batches:
        files, blocks = batch["_file"].dictionary_encode().indices.to_numpy(), batch["_block"].to_numpy()
        ends = tuple(batch[c].to_numpy(zero_copy_only=False) for c in ("_f0", "_f1"))
        edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(blocks) != 0)) + 1
        columns: dict[str, list] = {name: [] for name in ("_at", *_FOLLOWED)}
        for low, high in zip([0, *edges], [*edges, batch.num_rows]):
            if low == high:
                continue
            here = (batch["_file"][int(low)].as_py(), int(blocks[low]))
            if here != where:
                where, at, states, starts = here, 0, [0, 1], [-1, -1]
            places = np.arange(at, at + high - low)
            for way in (0, 1):
                after = _through((ends[0][low:high], ends[1][low:high]), states[way])
                before = np.concatenate([[states[way]], after[:-1]])
                begun = np.maximum.accumulate(np.maximum(np.where(before == 0, places, -1), starts[way]))
                columns[f"before{way}"].append(before)
                columns[f"after{way}"].append(after)
                columns[f"start{way}"].append(begun)
                states[way], starts[way] = int(after[-1]), int(begun[-1])
            columns["_at"].append(places)
            at += int(high - low)
        made = [pa.array(np.concatenate(c).astype(np.int64) if c else [], pa.int64()) for c in columns.values()]
        yield pa.RecordBatch.from_arrays([batch["_file"], batch["_block"], batch["value"], *made],
                                         ["_file", "_block", "value", *columns])


def _range_starts(lines: DataFrame) -> DataFrame:
    """One row per byte range: the state it starts in, and the record still open there (its range and line)."""
    ends = lines.groupBy("_file", "_block").agg(*[F.max_by(c, "_at").alias(c) for c in _FOLLOWED if not c.startswith("before")])
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    upto = earlier.rowsBetween(Window.unboundedPreceding, 0)
    swaps = F.sum((F.col("after0") > F.col("after1")).cast("long"))
    ends = ends.select("*", swaps.over(upto).alias("_s"))
    base = F.when(F.col("after0") == F.col("after1"), (F.col("after0") + F.col("_s")) % 2)
    swapped = F.coalesce(F.last("_s").over(earlier), F.lit(0))
    ends = ends.select("*", base.alias("_base"))
    state = (F.coalesce(F.last("_base", ignorenulls=True).over(earlier), F.lit(0)) + swapped) % 2
    ends = ends.select("*", state.alias("_state"))
    begun = F.when(F.col("_state") == 0, F.col("start0")).otherwise(F.col("start1"))
    ends = ends.select("_file", "_block", "_state", F.when(begun >= 0, F.struct(F.col("_block").alias("block"), begun.alias("at"))).alias("_begun"))
    return ends.select("_file", "_block", "_state", F.last("_begun", ignorenulls=True).over(earlier).alias("_open"))


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    r"""(_file, _block, _at, record) of every CSV record, with its line breaks as they stand in the file.

    The place is that of the record's first line. Records end in \n or \r\n;
    blank lines outside quotes are none. A quoted field still open at the end of
    a file keeps all that follows it in one record. The lines are written once,
    so the places stay when a task is repeated. No file gives no rows.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), "value")
    outside, inside = outcomes(F.col("value"))
    lines = settle(lines.select("*", outside.alias("_f0"), inside.alias("_f1")).mapInArrow(_follow, _LINES))
    starts = settle(_range_starts(lines))  # its size is then known: small ones are broadcast, and no line is moved
    lines = lines.join(starts, ["_file", "_block"])
    real = {c: F.when(F.col("_state") == 0, F.col(f"{c}0")).otherwise(F.col(f"{c}1")) for c in ("before", "after", "start")}
    begun = F.when(real["start"] >= 0, F.struct(F.col("_block").alias("block"), real["start"].alias("at"))).otherwise(F.col("_open"))
    lines = lines.select("_file", "_block", "_at", "value", ((real["before"] == 0) & (real["after"] == 0)).alias("_whole"), begun.alias("_record"))

    whole = lines.where("_whole").select("_file", "_block", "_at", F.col("value").alias("record"))
    pieces = F.array_sort(F.collect_list(F.struct("_block", "_at", "value")))
    broken = lines.where("NOT _whole").groupBy("_file", "_record").agg(F.concat_ws("\n", pieces["value"]).alias("record"))
    broken = broken.select("_file", F.col("_record.block").alias("_block"), F.col("_record.at").alias("_at"), "record")
    every = whole.unionByName(broken).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return every.where(F.trim("record") != "")
