"""Change log over arriving images with keyed state: the last image of each record is in the state store.

A micro-batch reads and writes the state of the records it touches and nothing
else; the store's own checkpoints make restarts exact. Images of one record are
taken in order of their version: a newer one than the last gives an event, an
older one goes to the side table as ``late``, a different image of a version
that is known as ``contradiction`` (of several in one batch the smallest enters
the log), and a repetition is passed over. With ``hold_ms`` images wait that
long, by processing time, for older ones that arrive after them; a timer then
releases them in order. With ``forget_after_ms`` the store drops a record that
no image touched for so long; its next image is an INSERT again.

Rows without a key or version have no place in an order and go to the side table
as ``unreadable``. One record's images of one micro-batch are sorted in one
task, so ``files_per_batch`` bounds that.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ventaria.operators.changelog import ACTIONS
from ventaria.streaming.change_stream import BATCH, IMAGES, beside

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TOLD = "record_key string, version long, action_type string, old_data string, new_data string, reason string"
EVENT = ["record_key", "version", "action_type", "old_data", "new_data"]
Row = tuple[int, str | None, str | None, str | None, str | None]  # version, action, old, new, reason


def image_order(image: str | None) -> tuple[bool, str]:
    return image is not None, image or ""


def event(old: str | None, new: str | None) -> str | None:
    if old is None or new is None:
        return ACTIONS[0] if new is not None else ACTIONS[2] if old is not None else None
    return ACTIONS[1] if old != new else None


def judged(last: tuple[int, str | None] | None, images: Iterable[tuple[int, str | None]]) -> tuple[dict[int, str | None], list[Row]]:
    """Images that are newer than the last one, one for each version, and the refused ones."""
    fresh: dict[int, str | None] = {}
    refused: list[Row] = []
    for version, image in sorted(set(images), key=lambda r: (r[0], image_order(r[1]))):
        if last is not None and version <= last[0]:
            if (version, image) != last:
                refused.append((version, None, None, image, "late"))
        elif version in fresh:
            refused.append((version, None, None, image, "contradiction"))
        else:
            fresh[version] = image
    return fresh, refused


def released(last: tuple[int, str | None] | None, fresh: dict[int, str | None]) -> tuple[tuple[int, str | None] | None, list[Row]]:
    """Events of fresh images in order, and the last image then."""
    rows: list[Row] = []
    for version in sorted(fresh):
        old, new = None if last is None else last[1], fresh[version]
        if action := event(old, new):
            rows.append((version, action, old, new, None))
        last = (version, new)
    return last, rows


class LastImage(StatefulProcessor):
    """State of one record: its last image in the log and, while images wait, those by version."""

    def __init__(self, hold_ms: int = 0, forget_after_ms: int | None = None):
        self.hold_ms, self.forget_after_ms = hold_ms, forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "version long, image string", self.forget_after_ms)
        if self.hold_ms:
            self.waiting = handle.getMapState("waiting", "version long", "image string")

    def known(self) -> tuple[int, str | None] | None:
        return tuple(self.last.get()) if self.last.exists() else None

    def told(self, key, rows: list[Row]) -> Iterator[pd.DataFrame]:
        if rows:
            made = pd.DataFrame(rows, columns=["version", "action_type", "old_data", "new_data", "reason"], dtype=object)
            made.insert(0, "record_key", key[0])
            yield made.astype({"version": "int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        images = [(int(v), None if pd.isna(i) else i) for pdf in rows for v, i in zip(pdf["version"], pdf["image"])]
        last = self.known()
        if self.hold_ms:
            held = {int(v[0]): i[0] for v, i in self.waiting.iterator()}
            fresh, refused = judged(last, [*images, *held.items()])
            if not held and fresh:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.hold_ms)
            for version, image in fresh.items():
                if version not in held or held[version] != image:
                    self.waiting.updateValue((version,), (image,))
            yield from self.told(key, refused)
            return
        fresh, refused = judged(last, images)
        now, events = released(last, fresh)
        if fresh:
            self.last.update(now)
        yield from self.told(key, events + refused)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now, events = released(self.known(), {int(v[0]): i[0] for v, i in self.waiting.iterator()})
        self.waiting.clear()
        if now is not None:
            self.last.update(now)
        yield from self.told(key, events)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        last = max(zip(initialState["version"], initialState["image"]), key=lambda r: r[0])
        self.last.update((int(last[0]), None if pd.isna(last[1]) else last[1]))

    def close(self) -> None:
        pass


def change_events(images: DataFrame, first: DataFrame | None = None, hold_ms: int = 0, forget_after_ms: int | None = None) -> DataFrame:
    """Events and refused images (``reason``) of a stream of (record_key, version, image); ``first`` holds the images the log starts from."""
    images = images.select("record_key", F.col("version").cast("long").alias("version"), "image")
    placed = "record_key IS NOT NULL AND version IS NOT NULL"
    seed = None if first is None else first.where(placed).select("record_key", F.col("version").cast("long").alias("version"), "image").groupBy("record_key")
    timed = "ProcessingTime" if hold_ms or forget_after_ms else "None"
    told = images.where(placed).groupBy("record_key").transformWithStateInPandas(
        LastImage(hold_ms, forget_after_ms), TOLD, "Append", timed, seed)
    odd = images.where(f"NOT ({placed})").selectExpr("record_key", "version", "string(NULL) AS action_type", "string(NULL) AS old_data",
                                                     "image AS new_data", "'unreadable' AS reason")
    return told.unionByName(odd)


def write_batch(batch: DataFrame, batch_id: int, log: str) -> None:
    """Events and refused images of one batch, each under its id: a repeated batch replaces its own files."""
    told = batch.persist()
    told.where("reason IS NULL").select(*EVENT).write.mode("overwrite").parquet(f"{log}/{BATCH}={batch_id}")
    told.where("reason IS NOT NULL").selectExpr("record_key", "version", "new_data AS image", "reason").write.mode("overwrite").parquet(
        f"{beside(log)}/{BATCH}={batch_id}")
    told.unpersist()


def start_keyed_log(spark: SparkSession, source: str, log: str, checkpoint: str, first: DataFrame | None = None, files_per_batch: int = 100,
                    hold_ms: int = 0, forget_after_ms: int | None = None) -> StreamingQuery:
    """Process what has arrived in ``source`` (Parquet images), then stop; read with ``read_log`` and ``read_late``.

    With ``hold_ms`` or ``forget_after_ms`` time goes on after the last file, so the query runs until its caller stops it.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    arriving = spark.readStream.schema(IMAGES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    events = change_events(arriving, first, hold_ms, forget_after_ms)
    writer = events.writeStream.foreachBatch(lambda df, n: write_batch(df, n, log)).outputMode("append").option("checkpointLocation", checkpoint)
    timed = hold_ms or forget_after_ms
    return (writer.trigger(processingTime="1 second") if timed else writer.trigger(availableNow=True)).start()
