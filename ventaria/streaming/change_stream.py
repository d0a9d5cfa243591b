"""Change log over row images that keep arriving as files.

Every micro-batch meets the last known image of the records it touches, and the
same version operator as in batch finds the events. Each batch writes its
events and its new last images under its own batch id and overwrites them when
it runs again, so a retried batch leaves one copy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ventaria.operators.changelog import log_versions
from ventaria.session import leftovers_removed, settle

IMAGES = "record_key string, version long, image string"
BATCH = "batch_id"
SEED = -1


def seed_state(images: DataFrame, state: str) -> None:
    """Write the images the log starts from (may be empty)."""
    images.select("record_key", F.col("version").cast("long").alias("version"), "image").write.mode("overwrite").parquet(f"{state}/{BATCH}={SEED}")


def last_images(spark: SparkSession, state: str, before: int, keys: DataFrame | None = None) -> DataFrame:
    """The newest image of every record (or of ``keys`` only) known before a batch."""
    known = spark.read.schema(f"{IMAGES}, {BATCH} long").parquet(state).where(F.col(BATCH) < before)
    known = known if keys is None else known.join(keys, "record_key", "left_semi")  # before anything is grouped
    newest = known.groupBy("record_key").agg(F.max("version").alias("version"))
    return known.join(newest, ["record_key", "version"]).select("record_key", "version", "image").dropDuplicates(["record_key", "version"])


def beside(log: str) -> str:
    """Where images that cannot enter the log are kept."""
    return f"{log.rstrip('/')}_late"


def apply_batch(batch: DataFrame, batch_id: int, state: str, log: str) -> None:
    """One micro-batch; what it settled on the way is removed at its end."""
    with leftovers_removed(batch.sparkSession):
        write_batch(batch, batch_id, state, log)


def write_batch(batch: DataFrame, batch_id: int, state: str, log: str) -> None:
    """Write the events, the new last images and the refused images of one micro-batch.

    Nothing is dropped: an image that is not newer than the stored one goes to the
    side table as ``late``; of different images with one key and version the
    smallest enters the log and the others go there as ``contradiction``. Only a
    row that says again what is known already is left out.
    """
    rows = batch.select("record_key", "version", "image").distinct()
    touched = rows.select("record_key").distinct()
    stored = settle(last_images(batch.sparkSession, state, batch_id, touched))
    floor = stored.select(F.col("record_key").alias("_k"), F.col("version").alias("_v"), F.col("image").alias("_i"))
    chosen = rows.groupBy(F.col("record_key").alias("_ck"), F.col("version").alias("_cv")).agg(F.min(F.struct("image")).alias("_c"))
    marked = rows.join(chosen, F.col("record_key").eqNullSafe(F.col("_ck")) & F.col("version").eqNullSafe(F.col("_cv"))).join(
        floor, F.col("record_key") == F.col("_k"), "left")
    known = F.col("version").eqNullSafe(F.col("_v")) & F.col("image").eqNullSafe(F.col("_i")) & F.col("_v").isNotNull()
    reason = (F.when(known, "known").when(F.col("version") <= F.col("_v"), "late")
              .when(~F.col("image").eqNullSafe(F.col("_c.image")), "contradiction"))
    judged = settle(marked.select("record_key", "version", "image", reason.alias("reason")))
    judged.where("reason IN ('late', 'contradiction')").write.mode("overwrite").parquet(f"{beside(log)}/{BATCH}={batch_id}")
    fresh = judged.where("reason IS NULL").drop("reason")
    both = fresh.withColumn("new", F.lit(True)).unionByName(stored.withColumn("new", F.lit(False)))
    log_versions(both, keep="new").write.mode("overwrite").parquet(f"{log}/{BATCH}={batch_id}")
    newest = fresh.groupBy("record_key").agg(F.max("version").alias("version"))
    fresh.join(newest, ["record_key", "version"]).write.mode("overwrite").parquet(f"{state}/{BATCH}={batch_id}")


def start_change_log(spark: SparkSession, source: str, state: str, log: str, checkpoint: str, files_per_batch: int = 100) -> StreamingQuery:
    """Process what has arrived in ``source`` (Parquet images), then stop."""
    arriving = spark.readStream.schema(IMAGES).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    return (arriving.writeStream.foreachBatch(lambda df, n: apply_batch(df, n, state, log))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def read_late(spark: SparkSession, log: str) -> DataFrame:
    """Images that arrived late or contradict one of the same version."""
    return spark.read.schema(f"{IMAGES}, reason string, {BATCH} long").parquet(beside(log))


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return spark.read.parquet(log)


def compact_state(spark: SparkSession, state: str, target: str, through: int) -> None:
    """Fold all batches up to ``through`` into a new state folder."""
    seed_state(last_images(spark, state, through + 1), target)
