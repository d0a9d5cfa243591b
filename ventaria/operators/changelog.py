"""Before/after change log of a table, from snapshots or from versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ventaria.functions.expressions import all_of, any_of
from ventaria.operators.ordering import number_rows
from ventaria.operators.reconcile import OK, REVIEW

ACTIONS = ("INSERT", "UPDATE", "DELETE")  # fixed values
LOG_COLUMNS = ("table_name", "record_key", "action_type", "changed_at", "changed_by", "connection_id", "old_data", "new_data")


def image(columns: list[str]) -> Column:
    """All columns of a row as JSON; unknown members stay in it as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def change_log(
    old: DataFrame, new: DataFrame, key: str, table: str, changed_by: str, connection_id: int = 0, changed_at: Column | None = None,
    home: str | None = None,
) -> DataFrame:
    """Rows added, changed and removed between two snapshots with a unique key.

    A row counts as changed when any column differs, NULL being equal to NULL.
    Images are rendered only for rows that changed. Rows without a key belong to
    no row of the other side: they are removed and added. ``home`` names a column of
    both that follows from the key, is never NULL and is no part of the images: rows
    parted by it are compared where they are (inside ``parted_by_one``).
    """
    columns = [c for c in new.columns if c != home]
    before = old.select(F.lit(True).alias("_was"), F.col(key).alias("_ok"), F.struct(*columns).alias("_old"), *([F.col(home).alias("_oh")] if home else []))
    after = new.select(F.lit(True).alias("_is"), F.col(key).alias("_nk"), F.struct(*columns).alias("_new"), *([F.col(home).alias("_nh")] if home else []))
    alike = F.col("_ok") == F.col("_nk")
    both = before.join(after, alike & (F.col("_oh") == F.col("_nh")) if home else alike, "full")
    same = all_of([F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in columns])
    action = F.when(F.col("_was").isNull(), ACTIONS[0]).when(F.col("_is").isNull(), ACTIONS[2]).when(~same, ACTIONS[1])
    changed = both.select("*", action.alias("action_type")).where("action_type IS NOT NULL")
    render = lambda c: F.when(F.col(c).isNotNull(), F.to_json(c, {"ignoreNullFields": "false"}))
    return changed.select(
        F.lit(table).alias("table_name"), F.coalesce("_nk", "_ok").cast("string").alias("record_key"), "action_type",
        (F.current_timestamp() if changed_at is None else changed_at).alias("changed_at"),
        F.lit(changed_by).alias("changed_by"), F.lit(connection_id).cast("long").alias("connection_id"),
        render("_old").alias("old_data"), render("_new").alias("new_data"))


def log_versions(versions: DataFrame, keep: str | None = None) -> DataFrame:
    """Events of (record_key, version, image) rows; a NULL image means removed.

    Versions of a record follow each other in order; a repeated image gives no
    event. The preceding image is found slice by slice, so one record may own
    any part of all versions. ``keep`` names a boolean column: rows where it is
    false only serve as predecessors.
    """
    df = number_rows(versions, "version", partition=("record_key",), previous=("image", "old_data"))
    before, now = F.col("old_data"), F.col("image")
    action = (F.when(before.isNull() & now.isNotNull(), ACTIONS[0]).when(before.isNotNull() & now.isNull(), ACTIONS[2])
              .when(before != now, ACTIONS[1]))
    df = df.select("*", action.alias("action_type")).where("action_type IS NOT NULL")
    if keep:
        df = df.where(F.col(keep))
    return df.select("record_key", "version", "action_type", "old_data", F.col("image").alias("new_data"))


def with_sequence(log: DataFrame, order: str = "table_name, record_key, action_type") -> DataFrame:
    """Dense audit_id in the given order."""
    return number_rows(log, order, position="audit_id").select("audit_id", *log.columns)


def history(log: DataFrame, table: str, key: str) -> DataFrame:
    """All events of one record in their order."""
    return log.where((F.col("table_name") == table) & (F.col("record_key") == key)).orderBy("audit_id")


def bad_payload() -> Column:
    old, new, action = F.col("old_data"), F.col("new_data"), F.col("action_type")
    return any_of([
        (action == ACTIONS[0]) & (old.isNotNull() | new.isNull()), (action == ACTIONS[1]) & (old.isNull() | new.isNull()),
        (action == ACTIONS[2]) & (old.isNull() | new.isNotNull())])


def event_counts(log: DataFrame, expected: int | None = None) -> DataFrame:
    """Events per action; with ``expected`` also OK or REVISAR."""
    df = log.groupBy("table_name", "action_type").agg(F.count(F.lit(1)).alias("event_count"))
    if expected is None:
        return df
    return df.select("*", F.when(F.col("event_count") == expected, OK).otherwise(REVIEW).alias("validation_status"))


def payload_checks(log: DataFrame) -> DataFrame:
    """Events per action whose images fit the action."""
    good = ~bad_payload()
    return log.groupBy("table_name").agg(*[
        F.count_if(good & (F.col("action_type") == a)).alias(f"valid_{a.lower()}_events") for a in ACTIONS])


def scorecard(log: DataFrame, tables: list[str]) -> DataFrame:
    c = F.col
    counts = log.agg(
        F.count_if(~c("table_name").isin(*tables)).alias("invalid_table_records"),
        F.count_if(~c("action_type").isin(*ACTIONS)).alias("invalid_action_records"),
        F.count_if(bad_payload()).alias("invalid_payload_records"),
        F.count_if(c("record_key").isNull() | (F.trim("record_key") == "")).alias("invalid_record_keys"),
        F.count_if(c("changed_at").isNull() | c("changed_by").isNull() | (F.trim("changed_by") == "")
                   | c("connection_id").isNull() | (c("connection_id") == 0)).alias("invalid_audit_metadata"))
    fine = all_of([c(n) == 0 for n in counts.columns])
    columns_found = len([n for n in ("audit_id", *LOG_COLUMNS) if n in log.columns])
    return counts.select(F.lit(columns_found).alias("audit_columns_found"), "*", F.when(fine, OK).otherwise(REVIEW).alias("audit_system_status"))


def field(payload: str, name: str, kind: str) -> Column:
    """A member of an image, cast back from its text."""
    return F.expr(f"try_cast(get_json_object({payload}, '$.{name}') AS {kind})")
