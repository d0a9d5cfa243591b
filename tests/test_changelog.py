"""Change log in batch and as a stream."""

import pytest
from pyspark.sql import functions as F

from ventaria.operators import changelog as L
from ventaria.streaming import change_stream as S

SCHEMA = "order_key long, ship_mode string, ship_date date"


def snapshot(spark, *rows):
    return spark.createDataFrame([(k, m, d) for k, m, d in rows], "order_key long, ship_mode string, ship_date string").select(
        "order_key", "ship_mode", F.to_date("ship_date").alias("ship_date"))


def log(old, new):
    return L.change_log(old, new, "order_key", "orders", "tester", 9)


@pytest.fixture(scope="module")
def versions(spark):
    v0 = snapshot(spark, (1, None, "2026-08-13"), (2, "Same Day", "2026-08-13"))
    v1 = snapshot(spark, (1, None, "2026-08-13"), (2, "Same Day", "2026-08-13"), (3, None, "2026-08-13"))
    v2 = snapshot(spark, (1, None, "2026-08-13"), (2, "Same Day", "2026-08-13"), (3, None, "2026-08-14"))
    return [v0, v1, v2, v0]


def test_insert_update_delete_cycle(versions):
    steps = [log(a, b).collect() for a, b in zip(versions, versions[1:])]
    assert [[r["action_type"] for r in s] for s in steps] == [["INSERT"], ["UPDATE"], ["DELETE"]]
    assert all(s[0]["record_key"] == "3" for s in steps)
    insert, update, delete = (s[0] for s in steps)
    assert insert["old_data"] is None and '"ship_mode":null' in insert["new_data"]
    assert "2026-08-13" in update["old_data"] and "2026-08-14" in update["new_data"]
    assert delete["new_data"] is None and delete["old_data"] == update["new_data"]


def test_same_snapshot_gives_no_event(versions):
    assert log(versions[0], versions[0]).count() == 0


def test_null_to_value_is_an_update(spark):
    old, new = snapshot(spark, (1, None, None)), snapshot(spark, (1, "Same Day", None))
    row = log(old, new).select(L.field("old_data", "ship_mode", "string").alias("o"), L.field("new_data", "ship_mode", "string").alias("n")).first()
    assert (row["o"], row["n"]) == (None, "Same Day")


def test_scorecard_and_history(versions):
    events = log(versions[0], versions[1]).unionByName(log(versions[1], versions[2])).unionByName(log(versions[2], versions[3]))
    numbered = L.with_sequence(events)
    assert L.scorecard(numbered, ["orders"]).first()["audit_system_status"] == "OK"
    assert L.scorecard(numbered.withColumn("changed_by", F.lit(" ")), ["orders"]).first()["audit_system_status"] == "REVISAR"
    assert {r["validation_status"] for r in L.event_counts(events, expected=1).collect()} == {"OK"}
    assert L.history(numbered, "orders", "3").count() == 3
    assert L.payload_checks(events).first().asDict() == {"table_name": "orders", "valid_insert_events": 1, "valid_update_events": 1, "valid_delete_events": 1}


def images(spark, rows):
    return spark.createDataFrame(rows, S.IMAGES)


def test_versions_of_one_hot_record(spark, many_slices):
    """One record owns nearly all versions, so its history spans many slices."""
    rows = [("hot", v, f"i{v // 2}") for v in range(400)] + [("cold", 0, "a"), ("cold", 1, None), ("cold", 2, None), ("cold", 3, "b")]
    events = L.log_versions(images(spark, rows)).collect()
    hot = sorted((r["version"], r["action_type"], r["old_data"], r["new_data"]) for r in events if r["record_key"] == "hot")
    assert hot == [(0, "INSERT", None, "i0")] + [(v, "UPDATE", f"i{v // 2 - 1}", f"i{v // 2}") for v in range(2, 400, 2)]
    assert sorted((r["version"], r["action_type"]) for r in events if r["record_key"] == "cold") == [(0, "INSERT"), (1, "DELETE"), (3, "INSERT")]


def run(spark, paths):
    S.start_change_log(spark, *paths, files_per_batch=1).awaitTermination(120)


def test_stream_equals_batch(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("in", "state", "log", "check")]
    source, state, out, _ = paths
    seed = images(spark, [("1", 0, "a"), ("2", 0, "b")])
    S.seed_state(seed, state)
    first = images(spark, [("1", 1, "c"), ("3", 1, "x"), ("3", 2, "y")])
    second = images(spark, [("3", 3, None), ("2", 5, "b"), ("1", 1, "late"), ("1", 0, "older")])
    first.coalesce(1).write.parquet(source)
    run(spark, paths)
    second.coalesce(1).write.mode("append").parquet(source)
    run(spark, paths)
    got = sorted(tuple(r) for r in S.read_log(spark, out).select("record_key", "version", "action_type", "old_data", "new_data").collect())
    late = images(spark, [("1", 1, "late"), ("1", 0, "older")])
    history = seed.withColumn("new", F.lit(False)).unionByName(first.unionByName(second.exceptAll(late)).withColumn("new", F.lit(True)))
    want = sorted(tuple(r) for r in L.log_versions(history, keep="new").select("record_key", "version", "action_type", "old_data", "new_data").collect())
    assert got == want and len(got) == 4
    assert sorted(tuple(r)[:4] for r in S.read_late(spark, out).select("record_key", "version", "image", "reason").collect()) == sorted(
        (r["record_key"], r["version"], r["image"], "late") for r in late.collect())


def test_no_image_is_lost(spark, tmp_path):
    state, out = (str(tmp_path / n) for n in ("state", "log"))
    S.seed_state(images(spark, [("a", 3, "x")]), state)
    S.apply_batch(images(spark, [("a", 2, "old"), ("a", 3, "x"), ("a", 3, "y"), ("b", 1, "q"), ("b", 1, "p"), ("b", 1, "p"), ("c", 1, None), ("c", 1, "z")]), 0, state, out)
    late = sorted((r["record_key"], r["version"], r["image"], r["reason"]) for r in S.read_late(spark, out).collect())
    kept = {(r["record_key"], r["version"]): r["image"] for r in S.last_images(spark, state, 1).collect()}
    plain = {x["image"] for x in images(spark, [("b", 1, "p"), ("c", 1, None)]).collect()}
    assert [(k, v, why) for k, v, _, why in late] == [("a", 2, "late"), ("a", 3, "late"), ("b", 1, "contradiction"), ("c", 1, "contradiction")]
    assert {kept[("b", 1)], kept[("c", 1)]} == plain


def test_retried_batch_leaves_one_copy(spark, tmp_path):
    state, out, folded = (str(tmp_path / n) for n in ("state", "log", "folded"))
    S.seed_state(images(spark, []), state)
    batch = images(spark, [("1", 1, "a"), ("1", 2, "b")])
    for _ in range(2):
        S.apply_batch(batch, 0, state, out)
    assert S.read_log(spark, out).count() == 2
    S.apply_batch(images(spark, [("1", 3, "c")]), 1, state, out)
    S.compact_state(spark, state, folded, through=1)
    assert [tuple(r) for r in S.last_images(spark, folded, 9).collect()] == [("1", 3, "c")]
