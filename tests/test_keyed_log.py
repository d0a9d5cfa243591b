"""Change log with keyed state: equal to the batch log, restarts, holding, forgetting, rows without a place."""

import os
import random
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ventaria.operators import changelog as L
from ventaria.streaming import change_stream as S
from ventaria.streaming import keyed_log as K


def images(spark, rows):
    return spark.createDataFrame(rows, S.IMAGES)


def arrive(spark, source, rows):
    images(spark, rows).coalesce(1).write.mode("append").parquet(source)


def run(spark, paths, **more):
    query = K.start_keyed_log(spark, *paths, files_per_batch=1, **more)
    query.awaitTermination(180)
    return query


def events(spark, log):
    return sorted((r.record_key, r.version, r.action_type, r.old_data, r.new_data) for r in S.read_log(spark, log).collect())


@pytest.fixture
def paths(tmp_path):
    return [str(tmp_path / n) for n in ("in", "log", "check")]


def test_stream_equals_batch_over_restarts(spark, paths):
    """Each run starts anew from the checkpoint; late, repeated and contradictory images are planted."""
    r = random.Random(3)
    seed = [(str(k), 0, f"s{k}") for k in range(0, 30, 2)]
    arrived, known, late = [], {k: (v, i) for k, v, i in seed}, []
    for batch in range(3):
        rows = []
        for k in map(str, range(30)):
            for version in range(1 + batch * 4, r.randrange(2, 5) + batch * 4):
                if r.random() < 0.6:
                    rows.append((k, version, r.choice([None, "a", "b", f"v{version}"])))
        rows += [x for x in rows if r.random() < 0.2]
        fresh = {}
        for k, v, i in rows:
            fresh.setdefault((k, v), set()).add(i)
        for (k, v), found in fresh.items():
            first, *others = sorted(found, key=K.image_order)
            arrived.append((k, v, first))
            late += [(k, v, i, "contradiction") for i in others]
        if batch:
            old = [(k, v - 1, "older") for k, (v, _) in list(known.items())[:5]]
            rows += old
            late += [(k, v, i, "late") for k, v, i in old]
        for k, v, i in arrived:
            known[k] = max(known.get(k, (-1, None)), (v, i), key=lambda x: x[0])
        arrive(spark, paths[0], rows)
        run(spark, paths, first=images(spark, seed))
    history = images(spark, seed).withColumn("new", F.lit(False)).unionByName(images(spark, arrived).withColumn("new", F.lit(True)))
    want = sorted(tuple(x) for x in L.log_versions(history, keep="new").select(*K.EVENT).collect())
    assert events(spark, paths[1]) == want and len(want) > 50
    told = sorted((x.record_key, x.version, str(x.image), x.reason) for x in S.read_late(spark, paths[1]).collect())
    assert told == sorted((k, v, str(i), why) for k, v, i, why in late)


def test_rows_without_a_place_and_known_rows(spark, paths):
    arrive(spark, paths[0], [("a", 1, "x"), (None, 1, "x"), ("a", None, "y"), ("b", 1, None)])
    run(spark, paths)
    arrive(spark, paths[0], [("a", 1, "x"), ("b", 1, None), ("b", 2, "z"), ("a", 1, "other")])
    run(spark, paths)
    assert events(spark, paths[1]) == [("a", 1, "INSERT", None, "x"), ("b", 2, "INSERT", None, "z")]
    assert sorted((str(r.record_key), r.reason) for r in S.read_late(spark, paths[1]).collect()) == [("None", "unreadable"), ("a", "late"), ("a", "unreadable")]


def until(query, done, seconds=90):
    """Let a timed query run until ``done`` holds."""
    end = time.time() + seconds
    while not done() and time.time() < end:
        assert query.exception() is None
        time.sleep(0.3)
    return done()


def told(spark, log):
    """Events written so far; none while the first batch is still being written."""
    try:
        return events(spark, log)
    except AnalysisException:
        return []


def test_held_images_are_put_in_order(spark, paths):
    arrive(spark, paths[0], [("a", 3, "three"), ("a", 5, "five")])
    query = K.start_keyed_log(spark, *paths, files_per_batch=1, hold_ms=12_000)
    try:
        assert until(query, lambda: (query.lastProgress or {"batchId": -1})["batchId"] >= 0)
        arrive(spark, paths[0], [("a", 2, "two"), ("a", 5, "six")])
        assert until(query, lambda: len(told(spark, paths[1])) == 3)
    finally:
        query.stop()
    got = events(spark, paths[1])
    assert [(e[1], e[2]) for e in got] == [(2, "INSERT"), (3, "UPDATE"), (5, "UPDATE")] and got[2][4] == "five"
    assert [(r.version, r.image, r.reason) for r in S.read_late(spark, paths[1]).collect()][:1] == [(5, "six", "contradiction")]


def test_forgotten_records_start_again(spark, paths):
    arrive(spark, paths[0], [("a", 5, "x")])
    query = K.start_keyed_log(spark, *paths, files_per_batch=1, forget_after_ms=2_000)
    try:
        assert until(query, lambda: len(told(spark, paths[1])) == 1)
        time.sleep(3)
        arrive(spark, paths[0], [("a", 6, "y")])
        assert until(query, lambda: len(told(spark, paths[1])) == 2)
    finally:
        query.stop()
    assert [(e[1], e[2]) for e in events(spark, paths[1])] == [(5, "INSERT"), (6, "INSERT")]


def test_a_batch_touches_only_its_records(spark, paths):
    arrive(spark, paths[0], [(str(k), 1, "x") for k in range(500)])
    run(spark, paths)
    arrive(spark, paths[0], [("7", 2, "y")])
    query = run(spark, paths)
    state = query.lastProgress.stateOperators[0]
    assert state.numRowsTotal >= 500 and state.numRowsUpdated <= 2


def test_folder_batches_leave_no_settled_files(spark, tmp_path):
    from ventaria.session import checkpoint_folder

    def settled():
        folder = checkpoint_folder(spark).removeprefix("file:")
        return set(os.listdir(folder)) if os.path.isdir(folder) else set()

    state, log = (str(tmp_path / n) for n in ("state", "log"))
    S.seed_state(images(spark, []), state)
    before = settled()
    S.apply_batch(images(spark, [("1", 1, "a")]), 0, state, log)
    assert settled() == before and S.read_log(spark, log).count() == 1


def test_rows_without_a_key_are_removed_and_added(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k long, v string")
    log = L.change_log(frame([(None, "a"), (1, "b")]), frame([(1, "b"), (None, "a")]), "k", "t", "me", 1).collect()
    assert sorted((r.action_type, r.old_data is None, r.new_data is None) for r in log) == [("DELETE", False, True), ("INSERT", True, False)]
