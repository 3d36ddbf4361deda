"""Incremental entity activity: equal to the batch table, work that follows the
batch, replays, versions, idle entities (J4); velocity read by hour (J1)."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators import features as FE
from kestrel.streaming import scoring as SS
from kestrel.streaming.entity_store import EntityStore

DAY = 86_400_000_000
SCHEMA = "user_id long, us long, purchase_value double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("purchase_time", F.timestamp_micros("us"))


def as_set(df, want):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in df.select(*sorted(want.columns)).collect())


def batch_table(spark, rows, windows):
    df = frame(spark, rows)
    return SS.entity_table(df, "user_id", FE.max_epoch_micros(df, "purchase_time"), windows, with_user_stats=True)


def batches(rng, n, rows=40):
    """Rows over 100 days, some late, some without entity, time or amount."""
    out = []
    for k in range(n):
        now = (20_000 + k * 100 // n) * DAY + int(rng.integers(0, DAY))
        day = [(int(rng.integers(0, 12)), now - int(rng.integers(0, 3 * DAY)), float(rng.integers(1, 99))) for _ in range(rows)]
        day += [(k, now - 45 * DAY, 1.0), (None, now, 5.0), (50 + k, None, 7.0), (3, now - DAY, None)]
        out.append(day)
    return out


def test_every_version_equals_the_batch_table(spark, tmp_dir):
    store = EntityStore(spark, f"{tmp_dir}/data", f"{tmp_dir}/versions", "user_id", (1, 7, 30), fan_in=3)
    seen = []
    for k, rows in enumerate(batches(np.random.default_rng(2), 13)):
        store.add(frame(spark, rows), k)
        seen += rows
        if k in (0, 4, 12):
            want = batch_table(spark, seen, (1, 7, 30))
            assert as_set(store.table(with_user_stats=True), want) == as_set(want, want)
    some = frame(spark, [(3, 0, 0.0), (51, 0, 0.0), (777, 0, 0.0)])
    assert sorted(r["user_id"] for r in store.table(only=some).collect()) == [3, 51]
    # Old versions, and the files that only they name, are gone; old days of rows too.
    assert len(store._versions()) == 10
    days = [int(d.split("=")[1]) for d in os.listdir(f"{tmp_dir}/data/rows") if d.startswith("day=")]
    assert min(days) > 20_000 - 31


def test_work_of_a_batch_follows_the_batch(spark, tmp_dir, monkeypatch):
    """Partial rows read back while many batches come in, against a rebuild from the history."""
    read = []
    plain = EntityStore._read

    def counted(self, paths, schema):
        df = plain(self, paths, schema)
        read.append(df.count())
        return df

    monkeypatch.setattr(EntityStore, "_read", counted)
    store = EntityStore(spark, f"{tmp_dir}/data", f"{tmp_dir}/versions", "user_id", (1,), fan_in=4)
    rows = 30
    for k in range(16):
        store.add(frame(spark, [(1000 * k + i, 20_000 * DAY + k, 1.0) for i in range(rows)]), k)
    assert sum(read) <= 2 * 16 * rows          # each row is merged at most once a level
    assert sum(read) < sum(range(16)) * rows / 2


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_dir):
    store = EntityStore(spark, f"{tmp_dir}/data", f"{tmp_dir}/versions", "user_id", (1, 7), fan_in=2)
    all_rows = batches(np.random.default_rng(4), 7, rows=10)
    for k, rows in enumerate(all_rows):
        for _ in range(2):
            store.add(frame(spark, rows), k)
    want = batch_table(spark, sum(all_rows, []), (1, 7))
    assert as_set(store.table(with_user_stats=True), want) == as_set(want, want)


def test_an_unfinished_version_is_not_read(spark, tmp_dir):
    store = EntityStore(spark, f"{tmp_dir}/data", f"{tmp_dir}/versions", "user_id", (1,))
    assert store.table() is None and EntityStore.opened(spark, f"{tmp_dir}/data", f"{tmp_dir}/versions") is None
    store.add(frame(spark, [(1, 20_000 * DAY, 2.0)]), 0)
    store.add(frame(spark, [(1, 20_000 * DAY + 1, 3.0), (2, 20_000 * DAY, 1.0)]), 1)
    os.remove(f"{tmp_dir}/versions/version=1/_SUCCESS")
    found, version = EntityStore.opened(spark, f"{tmp_dir}/data", f"{tmp_dir}/versions")
    assert version == 0 and [tuple(r) for r in found.table(version).collect()] == [(1, 1, 2.0, 2.0)]


def test_empty_batches_and_idle_entities(spark, tmp_dir):
    store = EntityStore(spark, f"{tmp_dir}/data", f"{tmp_dir}/versions", "user_id", (1, 7))
    store.add(frame(spark, []), 0)
    assert store.table() is None
    store.add(frame(spark, [(1, 20_000 * DAY, 2.0)]), 1)
    store.add(frame(spark, []), 2)
    store.add(frame(spark, [(2, 20_005 * DAY, 3.0)]), 3)
    assert sorted(tuple(r) for r in store.table().collect()) == [(1, 0, None, None, 1, 2.0, 2.0), (2, 1, 3.0, 3.0, 1, 3.0, 3.0)]
    store.add(frame(spark, [(None, 20_009 * DAY, 3.0)]), 4)   # moves the anchor of the others
    assert sorted(r["user_id_count_last_7d"] for r in store.table().collect()) == [0, 1]


@pytest.mark.parametrize("by_hour", [False, True])
def test_velocity_windows_are_read_by_hour(spark, tmp_dir, by_hour):
    src, t0 = f"{tmp_dir}/in", dt.datetime(2024, 1, 1)
    os.makedirs(src)
    times = [t0 + dt.timedelta(hours=h, minutes=m) for h in range(0, 60, 5) for m in (0, 1, 2)]
    with open(f"{src}/a.json", "w") as fh:
        fh.write("\n".join(f'{{"event_id": {i}, "user_id": {i % 2}, "purchase_time": "{t}"}}' for i, t in enumerate(times)) + "\n")
    rows = spark.createDataFrame([(i, i % 2, t) for i, t in enumerate(times)] + [(99, 0, t0 - dt.timedelta(days=9)), (98, 0, None)],
                                 "event_id long, user_id long, purchase_time timestamp")
    empty = SS.with_velocity(rows, SS.windows_near(rows, f"{tmp_dir}/out"))   # no sink yet
    assert empty.count() == len(times) + 2 and empty.where("txn_velocity is not null").count() == 0
    SS.start_velocity_stream(spark, src, f"{tmp_dir}/out", limit=1, checkpoint=f"{tmp_dir}/ck", by_hour=by_hour).awaitTermination()
    some = rows.where("event_id between 6 and 8")
    near = SS.windows_near(some, f"{tmp_dir}/out")
    if by_hour:
        assert 0 < near.count() < spark.read.parquet(f"{tmp_dir}/out").count() / 4
    every = spark.read.parquet(f"{tmp_dir}/out").drop("start_hour")
    got = {r["event_id"]: r["txn_velocity"] for r in SS.with_velocity(rows, SS.windows_near(rows, f"{tmp_dir}/out")).collect()}
    assert got == {r["event_id"]: r["txn_velocity"] for r in SS.with_velocity(rows, every).collect()}
    assert got[99] is None and max(v for v in got.values() if v) == 2
