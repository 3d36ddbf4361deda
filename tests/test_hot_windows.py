"""Trailing windows of accounts too large for one task, against plain windows."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kestrel.operators import patterns as P
from kestrel.operators import windows as WN

MEASURES = {"n": ("count", None), "s": ("sum", "a"), "m": ("avg", "a"), "lo": ("min", "a"), "k": ("sum", "c")}


def rows(rng, n, hot_share=0.5):
    out = []
    for i in range(n):
        u = 0 if rng.random() < hot_share else int(rng.integers(1, 30))
        # Crowded stretches, long gaps, equal times.
        t = int(rng.choice([rng.integers(0, 300), rng.integers(5_000, 5_050), rng.integers(0, 20_000), 7_777]))
        out.append((i, u, t, None if i % 17 == 0 else float(rng.integers(1, 50)), i % 3, f"d{i % 4}"))
    out += [(n, None, 5, 2.0, 1, "d"), (n + 1, None, 6, 2.0, 1, "d"), (n + 2, 0, None, 2.0, 1, "d"), (n + 3, 0, 40_000, 3.0, 1, "d")]
    return out


def plain(df, width, strict):
    alone = F.when(F.col("u").isNull(), F.col("id"))
    w = Window.partitionBy("u", alone).orderBy("t").rangeBetween(-width, -1 if strict else 0)
    return df.select("id", F.count(F.lit(1)).over(w).alias("n"), F.coalesce(F.sum("a").over(w), F.lit(0.0)).alias("s"),
                     F.coalesce(F.avg("a").over(w), F.lit(0.0)).alias("m"), F.min("a").over(w).alias("lo"),
                     F.coalesce(F.sum("c").over(w), F.lit(0)).alias("k"))


@pytest.mark.parametrize("width,strict,chunk", [(700, False, 25), (700, True, 25), (60, False, 7), (19_000, True, 40)])
def test_chunked_equals_plain(spark, width, strict, chunk):
    df = spark.createDataFrame(rows(np.random.default_rng(width), 1500), "id long, u long, t long, a double, c int, d string")
    assert WN.hot_accounts(df, "u", "t", width, chunk).count() >= 1
    got = WN.trailing_measures(df, "u", "t", width, "id", MEASURES, strict, chunk).select("id", *MEASURES)
    key = lambda r: r["id"]
    assert sorted(got.collect(), key=key) == sorted(plain(df, width, strict).collect(), key=key)
    assert got.dtypes == WN.trailing_measures(df, "u", "t", width, "id", MEASURES, strict).select("id", *MEASURES).dtypes


def test_previous_row_over_chunk_edges(spark):
    df = spark.createDataFrame(rows(np.random.default_rng(1), 900), "id long, u long, t long, a double, c int, d string").where("u is not null and t is not null")
    w = Window.partitionBy("u").orderBy("t", "id")
    want = df.select("id", F.lag("d").over(w).alias("pd"), F.lag("t").over(w).alias("pt"))
    got = WN.previous_row(df, "u", "t", "id", {"pd": "d", "pt": "t"}, 20).select("id", "pd", "pt")
    assert sorted(got.collect()) == sorted(want.collect())


def test_device_changes_of_a_hot_account(spark):
    df = spark.createDataFrame(rows(np.random.default_rng(9), 1200), "event_id long, user_id long, t long, a double, c int, device_id string")
    df = df.withColumn("purchase_time", F.timestamp_micros(F.col("t") * 1_000_000))
    key = lambda r: r["event_id"]
    pick = lambda out: sorted(out.select("event_id", "device_changes_24h").collect(), key=key)
    for window in (900_000_000, 30_000_000):
        assert pick(P.device_changes(df, window_us=window, chunk_rows=30)) == pick(P.device_changes(df, window_us=window))


def test_a_hot_account_spreads_over_tasks(spark):
    """A third of all rows in one account and slice: no group holds more than two chunks."""
    n, chunk = 6000, 100
    df = spark.range(n).select(F.col("id"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("u"),
                               (F.col("id") * 7 % 5000).alias("t"), F.lit(1.0).alias("a"))
    placed = WN.range_chunks(df.where("u = 0").groupBy("u", "t").count(), ["u", "t"], chunk)
    sizes = [r["count"] for r in placed.groupBy("__chunk").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 3 * chunk
    got = WN.trailing_measures(df, "u", "t", 10_000, "id", {"n": ("count", None)}, chunk_rows=chunk)
    assert got.where("u = 0").agg(F.max("n")).first()[0] == n // 3


@pytest.mark.parametrize("low,high", [(0, 0), (1, 1), (0, 7), (1, 14), (5, 6), (3, 100), (64, 127), (63, 129)])
def test_dyadic_blocks_cover_a_range_once(spark, low, high):
    got = spark.range(1).select(F.explode(WN.dyadic_blocks(F.lit(low).cast("long"), F.lit(high).cast("long"), 9)).alias("x")).select("x.*").collect()
    covered = sorted(i for r in got for i in range(r["j"] << r["k"], (r["j"] + 1) << r["k"]))
    assert covered == list(range(low, high + 1))
