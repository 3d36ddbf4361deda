"""The distributed code paths (taken past a size threshold) give the same
exact answers as the simple ones; thresholds are forced small here."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.functions import stats as ST
from kestrel.operators import balance as BL
from kestrel.operators import geo
from kestrel.operators import prep as PR


def _np_quantile(vals, p):
    return float(np.quantile(np.array(vals, dtype=float), p))   # linear interpolation


@pytest.mark.parametrize("seed", [1, 2])
def test_exact_quantiles_bracketing_matches_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    vals = np.concatenate([rng.exponential(10, 3000), np.full(700, 5.0), rng.normal(0, 1, 300)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]
    got = ST.exact_quantiles(df, "x", probs, small=50)
    for p, g in zip(probs, got):
        assert g == pytest.approx(_np_quantile(vals, p), rel=1e-12, abs=1e-12)


def test_kth_smallest_heavy_duplicates(spark):
    vals = [1.0] * 2000 + [2.0] * 10 + [3.0] * 2000
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in (0, 1999, 2000, 2009, 2010, 4009):
        assert ST.kth_smallest(df, r, len(vals), small=20) == sorted(vals)[r]


def test_running_sums_sliced_equals_window(spark):
    rng = np.random.default_rng(3)
    keys = rng.choice(100000, 5000, replace=False)
    df = spark.createDataFrame([(float(k), int(k) % 7) for k in keys], "k double, w long")
    a = {r.k: r.w_cum for r in ST.running_sums(df, "k", ["w"], small=10**9).collect()}
    b = {r.k: r.w_cum for r in ST.running_sums(df, "k", ["w"], small=300).collect()}
    assert a == b
    d = {r.k: r.w_cum for r in ST.running_sums(df, "k", ["w"], descending=True, small=300).collect()}
    total = sum(int(k) % 7 for k in keys)
    for k in list(a)[:50]:
        assert d[k] == total - a[k] + int(k) % 7


def test_adjusted_skew_matches_formula(spark):
    vals = [1.0, 2.0, 2.0, 3.0, 10.0, 40.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.agg(ST.adjusted_skew("x")).first()[0]
    x = np.array(vals)
    n = len(x)
    m2, m3 = ((x - x.mean()) ** 2).mean(), ((x - x.mean()) ** 3).mean()
    g1 = m3 / m2 ** 1.5
    assert got == pytest.approx(g1 * math.sqrt(n * (n - 1)) / (n - 2), rel=1e-9)


def test_geo_join_matches_searchsorted(spark):
    rng = np.random.default_rng(7)
    lo = rng.integers(0, 2**32 - 1, 800)
    lo = np.concatenate([lo, lo[:50]])                      # tied lower bounds
    up = lo + rng.integers(0, 2**26, len(lo))               # overlapping / nested ranges
    names = [f"c{i}" for i in range(len(lo))]
    ranges = spark.createDataFrame(
        [(int(a), int(b), n) for a, b, n in zip(lo, up, names)],
        "lower_bound_ip_address bigint, upper_bound_ip_address bigint, country string")
    ips = np.concatenate([rng.integers(0, 2**32 - 1, 4000), lo[:100], up[:100]])
    df = spark.createDataFrame([(i, int(v)) for i, v in enumerate(ips)], "id long, ip long")
    got = {r.id: r.country for r in geo.map_ips_to_countries(df, ranges, ip_col="ip").collect()}
    # Brute force: per lower bound keep the largest (upper, country); then searchsorted.
    best = {}
    for a, b, n in zip(lo, up, names):
        if a not in best or (b, n) > best[a]:
            best[a] = (b, n)
    keys = np.array(sorted(best))
    for i, v in enumerate(ips):
        j = np.searchsorted(keys, v, side="right") - 1
        want = "Unknown"
        if j >= 0 and v <= best[keys[j]][0]:
            want = best[keys[j]][1]
        assert got[i] == want, (i, v)


def test_stratified_split_sizes_and_ties(spark):
    rows = [(i % 50, i % 3 == 0) for i in range(900)]        # duplicate keys: ties
    df = spark.createDataFrame([(k, int(c)) for k, c in rows], "key long, label int")
    out = PR.stratified_split(df, "label", ["key"])
    c = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert c[(1, "test")] == round(0.2 * 300) and c[(0, "test")] == round(0.2 * 600)
    assert out.count() == 900


@pytest.mark.parametrize("block,stream", [(10**6, 10**6), (40, 10**6), (25, 10)])
def test_knn_blocks_equal_brute_force(spark, block, stream):
    rng = np.random.default_rng(11)
    pts = np.concatenate([rng.normal(0, 1, (220, 8)), rng.normal(9, 0.1, (60, 8)), np.zeros((20, 8))])
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(pts)],
                               "vec_id long, embedding array<double>").repartition(3)
    got = {r.qid: r.nb for r in BL.knn(df, df, 5, block_rows=block, stream_rows=stream).collect()}
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    for i in range(300):
        assert got[i] == [int(j) for j in np.lexsort((np.arange(300), d[i]))[:5]]
    one = df.where("vec_id = 3")
    assert BL.knn(one, one, 5).first()["nb"] == [] and BL.knn(one, one.where("false"), 5).first()["nb"] == []


def test_balance_counts_with_identical_rows(spark):
    from kestrel.plans.jobs import _balance

    class Model:
        feature_names = ["a", "b c"]

    rows = [(float(i % 8), float(i % 4), 1, "train") for i in range(24)] + \
           [(float(i % 20), float(i % 6), 0, "train") for i in range(60)] + [(1.0, 1.0, 1, "test")]
    df = spark.createDataFrame(rows, "a double, `b c` double, y int, split string")
    out = _balance(df, Model, "y", "smote")
    n = {(r.y, r.synthetic): r["count"] for r in out.groupBy("y", "synthetic").count().collect()}
    assert n == {(0, 0): 60, (1, 0): 24, (1, 1): 36}


def test_windows_sliced_equals_plain(spark):
    from pyspark.sql import Window
    from kestrel.operators.windows import trailing_range_aggregate
    rng = np.random.default_rng(5)
    rows = [(i, int(rng.integers(0, 3)), int(rng.integers(0, 10_000)), float(rng.integers(1, 9)))
            for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, u long, t long, a double")
    got = trailing_range_aggregate(df, "u", "t", 700, "id",
                                   {"s": lambda w: F.sum("a").over(w)}).select("id", "s")
    w = Window.partitionBy("u").orderBy("t").rangeBetween(-700, 0)
    want = df.select("id", F.sum("a").over(w).alias("s"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_copy_expansion_chunked_equals_plain(spark):
    seeds = spark.createDataFrame([(1, 25), (2, 3), (3, 0), (4, 11)], "vec_id long, __copies int")
    plain = sorted(tuple(r) for r in PR.expand_copies(seeds, ["vec_id"], chunk=1000).collect())
    chunked = sorted(tuple(r) for r in PR.expand_copies(seeds, ["vec_id"], chunk=4).collect())
    assert plain == chunked and len(plain) == 39
    assert all(c >= 0 for _, c in plain)


@pytest.mark.parametrize("direct", [1, 20, 10**6])
def test_order_stats_end_on_zero_inflated_values(spark, direct):
    vals = [0.0] * 19_900 + [float(i) for i in range(1, 101)]
    df = spark.createDataFrame([(v,) for v in vals], "x double").union(spark.sql("SELECT double('NaN') UNION ALL SELECT null"))
    ranks = [0, 19_899, 19_900, 19_950, 19_999]
    got = ST.order_stats(df, [("x", None, r, len(vals)) for r in ranks], direct=direct, small=20, accuracy=50)
    assert got == [vals[r] for r in ranks]


def test_order_stats_with_extreme_values(spark):
    vals = sorted([-1e308, -5e-324, 0.0, 5e-324, 1e-300, 1.0, 1.0 + 2**-52, 1e308, float("inf"), float("-inf")] * 3)
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = ST.order_stats(df, [("x", None, r, len(vals)) for r in range(len(vals))], direct=1, accuracy=10)
    assert got == vals


@pytest.mark.parametrize("small", [10, 10**6])
def test_nan_scores_count_as_missing_at_every_size(spark, small):
    from kestrel.operators import metrics as M
    rows = [(i % 3 == 0, float(i) / 100) for i in range(100)]
    clean = spark.createDataFrame([(int(y), v) for y, v in rows], "class int, score double")
    dirty = clean.union(spark.createDataFrame([(1, float("nan")), (0, None)], "class int, score double"))
    assert M.average_precision(dirty, small=small).first()[0] == pytest.approx(M.average_precision(clean, small=10**9).first()[0])
    assert M.confusion_matrix(dirty).first() == M.confusion_matrix(clean).first()


def test_split_keeps_rows_without_label_and_with_null_keys(spark):
    rows = [(None if i % 7 == 0 else i % 20, i % 3, None if i % 10 == 0 else i % 2) for i in range(700)]
    df = spark.createDataFrame(rows, "key long, b long, label int")
    out = PR.stratified_split(df, "label", ["key", "b"])
    assert sorted(map(str, out.drop("split").collect())) == sorted(map(str, df.collect()))
    n = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    for label in (0, 1):
        size = sum(r[2] == label for r in rows)
        assert n[(label, "test")] == math.floor(0.2 * size + 0.5)
    assert (None, "test") not in n and n[(None, "train")] == sum(r[2] is None for r in rows)


def test_split_key_parts_do_not_run_together(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "a")], "x string, y string")
    assert len({r[0] for r in df.select(PR.split_hash(["x", "y"])).collect()}) == 3


def test_null_entities_are_nobody(spark):
    from kestrel.operators import patterns as P
    rows = [(i, None, 1_000_000 * i, 2.0 if i == 0 else 90.0, f"d{i}") for i in range(7)] + \
           [(100 + i, 5, 1_000_000 * i, 1.0, "d") for i in range(7)]
    df = spark.createDataFrame(rows, "event_id long, user_id long, us long, purchase_value double, device_id string")
    df = df.withColumn("purchase_time", F.timestamp_micros("us"))
    for out, col, own, seen in ((P.velocity(df), "txn_velocity", 1, 7), (P.device_changes(df), "device_changes_24h", 0, 0),
                                (P.micro_test(df), "micro_test", 0, 0)):
        got = {r["event_id"]: r[col] for r in out.collect()}
        assert all(got[i] == own for i in range(7)) and got[106] == seen


def test_window_columns_keep_their_types_without_times(spark):
    from kestrel.operators import features as FE
    df = spark.createDataFrame([(1, "d", 3.0, None), (2, "e", 4.0, None)], "user_id long, device_id string, purchase_value double, purchase_time timestamp")
    some = df.withColumn("purchase_time", F.lit("2024-01-01").cast("timestamp"))
    assert FE.add_time_window_features(df).dtypes == FE.add_time_window_features(some).dtypes
