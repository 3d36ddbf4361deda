"""Unit tests modelled on the reference's own tests: ingestion, IP mapping,
cleaning, features, encoding and class balance, on small in-test frames."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel.operators import balance as BL
from kestrel.operators import cleaning as CL
from kestrel.operators import features as FE
from kestrel.operators import geo
from kestrel.operators import prep as PR
from kestrel.sources import files as FS

RANGES_CSV = """lower_bound_ip_address,upper_bound_ip_address,country
16777216.0,16777471.0,Australia
16777472.0,16777727.0,China
2130706432.0,2130706687.0,United States
3409154048.0,3409154303.0,Canada
"""

FRAUD_CSV = """user_id,signup_time,purchase_time,purchase_value,device_id,source,browser,sex,age,ip_address,class
1,2023-01-01 10:00:00,2023-01-01 10:30:00,100,A1,SEO,Chrome,M,25.0,192.168.1.1,0
2,2023-01-01 11:00:00,2023-01-01 11:30:00,200,B2,Ads,Firefox,F,30.0,10.0.0.1,0
3,2023-01-02 12:00:00,2023-01-02 12:30:00,50,C3,Direct,Safari,M,22.0,172.16.0.1,1
4,2023-01-03 13:00:00,2023-01-03 13:30:00,150,D4,SEO,Chrome,F,35.0,192.168.1.1,0
5,2023-01-04 14:00:00,2023-01-04 14:30:00,300,E5,Ads,Edge,M,28.0,10.0.0.1,0
6,,2023-01-05 15:00:00,120,F6,Direct,Firefox,F,,203.0.113.45,1
"""


def _write(tmp_dir, name, text):
    p = f"{tmp_dir}/{name}"
    with open(p, "w") as fh:
        fh.write(text)
    return p


def test_load_ip_ranges_types(spark, tmp_dir):
    df = FS.load_ip_to_country_data(spark, _write(tmp_dir, "ip.csv", RANGES_CSV))
    assert df.count() == 4
    assert dict(df.dtypes)["lower_bound_ip_address"] == "double"
    clean = geo.clean_ranges(df)
    assert dict(clean.dtypes)["lower_bound_ip_address"] == "bigint"


def test_missing_source_raises(spark, tmp_dir):
    with pytest.raises(FS.SourceMissing):
        FS.load_fraud_data(spark, f"{tmp_dir}/nope.csv")


def test_map_ips_to_countries(spark, tmp_dir):
    ranges = geo.clean_ranges(FS.load_ip_to_country_data(spark, _write(tmp_dir, "ip.csv", RANGES_CSV)))
    df = spark.createDataFrame([(1, "1.0.0.1"), (2, "255.255.255.255"), (3, "99.99.99.99"),
                                (4, "127.0.0.5"), (5, None), (6, "16777300")],
                               "user_id int, ip_address string")
    out = {r.user_id: r.country for r in geo.map_ips_to_countries(df, ranges).collect()}
    assert out == {1: "Australia", 2: "Unknown", 3: "Unknown", 4: "United States",
                   5: "Unknown", 6: "Australia"}


def test_map_without_ranges_or_column(spark):
    df = spark.createDataFrame([(1, "1.0.0.1")], "user_id int, ip_address string")
    assert geo.map_ips_to_countries(df, None).first().country == "Unknown"
    no_ip = spark.createDataFrame([(1,)], "user_id int")
    assert geo.map_ips_to_countries(no_ip, None).first().country == "Unknown"


def test_ip_to_int_values(spark):
    from kestrel.functions.casts import ip_to_int
    df = spark.createDataFrame([("1.0.0.1",), ("255.255.255.255",), ("12.7",), ("3232235777",),
                                ("300.1.1.1",), ("x.y.z.w",), (None,)], "ip string")
    got = [r[0] for r in df.select(ip_to_int("ip", df.schema["ip"].dataType)).collect()]
    assert got == [16777217, 4294967295, None, 3232235777, None, None, None]


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "a"), (None, None), (None, None)],
                               "col1 int, col2 string")
    assert CL.remove_duplicates(df).count() == 3


def test_handle_missing_values_fills_everything(spark):
    df = spark.createDataFrame([
        (1.0, "2023-01-01 10:00:00", "2023-01-01 11:00:00", "x"),
        (None, "2023-01-02 10:00:00", "2023-01-02 11:00:00", None),
        (3.0, None, "2023-01-03 11:00:00", "y"),
        (4.0, "2023-01-04 10:00:00", None, "z"),
    ], "numerical_col double, signup_time string, purchase_time string, categorical_col string")
    out = CL.handle_missing_values(df, protect=())
    # 25 % null datetimes are above 5 %: those rows are dropped; the rest are filled.
    rows = out.collect()
    assert len(rows) == 2
    for r in rows:
        assert all(v is not None for v in r)


def test_handle_missing_values_median_and_unknown(spark):
    rows = [(float(i), f"2023-01-{(i % 28) + 1:02d} 10:00:00", "2023-02-01 00:00:00",
             None if i == 0 else "c") for i in range(40)]
    rows.append((None, None, "2023-02-01 00:00:00", "c"))     # 1 of 41 null: below 5 %
    df = spark.createDataFrame(rows, "numerical_col double, signup_time string, "
                                     "purchase_time string, categorical_col string")
    rep = CL.CleaningReport()
    out = CL.handle_missing_values(df, protect=(), report=rep)
    assert out.count() == 41
    assert out.where(F.col("signup_time").isNull()).count() == 0
    assert out.where(F.col("categorical_col") == "Unknown").count() == 1
    assert out.where(F.col("numerical_col").isNull()).count() == 0
    steps = {(r[0], r[1]) for r in rep.rows}
    assert ("datetime_fill", "signup_time") in steps and ("numeric_fill", "numerical_col") in steps


def test_all_null_numeric_column_stays_null(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, None)], "k int, x double")
    out = CL.impute_numeric(df, protect=("k",))
    assert out.where(F.col("x").isNotNull()).count() == 0


def test_correct_data_types_ecommerce(spark, tmp_dir):
    raw = FS.load_fraud_data(spark, _write(tmp_dir, "fraud.csv", FRAUD_CSV))
    typed = CL.correct_data_types(raw, "ecommerce")
    t = dict(typed.dtypes)
    assert t["signup_time"] == "timestamp" and t["purchase_value"] == "double"
    assert t["ip_address"] == "bigint"
    assert typed.where(F.col("ip_address").isNull()).count() == 0   # dotted IPs survive


def _features_frame(spark):
    base = dt.datetime(2023, 1, 1, 10, 0, 0)
    rows = [(1, base, base + dt.timedelta(hours=0.5 * (i + 1)), 100.0 + i, "SEO", "Chrome", "M", "Canada")
            for i in range(3)]
    return spark.createDataFrame(rows, "user_id int, signup_time timestamp, purchase_time timestamp, "
                                       "purchase_value double, source string, browser string, sex string, "
                                       "country string")


def test_time_based_features(spark):
    out = FE.add_time_since_signup(FE.add_time_parts(_features_frame(spark)))
    for c in ("purchase_hour", "purchase_dayofweek", "purchase_month", "time_since_signup_hours"):
        assert c in out.columns
    assert all(r.time_since_signup_hours > 0 for r in out.collect())
    assert {r.purchase_dayofweek for r in out.collect()} == {6}     # 2023-01-01 is a Sunday


def test_user_transaction_frequency(spark):
    df = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 5.0), (None, 1.0)],
                               "user_id int, purchase_value double")
    got = sorted((r.user_id or 0, r.user_transaction_count)
                 for r in FE.add_user_transaction_count(df).collect())
    assert got == [(0, 1), (1, 2), (1, 2), (2, 1)]


def test_encode_categorical_features(spark):
    out = PR.encode_categorical_features(_features_frame(spark), ["source", "browser", "sex", "country"])
    for c in ("source_SEO", "browser_Chrome", "sex_M", "country_Canada"):
        assert c in out.columns
    for c in ("source", "browser", "sex", "country"):
        assert c not in out.columns


def test_one_hot_unseen_is_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    model = PR.fit_one_hot(train, ["c"])
    test = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    rows = model.transform(test, drop=True).collect()
    assert [(r.c_a, r.c_b) for r in rows] == [(1.0, 0.0), (0.0, 0.0), (0.0, 0.0)]


def _imbalanced(spark, n_min=8, n_maj=30):
    rows = [(i, [float(i), float(i * 10)], 0) for i in range(n_maj)]
    rows += [(100 + i, [float(i) + 0.5, float(i * 10) + 3.0], 1) for i in range(n_min)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, y int")


def test_smote_balances_classes(spark):
    out = BL.smote(_imbalanced(spark))
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[0] == counts[1] == 30


def test_smote_needs_k_plus_one(spark):
    with pytest.raises(ValueError):
        BL.smote(_imbalanced(spark, n_min=3))


def test_adasyn_grows_minority(spark):
    out = BL.adasyn(_imbalanced(spark))
    counts = {r.y: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts[1] > 8
