"""Streaming jobs give the batch result on the same rows."""

import os

from pyspark.sql import functions as F

from kestrel.operators import cleaning as CL
from kestrel.operators import geo
from kestrel.operators import features as FE
from kestrel.sources import testviews as TV
from kestrel.streaming import scoring as SS

SF = "/root/testdata/sf0.001"
PROTECT = ("event_id", "user_id", "device_id", "ip_int", "class")
COEF = {"purchase_value": 0.01, "age": -0.02, "time_since_signup_hours": -0.001}


def _json_files(df, path, n=3):
    """Rows as JSON text in ``n`` files, written in time order."""
    SS.write_in_time_order(df, path, n)


def test_ecommerce_stream_equals_batch(spark, tmp_dir):
    tx = TV.tx(spark, SF)
    ranges = geo.clean_ranges(TV.ip_ranges(spark, SF))
    codes = TV.country_codes(spark, SF)
    src = f"{tmp_dir}/in"
    _json_files(tx, src)
    with open(f"{src}/zz-bad.json", "w") as fh:
        fh.write("not json\n\n{}\n")
    st = SS.fit_ecommerce_state(tx, ranges)
    scorer = SS.linear_scorer(COEF, -1.0, {c: 0.0 for c in COEF})
    q = SS.start_ecommerce_scoring(spark, src, f"{tmp_dir}/out", f"{tmp_dir}/rej", st, ranges,
                                   scorer, codes, checkpoint=f"{tmp_dir}/ck")
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out").drop("batch_id")
    assert tx.where("age is null").count() and tx.where("browser is null").count()
    batch = FE.engineer_ecommerce_features(CL.handle_missing_values(tx, PROTECT), ranges, ip_col="ip_int")
    want = SS.score_decide(batch, scorer, codes).select(*got.columns)
    assert got.count() == tx.count()
    g = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in got.collect())
    w = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in want.collect())
    assert g == w
    rej = spark.read.parquet(f"{tmp_dir}/rej").drop("batch_id")
    assert rej.count() == 3          # bad JSON, empty line, empty object


def test_velocity_stream_closed_windows(spark, tmp_dir):
    tx = TV.tx(spark, SF)
    src = f"{tmp_dir}/vin"
    _json_files(tx, src)
    q = SS.start_velocity_stream(spark, src, f"{tmp_dir}/vout", limit=1, checkpoint=f"{tmp_dir}/vck")
    q.awaitTermination()
    got = {tuple(r) for r in spark.read.parquet(f"{tmp_dir}/vout").collect()}
    batch = SS.velocity_windows(tx, watermark=None, limit=1)
    max_t = tx.agg(F.max("purchase_time")).first()[0]
    import datetime as dt
    closed = batch.where(F.col("window_end") <= F.lit(max_t - dt.timedelta(minutes=10)))
    want = {tuple(r) for r in closed.collect()}
    assert want and got == want


def test_late_row_dropped(spark, tmp_dir):
    src = f"{tmp_dir}/late"
    os.makedirs(src)
    rows = [f'{{"event_id": {i}, "user_id": 1, "purchase_time": "2024-01-01 0{h}:00:00"}}'
            for i, h in enumerate([0, 0, 3])]
    with open(f"{src}/a.json", "w") as fh:
        fh.write("\n".join(rows) + "\n")
    q = SS.start_velocity_stream(spark, src, f"{tmp_dir}/lout", limit=1, checkpoint=f"{tmp_dir}/lck")
    q.awaitTermination()
    before = spark.read.parquet(f"{tmp_dir}/lout").count()
    with open(f"{src}/b.json", "w") as fh:   # far behind the watermark: ignored
        fh.write('{"event_id": 9, "user_id": 1, "purchase_time": "2024-01-01 00:00:30"}\n')
    q = SS.start_velocity_stream(spark, src, f"{tmp_dir}/lout", limit=1, checkpoint=f"{tmp_dir}/lck")
    q.awaitTermination()
    after = spark.read.parquet(f"{tmp_dir}/lout")
    assert after.count() == before
    assert after.agg(F.max("n")).first()[0] == 2


def test_entity_refresh_matches_batch(spark, tmp_dir):
    tx = TV.tx(spark, SF)
    src = f"{tmp_dir}/ein"
    _json_files(tx, src)
    q = SS.start_entity_refresh(spark, src, f"{tmp_dir}/hist", f"{tmp_dir}/tbl",
                                checkpoint=f"{tmp_dir}/eck")
    q.awaitTermination()
    got = SS.latest_table(spark, f"{tmp_dir}/tbl")
    want = SS.entity_table(tx, "user_id", FE.max_epoch_micros(tx, "purchase_time"))
    r = lambda df: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in x)
                          for x in df.select(*sorted(want.columns)).collect())
    assert r(got) == r(want)


def test_replayed_batch_and_velocity(spark, tmp_dir):
    """A batch that runs again replaces its rows; the documented payload (dotted
    address, missing age) is scored with stored fills, explained and decided."""
    import json
    tx = TV.tx(spark, SF)
    ranges = spark.createDataFrame([(16777216, 16777471, "A")], "lower_bound_ip_address long, upper_bound_ip_address long, country string")
    st = SS.fit_ecommerce_state(tx, ranges)
    assert set(st.numeric_fill) == {"purchase_value", "age"} and set(st.datetime_fill) == {"signup_time", "purchase_time"}
    src = f"{tmp_dir}/pay"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as fh:
        fh.write(json.dumps({"event_id": 1, "user_id": 7, "purchase_time": "2024-01-01 00:30:00", "purchase_value": 40, "ip_address": "1.0.0.1"}) + "\n")
    spark.sql("SELECT timestamp'2024-01-01 00:00:00' window_start, timestamp'2024-01-01 01:00:00' window_end, 7L user_id, 9L n") \
        .write.parquet(f"{tmp_dir}/vel")
    means = {"age": 30.0, "purchase_value": 10.0}
    coef = {"age": 0.01, "purchase_value": 0.02}
    for _ in range(2):   # a new checkpoint: batch 0 again
        q = SS.start_ecommerce_scoring(spark, src, f"{tmp_dir}/po", f"{tmp_dir}/pr", st, ranges, SS.linear_scorer(coef, -1.0, means),
                                       checkpoint=f"{tmp_dir}/pck{_}", explain=SS.linear_explainer(coef, -1.0, means),
                                       velocity_dir=f"{tmp_dir}/vel", extra=["txn_velocity", "age"])
        q.awaitTermination()
    rows = spark.read.parquet(f"{tmp_dir}/po").collect()
    assert len(rows) == 1
    r = rows[0]
    assert r["country"] == "A" and r["txn_velocity"] == 9 and r["age"] == st.numeric_fill["age"]
    assert r["fraud_probability"] is not None and r["is_fraud"] in (0, 1) and r["threshold"] == 0.6
    assert r["top_features"][0]["feature"] == "purchase_value" and abs(r["top_features"][0]["contribution"] - 0.6) < 1e-9
    assert abs(r["base_value"] - (-1.0 + 0.3 + 0.2)) < 1e-9
