"""Round trips through the sources and sinks (A1-A3, A5, A6, A8, B10, C5): the
test tables are written to the shared scratch folder in the source's format,
read back by the library's reader and compared with the plain table."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import schemas as SC
from kestrel.operators import cleaning as CL
from kestrel.operators import prep as PR
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.catalog_clean import TYPED_ECOM
from kestrel.plans.catalog_prep import BANK_KEYS, split_sql
from kestrel.plans.finish import final_sql, finish
from kestrel.session import scratch_path
from kestrel.sources import files as FS
from kestrel.sources import testviews as TV

_TS = ("signup_time", "purchase_time")


def _columns(schema) -> list[str]:
    return [f.name for f in schema.fields]


_ECOM = [c for c in _columns(SC.ECOM_RAW)]


@query("source_ecommerce_csv", final_sql(V.with_(*V.tx_ctes(), ("tx_raw", V.TX_RAW), ("typed", TYPED_ECOM)) + f"""
SELECT {', '.join(c for c in _ECOM if c != 'ip_address')} FROM typed""", doubles=["purchase_value", "age"], ints=["class"], ts=_TS))
def q_source_ecommerce_csv(spark, sf):
    path = scratch_path(spark, "ecommerce-csv")
    TV.tx_raw(spark, sf).select(*_ECOM).write.option("header", True).csv(path)
    typed = CL.correct_data_types(FS.require_rows(FS.load_fraud_data(spark, path)), "ecommerce")
    return finish(FS.require_columns(typed, _ECOM).drop("ip_address"))


@query("source_ranges_csv", final_sql(f"WITH r AS ({V.ranges()}) SELECT * FROM r",
                                      doubles=["lower_bound_ip_address", "upper_bound_ip_address"]))
def q_source_ranges_csv(spark, sf):
    path = scratch_path(spark, "ranges-csv")
    TV.ip_ranges(spark, sf).write.option("header", True).csv(path)
    return finish(FS.load_ip_to_country_data(spark, path))


@query("source_card_csv", final_sql(V.with_(("bank_tx", V.BANK)) + """
SELECT "Time", "V1", "V2", "V3", "V4", "Amount", "Class" FROM bank_tx""",
                                    doubles=["Time", "V1", "V2", "V3", "V4", "Amount"], ints=["Class"]))
def q_source_card_csv(spark, sf):
    path = scratch_path(spark, "card-csv")
    card = TV.bank_tx(spark, sf)
    rest = [F.lit(0.0).alias(c) if c not in card.columns else F.col(c) for c in _columns(SC.BANK_RAW)]
    card.select(*rest).write.option("header", True).csv(path)
    typed = CL.correct_data_types(FS.load_creditcard_data(spark, path), "bank")
    return finish(typed.select("Time", "V1", "V2", "V3", "V4", "Amount", "Class"))


@query("sets_round_trip", final_sql(V.with_(("bank_tx", V.BANK), split_sql("bank_tx", '"Class"', BANK_KEYS)) + f"""
SELECT {', '.join(BANK_KEYS)}, "Class", "Amount" FROM sp WHERE split = 'test'""", doubles=["Amount"], ints=["Class", "l_linenumber"]))
def q_sets_round_trip(spark, sf):
    sets = PR.stratified_split(TV.bank_tx(spark, sf).select(*BANK_KEYS, "Class", "Amount"), "Class", BANK_KEYS)
    path = FS.write_sets(sets, scratch_path(spark, "sets"))
    return finish(FS.read_set(spark, path, "test", label_col="Class"))


@query("records_json", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, user_id, purchase_value, device_id, age, purchase_time FROM tx""", doubles=["purchase_value", "age"], ts=["purchase_time"]))
def q_records_json(spark, sf):
    path = scratch_path(spark, "records")
    names = ["event_id", "user_id", "purchase_value", "device_id", "age", "purchase_time"]
    rows = TV.tx(spark, sf).select(*names)
    rows.select(F.to_json(F.struct(*names), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}).alias("value")).write.text(path)
    good, _ = FS.parse_records(spark.read.text(path), rows.schema)
    return finish(good)


@query("impute_strategy_median", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, COALESCE(age, (SELECT median(age) FROM tx)) AS age, purchase_value FROM tx""", doubles=["age", "purchase_value"]))
def q_impute_strategy_median(spark, sf):
    out = CL.impute_with_strategy(TV.tx(spark, sf), "median", ["age", "purchase_value"])
    return finish(out.select("event_id", "age", "purchase_value"))
