"""Queries for split, scaling and encoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import prep as PR
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.catalog_clean import BANK_COLS, BANK_KEYS
from kestrel.plans.catalog_features import ecommerce_features, features_sql
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

# The category values the fixture views define.
SOURCES = ("Ads", "Direct", "SEO")
BROWSERS = ("Chrome", "Edge", "Firefox", "Safari")
SEXES = ("F", "M")
COUNTRIES = tuple(sorted([f"NATION_{i}" for i in range(25)] + ["Unknown"]))


def split_sql(src: str, label: str, keys, name: str = "sp") -> tuple[str, str]:
    k = " || ':' || ".join(f"CAST({c} AS VARCHAR)" for c in keys)
    return (name, f"""SELECT *, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY md5('42:' || {k}))
    <= round(0.2 * count(*) OVER (PARTITION BY {label})) THEN 'test' ELSE 'train' END AS split FROM {src}""")


# F1 -----------------------------------------------------------------------------
@query("stratified_split", final_sql(V.with_(*V.tx_ctes(), split_sql("tx", "class", ["event_id"]))
                                     + "SELECT event_id, class, split FROM sp", ints=["class"]))
def q_stratified_split(spark, sf):
    out = PR.stratified_split(TV.tx(spark, sf).select("event_id", "class"), "class", ["event_id"])
    return finish(out)


@query("stratified_split_bank", final_sql(
    V.with_(("bank_tx", V.BANK), split_sql("bank_tx", '"Class"', BANK_KEYS))
    + f"SELECT {', '.join(BANK_KEYS)}, \"Class\", split FROM sp", ints=["Class", "l_linenumber"]))
def q_stratified_split_bank(spark, sf):
    b = TV.bank_tx(spark, sf).select(*BANK_KEYS, "Class")
    return finish(PR.stratified_split(b, "Class", BANK_KEYS))


# F2 -----------------------------------------------------------------------------
def scaled_sql(cols, src="sp", prefix=""):
    stats = ", ".join(f'avg("{c}") AS "m_{c}", stddev_pop("{c}") AS "s_{c}"' for c in cols)
    exprs = ", ".join(f'("{c}" - "m_{c}") / CASE WHEN "s_{c}" = 0 OR "s_{c}" IS NULL OR isnan("s_{c}") '
                      f'THEN 1 ELSE "s_{c}" END AS "{prefix}{c}"' for c in cols)
    return stats, exprs


def _standardize_sql():
    stats, exprs = scaled_sql(BANK_COLS)
    return final_sql(V.with_(("bank_tx", V.BANK), split_sql("bank_tx", '"Class"', BANK_KEYS),
                             ("st", f"SELECT {stats} FROM sp WHERE split = 'train'"))
                     + f"SELECT {', '.join(BANK_KEYS)}, split, {exprs} FROM sp, st",
                     doubles=BANK_COLS, ints=["l_linenumber"])


def bank_split(spark, sf):
    return PR.stratified_split(TV.bank_tx(spark, sf), "Class", BANK_KEYS)


@query("standardize", _standardize_sql())
def q_standardize(spark, sf):
    sp = bank_split(spark, sf)
    model = PR.fit_standard_scaler(sp.where(F.col("split") == "train"), BANK_COLS)
    return finish(model.transform(sp).select(*BANK_KEYS, "split", *BANK_COLS))


# F3 / F4 ------------------------------------------------------------------------
def onehot_sql(col: str, values, prefix: str = "", as_int: bool = False):
    one, zero = ("1", "0") if as_int else ("1.0", "0.0")
    return ", ".join(f"CASE WHEN {col} = '{v}' THEN {one} ELSE {zero} END AS \"{prefix}{col}_{v}\""
                     for v in values)


_CATS = {"source": SOURCES, "browser": BROWSERS, "sex": SEXES}


@query("one_hot", V.with_(*V.tx_ctes(), split_sql("tx", "class", ["event_id"])) + "SELECT event_id, split, "
       + ", ".join(onehot_sql(c, v) for c, v in _CATS.items()) + " FROM sp")
def q_one_hot(spark, sf):
    sp = PR.stratified_split(TV.tx(spark, sf), "class", ["event_id"])
    model = PR.fit_one_hot(sp.where(F.col("split") == "train"), list(_CATS))
    return finish(model.transform(sp, keep=["event_id", "split"]))


@query("encode_categorical", V.with_(*V.tx_ctes()) + "SELECT event_id, "
       + ", ".join(onehot_sql(c, v, as_int=True) for c, v in _CATS.items()) + " FROM tx")
def q_encode_categorical(spark, sf):
    out = PR.encode_categorical_features(TV.tx(spark, sf).select("event_id", *_CATS), list(_CATS))
    return finish(out)


# F5 -----------------------------------------------------------------------------
ECOM_DROP = ("class", "user_id", "device_id", "signup_time", "purchase_time", "ip_int", "event_id")


def ecommerce_numeric_features():
    from kestrel.operators.features import window_feature_names
    base = ["purchase_value", "age", "purchase_hour", "purchase_dayofweek", "purchase_month",
            "time_since_signup_hours", "user_transaction_count", "transaction_amount_log",
            "transaction_amount_per_user_avg"]
    return base + [n for e in ("user_id", "device_id", "ip_int") for n in window_feature_names(e)]


def _preprocess_ecom_sql():
    num = ecommerce_numeric_features()
    stats, exprs = scaled_sql(num, prefix="scaler__")
    cats = dict(_CATS, country=COUNTRIES)
    enc = ", ".join(onehot_sql(c, v, prefix="encoder__") for c, v in cats.items())
    body = features_sql().rstrip() + ",\n" + ",\n".join(
        f"{n} AS ({b})" for n, b in [split_sql("feat", "class", ["event_id"]),
                                     ("st", f"SELECT {stats} FROM sp WHERE split = 'train'")])
    sql = body + f"\nSELECT event_id, class, split, {exprs}, {enc} FROM sp, st"
    return final_sql(sql, doubles=[f"scaler__{c}" for c in num], ints=["class"])


def ecommerce_preprocessed(spark, sf):
    feat = ecommerce_features(spark, sf)
    sp = PR.stratified_split(feat, "class", ["event_id"])
    model = PR.fit_column_transformer(sp.where(F.col("split") == "train"),
                                      drop=ECOM_DROP + ("split",))
    return model, model.transform(sp, keep=["event_id", "class", "split"])


@query("preprocess_ecommerce", _preprocess_ecom_sql())
def q_preprocess_ecommerce(spark, sf):
    return finish(ecommerce_preprocessed(spark, sf)[1])


def _preprocess_bank_sql():
    stats, exprs = scaled_sql(BANK_COLS, prefix="scaler__")
    return final_sql(V.with_(("bank_tx", V.BANK), split_sql("bank_tx", '"Class"', BANK_KEYS),
                             ("st", f"SELECT {stats} FROM sp WHERE split = 'train'"))
                     + f"SELECT {', '.join(BANK_KEYS)}, \"Class\", split, {exprs} FROM sp, st",
                     doubles=[f"scaler__{c}" for c in BANK_COLS], ints=["Class", "l_linenumber"])


def bank_preprocessed(spark, sf):
    sp = bank_split(spark, sf)
    model = PR.fit_column_transformer(sp.where(F.col("split") == "train"),
                                      drop=BANK_KEYS + ("Class", "split"))
    return model, model.transform(sp, keep=[*BANK_KEYS, "Class", "split"])


@query("preprocess_bank", _preprocess_bank_sql())
def q_preprocess_bank(spark, sf):
    return finish(bank_preprocessed(spark, sf)[1])


# F8 -----------------------------------------------------------------------------
@query("class_share", final_sql(V.with_(*V.tx_ctes()) + """
SELECT class, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM tx GROUP BY class""",
                                doubles=["share"], ints=["class", "n"]))
def q_class_share(spark, sf):
    return finish(PR.class_shares(TV.tx(spark, sf), "class"))

