"""Queries for casting (B1-B6) and cleaning (C1-C9), with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel import schemas as SC
from kestrel.functions.casts import to_double, to_timestamp_utc
from kestrel.operators import cleaning as CL
from kestrel.plans import oracle_views as V
from kestrel.plans.catalog import query
from kestrel.plans.finish import final_sql, finish
from kestrel.sources import testviews as TV

# ---------------------------------------------------------------- SQL pieces
_FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M:%S.%f", "%Y-%m-%dT%H:%M:%S", "%Y-%m-%d")


def ts_sql(c: str) -> str:
    return "COALESCE(" + ", ".join(f"try_strptime(trim({c}), '{f}')" for f in _FORMATS) + ")"


def num_sql(c: str) -> str:
    return f"TRY_CAST(trim({c}) AS DOUBLE)"


def ip_sql(c: str) -> str:
    s = f"trim({c})"
    p = f"string_split(trim({c}), '.')"
    octs = " AND ".join(f"TRY_CAST({p}[{i}] AS INTEGER) BETWEEN 0 AND 255" for i in range(1, 5))
    val = " + ".join(f"TRY_CAST({p}[{i}] AS BIGINT)*{m}"
                     for i, m in zip(range(1, 5), (16777216, 65536, 256, 1)))
    return (f"CASE WHEN {s} IS NULL THEN NULL WHEN contains({s}, '.') THEN "
            f"CASE WHEN len({p}) = 4 AND {octs} THEN {val} END "
            f"ELSE TRY_CAST({s} AS BIGINT) END")


TYPED_ECOM = f"""SELECT event_id, user_id, {ts_sql('signup_time')} AS signup_time,
  {ts_sql('purchase_time')} AS purchase_time, {num_sql('purchase_value')} AS purchase_value,
  device_id, source, browser, sex, {num_sql('age')} AS age, {ip_sql('ip_address')} AS ip_address,
  class FROM tx_raw"""

BANK_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
BANK_COLS = ("Time", "V1", "V2", "V3", "V4", "Amount")
TYPED_BANK = ("SELECT " + ", ".join(BANK_KEYS) + ", "
              + ", ".join(f'{num_sql(chr(34) + c + chr(34))} AS "{c}"' for c in BANK_COLS)
              + ', "Class" FROM bank_raw')


def missing_ctes(src: str, dt_cols, num_cols, str_cols, prefix: str = "m"):
    """CTEs that apply C1 -> C2 -> C3 to view ``src``; returns (ctes, final name)."""
    ctes, cur = [], src
    for i, c in enumerate(dt_cols):
        s, d = f"{prefix}s{i}", f"{prefix}d{i}"
        ctes.append((s, f"""SELECT count(*) AS n, count({c}) AS nn,
  floor(quantile_cont(CAST(epoch_us({c}) AS DOUBLE), 0.5)) AS med FROM {cur}"""))
        ctes.append((d, f"""SELECT * REPLACE (CASE WHEN {c} IS NULL
    AND (SELECT CAST(n - nn AS DOUBLE) / n FROM {s}) <= 0.05
    THEN make_timestamp(CAST((SELECT med FROM {s}) AS BIGINT)) ELSE {c} END AS {c})
  FROM {cur} WHERE NOT ({c} IS NULL AND (SELECT CAST(n - nn AS DOUBLE) / n FROM {s}) > 0.05)"""))
        cur = d
    if num_cols:
        s, d = f"{prefix}sn", f"{prefix}dn"
        aggs = ", ".join(f'skewness("{c}") AS "s_{c}", quantile_cont("{c}", 0.5) AS "md_{c}", '
                         f'avg("{c}") AS "m_{c}"' for c in num_cols)
        ctes.append((s, f"SELECT {aggs} FROM {cur}"))
        reps = ", ".join(f'COALESCE("{c}", (SELECT CASE WHEN abs("s_{c}") > 1 THEN "md_{c}" '
                         f'ELSE "m_{c}" END FROM {s})) AS "{c}"' for c in num_cols)
        ctes.append((d, f"SELECT * REPLACE ({reps}) FROM {cur}"))
        cur = d
    if str_cols:
        d = f"{prefix}dc"
        reps = ", ".join(f"COALESCE({c}, 'Unknown') AS {c}" for c in str_cols)
        ctes.append((d, f"SELECT * REPLACE ({reps}) FROM {cur}"))
        cur = d
    return ctes, cur


ECOM_STR = ("device_id", "source", "browser", "sex")
_TS = ("signup_time", "purchase_time")


def _raw_ctes():
    return [*V.tx_ctes(), ("tx_raw", V.TX_RAW)]


# ------------------------------------------------------------------ B1-B6
@query("cast_datetime", final_sql(V.with_(*_raw_ctes()) + f"""
SELECT event_id, {ts_sql('signup_time')} AS signup_time, {ts_sql('purchase_time')} AS purchase_time
FROM tx_raw""", ts=_TS))
def q_cast_datetime(spark, sf):
    raw = TV.tx_raw(spark, sf)
    return finish(raw.select("event_id", to_timestamp_utc("signup_time").alias("signup_time"),
                             to_timestamp_utc("purchase_time").alias("purchase_time")))


@query("cast_numeric", final_sql(V.with_(*_raw_ctes()) + f"""
SELECT event_id, {num_sql('purchase_value')} AS purchase_value, {num_sql('age')} AS age
FROM tx_raw""", doubles=["purchase_value", "age"]))
def q_cast_numeric(spark, sf):
    raw = TV.tx_raw(spark, sf)
    return finish(raw.select("event_id", to_double(F.col("purchase_value"), raw.schema["purchase_value"].dataType)
                             .alias("purchase_value"),
                             to_double(F.col("age"), raw.schema["age"].dataType).alias("age")))


@query("types_ecommerce", final_sql(V.with_(*_raw_ctes(), ("typed", TYPED_ECOM))
                                    + "SELECT * FROM typed", doubles=["purchase_value", "age"],
                                    ints=["class"], ts=_TS))
def q_types_ecommerce(spark, sf):
    return finish(CL.correct_data_types(TV.tx_raw(spark, sf), "ecommerce"))


def _bank_raw_ctes():
    return [("bank_tx", V.BANK), ("bank_raw", V.BANK_RAW)]


@query("types_bank", final_sql(V.with_(*_bank_raw_ctes(), ("typed", TYPED_BANK))
                               + "SELECT * FROM typed", doubles=BANK_COLS,
                               ints=["Class", "l_linenumber"]))
def q_types_bank(spark, sf):
    return finish(CL.correct_data_types(TV.bank_raw(spark, sf), "bank"))


@query("types_generic", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, user_id, signup_time, purchase_time, purchase_value, device_id, source, browser,
  sex, age, ip_int, class FROM tx""", doubles=["purchase_value", "age"], ints=["class"], ts=_TS))
def q_types_generic(spark, sf):
    return finish(CL.correct_data_types(TV.tx(spark, sf)))


TYPE_MAPPING = {"signup_time": "datetime64[ns]", "purchase_time": "datetime64[ns]",
                "purchase_value": "float64", "age": "int64", "class": "int64"}


@query("types_mapping", final_sql(V.with_(*_raw_ctes()) + f"""
SELECT event_id, user_id, {ts_sql('signup_time')} AS signup_time, {ts_sql('purchase_time')} AS purchase_time,
  {num_sql('purchase_value')} AS purchase_value, device_id, source, browser, sex,
  TRY_CAST({num_sql('age')} AS BIGINT) AS age, ip_address, CAST(class AS BIGINT) AS class FROM tx_raw""",
                                  doubles=["purchase_value"], ts=_TS))
def q_types_mapping(spark, sf):
    return finish(CL.cast_columns(TV.tx_raw(spark, sf), TYPE_MAPPING))


# ------------------------------------------------------------------ C1-C4
PROTECT_TX = SC.PROTECTED + ("event_id", "ip_int")


def _dt_query(variant):
    ctes, last = missing_ctes("tx", _TS, (), ())
    sql = V.with_(*V.tx_ctes(null_signup=variant), *ctes) + f"""
SELECT event_id, signup_time, purchase_time FROM {last}"""
    return final_sql(sql, ts=_TS)


@query("impute_datetime_drop", _dt_query("drop"))
def q_impute_datetime_drop(spark, sf):
    t = TV.tx(spark, sf, null_signup="drop")
    return finish(CL.impute_datetimes(t).select("event_id", "signup_time", "purchase_time"))


@query("impute_datetime_median", _dt_query("impute"))
def q_impute_datetime_median(spark, sf):
    t = TV.tx(spark, sf, null_signup="impute")
    return finish(CL.impute_datetimes(t).select("event_id", "signup_time", "purchase_time"))


def tx_numeric_nulls(spark, sf):
    """tx with nulls in a skewed column too (purchase value squared)."""
    t = TV.tx(spark, sf)
    eid = F.col("event_id")
    return t.withColumns({
        "purchase_value": F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("purchase_value")),
        "value_sq": F.when(eid % 7 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("purchase_value") * F.col("purchase_value")),
    })


TX_NUMERIC_NULLS = """SELECT * REPLACE (CASE WHEN event_id % 17 = 0 THEN NULL ELSE purchase_value END AS purchase_value),
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE purchase_value * purchase_value END AS value_sq FROM tx"""

_NUM = ("purchase_value", "age", "value_sq")


def _num_oracle():
    ctes, last = missing_ctes("txn", (), _NUM, ())
    return final_sql(V.with_(*V.tx_ctes(), ("txn", TX_NUMERIC_NULLS), *ctes)
                     + f"SELECT event_id, purchase_value, age, value_sq FROM {last}", doubles=_NUM)


@query("impute_numeric", _num_oracle())
def q_impute_numeric(spark, sf):
    out = CL.impute_numeric(tx_numeric_nulls(spark, sf), protect=PROTECT_TX)
    return finish(out.select("event_id", *_NUM))


def _cat_oracle():
    ctes, last = missing_ctes("tx", (), (), ECOM_STR)
    return V.with_(*V.tx_ctes(), *ctes) + f"SELECT event_id, {', '.join(ECOM_STR)} FROM {last}"


@query("impute_categorical", _cat_oracle())
def q_impute_categorical(spark, sf):
    out = CL.impute_categorical(TV.tx(spark, sf).select("event_id", *ECOM_STR))
    return finish(out)


_ALL_TX = ("event_id", "user_id", "signup_time", "purchase_time", "purchase_value", "device_id",
           "source", "browser", "sex", "age", "ip_int", "class", "value_sq")


def _handle_missing_oracle():
    ctes, last = missing_ctes("txn", _TS, _NUM, ECOM_STR)
    return final_sql(V.with_(*V.tx_ctes(null_signup="impute"), ("txn", TX_NUMERIC_NULLS), *ctes)
                     + f"SELECT {', '.join(_ALL_TX)} FROM {last}",
                     doubles=_NUM, ints=["class"], ts=_TS)


def _tx_all_nulls(spark, sf):
    t = TV.tx(spark, sf, null_signup="impute")
    eid = F.col("event_id")
    return t.withColumns({
        "purchase_value": F.when(eid % 17 == 0, F.lit(None).cast("double")).otherwise(F.col("purchase_value")),
        "value_sq": F.when(eid % 7 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("purchase_value") * F.col("purchase_value")),
    })


@query("handle_missing", _handle_missing_oracle())
def q_handle_missing(spark, sf):
    out = CL.handle_missing_values(_tx_all_nulls(spark, sf), protect=PROTECT_TX)
    return finish(out.select(*_ALL_TX))


# ------------------------------------------------------------------ C5
@query("impute_strategy_mean", final_sql(V.with_(*V.tx_ctes(), ("txn", TX_NUMERIC_NULLS)) + """
SELECT event_id, COALESCE(purchase_value, (SELECT avg(purchase_value) FROM txn)) AS purchase_value,
  COALESCE(age, (SELECT avg(age) FROM txn)) AS age FROM txn""", doubles=["purchase_value", "age"]))
def q_impute_strategy_mean(spark, sf):
    out = CL.impute_with_strategy(tx_numeric_nulls(spark, sf), "mean", ["purchase_value", "age"])
    return finish(out.select("event_id", "purchase_value", "age"))


def _mode_sql(c):
    return (f"(SELECT {c} FROM tx WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} ASC LIMIT 1)")


@query("impute_strategy_mode", V.with_(*V.tx_ctes()) + f"""
SELECT event_id, COALESCE(browser, {_mode_sql('browser')}) AS browser,
  COALESCE(source, {_mode_sql('source')}) AS source, COALESCE(sex, {_mode_sql('sex')}) AS sex FROM tx""")
def q_impute_strategy_mode(spark, sf):
    out = CL.impute_with_strategy(TV.tx(spark, sf), "mode", ["browser", "source", "sex"])
    return finish(out.select("event_id", "browser", "source", "sex"))


@query("impute_strategy_drop", final_sql(V.with_(*V.tx_ctes()) + """
SELECT event_id, browser, age FROM tx WHERE browser IS NOT NULL AND age IS NOT NULL""",
                                         doubles=["age"]))
def q_impute_strategy_drop(spark, sf):
    out = CL.impute_with_strategy(TV.tx(spark, sf), "drop", ["browser", "age"])
    return finish(out.select("event_id", "browser", "age"))


# ------------------------------------------------------------------ C6-C9
_DUP_COLS = ("user_id", "device_id", "source", "browser", "sex", "class")


@query("dedup_rows", final_sql(V.with_(*V.tx_ctes()) + f"""
SELECT DISTINCT {', '.join(_DUP_COLS)} FROM tx""", ints=["class"]))
def q_dedup_rows(spark, sf):
    return finish(CL.remove_duplicates(TV.tx(spark, sf).select(*_DUP_COLS)))


_ECOM_NUM = ("purchase_value", "age")


def _clean_ecom_oracle():
    ctes, last = missing_ctes("typed", _TS, _ECOM_NUM, ECOM_STR)
    return final_sql(V.with_(*_raw_ctes(), ("typed", TYPED_ECOM), *ctes)
                     + f"SELECT DISTINCT * FROM {last}", doubles=_ECOM_NUM, ints=["class"], ts=_TS)


@query("clean_ecommerce", _clean_ecom_oracle())
def q_clean_ecommerce(spark, sf):
    return finish(CL.clean_ecommerce_data(TV.tx_raw(spark, sf), protect=PROTECT_TX))


def _clean_bank_oracle():
    ctes, last = missing_ctes("typed", (), BANK_COLS, ())
    return final_sql(V.with_(*_bank_raw_ctes(), ("typed", TYPED_BANK), *ctes)
                     + f"SELECT DISTINCT * FROM {last}", doubles=BANK_COLS,
                     ints=["Class", "l_linenumber"])


PROTECT_BANK = SC.PROTECTED + BANK_KEYS


@query("clean_bank", _clean_bank_oracle())
def q_clean_bank(spark, sf):
    return finish(CL.clean_bank_data(TV.bank_raw(spark, sf), protect=PROTECT_BANK))


def _audit_oracle():
    ctes, last = missing_ctes("typed", _TS, _ECOM_NUM, ECOM_STR)
    body = V.with_(*_raw_ctes(), ("typed", TYPED_ECOM), *ctes)
    parts = [f"""SELECT 'invalid_ip' AS step, 'ip_address' AS column_name,
  count(*) FILTER (WHERE tx_raw.ip_address IS NOT NULL AND t.ip_address IS NULL) AS n_rows,
  'null' AS method, CAST(NULL AS DOUBLE) AS fill_value
  FROM tx_raw JOIN typed t USING (event_id)"""]
    for i, c in enumerate(_TS):
        parts.append(f"""SELECT CASE WHEN CAST(n - nn AS DOUBLE) / n > 0.05 THEN 'datetime_drop' ELSE 'datetime_fill' END,
  '{c}', n - nn, CASE WHEN CAST(n - nn AS DOUBLE) / n > 0.05 THEN 'drop' ELSE 'median' END,
  CASE WHEN CAST(n - nn AS DOUBLE) / n > 0.05 THEN NULL ELSE med END FROM ms{i} WHERE n > nn""")
    prev = "md1"
    for c in _ECOM_NUM:
        parts.append(f"""SELECT 'numeric_fill', '{c}', count(*) - count("{c}"),
  CASE WHEN abs(skewness("{c}")) > 1 THEN 'median' ELSE 'mean' END,
  CASE WHEN abs(skewness("{c}")) > 1 THEN quantile_cont("{c}", 0.5) ELSE avg("{c}") END
  FROM {prev} HAVING count(*) > count("{c}")""")
    for c in ECOM_STR:
        parts.append(f"""SELECT 'categorical_fill', '{c}', count(*) - count({c}), 'constant', NULL
  FROM mdn HAVING count(*) > count({c})""")
    parts.append(f"""SELECT 'duplicates', NULL, (SELECT count(*) FROM {last}) -
  (SELECT count(*) FROM (SELECT DISTINCT * FROM {last})), 'drop', NULL""")
    return final_sql(body + "\nUNION ALL\n".join(parts), doubles=["fill_value"], ints=["n_rows"])


@query("cleaning_audit", _audit_oracle())
def q_cleaning_audit(spark, sf):
    rep = CL.CleaningReport()
    CL.clean_ecommerce_data(TV.tx_raw(spark, sf), protect=PROTECT_TX, report=rep)
    return finish(rep.to_df(spark))
