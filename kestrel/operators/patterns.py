"""Fraud patterns (I7-I13) as per-row flags and summary shares.

Per-entity history uses aggregates joined back or the skew-safe sliced
windows of ``kestrel.operators.windows`` — never one task per entity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.casts import epoch_micros, to_timestamp_utc
from kestrel.operators.windows import CHUNK_ROWS, chunked_measures, hot_accounts, previous_row, split_by, trailing_measures, trailing_range_aggregate

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def _t(df, c):
    return epoch_micros(to_timestamp_utc(F.col(c), df.schema[c].dataType))


# I7 ---------------------------------------------------------------------------
def new_account_pattern(df: DataFrame, hours_col: str = "time_since_signup_hours",
                        label_col: str = "class", limit_hours: float = 2.0) -> DataFrame:
    """Rows within ``limit_hours`` of signup: count, their fraud rate and their
    share of all fraud."""
    new = F.col(hours_col) < F.lit(limit_hours)
    y = F.col(label_col) == 1
    agg = df.agg(F.count_if(new).alias("n_new"), F.count_if(new & y).alias("n_new_fraud"),
                 F.count_if(y).alias("n_fraud"))
    return agg.withColumns({
        "fraud_rate_new": F.try_divide(F.col("n_new_fraud").cast("double"), F.col("n_new")),
        "share_of_fraud_new": F.try_divide(F.col("n_new_fraud").cast("double"), F.col("n_fraud")),
    })


# I8 ---------------------------------------------------------------------------
def geo_mismatch(df: DataFrame, user_col: str = "user_id", country_col: str = "country",
                 time_col: str = "purchase_time", key_col: str = "event_id") -> DataFrame:
    """Flag a row whose country the user has not used before (in (time, key)
    order), except the user's first row.

    One aggregate finds the first row per (user, country) and is rolled up to the
    user's first row; one join brings both back. A hot user is combined map-side.
    """
    order = F.struct(_t(df, time_col).alias("t"), F.col(key_col).alias("k"))
    base = df.withColumn("__o", order)
    pairs = base.groupBy(user_col, country_col).agg(F.min("__o").alias("__first_pair"))
    users = pairs.groupBy(user_col).agg(F.min("__first_pair").alias("__first_user"))
    firsts = pairs.join(users, user_col)
    out = base.join(firsts, [user_col, country_col], "left")
    flag = (F.col("__o") == F.col("__first_pair")) & (F.col("__o") != F.col("__first_user"))
    return out.withColumn("geo_mismatch", F.coalesce(flag, F.lit(False)).cast("int")) \
        .drop("__o", "__first_pair", "__first_user")


# I9 ---------------------------------------------------------------------------
def device_changes(df: DataFrame, user_col: str = "user_id", device_col: str = "device_id",
                   time_col: str = "purchase_time", key_col: str = "event_id",
                   window_us: int = DAY_US, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Per row: how many of the user's rows in the trailing window switched
    device from the user's previous row, when that previous row is itself
    within the window before it."""
    base = df.withColumn("__t", _t(df, time_col))
    pre = {"__prev_dev": lambda w: F.lag(device_col).over(w),
           "__prev_t": lambda w: F.lag("__t").over(w)}

    def changed():
        return F.when(F.col("__prev_dev").isNotNull() & (F.col("__prev_dev") != F.col(device_col))
                      & (F.col("__t") - F.col("__prev_t") <= window_us), 1).otherwise(0)

    def sliced(rows):
        return trailing_range_aggregate(rows, user_col, "__t", window_us, key_col,
                                        {"device_changes_24h": lambda w: F.sum(changed()).over(w)}, context=2, pre=pre)

    hot = hot_accounts(base, user_col, "__t", window_us, chunk_rows)
    if hot is None:
        return sliced(base).drop("__t")
    cold, busy = split_by(base, user_col, "__t", hot)
    flagged = previous_row(busy, user_col, "__t", key_col, {"__prev_dev": device_col, "__prev_t": "__t"}, chunk_rows) \
        .withColumn("__changed", changed()).drop(*pre)
    counted = chunked_measures(flagged, user_col, "__t", window_us, {"device_changes_24h": ("sum", "__changed")}, chunk_rows=chunk_rows)
    return sliced(cold).unionByName(counted.drop("__changed")).drop("__t")


# I10 --------------------------------------------------------------------------
def velocity(df: DataFrame, user_col: str = "user_id", time_col: str = "purchase_time",
             key_col: str = "event_id", window_us: int = HOUR_US, limit: int = 5,
             out_col: str = "txn_velocity") -> DataFrame:
    """Rows of the user in [t - 1 h, t] and the flag ``> limit``."""
    base = df.withColumn("__t", _t(df, time_col))
    out = trailing_measures(base, user_col, "__t", window_us, key_col, {out_col: ("count", None)})
    return out.withColumn("high_velocity", (F.col(out_col) > F.lit(limit)).cast("int")).drop("__t")


# I11 --------------------------------------------------------------------------
def micro_test(df: DataFrame, user_col: str = "user_id", amount_col: str = "purchase_value",
               time_col: str = "purchase_time", key_col: str = "event_id",
               window_us: int = DAY_US, small: float = 5.0, factor: float = 10.0) -> DataFrame:
    """Flag a row whose amount is at least ``factor`` times a small (<= ``small``)
    amount the same account spent earlier within the window (strictly before t)."""
    base = df.withColumn("__t", _t(df, time_col))

    out = trailing_measures(base, user_col, "__t", window_us, key_col,
                            {"min_prev_amount_24h": ("min", amount_col)}, strict=True)
    m = F.col("min_prev_amount_24h")
    flag = (m <= F.lit(small)) & (F.col(amount_col) >= F.lit(factor) * m)
    return out.withColumn("micro_test", F.coalesce(flag, F.lit(False)).cast("int")).drop("__t")


# I12 --------------------------------------------------------------------------
def off_hours(df: DataFrame, time_col: str = "purchase_time", label_col: str = "class",
              start: int = 1, end: int = 5) -> DataFrame:
    """Rows between ``start``:00 and ``end``:00 UTC (end excluded): count, fraud
    rate and share of all fraud."""
    h = F.hour(to_timestamp_utc(F.col(time_col), df.schema[time_col].dataType))
    off = (h >= start) & (h < end)
    y = F.col(label_col) == 1
    agg = df.agg(F.count_if(off).alias("n_off_hours"), F.count_if(off & y).alias("n_off_hours_fraud"),
                 F.count_if(y).alias("n_fraud"))
    return agg.withColumns({
        "fraud_rate_off_hours": F.try_divide(F.col("n_off_hours_fraud").cast("double"),
                                             F.col("n_off_hours")),
        "share_of_fraud_off_hours": F.try_divide(F.col("n_off_hours_fraud").cast("double"),
                                                 F.col("n_fraud")),
    })


# I13 --------------------------------------------------------------------------
def v_anomaly(df: DataFrame, cols=("V4", "V14", "V17"), limit: float = 3.0) -> DataFrame:
    """|z-score| > ``limit`` flags per listed column (population deviation,
    one aggregate pass) and whether any fired."""
    cols = [c for c in cols if c in df.columns]
    st = df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]).first()
    flags = {}
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        if m is None or not s:
            flags[f"{c}_anomaly"] = F.lit(0)
            continue
        z = (F.col(c) - F.lit(m)) / F.lit(s)
        flags[f"{c}_anomaly"] = F.coalesce(F.abs(z) > F.lit(limit), F.lit(False)).cast("int")
    out = df.withColumns(flags)
    anyf = F.greatest(*[F.col(n) for n in flags]) if len(flags) > 1 else F.col(next(iter(flags)))
    return out.withColumn("any_v_anomaly", anyf)
