"""Feature engineering (E1-E9): time parts, durations, frequencies, amounts and
activity windows.

Entity statistics (count per user, mean amount per user, N-day activity per
user / device / address) are computed with one ``groupBy`` per entity and
joined back, never with a ``partitionBy(entity)`` window: the aggregate is
combined map-side, so a hot entity holding a third of the rows costs one
partial row per task instead of one giant task, and AQE can broadcast the
aggregate or split skewed join partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.casts import MICROS_PER_DAY, epoch_micros, hours_between, to_timestamp_utc
from kestrel.functions.stats import exact_median, exact_quantiles

DEFAULT_WINDOWS = (1, 7, 30)


def _ts(df: DataFrame, c: str):
    return to_timestamp_utc(F.col(c), df.schema[c].dataType)


# E1 ---------------------------------------------------------------------------
def add_time_parts(df: DataFrame, time_col: str = "purchase_time") -> DataFrame:
    """purchase_hour (0-23), purchase_dayofweek (Monday = 0), purchase_month (1-12)."""
    if time_col not in df.columns:
        return df
    t = _ts(df, time_col)
    return df.withColumns({"purchase_hour": F.hour(t), "purchase_dayofweek": F.weekday(t),
                           "purchase_month": F.month(t)})


# E2 ---------------------------------------------------------------------------
def add_time_since_signup(df: DataFrame, signup_col: str = "signup_time",
                          purchase_col: str = "purchase_time",
                          out_col: str = "time_since_signup_hours",
                          n_upper: int | None = None) -> DataFrame:
    """Hours from signup to purchase; a negative duration is a data error and,
    like a missing one, is replaced by the median of the valid durations."""
    if signup_col not in df.columns or purchase_col not in df.columns:
        return df
    h = hours_between(_ts(df, purchase_col), _ts(df, signup_col))
    out = df.withColumn(out_col, F.when(h >= 0, h))
    med = exact_median(out, out_col, n_upper=n_upper)
    if med is None:
        return out
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(float(med))))


# E3 ---------------------------------------------------------------------------
def add_user_transaction_count(df: DataFrame, id_col: str = "user_id",
                               out_col: str = "user_transaction_count") -> DataFrame:
    """Rows per user; a NULL or absent user counts 1."""
    if id_col not in df.columns:
        return df.withColumn(out_col, F.lit(1).cast("bigint"))
    counts = df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count("*").alias(out_col))
    return (df.join(counts, id_col, "left")
            .withColumn(out_col, F.coalesce(F.col(out_col), F.lit(1).cast("bigint"))))


# E4 / E5 ----------------------------------------------------------------------
def add_amount_log(df: DataFrame, amount_col: str = "purchase_value",
                   out_col: str = "transaction_amount_log") -> DataFrame:
    """log(1 + amount); NULL at and below -1 (numpy gives -inf / NaN there)."""
    if amount_col not in df.columns:
        return df
    return df.withColumn(out_col, F.log1p(F.col(amount_col)))


def clip_ratio(df: DataFrame, ratio_col: str, n_upper: int | None = None) -> DataFrame:
    """Cap a ratio at its 99th percentile (NULL stays NULL), then NULL -> 1."""
    p99 = exact_quantiles(df, ratio_col, [0.99], n_upper=n_upper)[0]
    r = F.col(ratio_col)
    if p99 is not None:
        r = F.when(r > F.lit(float(p99)), F.lit(float(p99))).otherwise(r)
    return df.withColumn(ratio_col, F.coalesce(r, F.lit(1.0)))


def add_amount_ratio(df: DataFrame, amount_col: str = "purchase_value",
                     id_col: str = "user_id",
                     out_col: str = "transaction_amount_per_user_avg") -> DataFrame:
    """Amount over the user's mean amount (+1e-6), capped at p99, missing -> 1."""
    if amount_col not in df.columns or id_col not in df.columns:
        return df
    means = (df.where(F.col(id_col).isNotNull()).groupBy(id_col)
             .agg(F.avg(amount_col).alias("__user_avg")))
    out = df.join(means, id_col, "left")
    out = out.withColumn(out_col, F.try_divide(F.col(amount_col),
                                               F.col("__user_avg") + F.lit(1e-6))).drop("__user_avg")
    return clip_ratio(out, out_col)


# E6 ---------------------------------------------------------------------------
def _window_aggs(time_us, amount, id_col: str, max_us: int, windows) -> list:
    aggs = []
    for n in windows:
        recent = time_us >= F.lit(max_us - n * MICROS_PER_DAY)
        aggs += [F.count_if(recent).alias(f"{id_col}_count_last_{n}d"),
                 F.sum(F.when(recent, amount)).alias(f"{id_col}_sum_amount_last_{n}d"),
                 F.avg(F.when(recent, amount)).alias(f"{id_col}_mean_amount_last_{n}d")]
    return aggs


def window_feature_names(id_col: str, windows=DEFAULT_WINDOWS) -> list[str]:
    return [f"{id_col}_{m}_last_{n}d" for n in windows
            for m in ("count", "sum_amount", "mean_amount")]


def max_epoch_micros(df: DataFrame, time_col: str):
    return df.agg(F.max(epoch_micros(_ts(df, time_col))).alias("m")).first()["m"]


def add_time_window_features(df: DataFrame, time_col: str = "purchase_time",
                             id_col: str = "user_id", amount_col: str = "purchase_value",
                             windows=DEFAULT_WINDOWS, max_us: int | None = None,
                             n_entities: int | None = None) -> DataFrame:
    """Per-entity count / sum / mean of the amount over the last N days of the
    data set (anchored at the newest row, threshold inclusive); every row of
    the entity receives its entity's totals; no recent activity -> 0.

    One scan for the newest time, one ``groupBy`` for all windows, one join.
    """
    if any(c not in df.columns for c in (time_col, id_col, amount_col)):
        return df
    if max_us is None:
        max_us = max_epoch_micros(df, time_col)
    names = window_feature_names(id_col, windows)
    if max_us is None:
        return df.withColumns({n: _no_activity(n) for n in names})
    t = epoch_micros(_ts(df, time_col))
    aggs = _window_aggs(t, F.col(amount_col), id_col, max_us, windows)
    agg = df.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(*aggs)
    out = df.join(_sized(agg, n_entities, len(aggs)), id_col, "left")
    return out.withColumns({n: F.coalesce(F.col(n), _no_activity(n)) for n in names})


def _no_activity(name: str):
    """What a window column holds without activity, in the column's type."""
    return F.lit(0).cast("bigint") if "_count_" in name else F.lit(0.0)


# E7 ---------------------------------------------------------------------------
def add_trailing_activity(df: DataFrame, time_col: str = "purchase_time",
                          id_col: str = "user_id", amount_col: str = "purchase_value",
                          days: int = 7, key_col: str = "event_id") -> DataFrame:
    """Leak-free form of E6: per row, the entity's count / sum / mean of the
    amount in ``[t - days, t]`` (inclusive, ties at t included).

    Skew-safe: rows are grouped by (entity, time slice of ``days``) and every
    slice also receives the previous slice's rows as read-only context, so
    one entity's history is spread over many tasks instead of one; an entity with
    too many rows in a slice is cut into chunks.
    """
    from kestrel.operators.windows import trailing_measures
    width = days * MICROS_PER_DAY
    t = epoch_micros(_ts(df, time_col))
    base = df.withColumn("__t", t)
    prefix = f"{id_col}_trailing_{days}d"
    return trailing_measures(base, id_col, "__t", width, key_col,
                             {f"{prefix}_count": ("count", None), f"{prefix}_sum": ("sum", amount_col),
                              f"{prefix}_mean": ("avg", amount_col)}).drop("__t")


# E9 ---------------------------------------------------------------------------
def add_amount_per_time(df: DataFrame, amount_col: str = "Amount", time_col: str = "Time",
                        out_col: str = "Amount_per_Time") -> DataFrame:
    """Amount / Time for card data; Time 0 -> NULL."""
    if amount_col not in df.columns or time_col not in df.columns:
        return df
    return df.withColumn(out_col, F.try_divide(F.col(amount_col).cast("double"),
                                               F.nullif(F.col(time_col).cast("double"),
                                                        F.lit(0.0))))


# E8 ---------------------------------------------------------------------------
ENTITIES = ("user_id", "device_id", "ip_address")


def engineer_ecommerce_features(df: DataFrame, ranges: DataFrame | None = None,
                                ip_col: str = "ip_address", entities=None,
                                windows=DEFAULT_WINDOWS, checkpoint: bool = True) -> DataFrame:
    """The e-commerce chain: country -> time -> frequency -> amount -> windows.

    The row-level part (country join, time parts) is materialised once with a
    reliable checkpoint when ``checkpoint`` is set, so the statistics passes
    (median duration, newest time, p99 ratio) and the three entity
    aggregates read it instead of recomputing the joins. The user-level
    statistics (count, mean amount, N-day windows) share one
    ``groupBy(user_id)`` and one join; device and address windows add one
    group-by and one join each.
    """
    from kestrel.operators.geo import map_ips_to_countries
    from kestrel.session import cut_lineage
    entities = list(entities or [e if e != "ip_address" else ip_col for e in ENTITIES])
    out = add_time_parts(map_ips_to_countries(df, ranges, ip_col=ip_col))
    has_times = "purchase_time" in out.columns and "signup_time" in out.columns
    if has_times:
        h = hours_between(_ts(out, "purchase_time"), _ts(out, "signup_time"))
        out = out.withColumn("time_since_signup_hours", F.when(h >= 0, h))
    if checkpoint:
        out = cut_lineage(out)
    n_rows, max_us, distinct = None, None, {}
    if "purchase_time" in out.columns:
        # One pass: row count, newest time, and the approximate number of
        # distinct entities (sizes the per-entity aggregates before joining).
        ents = [e for e in entities if e in out.columns]
        st = out.agg(F.count("*").alias("n"),
                     F.max(epoch_micros(_ts(out, "purchase_time"))).alias("m"),
                     *[F.approx_count_distinct(e, 0.02).alias(f"d{i}") for i, e in enumerate(ents)]
                     ).first()
        n_rows, max_us = st["n"], st["m"]
        distinct = {e: st[f"d{i}"] for i, e in enumerate(ents)}
    if has_times:
        med = exact_median(out, "time_since_signup_hours", n_upper=n_rows)
        if med is not None:
            out = out.withColumn("time_since_signup_hours",
                                 F.coalesce("time_since_signup_hours", F.lit(float(med))))
    if "user_id" in out.columns and "purchase_value" in out.columns:
        t = epoch_micros(_ts(out, "purchase_time")) if max_us is not None else None
        aggs = [F.count("*").alias("user_transaction_count"),
                F.avg("purchase_value").alias("__user_avg")]
        if "user_id" in entities and t is not None:
            aggs += _window_aggs(t, F.col("purchase_value"), "user_id", max_us, windows)
        user = out.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(*aggs)
        out = out.join(_sized(user, distinct.get("user_id"), len(aggs)), "user_id", "left")
        out = out.withColumn("user_transaction_count",
                             F.coalesce("user_transaction_count", F.lit(1).cast("bigint")))
        out = add_amount_log(out)
        out = out.withColumn("transaction_amount_per_user_avg",
                             F.try_divide(F.col("purchase_value"),
                                          F.col("__user_avg") + F.lit(1e-6))).drop("__user_avg")
        out = clip_ratio(out, "transaction_amount_per_user_avg", n_upper=n_rows)
        if "user_id" in entities and "purchase_time" in out.columns:
            names = window_feature_names("user_id", windows)
            out = out.withColumns({n: _no_activity(n) if t is None else F.coalesce(F.col(n), _no_activity(n))
                                   for n in names})
        rest = [e for e in entities if e != "user_id"]
    else:
        out = add_user_transaction_count(out)
        out = add_amount_log(out)
        out = add_amount_ratio(out)
        rest = entities
    for ent in rest:
        if ent in out.columns:
            out = add_time_window_features(out, "purchase_time", ent, "purchase_value",
                                           windows, max_us=max_us,
                                           n_entities=distinct.get(ent))
    return out


BROADCAST_MAX_BYTES = 256 << 20


def _sized(agg: DataFrame, n_entities: int | None, n_cols: int) -> DataFrame:
    """Broadcast a per-entity aggregate when its estimated size (distinct
    entities, HyperLogLog with 2 % error, times a 1.25 margin, times ~8
    bytes per column plus the key) fits the budget; the detail rows then
    are not shuffled at all. Otherwise a shuffle join (AQE splits skew)."""
    if n_entities is not None and n_entities * 1.25 * (8 * n_cols + 32) <= BROADCAST_MAX_BYTES:
        return F.broadcast(agg)
    return agg
