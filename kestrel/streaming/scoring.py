"""Structured Streaming jobs (J1-J5): score transactions as they arrive.

The batch side fits everything that needs statistics over history (fill
values, medians, the p99 cap, per-entity activity tables, the scaler and
encoder, the model). Each micro-batch is then scored without any statistic
of its own: casts, stored fills, a stream-static join to the IP pieces and
to the stored entity tables, the preprocessing expressions, the model and
the rules. A row therefore gets the same features and score whether it
arrives in a stream or is processed in the batch job.

Bad records (empty, not JSON) go to a reject sink in the same
``foreachBatch`` (J5). Velocity (J3) is a separate stateful query with a
watermark; stored entity features are refreshed by J4.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from kestrel import schemas as SC
from kestrel.functions.casts import epoch_micros, ip_to_int, nan_to_null
from kestrel.functions.stats import exact_quantiles
from kestrel.operators import cleaning as CL
from kestrel.operators import features as FE
from kestrel.operators import geo
from kestrel.operators import metrics as M
from kestrel.operators import rules as R
from kestrel.session import scratch_path
from kestrel.sources.files import parse_records
from kestrel.streaming.entity_store import EntityStore

ECOM_RECORD = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("signup_time", T.StringType()), T.StructField("purchase_time", T.StringType()),
    T.StructField("purchase_value", T.DoubleType()), T.StructField("device_id", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("browser", T.StringType()),
    T.StructField("sex", T.StringType()), T.StructField("age", T.DoubleType()),
    T.StructField("ip_address", T.StringType()), T.StructField("ip_int", T.LongType()),
    T.StructField("class", T.IntegerType()),
])

BANK_RECORD = T.StructType(
    [T.StructField("transaction_id", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in SC.BANK_FEATURES]
    + [T.StructField("Class", T.IntegerType())])


# Fitted state --------------------------------------------------------------------
@dataclass
class EcommerceState:
    """Everything a micro-batch needs, fitted once on the history table."""
    datetime_fill: dict = field(default_factory=dict)   # column -> epoch micros
    numeric_fill: dict = field(default_factory=dict)    # column -> value
    hours_median: float | None = None
    ratio_p99: float | None = None
    user_table: DataFrame | None = None                 # user_id -> count, avg, windows
    entity_tables: dict = field(default_factory=dict)   # entity -> window table
    pieces: DataFrame | None = None                     # IP pieces, made once
    windows: tuple = FE.DEFAULT_WINDOWS


def entity_table(history: DataFrame, ent: str, max_us: int, windows=FE.DEFAULT_WINDOWS,
                 with_user_stats: bool = False) -> DataFrame:
    """J4 core: per-entity activity aggregates anchored at ``max_us``."""
    t = epoch_micros(F.col("purchase_time"))
    aggs = FE._window_aggs(t, F.col("purchase_value"), ent, max_us, windows)
    if with_user_stats:
        aggs = [F.count("*").alias("user_transaction_count"),
                F.avg("purchase_value").alias("__user_avg")] + aggs
    return history.where(F.col(ent).isNotNull()).groupBy(ent).agg(*aggs)


def fit_ecommerce_state(history: DataFrame, ranges: DataFrame | None, ip_col: str = "ip_int",
                        entities=("user_id", "device_id", "ip_int"),
                        windows=FE.DEFAULT_WINDOWS) -> EcommerceState:
    """Fit on a history table. Fill values are those of the batch cleaning (C1, C2),
    for every column and not only those with nulls in the history; the other
    statistics are taken from the history with its nulls filled."""
    st = EcommerceState(windows=tuple(windows))
    typed = CL.correct_data_types(history, "ecommerce")
    st.datetime_fill = CL.fit_datetime_fills(typed)
    st.numeric_fill = CL.fit_numeric_fills(typed.select(*[c for c in SC.ECOM_NUMERIC if c in typed.columns]))
    st.pieces = geo.stored_pieces(ranges)
    hist = geo.map_ips_to_countries(filled(typed, st, ip_col), st.pieces, ip_col=ip_col)
    h = FE.hours_between(F.col("purchase_time"), F.col("signup_time"))
    hist = hist.withColumn("__h", F.when(h >= 0, h))
    st.hours_median = exact_quantiles(hist, "__h", [0.5])[0]
    max_us = FE.max_epoch_micros(hist, "purchase_time")
    # Stored tables are materialised once (reliable checkpoint) so micro-batches
    # join a fixed table instead of re-aggregating the history every batch;
    # each is broadcast only after its row count is checked.
    st.user_table = _stored(entity_table(hist, "user_id", max_us, windows, with_user_stats=True))
    ratio = F.try_divide(F.col("purchase_value"), F.col("__user_avg") + F.lit(1e-6))
    rt = hist.join(st.user_table.select("user_id", "__user_avg"), "user_id", "left") \
        .select(ratio.alias("r"))
    st.ratio_p99 = exact_quantiles(rt, "r", [0.99])[0]
    for ent in entities:
        if ent != "user_id":
            st.entity_tables[ent] = _stored(entity_table(hist, ent, max_us, windows))
    return st


def _stored(table: DataFrame) -> DataFrame:
    from kestrel.functions.joins import broadcast_if_small
    from kestrel.session import cut_lineage
    return broadcast_if_small(cut_lineage(table))


def filled(typed: DataFrame, st: EcommerceState, ip_col: str = "ip_int") -> DataFrame:
    """Stored fills for datetimes and numbers, 'Unknown' for text, and the address
    as a number, from its dotted or digit text where it has no number yet."""
    out = typed
    if "ip_address" in out.columns and ip_col != "ip_address":
        parsed = ip_to_int(F.col("ip_address"), out.schema["ip_address"].dataType)
        out = out.withColumn(ip_col, F.coalesce(F.col(ip_col), parsed) if ip_col in out.columns else parsed)
    fills = {c: F.coalesce(F.col(c), F.timestamp_micros(F.lit(v))) for c, v in st.datetime_fill.items() if c in out.columns}
    fills.update({c: F.coalesce(nan_to_null(F.col(c).cast("double")), F.lit(v))
                  for c, v in st.numeric_fill.items() if c in out.columns})
    out = out.withColumns(fills) if fills else out
    return CL.impute_categorical(out, protect=("ip_address",))


def ecommerce_features_stream(batch: DataFrame, st: EcommerceState, ranges: DataFrame | None = None,
                              ip_col: str = "ip_int") -> DataFrame:
    """The E8 feature table for new rows, using only stored statistics."""
    out = filled(CL.correct_data_types(batch, "ecommerce"), st, ip_col)
    out = geo.map_ips_to_countries(out, st.pieces if st.pieces is not None else ranges, ip_col=ip_col)
    out = FE.add_time_parts(out)
    h = FE.hours_between(F.col("purchase_time"), F.col("signup_time"))
    hours = F.when(h >= 0, h)
    if st.hours_median is not None:
        hours = F.coalesce(hours, F.lit(float(st.hours_median)))
    out = out.withColumn("time_since_signup_hours", hours)
    out = out.join(st.user_table, "user_id", "left")
    out = out.withColumn("user_transaction_count",
                         F.coalesce("user_transaction_count", F.lit(1).cast("bigint")))
    out = FE.add_amount_log(out)
    r = F.try_divide(F.col("purchase_value"), F.col("__user_avg") + F.lit(1e-6))
    if st.ratio_p99 is not None:
        p = F.lit(float(st.ratio_p99))
        r = F.when(r > p, p).otherwise(r)
    out = out.withColumn("transaction_amount_per_user_avg", F.coalesce(r, F.lit(1.0))).drop("__user_avg")
    for ent, tbl in st.entity_tables.items():
        out = out.join(tbl, ent, "left")
    zero = {}
    for ent in ["user_id", *st.entity_tables]:
        for n in FE.window_feature_names(ent, st.windows):
            zero[n] = F.coalesce(F.col(n), F.lit(0).cast("bigint") if "_count_" in n else F.lit(0.0))
    return out.withColumns(zero)


MOST_HOURS = 10_000
HOUR_SECONDS = 3600
_WINDOWS = "window_start timestamp, window_end timestamp, user_id bigint, n bigint"


def _hour(t):
    return F.floor(F.unix_seconds(t.cast("timestamp")) / HOUR_SECONDS).cast("bigint")


def windows_near(df: DataFrame, velocity_dir: str, time_col: str = "purchase_time", window_hours: int = 1) -> DataFrame:
    """The velocity windows (J3) that can hold a row of ``df``. Of a sink written
    ``by_hour`` only the folders of the rows' hours are read, so the work follows the
    batch and not the age of the stream; with more than ``MOST_HOURS`` different hours
    in one batch all folders are. An absent or empty sink has no windows."""
    spark = df.sparkSession
    try:
        windows = spark.read.parquet(velocity_dir)
    except AnalysisException:   # no window has closed yet
        return spark.createDataFrame([], _WINDOWS)
    if "start_hour" not in windows.columns:
        return windows
    hours = [r["h"] for r in df.select(_hour(F.col(time_col)).alias("h")).where("h is not null").distinct().limit(MOST_HOURS + 1).collect()]
    if len(hours) <= MOST_HOURS:
        windows = windows.where(F.col("start_hour").isin(sorted({h - k for h in hours for k in range(window_hours + 1)})))
    return windows.drop("start_hour")


def with_velocity(df: DataFrame, windows: DataFrame, user_col: str = "user_id",
                  time_col: str = "purchase_time") -> DataFrame:
    """``txn_velocity``: the largest count among the user's velocity windows
    that hold the row's time; null without one."""
    w = windows.select(F.col(user_col).alias("__u"), "window_start", "window_end", F.col("n").alias("__n"))
    t = F.col(time_col)
    keyed = df.withColumn("__row", F.monotonically_increasing_id())
    hit = (keyed.select("__row", user_col, time_col)
           .join(w, (F.col(user_col) == F.col("__u")) & (t >= F.col("window_start")) & (t < F.col("window_end")))
           .groupBy("__row").agg(F.max("__n").alias("txn_velocity")))
    return keyed.join(hit, "__row", "left").drop("__row")


def score_decide(feats: DataFrame, scorer, codes: DataFrame | None = None,
                 rules: dict | None = None, threshold: float = M.DEFAULT_THRESHOLD,
                 explain=None) -> DataFrame:
    """Model probability, ``is_fraud`` at ``threshold`` and the decision.
    ``scorer(df)`` adds ``fraud_probability``; ``explain(df)``, optional, adds
    ``top_features`` and ``base_value``. ``txn_velocity`` comes from the velocity
    stream (``with_velocity``); without it it is NULL and its condition does not
    fire."""
    from kestrel.functions.joins import attach_country_codes
    s = scorer(feats)
    if explain is not None:
        s = explain(s)
    if codes is not None:
        s = attach_country_codes(s.withColumnRenamed("country", "country_name"), codes,
                                 "country_name", "country")
    extra = {"time_since_signup": F.col("time_since_signup_hours"),
             "threshold": F.lit(float(threshold)),
             "is_fraud": (F.col("fraud_probability") >= F.lit(float(threshold))).cast("int")}
    if "txn_velocity" not in s.columns:
        extra["txn_velocity"] = F.lit(None).cast("bigint")
    return R.decide(s.withColumns(extra), rules)


def _sink(df: DataFrame, path: str, epoch: int) -> None:
    """Write a micro-batch into the folder of its number: a replayed batch replaces
    what its first run wrote."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={epoch}")


def _started(lines: DataFrame, handle, checkpoint: str, available_now: bool, every: str) -> StreamingQuery:
    def once(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()   # read by the scored rows and by the rejects
        try:
            handle(held, epoch)
        finally:
            held.unpersist()

    w = lines.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=every)).start()


# J1 / J5 -------------------------------------------------------------------------
def start_ecommerce_scoring(spark: SparkSession, source_dir: str, out_dir: str, reject_dir: str,
                            st: EcommerceState, ranges: DataFrame | None, scorer,
                            codes: DataFrame | None = None, checkpoint: str | None = None,
                            max_files_per_trigger: int = 1, available_now: bool = True,
                            keep=("event_id", "user_id", "class"), threshold: float = M.DEFAULT_THRESHOLD,
                            explain=None, velocity_dir: str | None = None, table_dir: str | None = None,
                            extra=()) -> StreamingQuery:
    """JSON lines in ``source_dir`` -> scored rows (parquet) in ``out_dir``;
    records that do not parse go to ``reject_dir`` (J5). ``velocity_dir`` is J3's
    sink and ``table_dir`` J4's; every micro-batch reads the hours and the entities
    that it needs from them. Neither has to exist before the first row."""
    lines = (spark.readStream.option("maxFilesPerTrigger", max_files_per_trigger)
             .text(source_dir))

    def handle(batch: DataFrame, epoch: int) -> None:
        good, bad = parse_records(batch, ECOM_RECORD)
        _sink(bad, reject_dir, epoch)
        fresh = latest_table(spark, table_dir, only=good.where("user_id is not null")) if table_dir else None
        state = st if fresh is None else replace(st, user_table=fresh)
        feats = ecommerce_features_stream(good, state, ranges)
        if velocity_dir:
            feats = with_velocity(feats, windows_near(feats, velocity_dir))
        out = score_decide(feats, scorer, codes, threshold=threshold, explain=explain)
        cols = [*keep, "country", "fraud_probability", "is_fraud", "threshold", "decision", "fired_rules"]
        cols += ["top_features", "base_value"] if explain is not None else []
        _sink(out.select(*cols, *extra), out_dir, epoch)

    return _started(lines, handle, checkpoint or scratch_path(spark, "ecom-scoring"), available_now, "10 seconds")


# J2 ----------------------------------------------------------------------------
def start_bank_scoring(spark: SparkSession, source_dir: str, out_dir: str, reject_dir: str,
                       numeric_fill: dict, preprocessor, scorer, checkpoint: str | None = None,
                       available_now: bool = True, threshold: float = M.DEFAULT_THRESHOLD,
                       explain=None) -> StreamingQuery:
    """Card records -> stored fills -> stored scaler -> model -> decision. The
    amount is the purchase value of the rules."""
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(source_dir)

    def handle(batch: DataFrame, epoch: int) -> None:
        good, bad = parse_records(batch, BANK_RECORD)
        _sink(bad, reject_dir, epoch)
        x = good.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in numeric_fill.items()
                              if v is not None and c in good.columns})
        x = preprocessor.transform(x.withColumn("purchase_value", F.col("Amount")),
                                   keep=["transaction_id", "Class", "purchase_value"])
        s = x.withColumns({"country": F.lit(None).cast("string"),
                           "time_since_signup_hours": F.lit(None).cast("double")})
        s = score_decide(s, scorer, threshold=threshold, explain=explain)
        cols = ["transaction_id", "Class", "fraud_probability", "is_fraud", "threshold", "decision"]
        cols += ["top_features", "base_value"] if explain is not None else []
        _sink(s.select(*cols), out_dir, epoch)

    return _started(lines, handle, checkpoint or scratch_path(spark, "bank-scoring"), available_now, "10 seconds")


# J3 ----------------------------------------------------------------------------
def velocity_windows(df: DataFrame, window: str = "1 hour", slide: str = "5 minutes",
                     watermark: str | None = "10 minutes", limit: int = 5,
                     user_col: str = "user_id", time_col: str = "purchase_time") -> DataFrame:
    """Sliding-window transaction counts per user, rows with count > limit.
    With a watermark (streams) rows later than it are dropped and a window
    is emitted once closed; without (batch) every window is returned."""
    t = F.col(time_col).cast("timestamp")
    x = df.withColumn(time_col, t)
    if watermark:
        x = x.withWatermark(time_col, watermark)
    agg = x.groupBy(F.window(time_col, window, slide).alias("w"), F.col(user_col)) \
        .agg(F.count("*").alias("n"))
    return agg.where(F.col("n") > limit).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), user_col, "n")


def start_velocity_stream(spark: SparkSession, source_dir: str, out_dir: str, limit: int = 5,
                          checkpoint: str | None = None, available_now: bool = True, by_hour: bool = False) -> StreamingQuery:
    """JSON records -> watermarked sliding counts -> parquet (append). ``by_hour``
    lays the windows out in one folder per hour of their start, from which J1 reads
    only the hours of its batch."""
    s = (spark.readStream.schema(ECOM_RECORD).option("maxFilesPerTrigger", 1).json(source_dir))
    s = s.withColumn("purchase_time", F.to_timestamp("purchase_time"))
    windows = velocity_windows(s, limit=limit)
    if by_hour:
        windows = windows.withColumn("start_hour", _hour(F.col("window_start")))
    q = windows.writeStream.format("parquet").outputMode("append").option("path", out_dir) \
        .option("checkpointLocation", checkpoint or scratch_path(spark, "velocity"))
    q = q.partitionBy("start_hour") if by_hour else q
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="10 seconds")
    return _start_with_state_partitions(spark, q)


def _start_with_state_partitions(spark: SparkSession, writer) -> StreamingQuery:
    """The number of state partitions is fixed when a stateful query first
    starts (taken from ``spark.sql.shuffle.partitions``). On a cluster the
    session's value is used as is; in local mode it is sized to the cores for
    the start and the session value is restored right after."""
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        return writer.start()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(sc.defaultParallelism))
    try:
        return writer.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


# J4 ----------------------------------------------------------------------------
def start_entity_refresh(spark: SparkSession, source_dir: str, history_dir: str, table_dir: str,
                         entity: str = "user_id", windows=FE.DEFAULT_WINDOWS,
                         checkpoint: str | None = None, available_now: bool = True,
                         with_user_stats: bool = False) -> StreamingQuery:
    """Merge each micro-batch into the entity's activity (``EntityStore``) and
    publish a version. The work of a batch follows the batch; windows are anchored at
    the newest row, and readers derive every entity's totals from the anchor.
    ``history_dir`` holds the partials, ``table_dir`` the versions; both belong to the
    checkpoint."""
    s = spark.readStream.schema(ECOM_RECORD).option("maxFilesPerTrigger", 1).json(source_dir)
    store = EntityStore(spark, history_dir, table_dir, entity, windows)
    spark.range(1).select(F.lit(history_dir).alias("data_dir"), F.lit(with_user_stats).alias("with_user_stats")) \
        .coalesce(1).write.mode("overwrite").json(f"{table_dir}/layout")

    def handle(batch: DataFrame, epoch: int) -> None:
        store.add(batch.withColumn("purchase_time", F.to_timestamp("purchase_time")), epoch)

    return _started(s, handle, checkpoint or scratch_path(spark, "entity-refresh"), available_now, "1 minute")


def latest_table(spark: SparkSession, table_dir: str, only: DataFrame | None = None) -> DataFrame | None:
    """The activity table of the newest version that J4 published, or None before the
    first; ``only`` restricts it to the entities of some rows."""
    try:
        layout = spark.read.schema("data_dir string, with_user_stats boolean").json(f"{table_dir}/layout").first()
    except AnalysisException:   # nothing published yet
        return None
    found = EntityStore.opened(spark, layout["data_dir"], table_dir)
    return None if found is None else found[0].table(found[1], layout["with_user_stats"], only)


SLICE_ROWS = 100_000


def write_in_time_order(df: DataFrame, path: str, n: int = 4,
                        time_col: str = "purchase_time") -> None:
    """Write rows as JSON files in ``n`` time slices, one append per slice,
    so a file stream sees them in time order (files are taken by modification
    time). Slices hold about ``SLICE_ROWS`` rows at most, so the one file and task
    of each stays small. Cut points come from ``percentile_approx``. The rows are
    computed once and laid out by slice, so what ``df`` joins or aggregates never runs
    inside the one task of a slice."""
    spark = df.sparkSession
    base = scratch_path(spark, "time-order")
    timed = df.withColumn("__t", F.unix_micros(F.col(time_col).cast("timestamp")))
    timed.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
                       for c in ("signup_time", "purchase_time") if c in df.columns}).write.parquet(f"{base}/rows")
    rows = spark.read.parquet(f"{base}/rows")
    n = max(n, math.ceil(rows.count() / SLICE_ROWS))
    cuts = sorted(set(rows.agg(F.percentile_approx("__t", [i / n for i in range(1, n)], 10_000)).first()[0]))
    number = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col("__t")))
    (rows.where("__t is not null").withColumn("__slice", number).drop("__t").repartition(len(cuts) + 1, "__slice")
     .write.partitionBy("__slice").parquet(f"{base}/slices"))
    slices = spark.read.parquet(f"{base}/slices")
    for i in range(len(cuts) + 1):
        slices.where(F.col("__slice") == i).drop("__slice").coalesce(1).write.mode("append").json(path)


def linear_scorer(coef: dict, intercept: float, means: dict | None = None):
    """A scorer for a linear model with known weights."""
    from kestrel.operators.metrics import linear_margin

    def fn(df: DataFrame) -> DataFrame:
        m = linear_margin(df, coef, intercept, means)
        return df.withColumn("fraud_probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-m)))
    return fn


def linear_explainer(coef: dict, intercept: float, means: dict, top: int = 5):
    """The ``top`` contributions of a linear model as an array, and its base value."""
    base = float(intercept) + sum(float(w) * float(means[c]) for c, w in coef.items())

    def fn(df: DataFrame) -> DataFrame:
        items = []
        for c, w in coef.items():
            v = F.lit(float(w)) * (F.coalesce(F.col(c).cast("double"), F.lit(float(means[c]))) - F.lit(float(means[c])))
            items.append(F.struct(F.abs(v).alias("a"), F.lit(c).alias("feature"), v.alias("contribution")))
        ranked = F.slice(F.sort_array(F.array(*items), asc=False), 1, top)
        return df.withColumns({"top_features": F.transform(ranked, lambda x: F.struct(x["feature"].alias("feature"), x["contribution"].alias("contribution"))),
                               "base_value": F.lit(base)})
    return fn


def model_scorer(model):
    """A scorer for a fitted Spark ML PipelineModel (assembler + classifier)."""
    from kestrel.plans.models import positive_probability

    def fn(df: DataFrame) -> DataFrame:
        out = positive_probability(model.transform(df))
        return out.drop("features", "rawPrediction", "probability", "prediction")
    return fn
