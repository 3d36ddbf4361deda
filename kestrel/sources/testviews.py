"""Fixture views over ``/root/testdata``: the transaction shapes the library works on.

The test tables carry no fraud label and no nulls, so these views derive the
e-commerce, card, resampling and scored shapes from existing columns with
plain arithmetic (FIXTURES.md part B). Each is an ordinary lazy DataFrame over
the parquet scan, so its size grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel import session as S
from kestrel.functions.casts import int_to_ip

TWO32 = 4294967296
# Fixed values of the fixture definitions.
IP_MULTIPLIER = 2654435761
NATION_RANGE_STEP = 171798691
NATION_RANGE_WIDTH = 120000000
CUSTOMER_RANGE_STEP = 286331
CUSTOMER_RANGE_WIDTH = 200000
OPEN_RANGES, OPEN_RANGE_STEP, OPEN_RANGE_TOP = 6, 600000000, 4294968000
WIDE_RANGE = (0, 4294967295, "WIDE")


SPREAD_MIN_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table. A file written as a single row group scans as one
    task whatever its size; when such a table is over 1 MB and arrives in
    fewer partitions than the session has cores, it is spread round-robin
    so the row-level work runs on every core. Multi-row-group inputs (any
    real data set) already scan in parallel and are left as they are."""
    S.prepare(spark)
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    df = spark.read.parquet(path)
    par = spark.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < par and _size(spark, path) >= SPREAD_MIN_BYTES:
        df = df.repartition(par)
    return df


def _size(spark: SparkSession, path: str) -> int:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getContentSummary(p).getLength()


def _mulmod32(x, c: int):
    """(x * c) mod 2^32 without 64-bit overflow for any non-negative bigint x."""
    x = F.pmod(x, F.lit(TWO32))
    hi = F.shiftright(x, 16)
    lo = x.bitwiseAND(65535)
    return F.pmod(F.pmod(hi * F.lit(c), F.lit(TWO32)) * 65536 + lo * F.lit(c), F.lit(TWO32))


def events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id",
                    "event_type", "value",
                    F.regexp_extract("props", "([0-9]+)", 1).try_cast("int").alias("k"))


def tx(spark: SparkSession, sf_dir: str, keep_k: bool = False,
       null_signup: str | None = None) -> DataFrame:
    """B1: one e-commerce purchase per ``events`` purchase row.

    ``null_signup``: None, ``'impute'`` (about 3.4 % null signup times) or
    ``'drop'`` (about 9 %), to exercise both datetime branches of cleaning.
    """
    e = events_k(spark, sf_dir)
    su = (e.where(F.col("event_type") == "signup").groupBy("user_id")
          .agg(F.min("ts").alias("signup_time")))
    p = e.where(F.col("event_type") == "purchase").join(su, "user_id", "left")
    k, eid, uid = F.col("k"), F.col("event_id"), F.col("user_id")
    signup = F.col("signup_time")
    if null_signup == "impute":
        signup = F.when(eid % 29 == 0, F.lit(None).cast("timestamp")).otherwise(signup)
    elif null_signup == "drop":
        signup = F.when(eid % 11 == 0, F.lit(None).cast("timestamp")).otherwise(signup)
    cols = [
        eid, uid, signup.alias("signup_time"), F.col("ts").alias("purchase_time"),
        F.col("value").alias("purchase_value"),
        F.concat(F.lit("D"), (k % 40).cast("string")).alias("device_id"),
        F.when(k % 3 == 0, "SEO").when(k % 3 == 1, "Ads").otherwise("Direct").alias("source"),
        F.when(eid % 19 == 0, F.lit(None)).when(k % 4 == 0, "Chrome").when(k % 4 == 1, "Firefox")
        .when(k % 4 == 2, "Safari").otherwise("Edge").alias("browser"),
        F.when(uid % 2 == 0, "M").otherwise("F").alias("sex"),
        F.when(eid % 23 == 0, F.lit(None).cast("double"))
        .otherwise((18 + uid % 50).cast("double")).alias("age"),
        _mulmod32(eid, IP_MULTIPLIER).alias("ip_int"),
        F.when((k >= 90) | (F.col("value") > 150), 1).otherwise(0).alias("class"),
    ]
    if keep_k:
        cols.append(k)
    return p.select(*cols)


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1 as text, the way a CSV export arrives: both datetime layouts, bad
    datetimes, bad numbers, digit-string and malformed IP addresses."""
    t = tx(spark, sf_dir)
    eid = F.col("event_id")
    signup = (F.when(eid % 29 == 0, F.lit(None).cast("string"))
              .when(eid % 31 == 0, F.lit("not a date"))
              .when(eid % 2 == 0, F.date_format("signup_time", "yyyy-MM-dd HH:mm:ss"))
              .otherwise(F.date_format("signup_time", "yyyy-MM-dd")))
    value = (F.when(eid % 37 == 0, F.lit("n/a"))
             .otherwise(F.col("purchase_value").cast("string")))
    ip = (F.when(eid % 13 == 0, F.col("ip_int").cast("string"))
          .when(eid % 13 == 1, F.lit("bad.ip.addr"))
          .when(eid % 13 == 2, F.lit(None).cast("string"))
          .otherwise(int_to_ip("ip_int")))
    return t.select(
        "event_id", "user_id", signup.alias("signup_time"),
        F.date_format("purchase_time", "yyyy-MM-dd HH:mm:ss").alias("purchase_time"),
        value.alias("purchase_value"), "device_id", "source", "browser", "sex",
        F.col("age").cast("bigint").cast("string").alias("age"),
        ip.alias("ip_address"), "class")


def ip_ranges(spark: SparkSession, sf_dir: str, variant: str = "nation") -> DataFrame:
    """B2: disjoint ranges with gaps (``nation``), many small ranges
    (``customer``), the nation ranges plus one range over everything
    (``overlap``), or ranges with shared lower bounds whose upper bounds lie above
    the largest address, the smaller names reaching further (``open``)."""
    if variant == "customer":
        c = table(spark, sf_dir, "customer")
        lo = F.col("c_custkey").cast("bigint") * CUSTOMER_RANGE_STEP
        return c.select(lo.alias("lower_bound_ip_address"),
                        (lo + CUSTOMER_RANGE_WIDTH).alias("upper_bound_ip_address"),
                        F.col("c_name").alias("country"))
    n = table(spark, sf_dir, "nation")
    if variant == "open":
        key = F.col("n_nationkey").cast("bigint")
        return n.select((key % OPEN_RANGES * OPEN_RANGE_STEP).alias("lower_bound_ip_address"),
                        (OPEN_RANGE_TOP - key).alias("upper_bound_ip_address"), F.col("n_name").alias("country"))
    lo = F.col("n_nationkey").cast("bigint") * NATION_RANGE_STEP
    r = n.select(lo.alias("lower_bound_ip_address"),
                 (lo + NATION_RANGE_WIDTH).alias("upper_bound_ip_address"),
                 F.col("n_name").alias("country"))
    if variant == "overlap":
        # One extra fixed row on top of the data-derived ranges.
        wide = n.limit(1).select(F.lit(WIDE_RANGE[0]).cast("bigint").alias("lower_bound_ip_address"),
                                 F.lit(WIDE_RANGE[1]).cast("bigint").alias("upper_bound_ip_address"),
                                 F.lit(WIDE_RANGE[2]).alias("country"))
        r = r.unionByName(wide)
    return r


def ip_ranges_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B2 as text with a fractional bound, a non-number and a missing bound,
    for the range-table cleaning step."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    lo = key.cast("bigint") * NATION_RANGE_STEP
    lo_txt = (F.when(key % 7 == 3, F.concat(lo.cast("string"), F.lit(".5")))
              .when(key % 11 == 5, F.lit("abc")).otherwise(lo.cast("string")))
    up_txt = F.when(key % 13 == 4, F.lit(None).cast("string")).otherwise(
        (lo + NATION_RANGE_WIDTH).cast("string"))
    return n.select(lo_txt.alias("lower_bound_ip_address"),
                    up_txt.alias("upper_bound_ip_address"), F.col("n_name").alias("country"))


def bank_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card-transaction shape, one row per ``lineitem`` row."""
    li = table(spark, sf_dir, "lineitem")
    t0 = F.unix_seconds(F.lit("1995-01-01 00:00:00").cast("timestamp"))
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        (F.unix_seconds(F.col("l_shipdate").cast("timestamp")) - t0).cast("double").alias("Time"),
        F.col("l_quantity").cast("double").alias("V1"),
        F.col("l_discount").cast("double").alias("V2"),
        F.col("l_tax").cast("double").alias("V3"),
        F.col("l_linenumber").cast("double").alias("V4"),
        F.col("l_extendedprice").cast("double").alias("Amount"),
        F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") > 40), 1).otherwise(0)
        .alias("Class"))


def bank_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B3 as text, with unparseable amounts and times."""
    b = bank_tx(spark, sf_dir)
    ok = F.col("l_orderkey")
    amount = F.when(ok % 41 == 0, F.lit("n/a")).otherwise(F.col("Amount").cast("string"))
    time = F.when(ok % 43 == 0, F.lit(None).cast("string")).otherwise(F.col("Time").cast("string"))
    return b.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    time.alias("Time"), *[F.col(c).cast("string").alias(c) for c in
                                          ("V1", "V2", "V3", "V4")],
                    amount.alias("Amount"), "Class")


def vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resampling input, minority = label 0."""
    e = table(spark, sf_dir, "embeddings")
    return e.select("vec_id", "embedding",
                    F.when(F.col("label") == 0, 1).otherwise(0).alias("y"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx`` with a fixed score in 0..1 (no model involved)."""
    t = tx(spark, sf_dir, keep_k=True)
    s = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                (F.col("k") + F.col("purchase_value") / 10) / 150)), 4)
    return t.withColumn("score", s)


# Fixed values of the fixture: codes for the first four nations so that the
# country rules fire; the other nations get a neutral code.
FIXTURE_CODES = ("NG", "RU", "BY", "KP")


def country_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country, code) for the nation names the range view produces."""
    n = table(spark, sf_dir, "nation")
    key = F.col("n_nationkey")
    code = F.concat(F.lit("N"), key.cast("string"))
    for i, c in enumerate(FIXTURE_CODES):
        code = F.when(key == i, F.lit(c)).otherwise(code)
    return n.select(F.col("n_name").alias("country"), code.alias("code"))
