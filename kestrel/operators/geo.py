"""IP address to country: cleaning the range table and the as-of range join.

Semantics: for each address take the range with the largest lower bound not
above it (ties on the lower bound: the largest (upper, country)), and keep
its country only if the address is also within that range's upper bound;
otherwise, and for NULL / invalid addresses, the country is 'Unknown'. All
input rows are kept.

Plan (no nested-loop join, no per-row Python):
1. Truncate every range at the next lower bound - 1. The pieces are disjoint,
   and containment in a piece equals the rule above, also for nested,
   overlapping and tied ranges. The "next lower bound" is a ``lead`` inside a
   /16 bucket of the lower bound (parallel), plus the first lower bound of the
   next non-empty bucket (a window over at most 65,536 rows).
2. Explode each piece over the /16 buckets it touches. Because pieces are
   disjoint this adds at most 65,536 rows to the range count.
3. Equi left join on the address's /16 bucket with a ``between`` check: a hash
   join that returns at most one piece per address. The range side is
   broadcast only when its counted size is below ``broadcast_max_rows``;
   otherwise it is a shuffle join (AQE still splits skewed address buckets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.casts import ip_to_int

UNKNOWN = "Unknown"
BUCKET_BITS = 16
MAX_IP = 4294967295
BROADCAST_MAX_ROWS = 2_000_000

LOWER, UPPER, COUNTRY = "lower_bound_ip_address", "upper_bound_ip_address", "country"


def clean_ranges(ranges: DataFrame) -> DataFrame:
    """A4: validate, cast and keep usable ranges.

    Missing required columns give an empty table. Bounds are read as numbers
    (text or numeric); a fractional bound or a non-number drops that row.
    """
    need = {LOWER, UPPER, COUNTRY}
    spark = ranges.sparkSession
    if not need.issubset(ranges.columns):
        return spark.createDataFrame([], f"{LOWER} bigint, {UPPER} bigint, {COUNTRY} string")

    types = {f.name: f.dataType for f in ranges.schema.fields}

    def bound(c):
        t = types[c]
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            return F.col(c).cast("bigint")
        if isinstance(t, T.StringType):
            d = F.trim(F.col(c)).try_cast("double")
        else:
            d = F.col(c).try_cast("double")
        return F.when(d.isNotNull() & ~F.isnan(d) & (d == F.floor(d)), d.try_cast("bigint"))

    return (ranges.select(bound(LOWER).alias(LOWER), bound(UPPER).alias(UPPER),
                          F.col(COUNTRY).cast("string").alias(COUNTRY))
            .where(F.col(LOWER).isNotNull() & F.col(UPPER).isNotNull()))


def range_pieces(ranges: DataFrame) -> DataFrame:
    """Disjoint pieces (lo, hi, country, bucket), one row per /16 bucket touched."""
    # Addresses live in 0..2^32-1: pieces are clamped to that, so no bound, however
    # large, makes more than 2^16 buckets. Ties are broken on the bounds as given.
    r = (ranges.where((F.col(UPPER) >= 0) & (F.col(LOWER) <= MAX_IP))
         .select(F.greatest(F.col(LOWER), F.lit(0).cast("bigint")).alias("lo"),
                 F.least(F.col(UPPER), F.lit(MAX_IP).cast("bigint")).alias("up"), F.col(COUNTRY).alias("country"),
                 F.col(LOWER).alias("given"), F.col(UPPER).alias("given_up")))
    r = r.withColumn("b", F.shiftright("lo", BUCKET_BITS))
    in_bucket = Window.partitionBy("b").orderBy("lo", "given", "given_up", "country")
    r = r.withColumn("next_lo", F.lead("lo").over(in_bucket))
    # First lower bound of the next non-empty bucket: one row per bucket, so
    # this global window is bounded by 2^16 rows whatever the table size.
    firsts = r.groupBy("b").agg(F.min("lo").alias("first_lo"))
    firsts = firsts.select("b", F.lead("first_lo").over(Window.orderBy("b")).alias("next_b_lo"))
    r = r.join(F.broadcast(firsts), "b")
    nxt = F.coalesce("next_lo", "next_b_lo")
    hi = F.when(nxt.isNull(), F.col("up")).otherwise(F.least(F.col("up"), nxt - 1))
    r = r.select("lo", hi.alias("hi"), "country").where(F.col("hi") >= F.col("lo"))
    first_b, last_b = F.shiftright("lo", BUCKET_BITS), F.shiftright("hi", BUCKET_BITS)
    return r.select("lo", "hi", "country",
                    F.explode(F.sequence(first_b, last_b)).alias("bucket"))


def stored_pieces(ranges: DataFrame | None, broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame | None:
    """The pieces of a range table, made once (reliable checkpoint) for jobs that
    look addresses up again and again; broadcast when their count allows it."""
    from kestrel.session import cut_lineage
    if ranges is None:
        return None
    pieces = cut_lineage(range_pieces(ranges))
    return F.broadcast(pieces) if pieces.count() <= broadcast_max_rows else pieces


def map_ips_to_countries(df: DataFrame, ranges: DataFrame | None, ip_col: str = "ip_address",
                         out_col: str = "country",
                         broadcast_max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Add ``out_col`` (country or 'Unknown') to every row of ``df``.

    ``ranges`` is a cleaned range table (``clean_ranges``), or the pieces made
    from one by ``stored_pieces``. No ranges or no address column gives
    'Unknown' for every row.
    """
    if ranges is None or ip_col not in df.columns:
        return df.withColumn(out_col, F.lit(UNKNOWN))
    pieces = ranges
    if "bucket" not in ranges.columns:
        pieces = range_pieces(ranges)
        n_pieces = pieces.count()
        if n_pieces == 0:
            return df.withColumn(out_col, F.lit(UNKNOWN))
        if n_pieces <= broadcast_max_rows:
            pieces = F.broadcast(pieces)
    ip = ip_to_int(F.col(ip_col), df.schema[ip_col].dataType)
    keyed = df.withColumn("__ip", ip).withColumn("__b", F.shiftright("__ip", BUCKET_BITS))
    cond = (F.col("__b") == F.col("__p.bucket")) & F.col("__ip").between(F.col("__p.lo"),
                                                                          F.col("__p.hi"))
    joined = keyed.join(pieces.alias("__p"), cond, "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col],
                         F.coalesce(F.col("__p.country"), F.lit(UNKNOWN)).alias(out_col))
