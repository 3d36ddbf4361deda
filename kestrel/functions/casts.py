"""Column-level casts that coerce bad input to NULL instead of failing.

All are plain Catalyst expressions (they stay inside whole-stage codegen);
Spark 4 runs with ANSI mode on, so every coercion goes through ``try_*``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The text layouts accepted as datetimes, tried in this order.
DATETIME_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd",
)

MICROS_PER_HOUR = 3_600_000_000.0
MICROS_PER_DAY = 86_400_000_000


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_utc(c, dtype: T.DataType | None = None) -> Column:
    """``to_datetime(utc=True, errors='coerce')``: text in any accepted layout, or a
    timestamp / date value, to a UTC timestamp; anything else becomes NULL."""
    c = _col(c)
    if dtype is not None and isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    s = F.trim(c.cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(fmt)) for fmt in DATETIME_FORMATS])


def to_double(c, dtype: T.DataType | None = None) -> Column:
    """``to_numeric(errors='coerce')`` as a nullable double; NaN becomes NULL."""
    c = _col(c)
    if dtype is not None and isinstance(dtype, T.StringType):
        x = F.trim(c).try_cast("double")
    else:
        x = c.try_cast("double")
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def nan_to_null(c) -> Column:
    c = _col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def ip_to_int(c, dtype: T.DataType | None = None) -> Column:
    """IPv4 text or number to its integer value.

    Dotted quads ``a.b.c.d`` give ``a<<24 | b<<16 | c<<8 | d`` (each octet must be
    0..255); a digit string is read as the integer itself; a number is truncated
    toward zero. Anything else is NULL.
    """
    c = _col(c)
    if dtype is not None and isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return c.cast("bigint")
    if dtype is not None and isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        d = c.cast("double")
        return F.when(F.isnan(d), F.lit(None).cast("bigint")).otherwise(d.try_cast("bigint"))
    s = F.trim(c.cast("string"))
    parts = F.split(s, r"\.", -1)
    octets = [F.get(parts, i).try_cast("int") for i in range(4)]
    valid = F.lit(True)
    for o in octets:
        valid = valid & o.isNotNull() & o.between(0, 255)
    dotted = (octets[0].cast("bigint") * 16777216 + octets[1].cast("bigint") * 65536
              + octets[2].cast("bigint") * 256 + octets[3].cast("bigint"))
    return (F.when(s.contains("."),
                   F.when((F.size(parts) == 4) & valid, dotted))
            .otherwise(s.try_cast("bigint")))


def int_to_ip(c) -> Column:
    """Integer to dotted-quad text (inverse of ``ip_to_int`` on 0..2^32-1)."""
    c = _col(c).cast("bigint")
    return F.concat_ws(".", *[F.shiftright(c, s).bitwiseAND(255).cast("string")
                              for s in (24, 16, 8, 0)])


def epoch_micros(c) -> Column:
    """Microseconds since the epoch of a timestamp (UTC session)."""
    return F.unix_micros(_col(c).cast("timestamp"))


def hours_between(later, earlier) -> Column:
    """Signed duration in hours, exact to the microsecond."""
    return (epoch_micros(later) - epoch_micros(earlier)) / F.lit(MICROS_PER_HOUR)
