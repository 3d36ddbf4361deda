"""Output normalisation shared by every registered query and its SQL oracle.

Both sides emit integers as BIGINT and round doubles to the same number of
places, so that results can be compared across engines whose summation
order differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.BooleanType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            c = F.round(c.cast("double"), digits) + F.lit(0.0)  # -0.0 -> 0.0
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.unix_micros(c.cast("timestamp"))
        cols.append(c.alias(f.name))
    return df.select(*cols)


def final_sql(sql: str, doubles=(), ints=(), ts=(), digits: int = DIGITS) -> str:
    """Wrap oracle SQL so the listed columns get the same rounding / width
    (timestamps as epoch microseconds)."""
    rep = [f'round(CAST("{c}" AS DOUBLE), {digits}) + 0.0 AS "{c}"' for c in doubles]
    rep += [f'CAST("{c}" AS BIGINT) AS "{c}"' for c in ints]
    rep += [f'epoch_us("{c}") AS "{c}"' for c in ts]
    if not rep:
        return sql
    return f"SELECT * REPLACE ({', '.join(rep)}) FROM (\n{sql}\n) AS q"
