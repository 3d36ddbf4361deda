"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_MAX_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast hint only after counting the side (a proven bound); larger
    sides are left to the shuffle join (AQE may still broadcast at run time)."""
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def attach_country_codes(df: DataFrame, codes: DataFrame, name_col: str = "country",
                         out_col: str = "country_code") -> DataFrame:
    """Map country names to codes through a (country, code) table; unknown -> NULL."""
    c = codes.select(F.col("country").alias("__name"), F.col("code").alias(out_col))
    out = df.join(broadcast_if_small(c), F.col(name_col) == F.col("__name"), "left")
    return out.drop("__name")
