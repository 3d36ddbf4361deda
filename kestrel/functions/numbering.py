"""Consecutive numbers in sorted order without a single sorting task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

CHUNK_ROWS = 50_000


def range_chunks(rows: DataFrame, order: list[str], chunk_rows: int = CHUNK_ROWS, out: str = "__chunk") -> DataFrame:
    """The rows dealt to ranges of about ``chunk_rows`` in the given order, with the
    range's number; written, so the numbers stay."""
    rows = cut_lineage(rows)
    n = max(1, -(-rows.count() // chunk_rows))
    return cut_lineage(rows.repartitionByRange(n, *order).withColumn(out, F.spark_partition_id()))


def numbered(rows: DataFrame, order: list[str], out: str, per: list[str] = (), chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``out``: 0, 1, 2, ... in ``order``, from 0 again for each value of ``per`` (the
    first columns of the order). Rows that are equal in ``order`` are numbered in any
    order. Ranges are counted and numbered apart; only one row per range (and value of
    ``per``) meets in one task."""
    per = list(per)
    placed = range_chunks(rows, order, chunk_rows)
    counts = placed.groupBy(*per, "__chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*per).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias(f"__p{i}") for i, c in enumerate(per)], F.col("__chunk").alias("__c"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    same = F.col("__chunk") == F.col("__c")
    for i, c in enumerate(per):
        same = same & F.col(c).eqNullSafe(F.col(f"__p{i}"))
    inside = F.row_number().over(Window.partitionBy("__chunk", *per).orderBy(*order)) - 1
    return placed.withColumn("__r", inside).join(offsets, same).select(*rows.columns, (F.col("__before") + F.col("__r")).cast("bigint").alias(out))
