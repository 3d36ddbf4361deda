"""Sharding by a two-pass external shuffle (operator 9), in DataFrame functions only.

Pass 1 scatters the records into buckets of about ``bucket_bytes`` of text with a
seeded hash of all their columns and, for equal rows, their number; pass 2 gathers
one bucket at a time and permutes it with Spark's ``shuffle`` function, which is a
seeded Fisher-Yates shuffle. The buckets one after the other are a random order of
all records; shards are consecutive stretches of it, so their row counts differ by
at most one (law ``rows``).

The number of buckets grows with the bytes, so a task never holds more than one
bucket, or one record if that is longer. Rows that repeat an id are dealt like any
others. Equal rows are counted, not gathered, and numbered as they are written out
again, so the order depends on the rows and the seed alone. Null texts have no
bytes; -0.0 comes back as 0.0. An empty table gives an empty result. All columns
are kept; those named like the two new ones are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from kestrel.llm.common import written

BUCKET_BYTES = 4 << 20
_GROUP = 4096
_REPEATS = 4096


def text_bytes(text_col: str):
    """UTF-8 bytes of the text and one more; null: one."""
    return (F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0)) + 1).cast("bigint")


def _numbered(df: DataFrame, columns: list[str]) -> DataFrame:
    """(record, number): all rows, equal ones numbered from 0. A row that occurs more
    than ``_REPEATS`` times is written out by several tasks."""
    record = F.struct(*[F.col(f"`{c}`") for c in columns])
    counted = df.groupBy(record.alias("record")).agg(F.count("*").alias("c"))
    few = counted.where(F.col("c") <= _REPEATS).select("record", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("c") - 1)).alias("number"))
    parts = counted.where(F.col("c") > _REPEATS).select("record", "c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("c") - 1) / _REPEATS))).alias("part"))
    last = F.least(F.col("c"), (F.col("part") + 1) * _REPEATS) - 1
    many = parts.repartition("record", "part").select("record", F.explode(F.sequence(F.col("part") * _REPEATS, last)).alias("number"))
    return few.union(many)


def _bucket(n: int, seed: int):
    return F.pmod(F.xxhash64(F.lit(seed), F.col("record"), F.col("number")), F.lit(n))


def _bucket_offsets(df: DataFrame, n: int, seed: int) -> DataFrame:
    """(bucket, offset): rows in the buckets before. Prefix sums in two steps, so no
    window holds more than a group of buckets or one row a group."""
    counts = df.select(_bucket(n, seed).alias("bucket")).groupBy("bucket").agg(F.count("*").alias("rows"))
    counts = written(counts.withColumn("group", F.floor(F.col("bucket") / _GROUP)), "bucket-counts")
    before = W.orderBy("group").rowsBetween(W.unboundedPreceding, -1)
    groups = counts.groupBy("group").agg(F.sum("rows").alias("r")).select("group", F.coalesce(F.sum("r").over(before), F.lit(0)).alias("g"))
    inside = W.partitionBy("group").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("i", F.coalesce(F.sum("rows").over(inside), F.lit(0))).join(groups, "group").select(
        "bucket", (F.col("g") + F.col("i")).alias("offset"))


def shuffled_shards(df: DataFrame, shards: int, text_col: str = "text", seed: int = 9,
                    bucket_bytes: int = BUCKET_BYTES, shard_out: str = "shard", slot_out: str = "slot") -> DataFrame:
    """All rows of ``df`` in shuffled order, as (columns, shard, slot)."""
    total = df.agg(F.sum(text_bytes(text_col)).alias("b"), F.count("*").alias("n")).first()
    n_rows, n = total["n"], max(1, math.ceil((total["b"] or 0) / bucket_bytes))
    columns = [c for c in df.columns if c not in (shard_out, slot_out)]
    numbered = _numbered(df, columns)
    offsets = written(_bucket_offsets(numbered, n, seed), "bucket-offsets")
    rows = numbered.select(_bucket(n, seed).alias("bucket"),
                           F.struct(F.xxhash64(F.lit(seed + 1), F.col("record"), F.col("number")).alias("h"), "record").alias("x"))
    scattered = rows.repartition(n, "bucket")
    # Records meet in any order; sorting by hash first makes the shuffle repeatable.
    gathered = scattered.groupBy("bucket").agg(F.collect_list("x").alias("xs"))
    order = F.shuffle(F.array_sort("xs", lambda a, b: F.when(a["h"] < b["h"], -1).when(a["h"] > b["h"], 1).otherwise(0)), F.lit(seed))
    placed = (gathered.join(offsets, "bucket").sortWithinPartitions("bucket")
              .select("offset", F.posexplode(order).alias("at", "x")).select((F.col("offset") + F.col("at")).alias("i"), "x.record"))
    short, longer = divmod(n_rows, shards)
    edge = longer * (short + 1)  # the first shards hold one row more
    i = F.col("i")
    shard = F.when(i < edge, F.floor(i / (short + 1))).otherwise(longer + F.floor((i - edge) / max(short, 1)))
    slot = F.when(i < edge, i % (short + 1)).otherwise((i - edge) % max(short, 1))
    return placed.select("record.*", shard.cast("int").alias(shard_out), slot.cast("bigint").alias(slot_out))


def write_shards(df: DataFrame, path: str, shards: int, **options) -> None:
    """Write the shards as Parquet, one folder a shard, rows by slot in each file."""
    out = shuffled_shards(df, shards, **options)
    shard, slot = options.get("shard_out", "shard"), options.get("slot_out", "slot")
    out.sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)
