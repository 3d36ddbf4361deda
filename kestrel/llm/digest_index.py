"""Exact dedup against a persistent digest index (operator 13), in DataFrame functions only.

Two texts are equal when they are identical after lower-casing A-Z. The index is a
table of (digest, keep_id): the SHA-256 of the normalised text and the id of the row
that stands for it. It lies in files bucketed by the digest and sorted by it inside a
bucket, outlives the session, and is opened again by its path.

New rows come in batches. Equal texts of a batch are brought together by a grouped
maximum (partial sums before the shuffle, so a text that a third of all rows hold is
one row a task). The digests that the index does not hold yet are found by a
sort-merge anti-join, in which the index is read bucket by bucket without a shuffle,
and are appended. The row that stays is the one whose id the index holds: of the
first batch with that text, the row with the largest id.

A batch may be given again after a failure: its rows then meet their own ids in the
index and the decisions are the same. For the same reason a later row that repeats
the id and the text of the row that stays counts as that row.

Only (id, digest, hash of the row, number) is written and shuffled to decide. Texts
held by more than one in ``HOT_SHARE`` rows, of which there are fewer than
``HOT_SHARE``, are looked up in a broadcast table; all others by a sort-merge join.

Null texts count as empty. A null id is smaller than any other. Of rows that repeat
an id and a text one stays, chosen by the hash of all columns. An empty table gives
an empty result. Extra columns are kept by ``deduplicated``, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import written

ROWS_PER_BUCKET = 1_000_000
LEAST_BUCKETS = 16
HOT_SHARE = 1000


def normalised(text: Column) -> Column:
    """The text with A-Z in lower case and nothing else changed; null: empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def digest_of(text: Column) -> Column:
    """SHA-256 of the normalised text, 32 bytes."""
    return F.unhex(F.sha2(normalised(text).cast("binary"), 256))


class DigestIndex:
    """The index at ``path``: buckets of (digest, keep_id) sorted by digest."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str):
        self.spark, self.path, self.buckets, self.id_type = spark, path, buckets, id_type
        self.name = "digest_index_" + hashlib.md5(path.encode()).hexdigest()
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, keep_id {id_type}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/digests'")

    @classmethod
    def create(cls, spark: SparkSession, path: str, id_type: str = "bigint", expected_rows: int = 0) -> "DigestIndex":
        """A new index, with buckets for the number of texts it is to hold."""
        buckets = max(LEAST_BUCKETS, math.ceil(expected_rows / ROWS_PER_BUCKET))
        spark.range(1).select(F.lit(buckets).alias("buckets"), F.lit(id_type).alias("id_type")).write.json(f"{path}/layout")
        return cls(spark, path, buckets, id_type)

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> "DigestIndex":
        """The index that an earlier session left at ``path``."""
        layout = spark.read.schema("buckets int, id_type string").json(f"{path}/layout").first()
        return cls(spark, path, layout["buckets"], layout["id_type"])

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def fresh(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` (one a digest) whose digest is not in the index."""
        return groups.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, rows: DataFrame) -> None:
        """Add the digests of ``rows`` (id, digest, ...) that are new, each with its largest id.

        The groups are written first: Spark would push the anti-join below the grouping
        and send every row of a hot text to its bucket."""
        groups = written(rows.groupBy("digest").agg(F.max("id").alias("keep_id")), "new-digests")
        self.fresh(groups).select("digest", "keep_id").write.insertInto(self.name)

    def compacted(self, path: str) -> "DigestIndex":
        """A copy at ``path`` with one sorted file a bucket, after many appends."""
        entries = self.entries()
        out = DigestIndex.create(self.spark, path, self.id_type, entries.count())
        entries.repartition(out.buckets, "digest").write.insertInto(out.name)
        return out


def digested(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One narrow row per row of ``df``: id, digest, hash of all columns, a number."""
    every = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    return df.select(F.col(f"`{id_col}`").alias("id"), digest_of(F.col(f"`{text_col}`")).alias("digest"),
                     every.alias("row_hash"), F.monotonically_increasing_id().alias("number"))


def decisions(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Rows of ``digested`` (written) with keep_id, group_size (rows among these with
    that text) and kept; the index must hold all their digests."""
    first = F.max(F.struct("id", "row_hash", "number"))
    groups = rows.groupBy("digest").agg(first.alias("first"), F.count("*").alias("group_size"))
    known = groups.join(index.entries().hint("merge"), "digest")
    known = written(known.select("digest", "keep_id", "group_size", F.struct("first.number", "first.id").alias("first")), "digest-groups")
    total = known.agg(F.sum("group_size").alias("n")).first()["n"] or 0
    hot = known.where(F.col("group_size") > total / HOT_SHARE)
    cold = known.where(F.col("group_size") <= total / HOT_SHARE)
    often = rows.join(F.broadcast(hot), "digest")
    seldom = rows.join(F.broadcast(hot.select("digest")), "digest", "left_anti").join(cold, "digest")
    kept = (F.col("number") == F.col("first.number")) & F.col("id").eqNullSafe(F.col("keep_id"))
    return often.unionByName(seldom).select("id", "digest", "row_hash", "keep_id", "group_size", kept.alias("kept"))


def ingested(df: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text", batches: int = 1) -> DataFrame:
    """Add all rows of ``df`` to the index, the largest ids first, and return the
    decisions on them. With several batches each but the first meets an index that
    already holds the rows with larger ids."""
    rows = written(digested(df, id_col, text_col), "digests")
    shares = [k / batches for k in range(batches - 1, 0, -1)]
    cuts = sorted(set(rows.agg(F.percentile_approx("id", shares).alias("q")).first()["q"] or []), reverse=True) if shares else []
    for high, low in zip([None, *cuts], [*cuts, None]):
        batch = rows if high is None else rows.where(F.col("id").isNull() | (F.col("id") < F.lit(high)))
        index.append(batch if low is None else batch.where(F.col("id") >= F.lit(low)))
    return decisions(rows, index)


def deduplicated(df: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add the rows of ``df`` to the index and return those that stay, with their own columns."""
    stay = ingested(df, index, id_col, text_col).where("kept").select(F.struct("id", "digest", "row_hash").alias("stays"))
    narrow = F.struct(F.col(f"`{id_col}`").alias("id"), digest_of(F.col(f"`{text_col}`")).alias("digest"),
                      F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("row_hash"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record"), narrow.alias("key"))
    found = rows.join(stay, (F.col("key.id").eqNullSafe(F.col("stays.id"))) & (F.col("key.digest") == F.col("stays.digest"))
                      & (F.col("key.row_hash") == F.col("stays.row_hash")), "left_semi")
    return found.dropDuplicates(["key"]).select("record.*")
