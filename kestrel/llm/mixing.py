"""Mixing sources to target weights by hash-threshold histograms (operator 8).

Sizes are words. Every source has a weight and the mix a total budget, shared by
weight; a target stops at ``max_repeats`` times its source's size, and what is
left over is shared again by weight among the others.

A target of ``c + f`` times the source (c whole, f a fraction) takes every
document c times and the documents of a nested sample once more: those whose
seeded hash lies below the source's threshold. The threshold is found without
sorting: sizes are summed by source and hash bucket, the running sum over the
buckets of a source (a fixed number) names the bucket in which the budget ends,
and only that bucket is summed again at the next digits of the hash, until the
hash has no digits left. A larger budget only adds documents.

The document at the boundary is taken if that brings the source nearer to its
target.

The hash is that of the id. Where ids repeat, or several are null, it is that of the
id, the contents and the number among equal rows, so a source whose words lie under
one id comes as near to its target as any other.

Null texts have size 0, and documents of size 0 add nothing. Null sources form
one source, last in order. Repeated rows are separate documents. Extra columns are kept by ``mix`` and ignored by the query. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from kestrel.llm.common import extended, lean, with_arrays, written
from kestrel.llm.external_shuffle import _REPEATS, _numbered
from kestrel.llm.textblocks import count_words

DIGIT_BITS, HASH_BITS = 10, 60
WEIGHTS = (3.0, 1.0, 2.0)


def _size_batches(text_col: str, size_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pa.array(count_words(batch.column(text_col)), pa.int64())
            yield with_arrays(batch.drop_columns([text_col]), **{size_col: sizes})
    return run


def sized(df: DataFrame, text_col: str = "text", size_col: str = "size") -> DataFrame:
    """The rows with the number of words in place of the text."""
    return df.mapInArrow(lean(_size_batches(text_col, size_col)), extended(df.drop(text_col), **{size_col: T.LongType()}))


def sample_hash(id_col: str, seed: int) -> Column:
    """60 bits of a seeded hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def repeats_ids(df: DataFrame, id_col: str) -> bool:
    """Whether an id, or null, occurs more than once."""
    row = df.agg(F.count("*").alias("n"), F.count_distinct(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))).alias("d")).first()
    return row["n"] != row["d"]


def row_hash(seed: int) -> Column:
    """60 bits of a seeded hash of (doc_id, key, number): where ids repeat, rows are
    told apart by their contents, and equal rows by their number."""
    text = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("key"), F.col("number").cast("string"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def source_targets(sources: DataFrame, budget_share: float = 1.5, max_repeats: float = 2.0,
                   weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """Rows (source, source_size) with their target.

    Weights go round the sources in code point order, null last. A round of the
    water filling is one aggregate over the sources, of which one row reaches the
    driver; it ends when no source is above its limit.
    """
    # UTF-8 order is code point order.
    rank = F.row_number().over(W.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    weighed = written(sources.withColumn("weight", choice).withColumn("limit", max_repeats * F.col("source_size")), "sources")
    total = weighed.agg(F.sum("source_size").alias("s")).first()["s"] or 0
    budget, level = budget_share * total, 0.0  # level: words per unit of weight
    while True:
        full = F.col("limit") <= level * F.col("weight")
        row = weighed.agg(F.sum(F.when(full, F.col("limit"))).alias("used"), F.sum(F.when(~full, F.col("weight"))).alias("open")).first()
        new = (budget - (row["used"] or 0.0)) / row["open"] if row["open"] else level
        if new <= level:
            return weighed.select("source", "source_size", F.least(F.col("limit"), F.lit(level) * F.col("weight")).alias("target"))
        level = new


def _at_source(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left rows with the columns of their source; null meets null."""
    r = right.withColumnRenamed("source", "_source")
    return left.join(r, left["source"].eqNullSafe(r["_source"])).drop("_source")


def sample_bounds(rows: DataFrame, extras: DataFrame) -> DataFrame:
    """(source, bound): documents of a source with ``h < bound`` are in its sample.

    ``rows`` has source, size and h; ``extras`` has source and extra, the words the
    sample should hold. Only the first level reads all rows.
    """
    rest = _at_source(rows.select("source", "size", "h"), extras.select("source", F.col("extra").alias("left")))
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        digit = F.shiftright("h", shift).bitwiseAND((1 << DIGIT_BITS) - 1)
        histogram = rest.groupBy("source", "left", digit.alias("bucket")).agg(F.sum("size").alias("size"))
        upto = F.sum("size").over(W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0))
        ends = (histogram.withColumn("upto", upto).where("upto >= left").groupBy("source")
                .agg(F.min(F.struct("bucket", (F.col("left") - F.col("upto") + F.col("size")).alias("rest"))).alias("x"))
                .select("source", F.col("x.bucket").alias("end"), F.col("x.rest").alias("left")))
        rest = written(_at_source(rest.drop("left"), ends).where(digit == F.col("end")).drop("end"), "boundary")
        crowd = rest.groupBy("source").agg(F.count_distinct("h").alias("k")).agg(F.max("k").alias("k")).first()["k"]
        if crowd is None or crowd <= 1:
            break
    last = rest.groupBy("source", "left").agg(F.min("h").alias("h"), F.sum("size").alias("size"))
    return last.select("source", (F.col("h") + F.when(F.col("left") * 2 >= F.col("size"), 1).otherwise(0)).alias("bound"))


def mix_plan(rows: DataFrame, budget_share: float = 1.5, max_repeats: float = 2.0,
             weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """One row per source of ``rows`` (source, size, h): source_size, target, and
    the copies a document gets (``whole``, one more if its hash is below ``bound``)."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    targets = written(source_targets(sources, budget_share, max_repeats, weights)
                      .withColumn("whole", whole).withColumn("extra", F.col("target") - F.col("whole") * F.col("source_size")), "targets")
    return written(_at_source(targets.drop("extra"), sample_bounds(rows, targets)), "mix-plan")


def _rows(df: DataFrame, id_col: str, text_col: str, source_col: str, seed: int) -> tuple[DataFrame, bool]:
    """(doc_id, source, size, h), one per row and written, and whether ids repeat;
    then with ``key``, a digest of the row's columns."""
    narrow = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"), F.col(f"`{text_col}`").alias("text"),
                       record_key(df).alias("key"))
    if not repeats_ids(df, id_col):
        return written(sized(narrow.drop("key")).withColumn("h", sample_hash("doc_id", seed)), "sizes"), False
    rows = _numbered(written(sized(narrow), "sizes"), ["doc_id", "source", "size", "key"]).select("record.*", "number")
    return written(rows.withColumn("h", row_hash(seed)).drop("number"), "numbered-sizes"), True


def record_key(df: DataFrame) -> Column:
    """A digest of all columns of a row."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}), 256)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 8,
        **options) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target and
    ``copies``, how often the mix takes the document."""
    rows, _ = _rows(df, id_col, text_col, source_col, seed)
    return _at_source(rows, mix_plan(rows, **options)).select(
        "doc_id", "source", "size", "source_size", "target", _copies(F.col("h")).alias("copies"))


def _copies(h: Column) -> Column:
    return F.col("whole") + F.when(h < F.col("bound"), 1).otherwise(0)


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 8,
               **options) -> DataFrame:
    """The documents of the mix: each input row as often as the mix takes it, with
    its own columns. With unique ids only the plan, one row per source, is joined with
    the texts; where ids repeat, equal rows are taken together as often as all of them."""
    rows, repeated = _rows(df, id_col, text_col, source_col, seed)
    plan = mix_plan(rows, **options)
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("record")
    if repeated:
        taken = _at_source(rows, plan).groupBy("key").agg(F.sum(_copies(F.col("h"))).alias("copies")).where("copies > 0")
        distinct = df.select(record, record_key(df).alias("key")).dropDuplicates(["key"])
        parts = distinct.join(taken, "key").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / _REPEATS))))
        spread = parts.withColumn("n", F.least(F.lit(_REPEATS), F.col("copies") - F.col("part") * _REPEATS))
    else:
        hashed = df.select(record, F.col(f"`{source_col}`").alias("source"), sample_hash(id_col, seed).alias("h"))
        spread = _at_source(hashed, plan).withColumn("n", _copies(F.col("h"))).where("n > 0")
    return spread.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n").cast("bigint")))).select("record.*")
