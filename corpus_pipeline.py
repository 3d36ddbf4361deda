"""The corpus pipeline: stages applied one after the other to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; what it returns
is written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``documents``.

The language stage cannot be expressed in SQL, so there is no ``ORACLE_SQL``; the
tests hold the stages against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import held_out, released, small_batches, table, tokenizer_paths, unused, written
from kestrel.llm.language_id import UNDETERMINED, identify, learn_profiles
from kestrel.llm.mixing import mixed_rows
from kestrel.llm.near_dedup import one_of_each_group
from kestrel.llm.packing import pack
from kestrel.llm.secret_scan import redacted, scan

ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language cannot be determined: null texts and texts
    without a letter. Profiles are learned from the stage's own input."""
    profiles = learn_profiles(docs.where(~held_out()))
    lang, score = unused(docs, "_lang_pred"), unused(docs, "_lang_score")
    found = identify(docs, profiles, lang_out=lang, score_out=score)
    return found.where(F.col(lang) != UNDETERMINED).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: shingles of five words,
    similarity of at least 0.8."""
    return one_of_each_group(docs, shingle_words=5, percent=80)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret in a text by a mark. No document goes; ``n_chars``, where
    there is such a column, follows the new text."""
    base, spans = unused(docs, "_base_spans"), unused(docs, "_secret_spans")
    found = scan(docs, base_out=base, all_out=spans)
    text = redacted(F.col("text"), F.col(spans))
    clean = found.withColumn("text", F.when(F.size(spans) > 0, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return clean.select(*[F.col(f"`{c}`") for c in docs.columns])


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bring the sources to their target weights: a document appears as often as the
    mix takes it, so some go and some repeat."""
    return mixed_rows(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack all documents into token sequences; one row per piece."""
    return pack(docs, **tokenizer_paths())


STAGES = [
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``. What a stage writes on its way goes once its result
    is written, and a result once the next one is."""
    docs = table(spark, sf_dir, "documents")
    small_batches(spark)    # from the first stage on: what a worker once took stays with it
    with released(spark):
        for name, stage in STAGES:
            with released(spark):
                docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}", keep=True)
        return written(docs, "pipeline", keep=True)
