"""Readers and writers.

Sources are read with explicit schemas (no inference pass over the data).
Processed sets are written as parquet partitioned by split, so a reader of
one split prunes the other at the file listing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel import schemas as SC


class SourceMissing(FileNotFoundError):
    """A required input file or directory does not exist."""


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) or bool(fs.globStatus(p))


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    if not _exists(spark, path):
        raise SourceMissing(path)
    return spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)


def load_fraud_data(spark: SparkSession, path: str) -> DataFrame:
    """A1: e-commerce transactions (raw text columns; cast by ``correct_data_types``)."""
    return read_csv(spark, path, SC.ECOM_RAW)


def load_ip_to_country_data(spark: SparkSession, path: str) -> DataFrame:
    """A2: IP ranges; bounds as doubles, as exported."""
    df = read_csv(spark, path, SC.IP_RANGES_RAW)
    return df.select(F.col("lower_bound_ip_address").try_cast("double").alias("lower_bound_ip_address"),
                     F.col("upper_bound_ip_address").try_cast("double").alias("upper_bound_ip_address"),
                     "country")


def load_creditcard_data(spark: SparkSession, path: str) -> DataFrame:
    """A3: card transactions (Time, V1..V28, Amount as text, Class)."""
    return read_csv(spark, path, SC.BANK_RAW)


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Stop with a named error on an empty input (one-row probe)."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def require_columns(df: DataFrame, cols, what: str = "input") -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"{what} lacks columns {missing}")
    return df


def write_sets(df: DataFrame, path: str, split_col: str = "split", fmt: str = "parquet",
               mode: str = "overwrite") -> str:
    """A5: write features + label, partitioned by split ('train' / 'test')."""
    w = df.write.mode(mode).partitionBy(split_col)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)
    return path


def read_set(spark: SparkSession, path: str, split: str, label_col: str | None = None,
             split_col: str = "split", fmt: str = "parquet") -> DataFrame:
    """Read one split back (partition pruning on ``split``); with
    ``label_col`` the label is moved to the first column, as the reference's
    label files are read."""
    r = spark.read.option("header", True) if fmt == "csv" else spark.read
    df = (r.option("inferSchema", True).csv(path) if fmt == "csv" else r.parquet(path))
    df = df.where(F.col(split_col) == split).drop(split_col)
    if label_col:
        df = df.select(label_col, *[c for c in df.columns if c != label_col])
    return df


def parse_records(lines: DataFrame, schema: T.StructType, text_col: str = "value"):
    """JSON text records -> (rows, rejects). A record that is not
    valid JSON, or is empty, goes to the reject table with its text."""
    parsed = lines.select(F.col(text_col).alias("__raw"),
                          F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE"}).alias("r"))
    fields = [F.col(f"r.`{f.name}`").isNotNull() for f in schema.fields]
    any_field = fields[0]
    for f in fields[1:]:
        any_field = any_field | f
    ok = F.coalesce(F.col("__raw").isNotNull() & (F.trim(F.col("__raw")) != "")
                    & F.col("r").isNotNull() & any_field, F.lit(False))
    good = parsed.where(ok).select("r.*")
    bad = parsed.where(~ok).select(F.col("__raw").alias("raw_record"))
    return good, bad


__all__ = ["load_fraud_data", "load_ip_to_country_data", "load_creditcard_data", "require_rows",
           "require_columns", "write_sets", "read_set", "parse_records", "SourceMissing"]
