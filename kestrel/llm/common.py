"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.session import prepare, scratch_path

HELD_OUT_MOD = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, in a session prepared for Python workers."""
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


_SCOPES: list[list[str]] = []


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage: later jobs read the files, which outlive any executor. Inside
    ``released`` the files go when the block ends; what is to be kept goes with the
    block around it, if there is one.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    scopes = _SCOPES[:-1] if keep else _SCOPES
    if scopes:
        scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Remove what ``written`` writes inside the block when the block ends. What is
    built on it has to be written before that, with ``keep``."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession, size: str = "4m") -> None:
    """Bound the Arrow batches of the session by bytes as well as by rows, so that what
    an executor and its Python workers hold of a table does not follow the length of
    its texts. A limit that the session has already stays."""
    if spark.conf.get(_BATCH_LIMIT, None) is None:
        spark.conf.set(_BATCH_LIMIT, size)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, a function for ``mapInArrow``, followed by the return of freed memory to
    the system. Workers are used again, and what one stage once took would otherwise
    stay beside that of the next."""
    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()
    return through


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
    if trim is not None:
        trim(0)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def held_out(id_col: str = "doc_id"):
    """crc32 of the id's text is divisible by five; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % HELD_OUT_MOD == 0, F.lit(False))


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)


def with_arrays(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns added, replacing those of the same name."""
    names = [n for n in batch.schema.names if n not in columns]
    arrays = [batch.column(n) for n in names] + list(columns.values())
    return pa.RecordBatch.from_arrays(arrays, names=[*names, *columns])


def extended(df: DataFrame, **types) -> "T.StructType":  # noqa: F821
    """Schema of ``with_arrays`` on the rows of ``df``."""
    from pyspark.sql import types as T
    kept = [f for f in df.schema.fields if f.name not in types]
    return T.StructType([*kept, *(T.StructField(n, t) for n, t in types.items())])


def tokenizer_paths() -> dict[str, str]:
    """Files of the default vocabulary, part of the workers' installation."""
    import public_tokenizers
    return {"tokenizer": public_tokenizers.path("byte_bpe_50k.json"), "ranks": public_tokenizers.path("byte_bpe_50k.tiktoken")}
