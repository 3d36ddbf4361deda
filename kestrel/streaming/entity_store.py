"""Entity activity kept up to date batch by batch.

The activity table of an entity (all-time count and mean, N-day counts, sums and
means anchored at the newest row) is never rebuilt from the history. A batch
contributes

- partials (entity, day, rows, amounts, sum of amounts), one small file set a batch;
- its rows (entity, time, amount), by day, for the days that a window can still cut.

Partials of several batches are merged as their number grows (``FAN_IN`` sets of one
level make one of the next), so a row is rewritten a logarithmic number of times and
the work of a batch follows the batch. Merging folds the days that no window can reach
any more into one row per entity; as the anchor only moves forward, they stay out.

The table is derived when it is read: whole days come from partials and the three or
so days in which a window begins from their rows, so entities that have been idle for
weeks are right without having been touched.

A version is a manifest: the partial sets that belong together and the anchor. It is
complete once its ``_SUCCESS`` file exists, and readers take the newest complete one.
A batch that runs again starts from the version before it and replaces its own files.
Files are removed when no kept version names them.

Rows without an entity take no part. Rows without a time count for the all-time
figures alone, rows without an amount for the counts. An empty batch publishes the
version before under its own number.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.casts import MICROS_PER_DAY, epoch_micros

FAN_IN = 8
KEEP_VERSIONS = 10
_BEFORE = -1   # the day of what no window reaches


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


_MANIFEST = "entity string, id_type string, windows array<int>, max_us bigint, sets array<struct<path:string,level:int>>"


class EntityStore:
    """Partials and rows under ``data_dir``, versions under ``version_dir``."""

    def __init__(self, spark: SparkSession, data_dir: str, version_dir: str, entity: str, windows: Iterable[int],
                 time_col: str = "purchase_time", amount_col: str = "purchase_value", fan_in: int = FAN_IN):
        self.spark, self.data_dir, self.version_dir = spark, data_dir.rstrip("/"), version_dir.rstrip("/")
        self.entity, self.windows, self.fan_in = entity, tuple(windows), fan_in
        self.time_col, self.amount_col = time_col, amount_col

    # Versions -----------------------------------------------------------------
    def _versions(self) -> list[int]:
        names = [n for n in _children(self.spark, self.version_dir) if n.startswith("version=")]
        numbers = sorted(int(n.split("=")[1]) for n in names)
        return [n for n in numbers if _exists(self.spark, f"{self.version_dir}/version={n}/_SUCCESS")]

    def _manifest(self, version: int):
        return self.spark.read.schema(_MANIFEST).json(f"{self.version_dir}/version={version}").first()

    def _publish(self, version: int, id_type: str, max_us: int | None, sets: list[tuple[str, int]]) -> None:
        listed = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(level).alias("level")) for p, level in sets]) if sets \
            else F.array().cast("array<struct<path:string,level:int>>")
        row = self.spark.range(1).select(
            F.lit(self.entity).alias("entity"), F.lit(id_type).alias("id_type"), F.array(*[F.lit(w) for w in self.windows]).alias("windows"),
            F.lit(max_us).cast("bigint").alias("max_us"), listed.alias("sets"))
        row.coalesce(1).write.mode("overwrite").json(f"{self.version_dir}/version={version}")

    # Writing ------------------------------------------------------------------
    def _read(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths)

    def _partial_schema(self, id_type: str) -> str:
        return f"entity {id_type}, day bigint, n bigint, amounts bigint, total double"

    def _horizon(self, max_us: int) -> int:
        """The first day that a window reaches."""
        return (max_us - max(self.windows) * MICROS_PER_DAY) // MICROS_PER_DAY

    def add(self, batch: DataFrame, epoch: int) -> None:
        """Take in the rows of batch ``epoch`` and publish version ``epoch``."""
        id_type = dict(batch.dtypes)[self.entity]
        before = [v for v in self._versions() if v < epoch]
        last = self._manifest(before[-1]) if before else None
        t = epoch_micros(F.col(self.time_col).cast("timestamp"))
        rows = batch.where(F.col(self.entity).isNotNull()).select(
            F.col(self.entity).alias("entity"), t.alias("t"), F.col(self.amount_col).cast("double").alias("amount"),
            F.coalesce(F.floor(t / MICROS_PER_DAY), F.lit(_BEFORE)).cast("bigint").alias("day"))
        # One pass over the batch for the anchor; null entities move it too.
        newest = batch.agg(F.max(t).alias("m")).first()["m"]
        max_us = max((m for m in (newest, last and last["max_us"]) if m is not None), default=None)
        sets = [(s["path"], s["level"]) for s in last["sets"]] if last else []
        if max_us is not None:
            path = f"{self.data_dir}/partials/{epoch}-0"
            _partials(rows).write.mode("overwrite").parquet(path)
            (rows.where(F.col("day") >= self._horizon(max_us)).withColumn("batch_id", F.lit(epoch))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "batch_id").parquet(f"{self.data_dir}/rows"))
            sets = self._merged(sets, epoch, id_type, max_us) + [(path, 0)]
        self._publish(epoch, id_type, max_us, sets)
        self._clean()

    def _merged(self, sets: list[tuple[str, int]], epoch: int, id_type: str, max_us: int) -> list[tuple[str, int]]:
        """Levels with ``fan_in`` sets become one set of the next level. Only sets of
        earlier versions are merged, so a batch that runs again does the same."""
        level = 0
        while True:
            mine = [p for p, k in sets if k == level]
            if len(mine) < self.fan_in:
                if level > max([k for _, k in sets], default=0):
                    return sets
                level += 1
                continue
            folded = F.when(F.col("day") >= self._horizon(max_us), F.col("day")).otherwise(F.lit(_BEFORE))
            rows = self._read(mine, self._partial_schema(id_type)).withColumn("day", folded.cast("bigint"))
            path = f"{self.data_dir}/partials/{epoch}-{level + 1}"
            rows.groupBy("entity", "day").agg(*[F.sum(c).alias(c) for c in ("n", "amounts", "total")]).write.mode("overwrite").parquet(path)
            sets = [(path, level + 1)] + [(p, k) for p, k in sets if k != level]
            level += 1

    def _clean(self) -> None:
        versions = self._versions()
        kept, gone = versions[-KEEP_VERSIONS:], versions[:-KEEP_VERSIONS]
        if not gone:
            return
        manifests = [self._manifest(v) for v in kept]
        named = {s["path"].rsplit("/", 1)[1] for m in manifests for s in m["sets"]}
        for name in _children(self.spark, f"{self.data_dir}/partials"):
            if name not in named:
                _remove(self.spark, f"{self.data_dir}/partials/{name}")
        anchors = [m["max_us"] for m in manifests if m["max_us"] is not None]
        for name in _children(self.spark, f"{self.data_dir}/rows"):
            if anchors and name.startswith("day=") and int(name.split("=")[1]) < self._horizon(min(anchors)):
                _remove(self.spark, f"{self.data_dir}/rows/{name}")
        for v in gone:
            _remove(self.spark, f"{self.version_dir}/version={v}")

    # Reading ------------------------------------------------------------------
    @classmethod
    def opened(cls, spark: SparkSession, data_dir: str, version_dir: str) -> "tuple[EntityStore, int] | None":
        """The store behind the newest complete version and its number; None without one."""
        probe = cls(spark, data_dir, version_dir, "", (1,))
        versions = probe._versions()
        if not versions:
            return None
        m = probe._manifest(versions[-1])
        return cls(spark, data_dir, version_dir, m["entity"], m["windows"]), versions[-1]

    def table(self, version: int | None = None, with_user_stats: bool = False, only: DataFrame | None = None) -> DataFrame | None:
        """The activity table of a version (the newest complete one): the entity, the
        N-day columns, and with ``with_user_stats`` the all-time count and mean.
        ``only``, with the entity's column, restricts it to some entities."""
        if version is None:
            versions = self._versions()
            if not versions:
                return None
            version = versions[-1]
        m = self._manifest(version)
        if m["max_us"] is None:
            return None
        edges = {n: m["max_us"] - n * MICROS_PER_DAY for n in self.windows}
        partials = self._read([s["path"] for s in m["sets"]], self._partial_schema(m["id_type"]))
        parts = [_weighed(partials, {n: F.col("day") > us // MICROS_PER_DAY for n, us in edges.items()}, F.lit(True))]
        for day in sorted({us // MICROS_PER_DAY for us in edges.values()}):
            path = f"{self.data_dir}/rows/day={day}"
            if not _exists(self.spark, path):
                continue
            rows = self._read([path], f"entity {m['id_type']}, t bigint, amount double, batch_id bigint").where(F.col("batch_id") <= version)
            ones = rows.select("entity", "t", F.lit(1).cast("bigint").alias("n"), F.col("amount").isNotNull().cast("bigint").alias("amounts"), F.col("amount").alias("total"))
            inside = {n: (F.col("t") >= us) if us // MICROS_PER_DAY == day else F.lit(False) for n, us in edges.items()}
            parts.append(_weighed(ones, inside, F.lit(False)))
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        if only is not None:
            every = every.join(only.select(F.col(self.entity).alias("entity")).distinct(), "entity", "left_semi")
        sums = every.groupBy("entity").agg(*[F.sum(c).alias(c) for c in every.columns if c != "entity"])
        mean = lambda k: F.try_divide(F.col(f"total_{k}"), F.col(f"amounts_{k}"))
        out = [F.col("entity").alias(self.entity)]
        if with_user_stats:
            out += [F.col("n_all").alias("user_transaction_count"), mean("all").alias("__user_avg")]
        for n in self.windows:
            some = F.col(f"amounts_{n}") > 0
            out += [F.col(f"n_{n}").alias(f"{self.entity}_count_last_{n}d"), F.when(some, F.col(f"total_{n}")).alias(f"{self.entity}_sum_amount_last_{n}d"),
                    mean(n).alias(f"{self.entity}_mean_amount_last_{n}d")]
        return sums.select(*out)


def _partials(rows: DataFrame) -> DataFrame:
    return rows.groupBy("entity", "day").agg(F.count("*").alias("n"), F.count("amount").alias("amounts"), F.sum("amount").alias("total"))


def _weighed(rows: DataFrame, inside: dict[int, Column], all_time: Column) -> DataFrame:
    """Rows (entity, n, amounts, total) with their share in each window and in all time."""
    cols = [F.col("entity")]
    for name, cond in {**inside, "all": all_time}.items():
        for c, zero in (("n", F.lit(0).cast("bigint")), ("amounts", F.lit(0).cast("bigint")), ("total", F.lit(0.0))):
            cols.append(F.when(cond, F.coalesce(F.col(c), zero)).otherwise(zero).alias(f"{c}_{name}"))
    return rows.select(*cols)
