"""Session helpers: one place for the runtime settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every kestrel job expects. Time arithmetic is done in UTC, AQE
# re-plans joins at run time (broadcast when a side turns out small, split
# skewed partitions), and the UI server stays off.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Shuffle partitions are sized by AQE towards this many bytes each, so the
    # configured count is an upper bound (set it to data size / 128 MB).
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Checkpoint files of lineage cuts are removed once unreferenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int = 8,
              app_name: str = "kestrel", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with kestrel's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings kestrel relies on to an existing session
    and make the package importable by the Python workers."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    ship_package(spark)
    return spark


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Ship this package to the executors once per application
    (``addPyFile`` of a zip built from the installed sources), so functions
    run by Python workers (``mapInPandas``) can import it wherever the job
    was started from."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="kestrel-pkg-"), "kestrel.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts and stream checkpoints.

    Taken from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local-mode session without one gets a fresh
    scratch folder; a cluster session without one is an error, since a
    machine-local folder is not visible to the other executors.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
            d = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme (for driver-side checks in tests)."""
    return path[5:] if path.startswith("file:") else path


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df, name: str):
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back. Also
    cuts the lineage; a pass over it reads the columns it needs only, where a
    checkpoint is read row by row and whole."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


__all__ = ["get_spark", "prepare", "checkpoint_dir", "scratch_path", "cut_lineage", "written",
           "local_path", "DEFAULT_CONF"]
