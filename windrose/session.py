"""Session construction and the settings every plan relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings the engine needs regardless of who built the session: timestamps
# without zone are read as UTC (the reference treats naive times as UTC) and
# AQE re-plans joins / coalesces partitions from runtime statistics.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # per-key "last N" filters (N = 2000 latency samples) still get a partial
    # WindowGroupLimit before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
}


def prepare_session(spark: SparkSession) -> SparkSession:
    """Apply the engine's session settings to an existing session and send the
    package to its executors (idempotent)."""
    for key, value in _REQUIRED.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and materialised intermediates.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset a
    single-process session (tests) gets a fresh scratch folder; any other
    session is refused, since its executors could not read one another's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="windrose-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


kept_watchers: list = []     # called with each frame that is about to be kept (plan reports)


def kept_table(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate table to the shared checkpoint folder and read it back
    (cuts lineage, and survives lost executors).  It stays until
    ``drop_kept_tables``, since results may still read it."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    for watch in kept_watchers:
        watch(df)
    df.write.option("compression", "zstd").parquet(path)
    kept = getattr(spark.sparkContext, "_windrose_kept", None)
    if kept is None:
        kept = spark.sparkContext._windrose_kept = []
    kept.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_kept_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables this session has written; call it when no
    result that was built on them is read any more.  Returns how many there were."""
    kept = getattr(spark.sparkContext, "_windrose_kept", [])
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in kept:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    n = len(kept)
    kept.clear()
    return n


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per session.

    Python stages import their functions by name; a cluster that does not have
    the package on the executors' path gets it as a zip file.
    """
    sc = spark.sparkContext
    if getattr(sc, "_windrose_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="windrose-zip-"), "windrose-package.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("windrose", os.path.relpath(full, root)))
    sc.addPyFile(target)
    sc._windrose_shipped = True


def stream_checkpoint(spark: SparkSession, output_path: str) -> str:
    """Checkpoint folder of a streaming query that writes to ``output_path``.

    Lives under the shared ``spark.checkpoint.dir`` and is derived from the
    output path, so a restarted query finds its offsets and state again.
    """
    name = re.sub(r"[^A-Za-z0-9_.-]+", "_", output_path.strip("/")) or "stream"
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "windrose") -> SparkSession:
    """Session for tests and the bench; on a cluster pass ``master=None``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    cpus = os.environ.get("BENCH_CPUS")
    parts = shuffle_partitions or (int(cpus) if cpus else 8)
    builder = (builder
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", str(parts))
               .config("spark.driver.memory", os.environ.get("WINDROSE_DRIVER_MEMORY", "8g")))
    for key, value in _REQUIRED.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare_session(spark)
    checkpoint_dir(spark)
    return spark
