"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings that the plans rely on. They are safe on any cluster: none of them fixes a
# partition count, AQE picks it from the measured shuffle sizes.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tokenising costs much CPU per byte: keep small stages parallel. Large ones still aim at the
    # advisory partition size.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when that costs one more exchange afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Files of a bucketed table are sorted by its key: with this, Spark takes their order as given.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # A write by a partition column of few values opens one file for each instead of sorting its rows.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    # States with timers need this store; it keeps them on disk instead of in the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Of a key that a JSON object repeats, the last value holds.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Notice dates carry no zone; UTC keeps every rendering independent of the host.
    "spark.sql.session.timeZone": "UTC",
}


_LOCAL_DIRS: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", app: str = "noticeworks") -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for written tables, below the folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset, a temporary folder
    takes its place in local mode; a cluster, whose machines do not share one, is refused.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        app = spark.sparkContext.applicationId
        if app not in _LOCAL_DIRS:
            _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="noticeworks-")
        base = _LOCAL_DIRS[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan gives fewer partitions than that (few or small files).

    Only then is anything shuffled. Use it on narrow rows, before the work that makes them wide.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def file_system(spark: SparkSession, path: str):
    """The JVM gateway and the file system that a path names."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    jvm, fs = file_system(spark, path)
    return fs.exists(jvm.org.apache.hadoop.fs.Path(path))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, read by the driver without a job."""
    jvm, fs = file_system(spark, path)
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(path))
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
