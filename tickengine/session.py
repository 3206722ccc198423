"""Spark session helpers.

Everything in the engine assumes a UTC session zone (candle minutes and trading dates are UTC). The checkpoint
directory is taken from the session (``spark.checkpoint.dir``); a local one is only made when nothing is set, which
is the case in tests and local benches.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # stored candles carry symbols such as "0012": never let partition discovery turn them into numbers
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(cpus: int | str = "*", app: str = "tickengine", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests, benches and the command line. On a cluster, use the cluster's session and
    call :func:`prepare` on it instead."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TICKENGINE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in SESSION_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


# Defaults for a cluster, applied where nothing is set. Shuffle partitions belong to the deployment (about 128-256 MB of
# shuffled data a task); AQE coalesces the small stages and splits skewed join partitions.
BATCH_CONF = {
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}

# Streams keep a state store per shuffle partition, on every trigger: far fewer partitions than a batch, and state off
# the heap.
STREAM_CONF = {
    "spark.sql.shuffle.partitions": "512",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def is_local(spark: SparkSession) -> bool:
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def prepare(spark: SparkSession, stream: bool = False) -> SparkSession:
    """Pin the runtime settings the operators rely on (all are SQL confs, settable on a live session), and on a cluster
    set the batch or stream defaults that the deployment has left open."""
    for k, v in SESSION_CONF.items():
        spark.conf.set(k, v)
    if not is_local(spark):
        given = {k for k, _ in spark.sparkContext.getConf().getAll()}
        for k, v in (STREAM_CONF if stream else BATCH_CONF).items():
            if k not in given:
                spark.conf.set(k, v)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster. Only when the session names none (local tests) is a
    private folder under the system temp dir created and registered."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="tickengine-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the workers this package: a zip of its sources, sent once per application by Spark itself. Python
    functions that run in tasks are pickled by reference, so a worker must be able to import their modules."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        here = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tickengine-src-")), "tickengine-src.zip")
        with zipfile.ZipFile(out, "w") as z:
            for folder, _, names in os.walk(here):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, os.path.dirname(here)))
        spark.sparkContext.addPyFile(out)
        _shipped.add(app)
    return spark


_written: list[str] = []


def materialize(df, **options: str):
    """Write an intermediate that several consumers read once, as a Parquet table in the shared checkpoint folder,
    and read it back: its lineage is computed once instead of once per consumer, and it is cut, so a lost
    executor costs a re-read, not a recomputation from the sources. (An eager ``checkpoint`` would compute the
    plan twice unless it were cached first; caching terabytes on executors is what this avoids.)
    ``options`` go to the writer."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tickengine-mat-{uuid.uuid4().hex}"
    df.write.mode("overwrite").options(**options).parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_intermediates(spark: SparkSession) -> int:
    """Delete what :func:`materialize` has written in this process. To be called when the results that read it are
    written (jobs do so at their end); returns how many folders went."""
    jvm, n = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
