"""Session helpers.

The library assumes the session time zone is UTC (driver tables store
wall-clock TIMESTAMP_NTZ values; all epoch arithmetic is done on UTC
TIMESTAMPs).  ``ensure_utc`` is called by the table loader so that every
query sees the same clock regardless of how the caller built the session.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "punctua") -> SparkSession:
    """Build (or reuse) a session with the settings the library is tuned for.

    * AQE on, with partition coalescing and skew-join splitting: on a cluster
      ``spark.sql.shuffle.partitions`` should be sized for the largest shuffle
      (~128-256 MB per partition) and AQE coalesces the small ones.
    * RocksDB state store for streams; UI off (no server), UTC session clock.
    """
    master = master or os.environ.get("PUNCTUA_MASTER", "local[*]")
    cpus = os.cpu_count() or 8
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # streaming state on disk: the keys of a watermark window need not fit in executor memory
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        # no read before each write for a row count, and commits upload what changed
        .config("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", "false")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PUNCTUA_DRIVER_MEMORY", "8g"))
    )
    # a cluster's own setting stands unless one is asked for (or see configure_for_inputs)
    if shuffle_partitions or master.startswith("local"):
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    checkpoint_dir(spark)
    return spark


def recommended_shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 256 << 20) -> int:
    """Partitions so that each shuffle partition holds about ``target_bytes`` of the
    input (an upper bound for shuffles that do not grow the data), at least one per
    core, rounded up to a multiple of the core count so waves are full."""
    n = max(cores, -(-input_bytes // target_bytes))
    return -(-n // cores) * cores


def configure_for_inputs(spark: SparkSession, paths: list[str], target_bytes: int = 256 << 20) -> int:
    """Size ``spark.sql.shuffle.partitions`` from the bytes of the input files (listing only)
    and let AQE coalesce towards the same advisory size.  Never lowers a larger setting."""
    from punctua.sources import hadoopfs as hfs
    total = sum(f.size for p in paths for f in hfs.list_files(spark, p))
    cores = spark.sparkContext.defaultParallelism
    n = recommended_shuffle_partitions(total, cores, target_bytes)
    current = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    if n > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_bytes))
    return max(n, current)


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``; we read it from the
    session.  Only when it is unset (local tests) do we create one under the
    system temp folder and register it.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="punctua-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def materialize(df, label: str, session: SparkSession | None = None):
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used when one derived frame feeds several branches of a plan: Spark would
    otherwise recompute it per branch.  The files live in the folder the
    cluster names in ``spark.checkpoint.dir`` (shared storage), so the result
    survives executor loss and cuts the lineage.  ``session`` reads the copy
    back in another session of the same application (e.g. an isolated one).
    """
    path = table_path(df.sparkSession, label)
    df.write.parquet(path)
    return (session or df.sparkSession).read.parquet(path)


def table_path(spark: SparkSession, label: str) -> str:
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{label}-{uuid.uuid4().hex}"


def materialize_by(df, label: str, column: str, values) -> dict:
    """Write ``df`` once and read it back as one frame per value of ``column`` (which goes): each has its own size, by which
    the planner may tell that it is small enough to broadcast."""
    from punctua.sources import hadoopfs as hfs
    spark, path = df.sparkSession, table_path(df.sparkSession, label)
    df.write.partitionBy(column).parquet(path)
    rest = df.drop(column)
    read = spark.read.schema(rest.schema)
    return {v: read.parquet(f"{path}/{column}={v}") if hfs.exists(spark, f"{path}/{column}={v}")
            else spark.createDataFrame([], rest.schema) for v in values}
