"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "trackwise") -> SparkSession:
    """Create (or reuse) a session with the settings the operators rely on.

    On a cluster, pass ``master=None`` so the launcher's settings win; only the
    SQL options below are forced because results depend on them.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # local mode: the driver JVM is the only executor
            b = b.config("spark.driver.memory", os.environ.get("TRACKWISE_DRIVER_MEMORY", "8g"))
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          # small but compute-heavy stages keep their tasks; large ones follow the advisory size
          .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
          .config("spark.ui.showConsoleProgress", "false")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Set only where it is unset (local tests); on a cluster the launcher names a
    folder every executor can reach, and we never replace it.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="trackwise-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else base.rstrip("/") + "/" + name


_MATERIALIZED: dict[tuple[str, str], str] = {}


def materialize(df: DataFrame, name: str, reuse_key: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads files instead of
    recomputing the upstream plan) and keeps plans small. With ``reuse_key``,
    a table already written in this application for the same key is reused.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    if reuse_key is not None and (app, reuse_key) in _MATERIALIZED:
        return spark.read.parquet(_MATERIALIZED[(app, reuse_key)])
    import uuid
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("overwrite").parquet(path)
    if reuse_key is not None:
        _MATERIALIZED[(app, reuse_key)] = path
    return spark.read.parquet(path)


@contextlib.contextmanager
def packed_listing(spark: SparkSession):
    """Folders are listed by a few tasks a core while a reader is made: Spark's default is a
    task a folder (up to 10,000), each of which costs more than its listing."""
    name = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    old = spark.conf.get(name)
    spark.conf.set(name, str(min(int(old), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(name, old)


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (file-system metadata only)."""
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(conf)
        for st in fs.globStatus(path) or []:
            total += int(fs.getContentSummary(st.getPath()).getLength())
    return total


def size_shuffles(spark: SparkSession, paths: list[str], target_partition_bytes: int = 256 << 20,
                  min_partitions: int | None = None) -> int:
    """Set ``spark.sql.shuffle.partitions`` from the input size.

    About one shuffle partition per ``target_partition_bytes`` of input (so a
    partition's sort/aggregate state fits executor memory), at least twice the
    default parallelism; AQE then coalesces small ones toward the same advisory
    size and splits skewed ones. 100 TB gives about 400,000.
    """
    n_in = input_bytes(spark, paths)
    floor_n = min_partitions or 2 * spark.sparkContext.defaultParallelism
    n = max(floor_n, n_in // target_partition_bytes + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(target_partition_bytes, 256 << 20)))
    return n
