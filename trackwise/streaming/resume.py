"""Resume-by-key: the reference's one incremental behaviour (APPEND_RESUME,
ANTI_DONE, SKIP_EXISTING), as a batch anti-join and as a Structured Streaming
query whose checkpoint records progress.

The reference reads its output file, skips keys already present, and appends
one row per new key. Here the output is a Parquet table in a shared folder:
pending = input LEFT ANTI JOIN existing keys; the produced rows are appended.
Running it twice adds nothing. The anti-join is a shuffle (or a broadcast of
the key set when AQE measures it small); nothing passes through the driver.

The streaming form keeps the keys it has seen as state (``dropDuplicates`` on the RocksDB
state store), so a batch reads only its own rows and their keys' state, not the
output. Every batch has an output folder of its own that is written whole: a batch that
runs again after a crash replaces its rows instead of adding them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.utils import AnalysisException


def read_output(spark: SparkSession, out_path: str) -> DataFrame:
    """Everything written under ``out_path``: by appends and by the batches of streams."""
    return spark.read.option("recursiveFileLookup", "true").parquet(out_path)


def existing_keys(spark: SparkSession, out_path: str, key: str) -> DataFrame | None:
    """Keys already written; None when there is no output yet (a wrong key or an
    unreadable output is an error)."""
    try:
        done = read_output(spark, out_path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    return done.select(key)


def pending(todo: DataFrame, done: DataFrame | None, key: str) -> DataFrame:
    """ANTI_DONE: rows of ``todo`` whose key is not in ``done``."""
    return todo if done is None else todo.join(done.select(key), key, "left_anti")


def append_new(todo: DataFrame, key: str, out_path: str,
               produce: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """APPEND_RESUME: produce rows for keys not yet in ``out_path`` and append them."""
    spark = todo.sparkSession
    new = produce(pending(todo, existing_keys(spark, out_path, key), key))
    new.write.mode("append").parquet(out_path)
    return read_output(spark, out_path)


def skip_existing_files(todo: DataFrame, name_col: str, listing: DataFrame,
                        pattern: str = r"([^/]+)$") -> DataFrame:
    """SKIP_EXISTING: drop work whose output name is already in ``listing`` (a
    ``binaryFile`` or path listing with column ``path``); group 1 of
    ``pattern`` is the name."""
    from pyspark.sql import functions as F
    names = listing.select(F.regexp_extract("path", pattern, 1).alias(name_col)).distinct()
    return todo.join(names, name_col, "left_anti")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def write_batch(rows: DataFrame, path: str) -> None:
    """A batch's rows, replacing those of an earlier try."""
    rows.write.mode("overwrite").parquet(path)


def resume_stream(spark: SparkSession, source_dir: str, schema, key: str, out_path: str,
                  checkpoint: str, produce: Callable[[DataFrame], DataFrame]):
    """Streaming form: new Parquet files under ``source_dir`` are processed once (the
    checkpoint records which), one row per key. ``availableNow`` drains what is there
    and stops.

    Keys seen by the stream are its state. Keys that the output held before the stream's
    first run are written beside the checkpoint then, and anti-joined; that table does
    not grow, so a batch costs the same however much the stream has written.
    """
    seed = checkpoint.rstrip("/") + "/keys_before"
    if existing_keys(spark, seed, key) is None:
        before = existing_keys(spark, out_path, key)
        before = spark.createDataFrame([], schema).select(key) if before is None else before.distinct()
        before.write.mode("overwrite").parquet(seed)
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]

    def batch(df: DataFrame, number: int) -> None:
        done = existing_keys(df.sparkSession, seed, key)
        write_batch(produce(pending(df, done, key)), f"{out_path.rstrip('/')}/stream-{name}-{number}")

    had = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        stream = spark.readStream.schema(schema).parquet(source_dir).dropDuplicates([key])
        q = (stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
                   .trigger(availableNow=True).start())
        q.awaitTermination()
    finally:
        spark.conf.set(_PROVIDER, had)
    return read_output(spark, out_path)
