"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Target size of one shuffle partition.
SHUFFLE_PARTITION_BYTES = 128 * 1024 * 1024


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """Settings for a job that reads ``input_bytes``.

    The shuffle starts with enough partitions for the input and adaptive
    execution merges them down to the advisory size, so the same code fits a
    few thousand rows and 100 TB. Skewed partitions of a join are split at run
    time. A side is broadcast only when its measured size is under the threshold.
    """
    partitions = max(200, -(-input_bytes // SHUFFLE_PARTITION_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SHUFFLE_PARTITION_BYTES),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.session.timeZone": "UTC",
    }


# With it a join uses rows as they are dealt out by some of its keys.
PLACED_JOINS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def session_with(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session of the same application with the settings of ``spark`` and more; ``spark`` stays as it is."""
    own = spark.newSession()
    for key, value in {**spark.conf.getAll, **settings}.items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    return own


def joins_in_place(spark: SparkSession) -> bool:
    return all(spark.conf.get(key) == value for key, value in PLACED_JOINS.items())


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, which has to be set.

    A folder of the driver's machine is accepted only where executors run there.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    scheme = path.getFileSystem(spark._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"spark.checkpoint.dir {folder} is a folder of one machine")
    return folder.rstrip("/")


@contextmanager
def observed(
    df: DataFrame, name: str, values: Mapping[str, Column]
) -> Iterator[tuple[DataFrame, dict[str, int]]]:
    """``materialized`` with aggregates of the rows, computed in the pass that writes them.

    No aggregate may be distinct. Tasks that run again count once.
    """
    watch = Observation(name)
    if not values:
        with materialized(df, name) as copy:
            yield copy, {}
        return
    with materialized(df.observe(watch, *(v.alias(n) for n, v in values.items())), name) as copy:
        yield copy, dict(watch.get)


@contextmanager
def materialized(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Write ``df`` once to the shared folder and work on the written copy.

    Later jobs read columns from parquet instead of repeating the parse or the
    shuffle, and a lost executor costs only the tasks it was running.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/stockflow/{uuid.uuid4()}/{name}"
    try:
        df.write.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(target, True)
