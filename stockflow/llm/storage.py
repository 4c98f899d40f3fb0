"""Where operators cut lineage: written tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``.

    Where it is unset a folder of this machine is used, and only if the master
    is this machine; on a cluster the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return f"{folder.rstrip('/')}/llm"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and go on with the written table.

    A lost executor then costs the tasks it was running, and what is read from
    here on does not repeat the work above it. The files live as long as the
    shared folder; the caller of the operator owns that folder.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
