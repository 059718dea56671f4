"""Tables written to the folder that driver and executors share: a cut of the lineage that lost executors can't undo."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a session on this machine alone gets a new local folder; on a cluster that is an error, as machines would not see one another's rows."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet under the shared folder and read back."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
