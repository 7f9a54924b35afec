"""Where tables, logs and stream state that must outlive an executor are put."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the folder the cluster shares (``spark.checkpoint.dir``).

    Only a local session may run without that setting; it gets a temporary
    folder. On a cluster a machine-local folder would be lost with its machine,
    so an unset value is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="snapfeed-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a fresh path and read back, so that it is computed once."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
