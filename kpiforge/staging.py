"""Intermediate tables that several parts of a plan read: computed once, written to the folder that all machines share.

The folder is the session's spark.checkpoint.dir; a local session without one gets a folder of its own, which goes with
the process. A written table survives the loss of any executor.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or in a local session where that is unset a folder made once for it."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="kpiforge-staged-")
        atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
    return _own[app]


def staged(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder under a path of its own and read from there."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
