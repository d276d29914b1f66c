"""Intermediate tables in the folder that driver and executors share.

The folder is the session's spark.checkpoint.dir; only where that is unset (a
local session, as in tests) one is made. A table written there cuts lineage
and survives the loss of any executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}
#: Arrow batches and Parquet row groups while a table is written: executors hold a few of each, whatever the rows' length.
BATCH_ROWS, BATCH_BYTES, GROUP_BYTES = 1024, 4 << 20, 16 << 20


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: spark.checkpoint.dir, or in a local session where that is unset a folder made once for it.

    On a cluster an unset spark.checkpoint.dir is an error, since its machines share no temporary folder.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="kpiforge-")
    return _own[app]


def modest(spark: SparkSession) -> None:
    """Passes rows to Python in small batches for the rest of the session, unless its settings already ask for fewer."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key).rstrip("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Plans made inside pass rows to Python in small batches; the session's own settings come back."""
    own = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS), "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES)}
    before = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


#: On a local file system, where Hadoop has no native library, every file and every checksum file beside it costs a process that sets its
#: permissions; intermediate tables go without checksum files. Other file systems don't look at this.
_PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}


def table(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Writes df to the shared folder and returns the DataFrame that reads it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with _small_batches(df.sparkSession):
        df.write.options(**_PLAIN_FILES).option("compression", codec).option("parquet.block.size", GROUP_BYTES).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def release(df: DataFrame) -> None:
    """Deletes a table() that nothing reads any more."""
    path = df._stored_at
    jvm, spark = df.sparkSession._jvm, df.sparkSession
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
