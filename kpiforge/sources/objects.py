"""Files of whatever store a path names: bytes, frames and folders, through Hadoop's file systems (s3a://, hdfs://, file://)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

#: Formats of frames and the options they are read and written with.
FORMATS = {
    "csv": {"header": "true", "multiLine": "true", "escape": '"', "quoteAll": "true"},
    "json": {},
    "parquet": {},
}


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    where, fs = _file_system(spark, path)
    return fs.exists(where)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """A whole object. For small ones; tables are read with read_frame()."""
    rows = spark.read.format("binaryFile").load(path).select("content").limit(1).collect()
    return bytes(rows[0]["content"])


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """Puts an object in the place of whatever is there."""
    where, fs = _file_system(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def read_frame(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """A table of one of FORMATS."""
    if kind not in FORMATS:
        raise ValueError(f"no format {kind}")
    return spark.read.format(kind).options(**FORMATS[kind]).load(path)


def write_frame(df: DataFrame, path: str, kind: str, mode: str = "overwrite") -> None:
    """Writes a table in one of FORMATS."""
    if kind not in FORMATS:
        raise ValueError(f"no format {kind}")
    df.write.format(kind).options(**{k: v for k, v in FORMATS[kind].items() if k != "multiLine"}).mode(mode).save(path)


def files_below(spark: SparkSession, folder: str) -> Iterator[str]:
    """Paths of all files below a folder, hidden ones aside, relative to it."""
    where, fs = _file_system(spark, folder)
    root = fs.resolvePath(where).toString().rstrip("/") + "/"
    found = fs.listFiles(where, True)
    while found.hasNext():
        path = found.next().getPath().toString()
        name = path[path.index(root.split(":", 1)[-1].lstrip("/")) + len(root.split(":", 1)[-1].lstrip("/")) :]
        if not any(part.startswith(".") for part in name.split("/")):
            yield name


def copy_folder(spark: SparkSession, source: str, target: str, overwrite: bool = True) -> list[str]:
    """Copies all files below a folder that are not hidden; without overwrite those that are there stay. The names copied."""
    done = []
    for name in sorted(files_below(spark, source)):
        a, fs_a = _file_system(spark, f"{source}/{name}")
        b, fs_b = _file_system(spark, f"{target}/{name}")
        if overwrite or not fs_b.exists(b):
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs_a, a, fs_b, b, False, True, spark._jsc.hadoopConfiguration())
            done.append(name)
    return done


def claim(spark: SparkSession, path: str) -> bool:
    """Makes a lock file that must not be there yet; False if another run has it."""
    where, fs = _file_system(spark, path)
    return fs.createNewFile(where)


def free(spark: SparkSession, path: str) -> None:
    where, fs = _file_system(spark, path)
    fs.delete(where, False)
