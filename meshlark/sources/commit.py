"""Files that may be made once: how writers of versions agree on who was first."""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch(spark: SparkSession, label: str) -> str:
    """A new path below the folder that all executors share; in local mode where that is unset, below a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="meshlark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/meshlark/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in a new folder of the shared one: what is read from it twice is the same, and no lost task goes back
    behind it."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """What a folder has, in order; nothing if it does not exist."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read(spark: SparkSession, path: str) -> bytes:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes())
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, data: bytes) -> bool:
    """Makes a file with this content; False, and nothing is changed, if it exists already.

    Of several writers one succeeds. In a local file system a finished file is linked to the name, which fails if it is
    taken; elsewhere it is renamed without leave to replace, which HDFS does as one step; on a store whose rename is a
    copy, the name is created conditionally, as far as the store's driver offers that. The content is whole whenever the
    name can be seen.
    """
    fs, p = _fs(spark, path)
    scheme = fs.getUri().getScheme()
    fs.mkdirs(p.getParent())
    if scheme == "file":
        final = unquote(urlparse(p.toUri().toString()).path)
        tmp = f"{os.path.dirname(final)}/.{uuid.uuid4().hex}"
        with open(tmp, "wb") as f:
            f.write(data)
            f.flush()
            os.fsync(f.fileno())
        try:
            os.link(tmp, final)
        except FileExistsError:
            return False
        finally:
            os.unlink(tmp)
        return True
    jvm = spark.sparkContext._jvm
    if scheme in ("hdfs", "viewfs"):
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        out.write(bytearray(data))
        out.close()
        none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(tmp, p, none)
            return True
        except Exception as error:
            fs.delete(tmp, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
    try:
        out = fs.create(p, False)
        out.write(bytearray(data))
        out.close()
        return True
    except Exception as error:
        if "FileAlreadyExists" in str(error) or "412" in str(error):
            return False
        raise
