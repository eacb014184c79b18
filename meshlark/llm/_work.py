"""Shared-folder tables and files, fresh column names and size-checked broadcasts."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections import OrderedDict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; unset in local mode, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = "file://" + tempfile.mkdtemp(prefix="meshlark-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/meshlark/{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the application's own folder below the shared one."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


#: Spark's setting by which a query's shuffle files go when it ends; a table that has been written does not need them.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_table(df: DataFrame, path: str, codec: str | None = None) -> None:
    """Writes df as Parquet, by the session's codec unless one is named; the shuffle files of its query go when that is done."""
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, label: str, codec: str | None = None) -> tuple[DataFrame, str]:
    """Writes df as Parquet in the shared folder; returns the table read back, and its path."""
    spark = df.sparkSession
    path = scratch(spark, label)
    write_table(df, path, codec)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, *paths: str) -> None:
    jvm = spark.sparkContext._jvm
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cleanup(spark: SparkSession) -> None:
    """Deletes the application's scratch tables, those of results not yet read included; other applications' stay."""
    remove(spark, _own_folder(spark))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of df has, letter case aside."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def col(name: str):
    """A top-level column, dots and blanks in its name included."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame) -> DataFrame:
    """df with columns named c0, c1, and so on: Python stages cannot read every name that Spark can."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


#: Bytes of rows that are sent to every task at most, and what a row of a broadcast table takes besides its values.
SENT_BYTES, ROW_BYTES = 32 << 20, 48
_WIDTH = {"boolean": 1, "tinyint": 1, "int": 4, "bigint": 8, "double": 8, "date": 4}


def is_small(df: DataFrame, rows: int, text_bytes: int = 32) -> bool:
    """Whether so many rows of df fit SENT_BYTES; a value without a fixed width counts ``text_bytes``."""
    return rows * (ROW_BYTES + sum(_WIDTH.get(kind, text_bytes) for _, kind in df.dtypes)) <= SENT_BYTES


def small_side(df: DataFrame, rows: int, text_bytes: int = 32) -> DataFrame:
    """Marks df, of so many rows, for broadcast where these are small in bytes; beyond, Spark shuffles."""
    return F.broadcast(df) if is_small(df, rows, text_bytes) else df


def squeeze(data: bytes) -> bytes:
    import pyarrow as pa

    return len(data).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(data, asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    import pyarrow as pa

    return pa.Codec("zstd").decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def open_fs(uri: str):
    """pyarrow file system and path of a URI, for executors that write files other than Spark's."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else os.path.abspath(uri))


def made_once(key, make):
    """A value that a Python worker makes once, however many of its tasks need it; only the last few are held."""
    import sys
    import types

    box = sys.modules.setdefault("_meshlark_made", types.ModuleType("_meshlark_made")).__dict__.setdefault("held", {})
    if key not in box:
        while len(box) >= 3:
            del box[next(iter(box))]
        box[key] = make()
    return box[key]


def tidy(run):
    """The function of batches, giving memory back to the system when its task ends: Python workers are used again, by
    other operators too, and what one of them once held would else stay with them."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes

            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim:
                trim(0)

    return tidied


class FileWriter:
    """Byte strings in a file of a task's own in a folder; a place is (file, start, length). The file is there after ``close``,
    and only files whose places Spark has committed with the task's rows are ever read."""

    def __init__(self, folder: str):
        self.folder, self.name, self.at, self._out = folder, uuid.uuid4().hex, 0, None

    def add(self, data: bytes) -> tuple[str, int, int]:
        if self._out is None:
            fs, root = open_fs(self.folder)
            fs.create_dir(root, recursive=True)
            self._out = fs.open_output_stream(f"{root}/{self.name}", compression=None)
        self._out.write(data)
        self.at += len(data)
        return self.name, self.at - len(data), len(data)

    def close(self) -> None:
        if self._out is not None:
            self._out.close()


class FileReader:
    """Reads places of a folder; the last used byte strings are held, up to so many bytes."""

    def __init__(self, folder: str, held_bytes: int = 32 << 20):
        self.fs, self.root = open_fs(folder)
        self.room, self.held, self.files = held_bytes, OrderedDict(), OrderedDict()

    def get(self, name: str, at: int, size: int) -> bytes:
        if (name, at) in self.held:
            self.held.move_to_end((name, at))
            return self.held[name, at]
        if name not in self.files:
            if len(self.files) >= 64:
                self.files.popitem(last=False)[1].close()
            self.files[name] = self.fs.open_input_file(f"{self.root}/{name}")
        self.files[name].seek(at)
        self.held[name, at] = data = self.files[name].read(size)
        self.room -= size
        while self.room < 0 and len(self.held) > 1:
            self.room += len(self.held.popitem(last=False)[1])
        return data
