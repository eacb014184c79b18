"""A store's changes as a Spark data source, to read in a batch or as a stream, and to write.

``spark.read.format("graph_changes").option("path", ...).option("table", "nodes/Customer")`` gives the rows that versions
have written and the keys that they took away, in the table's columns with ``_version`` and ``_change`` (row or gone);
without a table, those of all tables as JSON. As a stream, a version is an offset. Writing appends the rows as one version,
or nothing at all.

With the option prune=true, predicates on ``_version``, ``_change`` and ``_table`` decide which files are opened. Spark (4.1)
keeps the predicates of the first query over a loaded DataFrame for all later ones, so such a DataFrame is for one query;
``read_changes`` loads one and gives it its predicate. Without the option, Spark filters the rows of all files.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamReader, InputPartition, WriterCommitMessage
from pyspark.sql.datasource import EqualTo, GreaterThan, GreaterThanOrEqual, In, LessThan, LessThanOrEqual
from pyspark.sql.types import LongType, StringType, StructField, StructType

#: Columns that a reader adds, and those that it gives without a table.
VERSION, CHANGE, TABLE = "_version", "_change", "_table"
ALL = f"{TABLE} string, {VERSION} long, {CHANGE} string, record string"


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else os.path.abspath(path))


class Log:
    """Manifests of a store, read without a session."""

    def __init__(self, path: str):
        self.path, (self.fs, self.root) = path, _open(path)

    def _names(self, folder: str) -> list[str]:
        from pyarrow.fs import FileSelector

        return sorted(f.base_name for f in self.fs.get_file_info(FileSelector(f"{self.root}/{folder}", allow_not_found=True)) if f.is_file)

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in self._names("_versions") if n.startswith("v") and n.endswith(".json")]

    def manifest(self, version: int) -> dict:
        with self.fs.open_input_file(f"{self.root}/_versions/v{version:010d}.json") as f:
            return json.loads(f.read())

    def files(self, folder: str) -> list[str]:
        return [f"{folder}/{n}" for n in self._names(folder) if n.endswith(".parquet")]


@dataclass
class Piece(InputPartition):
    """A file of changes."""

    table: str
    version: int
    change: str
    file: str


#: What predicates say of the value that a file has.
_TESTS = {EqualTo: lambda v, x: v == x, In: lambda v, x: v in x, GreaterThan: lambda v, x: v > x, GreaterThanOrEqual: lambda v, x: v >= x, LessThan: lambda v, x: v < x, LessThanOrEqual: lambda v, x: v <= x}


class _Pieces:
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.table, self.schema = options["path"], options.get("table"), schema
        self.prune, self.tests = options.get("prune", "false").lower() == "true", []

    def pieces(self, since: int = 0, until: int | None = None) -> list[Piece]:
        log, out = Log(self.path), []
        for v in log.versions():
            if v <= since or until is not None and v > until or not self._fits(VERSION, v):
                continue
            for table, parts in log.manifest(v)["changed"].items():
                if self.table not in (None, table) or not self._fits(TABLE, table):
                    continue
                for change, kind in (("row", "rows"), ("gone", "gone")):
                    if self._fits(CHANGE, change):
                        out += [Piece(table, v, change, f) for x in parts[kind] for f in log.files(x["folder"])]
        return out

    def _fits(self, column: str, value) -> bool:
        return all(_TESTS[type(f)](value, f.value) for f in self.tests if f.attribute == (column,))

    def read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        fs, root = _open(self.path)
        target = to_arrow_schema(self.schema)
        with fs.open_input_file(f"{root}/{piece.file}") as f:
            for b in pq.ParquetFile(f).iter_batches(10_000):
                n = b.num_rows
                added = {VERSION: pa.array([piece.version] * n, pa.int64()), CHANGE: pa.array([piece.change] * n), TABLE: pa.array([piece.table] * n)}
                if self.table is None:
                    added["record"] = pa.array([json.dumps(r, default=str, ensure_ascii=False) for r in b.to_pylist()])
                have = {**dict(zip(b.schema.names, b.columns, strict=True)), **added}
                yield pa.RecordBatch.from_arrays([have[c.name].cast(c.type) if c.name in have else pa.nulls(n, c.type) for c in target], schema=target)


class ChangeReader(_Pieces, DataSourceReader):
    def pushFilters(self, filters):
        for f in filters:
            if self.prune and type(f) in _TESTS and f.attribute in ((VERSION,), (CHANGE,), (TABLE,)):
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> list[Piece]:
        return self.pieces()


class ChangeStream(_Pieces, DataSourceStreamReader):
    def initialOffset(self) -> dict:
        return {"version": 0}

    def latestOffset(self) -> dict:
        return {"version": max(Log(self.path).versions(), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        return self.pieces(start["version"], end["version"])


@dataclass
class Written(WriterCommitMessage):
    bytes: int


class ChangeWriter(DataSourceArrowWriter):
    """Rows as the version after ``base``, the latest one by default. A version's name is made by linking a finished file to
    it, so the folder must be one that is mounted; elsewhere ``Store.commit`` does the same."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.table = options["path"], options["table"]
        self.key = [k.strip() for k in options["key"].split(",")]
        if missing := [k for k in self.key if k not in schema.fieldNames()]:
            raise ValueError(f"rows of {self.table} have no key {missing}")
        log = Log(self.path)
        if log.fs.type_name != "local":
            raise NotImplementedError("changes are written to mounted folders; use Store.commit elsewhere")
        self.base = int(options.get("base", max(log.versions(), default=0)))
        before = log.manifest(self.base)["tables"].get(self.table) if self.base else None
        if before and sorted(f["name"] for f in json.loads(before["schema"])["fields"]) != sorted(schema.fieldNames()):
            raise ValueError(f"{self.table} has other columns")
        self.schema, self.folder = schema.json(), f"{self.table}/rows-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        import pyarrow.parquet as pq

        fs, root = _open(self.path)
        fs.create_dir(f"{root}/{self.folder}", recursive=True)
        name, out = f"{root}/{self.folder}/part-{uuid.uuid4().hex}.parquet", None
        for b in iterator:
            out = out or pq.ParquetWriter(name, b.schema, filesystem=fs, version="2.6", coerce_timestamps="us")
            out.write_batch(b)
        if out is None:
            return Written(0)
        out.close()
        return Written(fs.get_file_info(name).size)

    def commit(self, messages) -> None:
        log = Log(self.path)
        at, new = self.base + 1, {"folder": self.folder, "at": self.base + 1, "bytes": sum(m.bytes for m in messages if m)}
        tables = dict(log.manifest(self.base)["tables"]) if self.base else {}
        table = tables.get(self.table) or {"key": self.key, "schema": self.schema, "rows": [], "gone": []}
        tables[self.table] = {**table, "rows": [*table["rows"], new]}
        data = {"version": at, "made_by": "graph_changes", "tables": tables, "changed": {self.table: {"rows": [new], "gone": []}}}
        log.fs.create_dir(f"{log.root}/_versions", recursive=True)
        final, tmp = f"{log.root}/_versions/v{at:010d}.json", f"{log.root}/_versions/.{uuid.uuid4().hex}"
        try:
            with open(tmp, "w") as f:
                json.dump(data, f)
                f.flush()
                os.fsync(f.fileno())
            os.link(tmp, final)
        except FileExistsError:
            self.abort(messages)
            raise RuntimeError(f"version {at} of {self.path} exists") from None
        finally:
            os.unlink(tmp)

    def abort(self, messages) -> None:
        from pyarrow.fs import FileType

        fs, root = _open(self.path)
        if fs.get_file_info(f"{root}/{self.folder}").type == FileType.Directory:
            fs.delete_dir(f"{root}/{self.folder}")


class GraphChanges(DataSource):
    """Options: path; table, such as nodes/Customer; prune; to write also key, its columns with commas between them, and base."""

    @classmethod
    def name(cls) -> str:
        return "graph_changes"

    def schema(self) -> StructType | str:
        table = self.options.get("table")
        if table is None:
            return ALL
        log = Log(self.options["path"])
        found = next((t["schema"] for v in reversed(log.versions()) if (t := log.manifest(v)["tables"].get(table))), None)
        if found is None:
            raise ValueError(f"the store has no table {table}")
        own = StructType.fromJson(json.loads(found))
        return StructType([*[StructField(f.name, f.dataType) for f in own], StructField(VERSION, LongType()), StructField(CHANGE, StringType())])

    def reader(self, schema: StructType) -> ChangeReader:
        return ChangeReader(dict(self.options), schema)

    def streamReader(self, schema: StructType) -> ChangeStream:
        return ChangeStream(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> ChangeWriter:
        if overwrite:
            raise ValueError("changes are appended")
        return ChangeWriter(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    """Makes the format known to a session, and lets predicates reach it."""
    spark.dataSource.register(GraphChanges)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_changes(spark: SparkSession, path: str, where: str = "true", table: str | None = None) -> DataFrame:
    """Changes that meet a predicate in SQL; only files that can have such are opened."""
    options = {"path": path, "prune": "true", **({} if table is None else {"table": table})}
    return spark.read.format("graph_changes").options(**options).load().where(where)
