"""Versions of a graph's tables that are kept as changes.

A version is a manifest, one JSON file whose name is made once and never given up. For each table it names folders of rows,
with the version that wrote them, and folders of keys that were taken away. A row counts if no later version wrote or took
away its key: tables are put together when they are read, and a change writes what it changes. Compaction writes a table
in one folder again; older versions can be read as long as their folders are there.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..errors import SaveConflict, UpsertConflict
from . import commit

#: Bytes of changed keys that are sent to every task at most, when a table is put together.
SENT_BYTES = 32 << 20
#: A table is compacted once it has so many folders, or its changes are such a share of its bytes.
FOLDERS, SHARE = 16, 0.25


@dataclass
class Change:
    """What a version changes in a table: rows that are new or take the place of those with their key, and keys that go."""

    key: tuple[str, ...]
    rows: DataFrame | None = None
    gone: DataFrame | None = None


def _same(left: tuple[str, ...], right: tuple[str, ...]):
    return reduce(lambda a, b: a & b, [F.col(f"`{x}`") == F.col(f"`{y}`") for x, y in zip(left, right, strict=True)])


class Store:
    """``path`` is a folder of any Hadoop file system; it is made with the first version."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def versions(self) -> list[int]:
        return [int(n[1:-5]) for n in commit.names(self.spark, f"{self.path}/_versions") if n.startswith("v") and n.endswith(".json")]

    def version(self) -> int:
        """The latest version; 0 for a store without any."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        v = self.version() if version is None else version
        return json.loads(commit.read(self.spark, f"{self.path}/_versions/v{v:010d}.json")) if v else {"version": 0, "tables": {}, "changed": {}}

    def _size(self, folder: str) -> int:
        fs, p = commit._fs(self.spark, f"{self.path}/{folder}")
        return fs.getContentSummary(p).getLength()

    def _put(self, df: DataFrame, name: str, what: str, at: int) -> dict:
        folder = f"{name}/{what}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        return {"folder": folder, "at": at, "bytes": self._size(folder)}

    def commit(self, changes: dict[str, Change], base: int | None = None, made_by: str = "change") -> int:
        """Writes changes of tables as the version after ``base``, the latest by default; returns its number.

        SaveConflict if that version exists by the time the changes are written, which are then removed. Keys are not null;
        UpsertConflict where several rows of a change have one key. Tables that a change names first are new.
        """
        before = self.manifest(base)
        at, tables = before["version"] + 1, dict(before["tables"])
        changed: dict[str, dict[str, list[dict]]] = {}
        try:
            for name, c in changes.items():
                table = dict(tables.get(name) or {"key": list(c.key), "schema": (c.rows if c.rows is not None else c.gone).schema.json(), "rows": [], "gone": []})
                new = changed[name] = {"rows": [], "gone": []}
                if c.rows is not None:
                    several = c.rows.groupBy(*c.key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).collect()
                    if several:
                        raise UpsertConflict(f"several rows of {name} have {[several[0][k] for k in c.key]}")
                    names = StructType.fromJson(json.loads(table["schema"])).fieldNames()
                    if sorted(c.rows.columns) != sorted(names):
                        raise ValueError(f"{name} has the columns {names}, the change has {c.rows.columns}")
                    new["rows"].append(self._put(c.rows.select(*[F.col(f"`{x}`") for x in names]), name, "rows", at))
                if c.gone is not None:
                    new["gone"].append(self._put(c.gone.select(*c.key).distinct(), name, "gone", at))
                tables[name] = {**table, **{k: [*table[k], *new[k]] for k in new}}
            self._name(at, tables, changed, made_by)
        except Exception:
            self._remove(changed)
            raise
        return at

    def _name(self, at: int, tables: dict, changed: dict, made_by: str) -> None:
        data = json.dumps({"version": at, "made_by": made_by, "tables": tables, "changed": changed}).encode()
        if not commit.create_once(self.spark, f"{self.path}/_versions/v{at:010d}.json", data):
            raise SaveConflict(f"version {at} of {self.path} exists")

    def _remove(self, written: dict) -> None:
        for x in written.values():
            for f in [*x["rows"], *x["gone"]]:
                commit.delete(self.spark, f"{self.path}/{f['folder']}")

    def _folders(self, table: dict, what: str, columns: list[str] | None = None) -> DataFrame | None:
        """Rows of a table's folders with the version that wrote them, ``_at``."""
        schema = StructType.fromJson(json.loads(table["schema"]))
        schema = schema if columns is None else StructType([schema[c] for c in columns])
        read = lambda f: self.spark.read.schema(schema).parquet(f"{self.path}/{f['folder']}").withColumn("_at", F.lit(f["at"]))
        return reduce(DataFrame.unionByName, [read(f) for f in table[what]]) if table[what] else None

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as it was at a version, the latest by default. KeyError for a table that it does not have."""
        table = self.manifest(version)["tables"][name]
        rows, key = self._folders(table, "rows"), table["key"]
        if rows is None:
            return self.spark.createDataFrame([], StructType.fromJson(json.loads(table["schema"])))
        first = min(f["at"] for f in table["rows"])
        later = {"key": key, "schema": table["schema"], "rows": [f for f in table["rows"] if f["at"] > first], "gone": [f for f in table["gone"] if f["at"] > first]}
        over = [x for x in (self._folders(later, "rows", key), self._folders(later, "gone", key)) if x is not None]
        if over:
            marks = reduce(DataFrame.unionByName, over).groupBy(*key).agg(F.max("_at").alias("_last")).toDF(*[f"_k{n}" for n in range(len(key))], "_last")
            if sum(f["bytes"] for f in [*later["rows"], *later["gone"]]) <= SENT_BYTES:
                marks = F.broadcast(marks)
            rows = rows.join(marks, _same(tuple(key), tuple(f"_k{n}" for n in range(len(key)))) & (F.col("_last") > F.col("_at")), "left_anti")
        return rows.drop("_at")

    def changes(self, name: str, since: int, until: int | None = None) -> DataFrame:
        """Net changes of a table from one version to a later one: its key, ``change`` (insert, update or delete), and the
        records ``before`` and ``after``, null where there is none. Only rows that a version between has written are
        compared; rows that are as they were are no change."""
        until = self.version() if until is None else until
        touched = []
        for v in range(since + 1, until + 1):
            m = self.manifest(v)
            if name in m["changed"]:
                part = {**m["tables"][name], **m["changed"][name]}
                touched += [x.drop("_at") for x in (self._folders(part, "rows", part["key"]), self._folders(part, "gone", part["key"])) if x is not None]
        table = self.manifest(until)["tables"][name]
        key, schema = table["key"], StructType.fromJson(json.loads(table["schema"]))
        keys = reduce(DataFrame.unionByName, touched).distinct() if touched else self.spark.createDataFrame([], StructType([schema[k] for k in key]))
        had = name in self.manifest(since)["tables"]

        def at(version: int | None, own: str) -> DataFrame:
            df = self.spark.createDataFrame([], schema) if version is None else self.read(name, version)
            df = df.join(keys, key, "left_semi")
            return df.select(*key, F.struct(*[F.col(f"`{c}`") for c in schema.fieldNames()]).alias(own))

        both = at(since if had else None, "before").join(at(until, "after"), key, "full").where(~F.col("before").eqNullSafe(F.col("after")))
        kind = F.when(F.col("before").isNull(), "insert").when(F.col("after").isNull(), "delete").otherwise("update")
        return both.select(*key, kind.alias("change"), "before", "after")

    def compact(self, folders: int = FOLDERS, share: float = SHARE) -> int:
        """Writes tables with ``folders`` folders, or whose changes are a ``share`` of their bytes, in one folder; returns the
        version, which is the latest one if there are none. SaveConflict if another writer commits meanwhile."""
        m = self.manifest()
        tables, written = dict(m["tables"]), {}
        for name, t in m["tables"].items():
            own = [*t["rows"], *t["gone"]]
            first = min((f["at"] for f in t["rows"]), default=0)
            changed = sum(f["bytes"] for f in own if f["at"] > first)
            if len(own) > 1 and (len(own) >= folders or changed >= share * sum(f["bytes"] for f in own)):
                put = self._put(self.read(name, m["version"]), name, "rows", m["version"] + 1)
                written[name] = {"rows": [put], "gone": []}
                tables[name] = {**t, "rows": [put], "gone": []}
        if not written:
            return m["version"]
        try:
            self._name(m["version"] + 1, tables, {}, "compact")
        except SaveConflict:
            self._remove(written)
            raise
        return m["version"] + 1


def difference(key: tuple[str, ...], old: DataFrame, new: DataFrame) -> Change:
    """The change that makes a table of another: rows that are new or not as they were, and keys that are no more."""
    other = old.toDF(*[f"_o_{c}" for c in old.columns])
    alike = reduce(lambda a, b: a & b, [F.col(f"`{c}`").eqNullSafe(F.col(f"`_o_{c}`")) for c in new.columns if c not in key], F.lit(True))
    rows = new.join(other, _same(key, tuple(f"_o_{k}" for k in key)) & alike, "left_anti")
    kept = new.select(*[F.col(f"`{k}`").alias(f"_n_{k}") for k in key])
    gone = old.select(*key).join(kept, _same(key, tuple(f"_n_{k}" for k in key)), "left_anti")
    return Change(key, rows, gone)
