"""A table of immutable shards under size-tiered compaction, with versioned manifests.

Arrivals are appended as they come, in small shards. Compaction groups shards of similar size (tiers, each
FAN_IN times the one before) and merges a tier that has FAN_IN shards into files of about the target size.
A version is a manifest, one JSON file that names the shards which make up the table. Its name is made once and is never
free again, also after ``vacuum``, which deletes shards only: of two writers one gets it, and the other, however late it
comes, goes on from the latest version or removes what it wrote. Readers see whole versions only. Spark and Hadoop's file
system do all the work.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import commit

TARGET_BYTES = 256 << 20
FAN_IN = 4
#: Shards up to this size are the lowest tier.
LOWEST = 1 << 20
#: Times that a writer tries to commit after others, and seconds after which files that no version names are given up.
TRIES, GIVEN_UP = 20, 24 * 3600.0


class Conflict(RuntimeError):
    """Another writer has committed the version first."""


class ShardedTable:
    """``path`` is a folder of any Hadoop file system; it is made when something is appended."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def versions(self) -> list[int]:
        return sorted(int(n[1:-5]) for n in commit.names(self.spark, f"{self.path}/_manifests") if n.startswith("v") and n.endswith(".json"))

    def version(self) -> int:
        """The latest version; 0 for a table without any."""
        return max(self.versions(), default=0)

    def manifest(self, version: int | None = None) -> dict:
        v = self.version() if version is None else version
        if not v:
            return {"version": 0, "schema": None, "shards": []}
        return json.loads(commit.read(self.spark, f"{self.path}/_manifests/v{v:010d}.json"))

    def _commit(self, base: dict, shards: list[dict], schema: str, made_by: str) -> dict:
        new = {"version": base["version"] + 1, "made_by": made_by, "schema": schema, "shards": shards}
        if not commit.create_once(self.spark, f"{self.path}/_manifests/v{new['version']:010d}.json", json.dumps(new).encode()):
            raise Conflict(f"version {new['version']} exists")
        return new

    def _written(self, df: DataFrame, label: str) -> tuple[list[dict], str]:
        """Writes df as shards in a new folder; Spark's commit decides which files are in it."""
        folder = f"data/{label}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.path}/{folder}")
        files = [s for s in self._fs.listStatus(self._at(folder)) if s.getPath().getName().endswith(".parquet")]
        return [{"file": f"{folder}/{s.getPath().getName()}", "bytes": s.getLen()} for s in files], folder

    @staticmethod
    def _columns(schema: str) -> list[tuple]:
        return [(f["name"], json.dumps(f["type"], sort_keys=True)) for f in json.loads(schema)["fields"]]

    def append(self, df: DataFrame) -> dict:
        """Commits df as new shards, one for each of its partitions; returns the manifest. Columns and types must be the
        table's. Where others commit meanwhile, their versions come first; no arrival is lost.

        Nulls, repeated rows and any texts are kept as they are; an empty df makes a version with at most an empty shard.
        """
        schema = df.schema.json()
        base = self.manifest()
        if base["schema"] and self._columns(schema) != self._columns(base["schema"]):
            raise ValueError(f"the columns are {self._columns(schema)}; the table's are {self._columns(base['schema'])}")
        new, folder = self._written(df, "arrival")
        for _ in range(TRIES):
            try:
                return self._commit(base, base["shards"] + new, base["schema"] or schema, "append")
            except Conflict:
                base = self.manifest()
                if base["schema"] and self._columns(schema) != self._columns(base["schema"]):
                    break
        self._fs.delete(self._at(folder), True)
        raise Conflict(f"others went on committing versions of {self.path}, or gave it other columns")

    def read(self, version: int | None = None) -> DataFrame:
        """The table at a version, the latest by default; all rows as they came, none for a version without shards. A table
        without any version is a ValueError, one whose shards vacuum has deleted an error of the file system."""
        m = self.manifest(version)
        if not m["schema"]:
            raise ValueError("the table has no version")
        schema = StructType.fromJson(json.loads(m["schema"]))
        if not m["shards"]:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{s['file']}" for s in m["shards"]])

    @staticmethod
    def tier(size: int, fan_in: int = FAN_IN) -> int:
        return max(0, math.floor(math.log(max(size, 1) / LOWEST, fan_in)) + 1)

    def compact(self, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN) -> dict:
        """Merges, until no tier is left with ``fan_in`` shards under half the target; returns the last manifest.

        Each round merges all shards of the lowest such tier in one Spark job, without a shuffle, into files of the
        target size, or as many as the tier's bytes fill. Rows are neither changed nor dropped. Merged shards stay on
        disk for readers of older versions until ``vacuum``. Where others commit meanwhile, a merge whose shards are all
        still in the table is committed after theirs; otherwise it is removed, and made anew from what is there.
        """
        lost = 0
        while True:
            m = self.manifest()
            tiers: dict[int, list[dict]] = {}
            for s in m["shards"]:
                if 2 * s["bytes"] < target_bytes:
                    tiers.setdefault(self.tier(s["bytes"], fan_in), []).append(s)
            ready = sorted(t for t, shards in tiers.items() if len(shards) >= fan_in)
            if not ready:
                return m
            run = tiers[ready[0]]
            n = max(1, round(sum(s["bytes"] for s in run) / target_bytes))
            schema = StructType.fromJson(json.loads(m["schema"]))
            gone = {s["file"] for s in run}
            try:
                merged, folder = self._written(self.spark.read.schema(schema).parquet(*[f"{self.path}/{s['file']}" for s in run]).coalesce(n), "merged")
            except Exception:
                lost += 1
                if lost > TRIES or gone <= {s["file"] for s in self.manifest()["shards"]}:
                    raise
                continue  # others have merged these shards, and vacuum has deleted them
            while gone <= {s["file"] for s in m["shards"]} and lost < TRIES:
                try:
                    self._commit(m, [s for s in m["shards"] if s["file"] not in gone] + merged, m["schema"], "compact")
                    break
                except Conflict:
                    lost += 1
                    m = self.manifest()
            else:
                self._fs.delete(self._at(folder), True)
                lost += 1
                if lost > TRIES:
                    raise Conflict(f"others went on committing versions of {self.path}")

    def _vacuumed(self) -> int:
        """The version that was the latest when shards were last deleted; 0 for never."""
        return max((int(n[9:]) for n in commit.names(self.spark, f"{self.path}/_manifests") if n.startswith("vacuumed-")), default=0)

    def vacuum(self, given_up: float = GIVEN_UP) -> None:
        """Deletes shards that older versions name and the latest does not; of files that no version names, which a writer
        may be about to commit, only those written over ``given_up`` seconds ago. Manifests stay, so that no writer can
        take an old version's name; reading a version whose shards are gone is an error of the file system. An empty
        table, or one without versions, is left as it is."""
        latest, before = self.manifest(), self._vacuumed()
        old = [v for v in self.versions() if before <= v < latest["version"]]
        named = {s["file"] for s in latest["shards"]}
        once = {s["file"] for v in old for s in self.manifest(v)["shards"]}
        for f in once - named:
            self._fs.delete(self._at(f), False)
        since = (time.time() - given_up) * 1000
        for name in commit.names(self.spark, f"{self.path}/data"):
            files = [s for s in self._fs.listStatus(self._at(f"data/{name}"))]
            shards = [s for s in files if s.getPath().getName().endswith(".parquet")]
            for s in shards:
                if f"data/{name}/{s.getPath().getName()}" not in named | once and s.getModificationTime() < since:
                    self._fs.delete(s.getPath(), False)
            if any(s.getPath().getName() == "_SUCCESS" for s in files) and not any(self._fs.exists(s.getPath()) for s in shards):
                self._fs.delete(self._at(f"data/{name}"), True)
        if latest["version"]:
            commit.create_once(self.spark, f"{self.path}/_manifests/vacuumed-{latest['version']:010d}", b"")


def arrive_in_batches(df: DataFrame, table: ShardedTable, batches: int, key: str) -> dict:
    """Appends df in so many arrivals, dealt by a hash of the key; null keys are an arrival's as well. df is read once for each
    arrival and must not change between."""
    m = table.manifest()
    for k in range(batches):
        m = table.append(df.where(F.pmod(F.xxhash64(F.col(key)), F.lit(batches)) == k))
    return m
