"""A versioned Parquet store: each write makes a new version, and one small file names the current one.

That file lists the folders of rows that make up the version, so an append writes only its own rows.
Readers see the old version or the new one, never a mixture. Of two writers that started from the
same version the second fails.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tessera.errors import PlanError


#: Folders of rows that a version may have.
MAX_PARTS = 32


class VersionedStore:
    """Tables under a folder that Spark and Hadoop's file system reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.folder, *parts]))

    def _fs(self):
        return self._jvm.org.apache.hadoop.fs.Path(self.folder).getFileSystem(self._conf)

    def versions(self, table: str) -> list[tuple[int, str]]:
        """(number, folder) of the published versions, oldest first."""
        fs, at = self._fs(), self._path(table, "_versions")
        if not fs.exists(at):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return sorted((int(n.split("-")[0]), n) for n in names)

    def read(self, table: str, version: int | None = None) -> DataFrame:
        have = self.versions(table)
        if not have:
            raise PlanError(f"no table {table}")
        chosen = dict(have).get(version) if version is not None else have[-1][1]
        if chosen is None:
            raise PlanError(f"no version {version} of {table}")
        parts = self._parts(table, chosen)
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.folder}/{table}/{p}") for p in parts])

    def _parts(self, table: str, name: str) -> list[str]:
        """The folders of rows of a version, oldest first."""
        stream = self._fs().open(self._path(table, "_versions", name))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def write(self, table: str, rows: DataFrame, based_on: int | None = None, partition_by: tuple[str, ...] = ()) -> int:
        """Publishes rows as the next version. based_on: the version that they were made from."""
        return self._publish(table, rows, based_on, [], partition_by)

    def append(self, table: str, rows: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Publishes the current rows and these. Only these are written, unless types differ or the
        version has MAX_PARTS folders, which are then written as one."""
        have = self.versions(table)
        if not have:
            return self.write(table, rows, 0, partition_by)
        now, parts = self.read(table), self._parts(table, have[-1][1])
        if len(parts) >= MAX_PARTS or dict(rows.dtypes) != dict(now.dtypes):
            return self.write(table, now.unionByName(rows), have[-1][0], partition_by)
        return self._publish(table, rows.select(*now.columns), have[-1][0], parts, partition_by)

    def _publish(self, table: str, rows: DataFrame, based_on: int | None, before: list[str], partition_by: tuple[str, ...]) -> int:
        last = max([0, *[n for n, _ in self.versions(table)]])
        number = (last if based_on is None else based_on) + 1
        name = f"{number}-{uuid.uuid4().hex}"
        rows.write.partitionBy(*partition_by).parquet(f"{self.folder}/{table}/{name}")
        fs = self._fs()
        fs.mkdirs(self._path(table, "_versions"))
        # the lock's name is the number alone: making it fails if another writer was first
        lock = self._path(table, f"_lock-{number}")
        if not fs.createNewFile(lock):
            fs.delete(self._path(table, name), True)
            raise PlanError(f"version {number} of {table} was written by another")
        # the list is complete before its name is there
        draft = self._path(table, f"_draft-{name}")
        stream = fs.create(draft)
        stream.write(bytearray(json.dumps([*before, name]).encode()))
        stream.close()
        if not fs.rename(draft, self._path(table, "_versions", name)):
            raise PlanError(f"version {number} of {table} can't be published")
        return number

    def loader(self):
        """For an Engine's repos. A tenant is a prefix of the table's folder."""
        return lambda table, tenant: self.read(f"{tenant}/{table}" if tenant else table)

    def create_tenant(self, name: str) -> None:
        self._fs().mkdirs(self._path(name))

    def rename_tenant(self, old: str, new: str) -> None:
        fs = self._fs()
        if not fs.exists(self._path(old)) or not fs.rename(self._path(old), self._path(new)):
            raise PlanError(f"tenant {old} can't be renamed to {new}")
