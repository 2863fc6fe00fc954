"""Stored tables that change while they are read: INSERT, UPDATE, DELETE and the
replacement of partitions.

A table is a folder with two parts:

* ``data/write=<id>/<column>=<value>/...``: every write of Parquet files has a folder
  of its own and never touches another one's;
* ``versions/version=<n>/commit=<id>/``: one small file that lists, for each
  partition, the writes that make it up.

A write first puts its data files down and only then its version file, which Spark
moves into place in one step. A reader takes the newest version file and reads
exactly the folders it lists: it sees the table before a write or after it, and a
write that fails leaves the old version in force. ``UPDATE`` and ``DELETE`` read,
rewrite and relist only the partitions that hold matching rows; the other
partitions' files stay where they are. A read of one partition opens that
partition's files only.

One writer at a time: a write that finds a version newer than the one it began with
raises ``StaleTable`` (and changes nothing). What the driver holds is one row per
partition and write, never rows of the table. Old writes stay readable by version
number until the folder is cleaned up by the deployment.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inforce.operators.common import exclude_keys

_LISTING = "part string, write string, schema string"


def _value(part: str) -> str:
    """Value of a partition's folder name, as text."""
    return unquote(part.partition("=")[2])


def _cast(df: DataFrame, schema: StructType) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


class StaleTable(RuntimeError):
    """Another write changed the table meanwhile."""


class StoredTable:
    """A table under ``path``, partitioned by one column."""

    def __init__(self, spark: SparkSession, path: str, partition_by: str):
        self.spark, self.path, self.column = spark, path.rstrip("/"), partition_by

    # ------------------------------------------------------------------ versions
    def _files(self, folder: str) -> list[str]:
        """Names of the Parquet files below a folder of this table."""
        try:
            return self.spark.read.schema("part string").parquet(f"{self.path}/{folder}").inputFiles()
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _commits(self) -> dict[int, str]:
        """Commit of each version: the least id, should two writers have met."""
        found: dict[int, str] = {}
        for f in self._files("versions"):
            m = re.search(r"/version=(\d+)/commit=([0-9a-f]+)/", f)
            if m:
                n = int(m[1])
                found[n] = min(found.get(n, m[2]), m[2])
        return found

    def version(self) -> int:
        """Number of the newest version; 0: nothing written yet."""
        return max(self._commits(), default=0)

    def _listing(self, version: int | None = None) -> tuple[int, list[tuple[str, str]], StructType | None]:
        commits = self._commits()
        version = max(commits, default=0) if version is None else version
        if version == 0:
            return 0, [], None
        rows = self.spark.read.schema(_LISTING).parquet(f"{self.path}/versions/version={version}/commit={commits[version]}").collect()
        schema = StructType.fromJson(json.loads(rows[0]["schema"]))
        return version, sorted((r["part"], r["write"]) for r in rows if r["part"] is not None), schema

    def _commit(self, base: int, listing: Sequence[tuple[str, str]], schema: StructType) -> int:
        if self.version() != base:
            raise StaleTable(f"{self.path}: version {self.version()} is newer than {base}, which this write began with")
        text, commit, now = schema.json(), uuid.uuid4().hex, base + 1
        # a row without a partition keeps the schema of a table that has no rows
        rows = [(p, w, text) for p, w in sorted(set(listing))] or [(None, None, text)]
        self.spark.createDataFrame(rows, _LISTING).coalesce(1).write.parquet(f"{self.path}/versions/version={now}/commit={commit}")
        if self._commits()[now] != commit:
            raise StaleTable(f"{self.path}: another write made version {now}")
        return now

    # ------------------------------------------------------------------ reading
    def partitions(self, version: int | None = None) -> list[str]:
        """Values of the partition column as text, ascending; no file is opened."""
        return sorted({_value(p) for p, _ in self._listing(version)[1]})

    def read(self, version: int | None = None, only: Callable[[str], bool] | None = None) -> DataFrame:
        """The table at a version (the newest one). ``only`` picks partitions by their
        value as text; files of the others are not listed."""
        _, listing, schema = self._listing(version)
        if schema is None:
            raise ValueError(f"{self.path}: nothing has been written")
        return self._frame([x for x in listing if only is None or only(_value(x[0]))], schema)

    def latest_partition(self) -> DataFrame:
        """The partition with the greatest value (as text: dates, zero-padded numbers)."""
        parts = [p for p in self.partitions() if not p.startswith("__HIVE")]
        return self.read(only=lambda p: bool(parts) and p == parts[-1])

    def _frame(self, listing: Sequence[tuple[str, str]], schema: StructType) -> DataFrame:
        if not listing:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/data/write={w}/{p}" for p, w in listing]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths).select(*schema.names)

    # ------------------------------------------------------------------ writing
    def _write(self, df: DataFrame) -> list[tuple[str, str]]:
        write = uuid.uuid4().hex
        # few files per partition, but a partition with very many rows is split among tasks
        df.hint("rebalance", self.column).write.partitionBy(self.column).parquet(f"{self.path}/data/write={write}")
        found = {unquote(m[1]) for f in self._files(f"data/write={write}") if (m := re.search(rf"/write={write}/([^/]+)/", f))}
        return [(p, write) for p in sorted(found)]

    def insert(self, df: DataFrame) -> int:
        """``INSERT INTO``: adds rows; returns the new version."""
        version, listing, schema = self._listing()
        schema = schema or df.schema
        return self._commit(version, [*listing, *self._write(_cast(df, schema))], schema)

    def replace(self, df: DataFrame) -> int:
        """Overwrites the partitions that ``df`` has rows for, and only those: writing
        the same rows twice gives the same table."""
        version, listing, schema = self._listing()
        schema = schema or df.schema
        new = self._write(_cast(df, schema))
        gone = {p for p, _ in new}
        return self._commit(version, [*(x for x in listing if x[0] not in gone), *new], schema)

    def overwrite(self, df: DataFrame) -> int:
        """``CREATE OR REPLACE``: the rows and columns of ``df`` and no others."""
        version = self._listing()[0]
        return self._commit(version, self._write(df), df.schema)

    def _touched(self, df: DataFrame) -> set[str]:
        """Partitions of this table that rows of ``df``, a selection of it, lie in."""
        files = df.select(F.col("_file").alias("f")).distinct().collect()
        return {unquote(m[1]) for r in files if (m := re.search(r"/write=[0-9a-f]+/([^/]+)/", r["f"]))}

    def _rewrite(self, picked: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame]) -> int:
        """Rewrites the partitions that hold rows which ``picked`` selects."""
        version, listing, schema = self._listing()
        if schema is None:
            raise ValueError(f"{self.path}: nothing has been written")
        if not listing:
            return version
        touched = self._touched(picked(self._files_of(listing, schema)))
        if not touched:
            return version
        new = self._write(change(self._frame([x for x in listing if x[0] in touched], schema)).select(*schema.names))
        return self._commit(version, [*(x for x in listing if x[0] not in touched), *new], schema)

    def _files_of(self, listing: Sequence[tuple[str, str]], schema: StructType) -> DataFrame:
        paths = [f"{self.path}/data/write={w}/{p}" for p, w in listing]
        df = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*paths)
        return df.select(*schema.names, F.col("_metadata.file_path").alias("_file"))

    def delete(self, condition: Column) -> int:
        """``DELETE WHERE``: rows for which the condition is true go."""
        hit = F.coalesce(condition, F.lit(False))
        return self._rewrite(lambda df: df.filter(hit), lambda df: df.filter(~hit))

    def delete_in(self, ids: DataFrame, key: str) -> int:
        """``DELETE WHERE key IN (SELECT key FROM ids)``; NULLs match nothing."""
        ids = ids.select(key).distinct()
        return self._rewrite(lambda df: df.join(ids, key, "left_semi"), lambda df: exclude_keys(df, ids, [key]))

    def update(self, values: Mapping[str, Column], condition: Column) -> int:
        """``UPDATE SET ... WHERE``: other rows keep their values."""
        hit, types = F.coalesce(condition, F.lit(False)), {f.name: f.dataType for f in self.schema().fields}
        new = {c: F.when(hit, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()}
        return self._rewrite(lambda df: df.filter(hit), lambda df: df.withColumns(new))

    def update_from(self, source: DataFrame, keys: Sequence[str], change: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """``UPDATE ... FROM``: ``change(rows, source)`` on the partitions in which a
        row's keys (NULL equals NULL) occur in the source."""
        names = [f"_s{i}" for i in range(len(keys))]
        ids = source.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)])  # a semi join: repeats change nothing
        on = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names, strict=True)]
        return self._rewrite(lambda df: df.join(ids, on, "left_semi"), lambda df: change(df, source))

    def schema(self) -> StructType:
        schema = self._listing()[2]
        if schema is None:
            raise ValueError(f"{self.path}: nothing has been written")
        return schema

    def add_columns(self, defaults: Mapping[str, Column]) -> int:
        """``ALTER TABLE ADD COLUMN ... DEFAULT``: every partition is rewritten."""
        version, listing, schema = self._listing()
        if schema is None:
            raise ValueError(f"{self.path}: nothing has been written")
        df = self._frame(listing, schema).withColumns(dict(defaults))
        return self._commit(version, self._write(df) if listing else [], df.schema)
