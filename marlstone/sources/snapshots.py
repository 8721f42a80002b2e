"""Versioned tables as parquet snapshots in a shared folder.

Layout: ``parts/<id>`` holds rows, ``history/v=N`` holds one row that
lists the parts of version N. The history row is written last, so a write that fails half-way leaves
the table at its old version. An append adds a part and rewrites nothing. One writer per table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.operators.changes import merge_into, update_where

_HISTORY = "version bigint, committed_at timestamp, operation string, n_rows bigint, parts array<string>, layout string"


class SchemaMismatch(ValueError):
    def __init__(self, missing: list[str], extra: list[str], changed: list[str]):
        self.missing, self.extra, self.changed = missing, extra, changed
        super().__init__(f"missing columns {missing}, extra columns {extra}, changed types {changed}")


def check_schema(target: T.StructType, new: T.StructType, allow_extra: bool = False) -> None:
    have = {f.name: f.dataType for f in new}
    want = {f.name: f.dataType for f in target}
    missing = [] if allow_extra else sorted(set(want) - set(have))
    extra = [] if allow_extra else sorted(set(have) - set(want))
    changed = sorted(c for c in set(want) & set(have) if want[c] != have[c])
    if missing or extra or changed:
        raise SchemaMismatch(missing, extra, changed)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


class SnapshotTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self._version = -1  # last version this writer committed or found

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> SnapshotTable:
        found = cls(spark, path)
        found._version = spark.read.schema(_HISTORY).parquet(f"{path}/history").agg(F.max("version")).first()[0]
        return found

    @property
    def version(self) -> int:
        return self._version

    def history(self) -> DataFrame:
        """One row per version: version, committed_at, operation, n_rows."""
        rows = self.spark.read.schema(_HISTORY).parquet(f"{self.path}/history")
        return rows.select("version", "committed_at", "operation", "n_rows")

    def _entry(self, version: int):
        return self.spark.read.schema(_HISTORY).parquet(f"{self.path}/history/v={version}").first()

    def schema(self, version: int | None = None) -> T.StructType:
        entry = self._entry(self._version if version is None else version)
        return T.StructType.fromJson(json.loads(entry.layout))

    def read(self, version: int | None = None) -> DataFrame:
        entry = self._entry(self._version if version is None else version)
        layout = T.StructType.fromJson(json.loads(entry.layout))
        return self.spark.read.schema(layout).parquet(*[f"{self.path}/parts/{p}" for p in entry.parts])

    def _commit(self, df: DataFrame, operation: str, kept: Sequence[str], layout: T.StructType, rows_before: int) -> int:
        part = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/parts/{part}")
        n_rows = rows_before + self.spark.read.schema(df.schema).parquet(f"{self.path}/parts/{part}").count()
        version = self._version + 1
        row = (version, operation, n_rows, [*kept, part], layout.json())
        names = "version bigint, operation string, n_rows bigint, parts array<string>, layout string"
        entry = self.spark.createDataFrame([row], names).withColumn("committed_at", F.current_timestamp())
        columns = [f.name for f in T._parse_datatype_string(_HISTORY)]
        entry.select(*columns).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/history/v={version}")
        self._version = version
        return version

    def overwrite(self, df: DataFrame, operation: str = "overwrite") -> int:
        return self._commit(df, operation, [], _nullable(df.schema), 0)

    def append(self, df: DataFrame, evolve: bool = False) -> int:
        """Add rows. A differing schema is refused, or with ``evolve`` new columns are added to the table."""
        entry = self._entry(self._version)
        layout = T.StructType.fromJson(json.loads(entry.layout))
        check_schema(layout, _nullable(df.schema), allow_extra=evolve)
        known = {f.name for f in layout}
        added = [T.StructField(f.name, f.dataType, True) for f in df.schema if f.name not in known]
        layout = T.StructType([*layout.fields, *added])
        rows = df.select(*[f.name for f in layout if f.name in df.columns])
        return self._commit(rows, "append", entry.parts, layout, entry.n_rows)

    def update(self, condition: Column, values: Mapping[str, Column]) -> int:
        return self.overwrite(update_where(self.read(), condition, values), "update")

    def merge(
        self, source: DataFrame, on: Sequence[str], set_columns: Sequence[str], insert_columns: Sequence[str] | None = None
    ) -> int:
        return self.overwrite(merge_into(self.read(), source, on, set_columns, insert_columns), "merge")
