"""Tables that grow batch by batch, without reading earlier input again.

Each batch leaves partial results, one part of the table. A merge rule makes one row per key of several parts, and
whenever ``FAN`` parts of a level are there they are merged into one of the next level, so that there are at most some
``FAN`` parts per level and a row is written once per level: log(batches) times.

A version, written last, names the parts that make up the table. What a failed attempt left is in no version and goes
with the next batch. Batches are numbered upwards; one that is not above the last is a run again and changes
nothing. One writer at a time; readers of the last version but one are not disturbed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from termscape.session import discard, folders

#: Parts of one level that are merged into one of the next.
FAN = 8

#: Versions that can still be read.
KEPT_VERSIONS = 2

VERSION_SCHEMA = "last_batch bigint, schema string, parts array<struct<name string, level int>>"


@dataclass(frozen=True)
class Version:
    number: int
    last_batch: int
    schema: str
    parts: tuple[tuple[str, int], ...]


class GrowingTable:
    """The table in the folder ``path``. ``merge`` turns rows of several parts into one row per key, with the same columns."""

    def __init__(self, spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.merge = spark, path.rstrip("/"), merge

    def version(self) -> Version | None:
        """The latest complete one."""
        numbers = self._versions()
        return self._read_version(numbers[-1]) if numbers else None

    def read(self) -> DataFrame:
        """The whole table, one row per key."""
        at = self.version()
        if at is None:
            raise ValueError(f"no batch in {self.path}")
        return self.merge(self._parts(at.schema, [name for name, _ in at.parts]))

    def add(self, batch: int, rows: DataFrame) -> bool:
        """Partial results of a batch, of one schema in all batches; whether the batch was new."""
        at = self.version()
        if at is not None and batch <= at.last_batch:
            return False
        schema = rows.schema.json()
        if at is not None and [(f.name, f.dataType) for f in rows.schema] != [
            (f.name, f.dataType) for f in StructType.fromJson(json.loads(at.schema))
        ]:
            raise ValueError(f"batch {batch} has other columns than the table in {self.path}")
        parts = [*(at.parts if at else ()), (self._write(rows), 0)]
        schema = at.schema if at else schema
        level = 0
        while sum(of == level for _, of in parts) >= FAN:
            names = [name for name, of in parts if of == level]
            merged = (self._write(self.merge(self._parts(schema, names))), level + 1)
            parts = [part for part in parts if part[1] != level] + [merged]
            level += 1
        number = at.number + 1 if at else 0
        row = self.spark.createDataFrame([(batch, schema, parts)], VERSION_SCHEMA)
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/{number}")
        self._clean()
        return True

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/parts/{name}")
        return name

    def _parts(self, schema: str, names: list[str]) -> DataFrame:
        typed = self.spark.read.schema(StructType.fromJson(json.loads(schema)))
        return typed.parquet(*(f"{self.path}/parts/{name}" for name in names))

    def _versions(self) -> list[int]:
        """Complete ones: Spark's committer marks a folder when all its files are there."""
        return sorted(int(name) for name in folders(self.spark, f"{self.path}/versions", marked="_SUCCESS"))

    def _read_version(self, number: int) -> Version:
        row = self.spark.read.schema(VERSION_SCHEMA).parquet(f"{self.path}/versions/{number}").first()
        return Version(number, row["last_batch"], row["schema"], tuple((p["name"], p["level"]) for p in row["parts"]))

    def _clean(self) -> None:
        """Versions that are too old, and parts that no version names."""
        numbers = self._versions()
        for number in numbers[:-KEPT_VERSIONS]:
            discard(self.spark, f"{self.path}/versions/{number}")
        named = {name for number in numbers[-KEPT_VERSIONS:] for name, _ in self._read_version(number).parts}
        for name in folders(self.spark, f"{self.path}/parts"):
            if name not in named:
                discard(self.spark, f"{self.path}/parts/{name}")
