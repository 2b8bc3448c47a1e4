"""Schema snapshots of a feed: versions, a widening lattice, and a log of drift.

A registry is a folder. ``v<number>.json`` holds one version of the schema with the change that made it; versions are
written once (put-if-absent), never altered, and the greatest number is in force. ``drift-<batch>.json`` holds what a batch
brought that the version in force does not say: new columns, and columns whose values widen the type.

New columns make a new version at once. A changed type never alters a column in force: the feed goes on being read by
the old type, values that do not fit stay in the rescue column, and the log says what type would hold both. ``promote`` adopts
such types, for a replay into a new table.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folio.sources import storage

DRIFT_SCHEMA = "batch long, version long, column string, kind string, stored string, observed string, widened string"


@dataclass(frozen=True)
class Change:
    column: str
    kind: str       # added | type | clash: a name that differs from a known one by case alone, or is none
    stored: str | None
    observed: str
    widened: str


def plain_type(kind: T.DataType) -> T.DataType:
    """Inferred types as a feed stores them: whole numbers long, other numbers double, mixed kinds variant."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return T.LongType()
    if isinstance(kind, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(plain_type(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, plain_type(f.dataType)) for f in kind.fields])
    return kind


def widen(one: T.DataType, other: T.DataType) -> T.DataType:
    """The least type that holds both: void < all; long < double < string; boolean < string; objects by
    field, arrays by element; variant above everything."""
    one, other = plain_type(one), plain_type(other)
    if one == other or isinstance(other, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return other
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        theirs = {f.name: f.dataType for f in other.fields}
        mine = [T.StructField(f.name, widen(f.dataType, theirs.pop(f.name, T.NullType()))) for f in one.fields]
        return T.StructType(mine + [T.StructField(n, t) for n, t in theirs.items()])
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(widen(one.elementType, other.elementType))
    nested = (T.StructType, T.ArrayType, T.VariantType)
    if isinstance(one, nested) or isinstance(other, nested):
        return T.VariantType()
    if {type(one), type(other)} == {T.LongType, T.DoubleType}:
        return T.DoubleType()
    return T.StringType()


def holds(stored: T.DataType, observed: T.DataType) -> bool:
    """Whether every value of ``observed`` fits a column of ``stored``."""
    return widen(stored, observed) == plain_type(stored)


def from_variant_ddl(text: str) -> T.StructType | None:
    """The type that ``schema_of_variant_agg`` names; None unless it is an object."""
    parts = re.split(r"(`(?:[^`]|``)*`)", text)
    kind = T.DataType.fromDDL("".join(p if p.startswith("`") else p.replace("OBJECT<", "STRUCT<") for p in parts))
    return plain_type(kind) if isinstance(kind, T.StructType) else None


def observed_json(lines: DataFrame, column: str = "value") -> T.StructType | None:
    """The schema that the JSON objects in a text column show, by a distributed aggregate; None if there are none."""
    parsed = lines.select(F.try_parse_json(F.col(column)).alias("v"))
    text = parsed.filter(F.schema_of_variant("v").startswith("OBJECT<")).agg(F.schema_of_variant_agg("v")).first()[0]
    return from_variant_ddl(text) if text and text != "VOID" else None


class SchemaRegistry:
    """The versions of one feed's schema in a folder on shared storage."""

    def __init__(self, spark: SparkSession, location: str, default: T.StructType, reserved: Iterable[str] = ()):
        self.spark, self.location, self.default, self.reserved = spark, location.rstrip("/"), default, tuple(reserved)

    def _versions(self) -> list[int]:
        return sorted(int(m[1]) for n in storage.file_names(self.spark, self.location) if (m := re.fullmatch(r"v(\d+)\.json", n)))

    def _path(self, version: int) -> str:
        return f"{self.location}/v{version:06d}.json"

    def schema(self, version: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(storage.read_text(self.spark, self._path(version)))["schema"])

    def current(self) -> tuple[int, T.StructType]:
        """Version in force and its schema. The first call stores the default, or a snapshot of the earlier format."""
        versions = self._versions()
        if not versions:
            old = storage.read_text(self.spark, f"{self.location}/schema.json")
            first = T.StructType.fromJson(json.loads(old)) if old else self.default
            self._store(1, first, [], None)
            versions = self._versions()
        return versions[-1], self.schema(versions[-1])

    def _store(self, version: int, schema: T.StructType, changes: list[Change], batch: int | None) -> bool:
        body = {"version": version, "schema": schema.jsonValue(), "batch": batch, "changes": [asdict(c) for c in changes]}
        return storage.put_if_absent(self.spark, self._path(version), json.dumps(body))

    def admit(self, observed: T.StructType, batch: int, evolve: bool = True) -> tuple[int, T.StructType, list[Change]]:
        """Merge what a batch shows: new columns make a new version (with ``evolve``), all changes are logged once a batch."""
        while True:
            version, schema = self.current()
            stored = {f.name: f.dataType for f in schema.fields}
            lower = {n.lower() for n in stored} | {n.lower() for n in self.reserved}
            changes, added = [], []
            for field in plain_type(observed).fields:
                seen = field.dataType
                if isinstance(seen, T.NullType):
                    continue  # nulls alone say nothing about the type
                if field.name not in stored and (field.name.lower() in lower or not field.name.strip()):
                    changes.append(Change(field.name, "clash", None, seen.simpleString(), seen.simpleString()))
                elif field.name not in stored:
                    lower.add(field.name.lower())
                    changes.append(Change(field.name, "added", None, seen.simpleString(), seen.simpleString()))
                    added.append(T.StructField(field.name, seen))
                elif not holds(stored[field.name], seen):
                    changes.append(Change(field.name, "type", stored[field.name].simpleString(), seen.simpleString(),
                                          widen(stored[field.name], seen).simpleString()))
            if added and evolve:
                wider = T.StructType(schema.fields + added)
                if not self._store(version + 1, wider, changes, batch):
                    continue  # another writer made that version; merge into it
                version, schema = version + 1, wider
            if changes:
                lines = "\n".join(json.dumps({"batch": batch, "version": version} | asdict(c)) for c in changes)
                storage.put_if_absent(self.spark, f"{self.location}/drift-{batch:09d}.json", lines)
            return version, schema, changes

    def promote(self) -> tuple[int, T.StructType]:
        """Adopt the widened types of the log as a new version, for a replay into a new table."""
        version, schema = self.current()
        wider = {r.column: r.widened for r in self.drift().filter("kind = 'type'").orderBy("batch").collect()}
        fields = [T.StructField(f.name, widen(f.dataType, T.DataType.fromDDL(wider[f.name]))) if f.name in wider else f for f in schema.fields]
        if fields != schema.fields:
            self._store(version + 1, T.StructType(fields), [], None)
        return self.current()

    def drift(self) -> DataFrame:
        """All logged changes, one row each."""
        logs = [n for n in storage.file_names(self.spark, self.location) if n.startswith("drift-")]
        if not logs:
            return self.spark.createDataFrame([], DRIFT_SCHEMA)
        return self.spark.read.schema(DRIFT_SCHEMA).json([f"{self.location}/{n}" for n in logs])
