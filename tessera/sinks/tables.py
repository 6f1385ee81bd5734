"""Tables in a warehouse folder: create, replace, append, keyed merge by bucket, ledgers, pinned snapshots.

A table is a folder of parts and a manifest for each version, which names the parts that the
version has. A write adds parts and then a manifest; nothing that a version names is changed,
so a reader sees the old or the new version, and a write that is lost leaves only parts that
nothing names. Rows of a table with a key lie in buckets by the key's hash: a merge reads and
rewrites the buckets that the batch has keys of, and takes the other parts over by name.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions import strings as S
from tessera.sinks.shared import Folder

#: Column that names a row's bucket while it is written.
BUCKET = "_bucket"


class TableExists(Exception):
    """A table is there and the mode is fail."""


class ConcurrentWrite(Exception):
    """Another writer made the version that this one was about to make."""


def last_of_each(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The last row of every key by `order`. Rows are met where they lie first, so a key of very many rows goes to no task in whole."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    last = df.select(*[F.col(f"`{k}`") for k in keys], row.alias("_row"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("_order"))
    return last.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.max_by("_row", "_order").alias("_row")).select("_row.*")


def merged(target: DataFrame, source: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """target with the rows of source put in by key; of equal keys in source the last by `order` counts.

    Columns that source lacks keep their values where the key is known and are null elsewhere;
    columns that target lacks are an error. A key that is null meets no other: such rows are
    all put in. Without `order` the last row is the last of the frame's last partition.
    """
    if unknown := [c for c in source.columns if c not in target.columns]:
        raise ValueError(f"columns not in the table: {unknown}")
    known = F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    new = last_of_each(source.filter(known), keys, order or [F.monotonically_increasing_id()])
    lacking = [c for c in target.columns if c not in source.columns]
    if lacking:
        new = new.join(target.select(*[F.col(f"`{c}`") for c in (*keys, *lacking)]), keys, "left")
    rest = target.join(new.select(*[F.col(f"`{k}`") for k in keys]), keys, "left_anti")
    columns = [F.col(f"`{c}`") for c in target.columns]
    return rest.select(*columns).unionByName(new.select(*columns)).unionByName(source.filter(~known), allowMissingColumns=True)


def bucket_of(key: Column, buckets: int) -> Column:
    """A key's bucket; the same for a number whatever its width."""
    return F.coalesce(F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)), F.lit(0)).cast("int")


@dataclass(frozen=True)
class Version:
    """A manifest: the table's columns, its key and number of buckets, and its parts as (bucket, folder); bucket -1 holds rows of any key."""

    number: int
    schema: StructType
    parts: tuple[tuple[int, str], ...]
    key: str | None = None
    buckets: int = 0

    def text(self) -> str:
        return json.dumps({"number": self.number, "schema": self.schema.jsonValue(), "key": self.key, "buckets": self.buckets, "parts": self.parts})

    @classmethod
    def of(cls, text: str) -> Version:
        d = json.loads(text)
        return cls(d["number"], StructType.fromJson(d["schema"]), tuple((b, p) for b, p in d["parts"]), d["key"], d["buckets"])


class TableStore:
    """Tables below one folder that driver and executors share. buckets: how many a table gets with its first key; resize() changes it."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 32, tries: int = 4):
        self.spark, self.root, self.buckets, self.tries = spark, root.rstrip("/"), buckets, tries
        self.folder = Folder(spark, self.root)

    # versions

    def versions(self, name: str) -> list[int]:
        """Numbers of the versions that can be read, oldest first."""
        return sorted(int(m[1]) for f in self.folder.names(f"{S.table_name(name)}/versions") if (m := re.fullmatch(r"(\d+)\.json", f)))

    def exists(self, name: str) -> bool:
        return bool(self.versions(name))

    def tables(self) -> list[str]:
        return sorted(t for t in self.folder.names("") if self.exists(t))

    def version(self, name: str, number: int | str | None = None) -> Version:
        """A version by its number or the name of a pin; the current one by default."""
        have = self.versions(name)
        if not have:
            raise FileNotFoundError(f"table {name} not found")
        if isinstance(number, str):
            number = self.pins(name)[S.table_name(number)]
        return Version.of(self.folder.read(f"{S.table_name(name)}/versions/{have[-1] if number is None else number:08d}.json"))

    def read(self, name: str, number: int | str | None = None) -> DataFrame:
        v = self.version(name, number)
        return self._parts(name, v, [p for _, p in v.parts])

    def _parts(self, name: str, v: Version, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], v.schema)
        return self.spark.read.schema(v.schema).parquet(*[f"{self.root}/{S.table_name(name)}/{p}" for p in parts])

    def _commit(self, name: str, v: Version) -> None:
        if not self.folder.create(f"{S.table_name(name)}/versions/{v.number:08d}.json", v.text()):
            raise ConcurrentWrite(f"version {v.number} of {name}")

    # parts

    def _add(self, df: DataFrame, name: str, key: str | None, buckets: int) -> tuple[tuple[int, str], ...]:
        """Write df as new parts of a table, one for each bucket that has rows."""
        write = f"data/{uuid.uuid4().hex}"
        path = f"{self.root}/{S.table_name(name)}/{write}"
        if key is None:
            df.write.parquet(path)
            return ((-1, write),)
        df.withColumn(BUCKET, bucket_of(F.col(f"`{key}`"), buckets)).repartition(BUCKET).write.partitionBy(BUCKET).parquet(path)
        found = [(int(m[1]), f"{write}/{f}") for f in self.folder.names(f"{S.table_name(name)}/{write}") if (m := re.fullmatch(rf"{BUCKET}=(\d+)", f))]
        return tuple(sorted(found))

    # writes

    def write(self, df: DataFrame, name: str, if_exists: str = "fail", key: str | None = None, order: list[str] | None = None) -> str:
        """What was done: create, replace, append or upsert. With a key, if_exists doesn't matter.

        order: columns by which the last of several rows of a key in df is told; they are
        written if the table has them. Appending a known key to a table that has a key is an
        error, as is giving a key to a table in which it repeats.
        """
        df = df.toDF(*S.unique_names(df.columns))
        if BUCKET in df.columns:
            raise ValueError(f"{BUCKET} is no name for a column")
        if key is not None:
            key = S.sanitize_name(key)
            if key not in df.columns:
                raise KeyError(f"key column {key} not found")
            if order and (missing := [c for c in order if c not in df.columns]):
                raise KeyError(f"order columns {missing} not found")
            return self._again(lambda: self._upsert(df, name, key, order))
        if not self.exists(name):
            self._commit(name, Version(1, df.schema, self._add(df, name, None, 0)))
            return "create"
        if if_exists == "fail":
            raise TableExists(f"table {name} exists")
        if if_exists == "append":
            return self._again(lambda: self._append(df, name))
        have = self.version(name)
        self._commit(name, Version(have.number + 1, df.schema, self._add(df, name, None, 0)))
        return "replace"

    def _again(self, work) -> str:
        """work, anew on the newest version when another writer was first."""
        for left in reversed(range(self.tries)):
            try:
                return work()
            except ConcurrentWrite:
                if not left:
                    raise
        raise AssertionError("no try")

    def _append(self, df: DataFrame, name: str) -> str:
        have = self.version(name)
        names = have.schema.fieldNames()
        if unknown := [c for c in df.columns if c not in names]:
            raise ValueError(f"columns not in the table: {unknown}")
        rows = self._like(df, have)
        if have.key is None:
            parts = self._add(rows, name, None, 0)
        else:
            key = F.col(f"`{have.key}`")
            rows_with_key = rows.filter(key.isNotNull())
            parts = self._add(rows, name, have.key, have.buckets)
            twice = not rows_with_key.groupBy(key.alias("k")).count().filter("count > 1").isEmpty()
            touched = {b for b, _ in parts}
            old = self._parts(name, have, [p for b, p in have.parts if b in touched])
            if twice or not rows_with_key.join(old, have.key, "left_semi").isEmpty():
                raise ValueError(f"{have.key} is the key of {name} and would repeat")
        self._commit(name, replace(have, number=have.number + 1, parts=have.parts + parts))
        return "append"

    def _like(self, df: DataFrame, v: Version) -> DataFrame:
        """df with the columns of a version that it has, in their types, and nulls for the others."""
        return df.select(*[(F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in v.schema])

    def _upsert(self, df: DataFrame, name: str, key: str, order: list[str] | None) -> str:
        if not self.exists(name):
            by = [F.col(f"`{c}`") for c in order] if order else None
            rows = merged(self.spark.createDataFrame([], df.schema), df, [key], by)
            self._commit(name, Version(1, df.schema, self._add(rows, name, key, self.buckets), key, self.buckets))
            return "create"
        have = self.version(name)
        if have.key != key:
            have = self._keyed(name, have, key)
        names = have.schema.fieldNames()
        extra = [c for c in df.columns if c not in names and c not in (order or [])]
        if extra:
            raise ValueError(f"columns not in the table: {extra}")
        # The batch is written once, with its order, by bucket: its folders tell which buckets it touches.
        batch = [F.col(f"`{c}`").cast(have.schema[c].dataType).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns]
        staged = self._add(last_and_null(df.select(*batch), key, order), name, key, have.buckets)
        given = [c for c in df.columns if c in names]
        source = self.spark.read.parquet(*[f"{self.root}/{S.table_name(name)}/{p}" for _, p in staged]).select(*[F.col(f"`{c}`") for c in given]) if staged else None
        if source is not None:
            touched = {b for b, _ in staged}
            old = self._parts(name, have, [p for b, p in have.parts if b in touched])
            parts = self._add(merged(old, source, [key], [F.lit(0)]), name, key, have.buckets)
            kept = tuple((b, p) for b, p in have.parts if b not in touched)
            self._commit(name, replace(have, number=have.number + 1, parts=kept + parts))
            self.folder.delete(f"{S.table_name(name)}/{staged[0][1].rsplit('/', 1)[0]}")
        return "upsert"

    def _keyed(self, name: str, have: Version, key: str) -> Version:
        """The next version, not committed, of a table laid out by another or no key: all of it by bucket."""
        if key not in have.schema.fieldNames():
            raise KeyError(f"key column {key} not found")
        rows = self._parts(name, have, [p for _, p in have.parts])
        k = F.col(f"`{key}`")
        if not rows.filter(k.isNotNull()).groupBy(k.alias("k")).count().filter("count > 1").isEmpty():
            raise ValueError(f"{key} repeats in {name} and can't be its key")
        return replace(have, parts=self._add(rows, name, key, self.buckets), key=key, buckets=self.buckets)

    def resize(self, name: str, buckets: int) -> None:
        """Lay a table with a key out in another number of buckets."""
        have = self.version(name)
        if have.key is None:
            raise KeyError(f"table {name} has no key")
        rows = self._parts(name, have, [p for _, p in have.parts])
        self._commit(name, replace(have, number=have.number + 1, parts=self._add(rows, name, have.key, buckets), buckets=buckets))

    # snapshots

    def snapshot(self, name: str, label: str | None = None) -> int:
        """The current version's number; with a label it is pinned: vacuum keeps it until unpin."""
        number = self.version(name).number
        if label is not None and not self.folder.create(f"{S.table_name(name)}/pins/{S.table_name(label)}", str(number)):
            raise TableExists(f"pin {label} of {name} exists")
        return number

    def pins(self, name: str) -> dict[str, int]:
        top = f"{S.table_name(name)}/pins"
        return {f: int(self.folder.read(f"{top}/{f}")) for f in self.folder.names(top) if not f.startswith((".", "_"))}

    def unpin(self, name: str, label: str) -> None:
        self.folder.delete(f"{S.table_name(name)}/pins/{S.table_name(label)}")

    def restore(self, name: str, number: int | str) -> None:
        """An older version, by number or pin, as the newest. No data are copied."""
        self._commit(name, replace(self.version(name, number), number=self.versions(name)[-1] + 1))

    def vacuum(self, name: str, keep: int = 2, grace: float = 3600.0) -> None:
        """Forget all but the last `keep` and the pinned versions, and delete writes that none of the rest names. grace: seconds for which a write without a version counts as unfinished."""
        table = S.table_name(name)
        have, pinned = self.versions(name), set(self.pins(name).values())
        gone = [v for v in have[:-keep] if v not in pinned] if keep else [v for v in have[:-1] if v not in pinned]
        named = {p.split("/")[1] for v in have if v not in gone for _, p in self.version(name, v).parts}
        before = {p.split("/")[1] for v in gone for _, p in self.version(name, v).parts}
        for v in gone:
            self.folder.delete(f"{table}/versions/{v:08d}.json")
        for w in self.folder.names(f"{table}/data"):
            if w not in named and (w in before or self.folder.age(f"{table}/data/{w}") > grace):
                self.folder.delete(f"{table}/data/{w}")


def last_and_null(df: DataFrame, key: str, order: list[str] | None) -> DataFrame:
    """The last row of each key, and all rows without one."""
    by = [F.col(f"`{c}`") for c in order] if order else [F.monotonically_increasing_id()]
    k = F.col(f"`{key}`")
    return last_of_each(df.filter(k.isNotNull()), [key], by).unionByName(df.filter(k.isNull()))


def pending(targets: DataFrame, done: DataFrame, on: list[str]) -> DataFrame:
    """Targets that no ledger row names."""
    return targets.join(done.select(*on).distinct(), on, "left_anti")


def changed(items: DataFrame, ledger: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """Items whose content differs from what the ledger (path, sha256) has."""
    return items.withColumn("sha256", S.content_hash(F.col(text))).join(ledger.select(path, "sha256").distinct(), [path, "sha256"], "left_anti")


def uncompiled(items: DataFrame, ledger: DataFrame, found: DataFrame) -> DataFrame:
    """Items (path, sha256, ...) to be made: those whose content the ledger (path, sha256) doesn't have, or whose output isn't among the files found (path)."""
    done = ledger.select("path", "sha256").distinct().join(found.select("path").distinct(), "path", "left_semi")
    return items.join(done, ["path", "sha256"], "left_anti")


def dual_commit(records: DataFrame, store: TableStore, table: str, vectors: str) -> bool:
    """Dialogue records into the relational and the vector table; true if both were written. The second is tried only after the first."""
    store.write(relational_rows(records), table, key="composite_key")
    store.write(vector_rows(records), vectors, key="id")
    return True


def relational_rows(records: DataFrame) -> DataFrame:
    return records.select("composite_key", "file_id", "map_id", "event_id", "line_id", "name", "body", "icon_index", F.to_json("keywords").alias("keywords"))


def vector_rows(records: DataFrame) -> DataFrame:
    """id, document and scalar metadata: no icon is -1, keywords are comma-joined."""
    return records.select(F.col("composite_key").alias("id"), F.col("body").alias("document"), "file_id", "map_id", "event_id", "line_id", "name", F.coalesce("icon_index", F.lit(-1)).alias("icon_index"), F.array_join("keywords", ",").alias("keywords"))
