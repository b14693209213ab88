"""Tables whose versions are manifests: a new version is written beside the old one and then pointed to.

A store holds buckets of rows. A manifest lists the folders of every bucket; the highest manifest is the current version. A commit
writes only the buckets that change, then puts its manifest under the next number, which fails if another writer has taken it.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators import documents as docs

BUCKET = "__bucket"


class Moved(RuntimeError):
    """Another writer has committed since the version that a commit builds on."""


@dataclass(frozen=True)
class Version:
    number: int
    #: Folders of each bucket, below the store.
    parts: Mapping[int, tuple[str, ...]]
    schema: StructType
    meta: Mapping = field(default_factory=dict)


class Store:
    """Buckets of rows in versions below a folder that all machines share."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at("").getFileSystem(self._conf)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def _names(self, folder: str) -> list[str]:
        at = self._at(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def numbers(self) -> list[int]:
        """Numbers of the versions that can be read, oldest first."""
        return sorted(int(n[1:-5]) for n in self._names("versions") if n.startswith("v") and n.endswith(".json"))

    def version(self, number: int | None = None) -> Version | None:
        """A version by number, or the current one; None if there is none yet."""
        if number is None:
            known = self.numbers()
            if not known:
                return None
            number = known[-1]
        text = self._fs.open(self._at(f"versions/v{number:012d}.json"))
        try:
            held = json.loads(bytes(text.readAllBytes()).decode())
        finally:
            text.close()
        parts = {int(b): tuple(folders) for b, folders in held["parts"].items()}
        return Version(number, parts, StructType.fromJson(held["schema"]), held["meta"])

    def write(self, rows: DataFrame, bucket: Column) -> dict[int, tuple[str, ...]]:
        """Write rows by their bucket into a fresh folder, a large bucket in several files; nothing points to it yet."""
        name = f"data/{uuid.uuid4().hex}"
        rows.withColumn(BUCKET, bucket).hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{name}")
        prefix = f"{BUCKET}="
        return {int(n[len(prefix):]): (f"{name}/{n}",) for n in self._names(name) if n.startswith(prefix)}

    def commit(self, base: Version | None, schema: StructType, replaced: Mapping[int, Iterable[str]] | None = None,
               added: Mapping[int, Iterable[str]] | None = None, meta: Mapping | None = None) -> Version:
        """Point to a new version: that of ``base`` with some buckets replaced (none left: gone) and folders added to others.

        The manifest gets the number after ``base``, written in full before it gets its name. If that number is taken, the
        commit raises ``Moved`` and nothing has changed.
        """
        parts = dict(base.parts) if base else {}
        for b, folders in (replaced or {}).items():
            parts.pop(b, None)
            if tuple(folders):
                parts[b] = tuple(folders)
        for b, folders in (added or {}).items():
            parts[b] = (*parts.get(b, ()), *folders)
        number = base.number + 1 if base else 1
        made = Version(number, parts, schema, dict(meta if meta is not None else base.meta if base else {}))
        text = json.dumps({"parts": {str(b): list(f) for b, f in sorted(parts.items())}, "schema": schema.jsonValue(), "meta": made.meta})
        fresh = self._at(f"versions/.{uuid.uuid4().hex}")
        out = self._fs.create(fresh, False)
        out.write(bytearray(text.encode()))
        out.close()
        self._place(fresh, self._at(f"versions/v{number:012d}.json"), number)
        return made

    def _place(self, fresh, name, number: int) -> None:
        """Give the written manifest its name, unless the name is there."""
        gateway, fs = self.spark.sparkContext._gateway, self._jvm.org.apache.hadoop.fs
        never = gateway.new_array(getattr(fs, "Options$Rename"), 0)
        try:
            fs.FileContext.getFileContext(name.toUri(), self._conf).rename(fresh, name, never)
        except Exception as error:
            self._fs.delete(fresh, False)
            if "FileAlreadyExists" in str(error):
                raise Moved(f"version {number} of {self.path} is there already") from None
            raise

    def read(self, version: Version, buckets: Iterable[int] | None = None) -> DataFrame:
        """Rows of a version, or of some of its buckets: other folders are not listed."""
        chosen = version.parts if buckets is None else {b: version.parts[b] for b in buckets if b in version.parts}
        folders = [f"{self.path}/{f}" for part in chosen.values() for f in part]
        if not folders:
            return self.spark.createDataFrame([], version.schema)
        return self.spark.read.schema(version.schema).parquet(*folders)

    def vacuum(self, keep: int = 1) -> int:
        """Forget all but the last ``keep`` versions, and delete the bucket folders that none of these points to. Only without
        writers at work: what a commit has written but not pointed to yet goes too."""
        known = self.numbers()
        held = {f for n in known[-keep:] for part in self.version(n).parts.values() for f in part}
        for n in known[:-keep]:
            self._fs.delete(self._at(f"versions/v{n:012d}.json"), False)
        written = {name: [f"data/{name}/{n}" for n in self._names(f"data/{name}") if n.startswith(BUCKET)] for name in self._names("data")}
        gone = [f for folders in written.values() for f in folders if f not in held]
        for name, folders in written.items():
            if not held.intersection(folders):
                self._fs.delete(self._at(f"data/{name}"), True)
        for f in gone:
            self._fs.delete(self._at(f), True)
        return len(gone)


def key_bucket(key: str, buckets: int) -> Column:
    """Bucket of a key: 32 bits of the digest of its text; a null key is a key like any other."""
    text = F.coalesce(F.col(key).cast("string"), F.lit("\0"))
    return F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


class KeyedTable:
    """A table with one row per key, kept in versions; a batch of changes rewrites only the buckets of its keys."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64) -> None:
        self.store, self.key, self.buckets = Store(spark, path), key, buckets

    def create(self, rows: DataFrame) -> Version:
        """First version. A store that has versions raises ``Moved``, a repeated key ``ValueError``."""
        again = rows.groupBy(self.key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").first()
        if again is not None:
            raise ValueError(f"repeated key {again[0]}")
        written = self.store.write(rows, self._bucket)
        return self.store.commit(None, rows.schema, replaced=written, meta={"key": self.key, "buckets": self.buckets})

    @property
    def _bucket(self) -> Column:
        return key_bucket(self.key, self.buckets)

    def apply(self, changes: DataFrame, op_col: str = "op", sequence: str | None = None, attempts: int = 3) -> Version:
        """Next version after a batch of inserts, updates and deletes (see ``documents.apply_changes``).

        Only the buckets that hold a key of the batch are read and written; their numbers, at most ``buckets`` of them, are all
        that reaches the driver. If another writer was faster, the batch is applied again to what that one left.
        """
        touched = [r[0] for r in changes.select(self._bucket).distinct().collect()]
        for attempt in range(attempts):
            base = self.store.version()
            if not touched:
                return base
            after = docs.apply_changes(self.store.read(base, touched), changes, self.key, op_col, sequence)
            written = self.store.write(after, self._bucket)
            try:
                return self.store.commit(base, base.schema, replaced={b: written.get(b, ()) for b in touched})
            except Moved:
                if attempt == attempts - 1:
                    raise
        raise ValueError("at least one attempt is needed")

    def read(self, number: int | None = None) -> DataFrame:
        """All rows of a version (the current one without a number)."""
        return self.store.read(self._known(number))

    def find(self, keys: list, number: int | None = None) -> DataFrame:
        """The rows of a few given keys: only their buckets are read."""
        spark = self.store.spark
        version = self._known(number)
        asked = spark.createDataFrame([(k,) for k in keys], StructType([version.schema[self.key]]))
        buckets = sorted({r[0] for r in asked.select(self._bucket).collect()})
        return self.store.read(version, buckets).join(F.broadcast(asked.distinct()), self.key, "left_semi")

    def rewritten(self, number: int) -> int:
        """How many buckets a version has that its predecessor has not, in content or at all, or lost."""
        now, before = self.store.version(number).parts, self.store.version(number - 1).parts if number > 1 else {}
        return sum(now.get(b) != before.get(b) for b in {*now, *before})

    def _known(self, number: int | None) -> Version:
        version = self.store.version(number)
        if version is None:
            raise ValueError(f"no version below {self.store.path}")
        return version
