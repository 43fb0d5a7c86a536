"""Tables in buckets whose current files a manifest names.

A folder holds data/, tombstones/ and manifest/. Each manifest lists, for every
bucket, the one folder that has its rows now, with figures of its rows. A change
writes new folders for the buckets that it touches, and becomes visible by the
one rename that puts the next manifest in its place; until then, and after a
crash anywhere before, readers see the version before. Of two writers that start
from the same version the later one fails and changes nothing.

The driver holds one manifest entry for each bucket, never rows.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import scratch

#: Column that files are parted by; it has the bucket's number and isn't read again.
_PART = "_bucket"


class ChangedMeanwhile(RuntimeError):
    """Another writer published a version first."""


@dataclass
class Manifest:
    version: int = 0
    schema: StructType | None = None
    #: By bucket: folder, rows and the figures of stats.
    buckets: dict[int, dict] = field(default_factory=dict)
    tombstones: list[str] = field(default_factory=list)
    notes: dict = field(default_factory=dict)


class VersionedTable:
    """Rows by bucket, a long column of theirs that says where each belongs.

    stats: figures kept for each bucket, aggregates of its rows by name.
    """

    def __init__(self, spark: SparkSession, path: str, bucket: str = "bucket", stats: dict[str, Column] | None = None):
        self.spark, self.path, self.bucket, self.stats = spark, path.rstrip("/"), bucket, stats or {}

    def _hadoop(self, *parts: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the newest manifest; 0 where there is none."""
        path, system = self._hadoop("manifest")
        if not system.exists(path):
            return 0
        names = [s.getPath().getName() for s in system.listStatus(path)]
        return max((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")), default=0)

    def manifest(self, version: int | None = None) -> Manifest:
        version = self.version() if version is None else version
        if not version:
            return Manifest()
        path, system = self._hadoop("manifest", f"{version:012d}.json")
        stream = system.open(path)
        held = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        stream.close()
        return Manifest(version, StructType.fromJson(held["schema"]), {int(b): e for b, e in held["buckets"].items()}, held["tombstones"], held["notes"])

    def read(self, buckets: list[int] | None = None, version: int | None = None) -> DataFrame:
        """The rows, or those of some buckets: the folders of others are not even listed."""
        now = self.manifest(version)
        if now.schema is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self._read(now, now.buckets if buckets is None else buckets)

    def _read(self, now: Manifest, buckets) -> DataFrame:
        folders = [f"{self.path}/{now.buckets[b]['folder']}" for b in buckets if b in now.buckets]
        if not folders:
            return self.spark.createDataFrame([], now.schema)
        return self.spark.read.schema(now.schema).parquet(*folders)

    def tombstones(self, since: int = 0) -> DataFrame:
        """(key, version) of the rows that went in versions after `since`."""
        folders = [f"{self.path}/{t}" for t in self.manifest().tombstones if int(t.split("/v")[1].split("-")[0]) > since]
        if not folders:
            return self.spark.createDataFrame([], "key string, version long")
        return self.spark.read.schema("key string, version long").parquet(*folders)

    def replace(self, rows: DataFrame, touched: list[int], base: Manifest, gone: DataFrame | None = None, notes: dict | None = None) -> Manifest:
        """Publish a version in which the touched buckets hold rows and all others what they held in base."""
        number = base.version + 1
        name = f"v{number}-{uuid.uuid4().hex}"
        folder, columns = f"data/{name}", rows.columns
        rows.withColumn(_PART, F.col(self.bucket)).hint("rebalance", _PART).write.partitionBy(_PART).parquet(f"{self.path}/{folder}")
        buckets = {b: e for b, e in base.buckets.items() if b not in set(touched)}
        written = self.spark.read.schema(rows.select("*").schema.add(_PART, "long")).parquet(f"{self.path}/{folder}")
        figures = written.groupBy(F.col(self.bucket).alias("b")).agg(F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in self.stats.items()])
        for r in figures.collect():
            buckets[r["b"]] = {"folder": f"{folder}/{_PART}={r['b']}"} | {k: v for k, v in r.asDict().items() if k != "b"}
        stones = list(base.tombstones)
        if gone is not None:
            gone.select("key", F.lit(number).cast("long").alias("version")).write.parquet(f"{self.path}/tombstones/{name}")
            stones.append(f"tombstones/{name}")
        new = Manifest(number, StructType([rows.schema[c] for c in columns]), buckets, stones, notes if notes is not None else base.notes)
        self._publish(new)
        return new

    def _publish(self, new: Manifest) -> None:
        """Write the manifest beside its place and move it there, which fails if the place is taken."""
        held = {"schema": new.schema.jsonValue(), "buckets": new.buckets, "tombstones": new.tombstones, "notes": new.notes}
        draft, system = self._hadoop("manifest", f".{uuid.uuid4().hex}.draft")
        out = system.create(draft, False)
        out.write(bytearray(json.dumps(held).encode()))
        out.close()
        place, _ = self._hadoop("manifest", f"{new.version:012d}.json")
        options = self.spark._jvm.org.apache.hadoop.fs.Options.Rename
        none = self.spark.sparkContext._gateway.new_array(options, 1)
        none[0] = getattr(options, "NONE")
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(system.makeQualified(draft), system.makeQualified(place), none)
        except Exception as e:
            system.delete(draft, False)
            if "FileAlreadyExistsException" in str(e) or "already exists" in str(e):
                raise ChangedMeanwhile(f"version {new.version} of {self.path} was published by another writer") from e
            raise

    def vacuum(self) -> int:
        """Delete what the newest manifest doesn't name; the number of folders that went. Older versions can't be read then."""
        now, deleted = self.manifest(), 0
        wanted = {e["folder"] for e in now.buckets.values()} | set(now.tombstones)
        runs = {w.rsplit("/", 1)[0] for w in wanted}

        def drop(name: str, status, system) -> int:
            return 0 if name in wanted else int(system.delete(status.getPath(), True))

        for kind in ("data", "tombstones"):
            path, system = self._hadoop(kind)
            for s in system.listStatus(path) if system.exists(path) else []:
                name = f"{kind}/{s.getPath().getName()}"
                if name in runs:
                    deleted += sum(drop(f"{name}/{b.getPath().getName()}", b, system) for b in system.listStatus(s.getPath()))
                else:
                    deleted += drop(name, s, system)
        path, system = self._hadoop("manifest")
        for s in system.listStatus(path):
            if s.getPath().getName() != f"{now.version:012d}.json":
                system.delete(s.getPath(), False)
        return deleted


def one_of_each(rows: DataFrame, key: str, order: list[str] = ()) -> DataFrame:
    """Of rows with one key that with the largest order, and of those that with the largest hash of its columns."""
    cells = [F.col(f"`{c}`") for c in rows.columns]
    best = F.max_by(F.struct(*cells), F.struct(*[F.col(c) for c in order], F.xxhash64(*cells), F.xxhash64(F.lit(1), *cells)))
    return rows.groupBy(F.col(key).alias("_key")).agg(best.alias("_row")).select("_row.*")


def upsert(table: VersionedTable, rows: DataFrame, place: Column, key: str = "id", scope: str | None = None, order: list[str] = (), notes: dict | None = None) -> Manifest:
    """Put rows in by key; place gives a row's bucket.

    With a scope, such as the source of a chunk, all rows that have one of the
    new rows' scopes make way, so a document that got shorter leaves nothing
    behind; rows that go for good are listed as tombstones. A scope lies in one
    bucket. Only buckets that new rows fall in are read or written.
    """
    at = scratch.folder(table.spark, "upsert")
    one_of_each(rows, key, order).withColumn(table.bucket, place.cast("long")).write.parquet(at)
    fresh = table.spark.read.parquet(at)
    base = table.manifest()
    touched = [r[0] for r in fresh.select(table.bucket).distinct().collect()]
    if base.schema is None:
        return table.replace(fresh, touched, base, notes=notes)
    old = table._read(base, touched)
    out = fresh.select(table.bucket, scope or key).distinct()
    leaving = old.join(out, [table.bucket, scope or key], "left_semi")
    gone = leaving.join(fresh.select(key), key, "left_anti").select(F.col(key).cast("string").alias("key")) if scope else None
    kept = old.join(out, [table.bucket, scope or key], "left_anti")
    return table.replace(kept.unionByName(fresh, allowMissingColumns=True).select(*fresh.columns), touched, base, gone, notes)


def remove(table: VersionedTable, scopes: DataFrame, place: Column, key: str = "id", scope: str = "source") -> Manifest:
    """Take out all rows of some scopes (column scope) and list them as tombstones."""
    base = table.manifest()
    out = scopes.select(place.cast("long").alias(table.bucket), scope).distinct()
    touched = [r[0] for r in out.select(table.bucket).distinct().collect()]
    old = table._read(base, touched)
    gone = old.join(out, [table.bucket, scope], "left_semi").select(F.col(key).cast("string").alias("key"))
    return table.replace(old.join(out, [table.bucket, scope], "left_anti"), touched, base, gone)
