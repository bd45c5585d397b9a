"""Tables with versions: readers see one whole version, a writer adds the next or nothing.

A version is a manifest, a small file that names the folders of its data. Data is written
first, under a name of its own; then the manifest is moved to its number, which a file
system does at once and refuses if the number is taken. Whatever a crash leaves behind before
that belongs to no version. Old versions stay readable until ``vacuum``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loam.operators.relational import keep_first, stored, unused


class Conflict(RuntimeError):
    """Another writer has added the version meanwhile; read again and repeat."""


def file_system(spark: SparkSession, path: str) -> tuple:
    """(file system, path object) of Hadoop, so that any store works."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


class Versions:
    """Numbered manifests below ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, number: int) -> str:
        return f"{self.root}/v{number:012d}.json"

    def numbers(self) -> list[int]:
        fs, pattern = file_system(self.spark, f"{self.root}/v*.json")
        return sorted(int(s.getPath().getName()[1:-5]) for s in fs.globStatus(pattern) or [])

    def read(self, number: int) -> dict:
        fs, at = file_system(self.spark, self._path(number))
        stream = fs.open(at)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def newest(self) -> tuple[int, dict | None]:
        """(number, manifest); (0, None) before the first."""
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else (0, None)

    def commit(self, number: int, manifest: dict) -> None:
        """Add version ``number``; ``Conflict`` if it is there."""
        jvm = self.spark.sparkContext._jvm
        fs, aside = file_system(self.spark, f"{self.root}/.new-{uuid.uuid4().hex}")
        out = fs.create(aside, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        to = jvm.org.apache.hadoop.fs.Path(self._path(number))
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        plain = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(aside, to, plain)  # refuses to replace
        except Exception as e:
            fs.delete(aside, False)
            if fs.exists(to):
                raise Conflict(f"version {number} of {self.root} exists") from e
            raise

    def vacuum(self, keep: int, folders: Callable[[dict], set[str]]) -> None:
        """Remove all but the newest ``keep`` versions, then the data folders that none of these names."""
        numbers = self.numbers()
        held = set().union(*(folders(self.read(n)) for n in numbers[-keep:]))
        for n in numbers[:-keep]:
            fs, at = file_system(self.spark, self._path(n))
            fs.delete(at, False)
        fs, data = file_system(self.spark, f"{self.root}/data/*")
        for s in fs.globStatus(data) or []:
            if s.getPath().getName() not in held:
                fs.delete(s.getPath(), True)


class KeyedTable:
    """SK-06, SK-08: rows by key in hash buckets; a batch rewrites only the buckets it touches.

    Buckets are by the key's text, so a key's type may be widened. Their number is set when the
    table is made; it bounds the manifest and what a batch tells the driver. Rows without a key
    aren't kept: a primary key has no nulls.
    """

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 64) -> None:
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        self.versions = Versions(spark, root)

    def exists(self) -> bool:
        return bool(self.versions.numbers())

    def _frame(self, manifest: dict, buckets: list[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        paths = [f"{self.root}/{p}" for b, p in sorted(manifest["buckets"].items()) if buckets is None or b in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version, or an older one that is still kept."""
        manifest = self.versions.read(version) if version else self.versions.newest()[1]
        if manifest is None:
            raise FileNotFoundError(f"no version of {self.root}")
        return self._frame(manifest)

    def _bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(n)).cast("int")

    def _write(self, rows: DataFrame, n: int) -> dict[str, str]:
        """Rows by bucket in a new folder: bucket to path, for those that have rows."""
        name, folder = unused(rows, "bucket"), f"data/{uuid.uuid4().hex}"
        rows.withColumn(name, self._bucket(n)).hint("rebalance", F.col(name)).write.partitionBy(name).parquet(f"{self.root}/{folder}")
        fs, made = file_system(self.spark, f"{self.root}/{folder}/{name}=*")
        return {s.getPath().getName().split("=")[1]: f"{folder}/{s.getPath().getName()}" for s in fs.globStatus(made) or []}

    def _replace(self, number: int, manifest: dict, touched: list[str], rows: DataFrame, schema: T.StructType) -> int:
        made = self._write(rows, manifest["n"])
        kept = {b: p for b, p in manifest["buckets"].items() if b not in touched}
        self.versions.commit(number + 1, manifest | {"schema": schema.jsonValue(), "buckets": kept | made})
        return number + 1

    def upsert(self, new: DataFrame, order: list[Column] | None = None) -> int:
        """Rows of ``new`` replace those with their key; the version made, or the present one if there is no row.

        Of rows of ``new`` with one key the first by ``order`` counts; without ``order`` keys must
        be unique. New columns are added, missing ones are null. Repeating a batch changes nothing.
        """
        number, manifest = self.versions.newest()
        rows = new.where(F.col(self.key).isNotNull())
        rows = stored(keep_first(rows, [self.key], order) if order else rows)
        if manifest is None:
            manifest = {"n": self.buckets, "schema": rows.schema.jsonValue(), "buckets": {}}
        touched = [str(r[0]) for r in rows.select(self._bucket(manifest["n"])).distinct().collect()]
        if not touched and number:
            return number
        old = self._frame(manifest, touched)
        merged = old.join(rows.select(self.key), self.key, "left_anti").unionByName(rows, allowMissingColumns=True)
        return self._replace(number, manifest, touched, merged.select(*old.columns, *[c for c in rows.columns if c not in old.columns]), merged.schema)

    def delete(self, gone: Column) -> int:
        """Remove the rows for which ``gone`` holds; buckets without such rows stay as they are."""
        number, manifest = self.versions.newest()
        if manifest is None:
            return 0
        found = self._frame(manifest).where(gone).select(self._bucket(manifest["n"]))
        touched = [str(r[0]) for r in found.distinct().collect()]
        if not touched:
            return number
        old = self._frame(manifest, touched)
        return self._replace(number, manifest, touched, old.where(~F.coalesce(gone, F.lit(False))), old.schema)

    def migrate(self, name: str, step: Callable[[DataFrame], DataFrame]) -> bool:
        """Replace the table by ``step`` of it, once for each name; whether it was done now."""
        number, manifest = self.versions.newest()
        if manifest is None or name in manifest.get("steps", []):
            return False
        rows = step(self._frame(manifest))
        known = manifest | {"steps": [*manifest.get("steps", []), name]}
        self._replace(number, known, list(manifest["buckets"]), rows.where(F.col(self.key).isNotNull()), rows.schema)
        return True

    def vacuum(self, keep: int = 2) -> None:
        self.versions.vacuum(keep, lambda m: {p.split("/")[1] for p in m["buckets"].values()})


class Published:
    """SK-05: a set of tables whose new contents appear together, by one manifest."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.versions = Versions(spark, root)

    def publish(self, tables: list[tuple[str, DataFrame]]) -> dict[str, int]:
        """Build every table, then switch to all of them; their row counts. Other tables stay.

        If a build fails, every table stays readable as it was.
        """
        number, manifest = self.versions.newest()
        made, counts = {}, {}
        for name, df in tables:
            seen, path = Observation(f"rows of {name}"), f"data/{uuid.uuid4().hex}"
            df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.root}/{path}")
            made[name] = {"path": path, "schema": df.schema.jsonValue()}
            counts[name] = seen.get["n"]
        self.versions.commit(number + 1, {"tables": ((manifest or {}).get("tables") or {}) | made})
        return counts

    def path(self, name: str) -> str:
        return f"{self.root}/{self._tables()[name]['path']}"

    def _tables(self) -> dict:
        return (self.versions.newest()[1] or {"tables": {}})["tables"]

    def names(self) -> list[str]:
        return sorted(self._tables())

    def read(self, name: str) -> DataFrame:
        one = self._tables()[name]
        return self.spark.read.schema(T.StructType.fromJson(one["schema"])).parquet(f"{self.root}/{one['path']}")

    def vacuum(self, keep: int = 2) -> None:
        self.versions.vacuum(keep, lambda m: {t["path"].split("/")[1] for t in m["tables"].values()})
