"""A table of current documents that is kept by rewriting the buckets that a batch touches.

Rows lie in buckets by a hash of their key. A batch joins the rows of its own buckets only, writes these buckets anew
beside the old ones, and at last a manifest that names the folder of each bucket: readers see the old table or the new
one. Reading needs no ranking and no shuffle. The manifest also holds the last batch of every run, so that a replayed
batch changes nothing.

With ``dimensions`` the table maintains counts: every batch adds the counts of its rows and takes away those of the
rows that they replace, so a dashboard reads sums instead of the documents.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chatterlens.operators.latest import upsert_view
from chatterlens.session import hadoop_path

BUCKETS = 64
COUNT = "n"
# Names of folders and so of columns that Spark reads from them; no column of the rows may have them.
_BUCKET, _WRITTEN = "_bucket", "_written"
# Count folders that are read at most before a batch sums them up into one.
MOST_COUNT_FOLDERS = 100


@dataclass
class Manifest:
    """What a version of the table is made of."""

    version: int = 0
    schema: dict | None = None
    #: Version whose folder holds the bucket's rows, by bucket.
    buckets: dict[int, int] = field(default_factory=dict)
    #: The last batch of each run.
    applied: dict[str, int] = field(default_factory=dict)
    #: Versions whose counts make up the sums.
    counts: list[int] = field(default_factory=list)

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        held = json.loads(text)
        held["buckets"] = {int(bucket): version for bucket, version in held["buckets"].items()}
        return cls(**held)


@dataclass(frozen=True)
class KeyedTable:
    """A keyed table at ``path``, below shared storage. One writer at a time; readers are not disturbed.

    ``buckets`` stays what it was when the table was made; it should be so large that a bucket is rewritten by a task
    or a few. ``order`` decides between several writes of a key in one batch as ``upsert_view`` does.
    """

    spark: SparkSession
    path: str
    key: Sequence[str] = ("id",)
    buckets: int = BUCKETS
    order: Sequence[str] = ("arrival",)
    dimensions: Sequence[str] = ()

    def manifest(self) -> Manifest:
        """The last complete one; an empty one if the table is new."""
        files, folder = hadoop_path(self.spark, f"{self.path}/manifest")
        if not files.exists(folder):
            return Manifest()
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        known = sorted(name for name in names if name.endswith(".json"))
        if not known:
            return Manifest()
        text = "\n".join(row.value for row in self.spark.read.text(f"{self.path}/manifest/{known[-1]}").collect())
        return Manifest.from_json(text)

    def read(self) -> DataFrame:
        """Current documents."""
        manifest = self.manifest()
        if manifest.schema is None:
            raise ValueError(f"nothing was written to {self.path}")
        return self._rows(manifest, list(manifest.buckets)).drop(_BUCKET)

    def read_keys(self, keys: DataFrame) -> DataFrame:
        """Current documents of a few keys; only their buckets are read."""
        manifest = self.manifest()
        wanted = [row[0] for row in keys.select(self._bucket()).distinct().collect()]
        rows = self._rows(manifest, [bucket for bucket in wanted if bucket in manifest.buckets])
        return rows.join(keys.distinct(), self._same_key(rows, keys.distinct()), "left_semi").drop(_BUCKET)

    def counts(self) -> DataFrame:
        """(dimensions, n) of the current documents, from the maintained counts."""
        return self._summed(self.manifest()).filter(F.col(COUNT) != 0)

    def upsert(self, batch: DataFrame, batch_id: int, run: str = "batch") -> bool:
        """Write a batch; returns whether it changed the table, which a replayed batch does not.

        Of several rows of a key the last by ``order`` counts; null keys are equal to each other. The columns of the
        first batch are those of the table.
        """
        manifest = self.manifest()
        if batch_id <= manifest.applied.get(run, -1):
            return False
        current = upsert_view(batch, self.key, self.order).withColumn(_BUCKET, self._bucket())
        if manifest.schema is not None:
            names = T.StructType.fromJson(manifest.schema).fieldNames()
            current = current.select(*names, _BUCKET)
        current = current.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = sorted(row[0] for row in current.select(_BUCKET).distinct().collect())
            after = self._written(manifest, current, touched)
        finally:
            current.unpersist()
        after.applied[run] = batch_id
        self._swap(after)
        return True

    def vacuum(self, keep: int = 2) -> None:
        """Delete folders and manifests that none of the last ``keep`` versions needs."""
        files, folder = hadoop_path(self.spark, f"{self.path}/manifest")
        names = sorted(status.getPath().getName() for status in files.listStatus(folder) if status.getPath().getName().endswith(".json"))
        held = [Manifest.from_json(self.spark.read.text(f"{self.path}/manifest/{name}").first().value) for name in names[-keep:]]
        needed = {
            "rows": {f"{_WRITTEN}={version}/{_BUCKET}={bucket}" for one in held for bucket, version in one.buckets.items()},
            "counts": {f"{_WRITTEN}={version}" for one in held for version in one.counts},
        }
        for name in names[:-keep]:
            self._delete(f"manifest/{name}")
        newest = max((one.version for one in held), default=0)
        for kind, wanted in needed.items():
            for version in self._names(kind):
                # A larger version is being written.
                if version.startswith(f"{_WRITTEN}=") and int(version.split("=")[1]) <= newest:
                    inside = self._names(f"{kind}/{version}") if kind == "rows" else []
                    parts = [f"{version}/{part}" for part in inside if part.startswith(_BUCKET)] or [version]
                    for part in parts:
                        if part not in wanted:
                            self._delete(f"{kind}/{part}")

    def _written(self, before: Manifest, current: DataFrame, touched: Sequence[int]) -> Manifest:
        """The next manifest, when the touched buckets and the changed counts are stored."""
        after = Manifest.from_json(before.to_json())
        after.version += 1
        after.schema = before.schema or json.loads(current.drop(_BUCKET).schema.json())
        known = [bucket for bucket in touched if bucket in before.buckets]
        rows = current
        if known:
            old = self._rows(before, known)
            # Keys tell which buckets have rows that stay; only those move their rows.
            keys = old.select(*self.key, _BUCKET)
            stay = keys.join(current.select(*self.key), self._same_key(keys, current), "left_anti")
            mixed = sorted(row[0] for row in stay.select(_BUCKET).distinct().collect())
            if mixed:
                held = self._rows(before, mixed)
                rows = held.join(current.select(*self.key), self._same_key(held, current), "left_anti").unionByName(current)
        if touched:
            target = f"{self.path}/rows/{_WRITTEN}={after.version}"
            rows.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(target)
            after.buckets |= dict.fromkeys(touched, after.version)
        if touched and self.dimensions:
            changes = current.select(*self.dimensions, F.lit(1).alias(COUNT))
            if known:
                replaced = old.join(current.select(*self.key), self._same_key(old, current), "left_semi")
                changes = changes.unionByName(replaced.select(*self.dimensions, F.lit(-1).alias(COUNT)))
            after.counts = [*before.counts, after.version]
            if len(after.counts) > MOST_COUNT_FOLDERS:
                changes = changes.unionByName(self._summed(before))
                after.counts = [after.version]
            changes = changes.groupBy(*self.dimensions).agg(F.sum(COUNT).alias(COUNT)).filter(F.col(COUNT) != 0)
            changes.write.mode("overwrite").parquet(f"{self.path}/counts/{_WRITTEN}={after.version}")
        return after

    def _summed(self, manifest: Manifest) -> DataFrame:
        if not self.dimensions or manifest.schema is None:
            raise ValueError(f"no counts are kept at {self.path}")
        fields = T.StructType.fromJson(manifest.schema)
        schema = T.StructType([*[fields[name] for name in self.dimensions], T.StructField(COUNT, T.LongType())])
        folders = [f"{self.path}/counts/{_WRITTEN}={version}" for version in manifest.counts]
        counted = self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)
        return counted.groupBy(*self.dimensions).agg(F.sum(COUNT).alias(COUNT))

    def _rows(self, manifest: Manifest, buckets: Sequence[int]) -> DataFrame:
        """Rows of some buckets with the bucket's number."""
        schema = T.StructType.fromJson(manifest.schema).add(_BUCKET, T.LongType())
        if not buckets:
            return self.spark.createDataFrame([], schema)
        root = f"{self.path}/rows"
        folders = [f"{root}/{_WRITTEN}={manifest.buckets[bucket]}/{_BUCKET}={bucket}" for bucket in buckets]
        return self.spark.read.schema(schema).option("basePath", root).parquet(*folders).select(*schema.fieldNames())

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).alias(_BUCKET)

    def _same_key(self, left: DataFrame, right: DataFrame) -> Column:
        return reduce(and_, [left[name].eqNullSafe(right[name]) for name in self.key])

    def _swap(self, manifest: Manifest) -> None:
        """Make the version the current one: a finished file gets its name in one step."""
        name = f"{manifest.version:012d}"
        files, draft = hadoop_path(self.spark, f"{self.path}/manifest/{name}.draft")
        out = files.create(draft, True)
        out.write(bytearray(manifest.to_json().encode()))
        out.close()
        _, final = hadoop_path(self.spark, f"{self.path}/manifest/{name}.json")
        if files.exists(final) or not files.rename(draft, final):
            raise RuntimeError(f"another writer made version {manifest.version} of {self.path}")

    def _names(self, folder: str) -> list[str]:
        files, place = hadoop_path(self.spark, f"{self.path}/{folder}")
        return [status.getPath().getName() for status in files.listStatus(place)] if files.exists(place) else []

    def _delete(self, place: str) -> None:
        files, found = hadoop_path(self.spark, f"{self.path}/{place}")
        files.delete(found, True)
