"""A table of points that is kept up to date batch by batch: buckets by id, and manifests that say what is current.

Every batch adds one folder for each bucket that it touches. The manifest of a version lists the folders of all
buckets; it is a single file, so a version is there or not. Readers take the newest one and read just
its folders. Compaction merges the buckets that have several folders and leaves all others as they are.
Nothing that a kept version lists is ever deleted. One writer at a time.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.saved import remove, store_of

MANIFEST = T.StructType(
    [T.StructField("bucket", T.IntegerType()), T.StructField("folder", T.StringType()), T.StructField("batch", T.LongType())]
)
_VERSION = "_version"


@dataclass(frozen=True)
class Snapshot:
    """A version: the last batch in it, and the folders of each bucket, oldest first."""

    version: int
    batch: int
    folders: dict[int, list[str]]


class PointTable:
    """Points by ``key``; ``schema`` is theirs. The number of buckets is fixed once the table has a version."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str = "point_id", buckets: int = 64) -> None:
        self.spark, self.path, self.schema, self.key, self.buckets = spark, path.rstrip("/"), schema, key, buckets
        self.stored = T.StructType([*schema.fields, T.StructField(_VERSION, T.LongType())])

    def _versions(self) -> list[int]:
        store, path = store_of(f"{self.path}/manifest")
        found = store.get_file_info(fs.FileSelector(path, allow_not_found=True, recursive=True))
        whole = {info.path.rsplit("/", 2)[-2] for info in found if info.path.endswith(".parquet") and "/_" not in info.path[len(path) :]}
        return sorted(int(name.removeprefix("version=")) for name in whole if name.startswith("version="))

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or the one asked for."""
        if version is None:
            version = max(self._versions(), default=0)
        if not version:
            return Snapshot(0, -1, {})
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/version={version}").collect()
        folders, batch = defaultdict(list), -1
        for row in sorted(rows, key=lambda row: (row.batch, row.folder or "")):
            batch = max(batch, row.batch)
            if row.folder is not None:
                folders[row.bucket].append(row.folder)
        return Snapshot(version, batch, dict(folders))

    def _commit(self, version: int, batch: int, folders: dict[int, list[tuple[str, int]]]) -> None:
        rows = [(bucket, folder, own) for bucket, some in folders.items() for folder, own in some]
        frame = self.spark.createDataFrame([*rows, (None, None, batch)], MANIFEST)
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/version={version}")

    def _listed(self, snapshot: Snapshot) -> dict[int, list[tuple[str, int]]]:
        if not snapshot.version:
            return {}
        rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/version={snapshot.version}").filter("folder IS NOT NULL").collect()
        folders = defaultdict(list)
        for row in rows:
            folders[row.bucket].append((row.folder, row.batch))
        return folders

    def _written(self, points: DataFrame, name: str) -> list[int]:
        """Points with their version, by bucket; the buckets that have some."""
        folder = f"{self.path}/data/{name}"
        bucket = F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")
        points.withColumn("bucket", bucket).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(folder)
        store, path = store_of(folder)
        found = store.get_file_info(fs.FileSelector(path))
        return sorted(int(info.base_name.removeprefix("bucket=")) for info in found if info.base_name.startswith("bucket="))

    def write(self, points: DataFrame, batch_id: int) -> None:
        """Add a batch of points, each id once. A batch that is in the table already changes nothing."""
        now = self.snapshot()
        if batch_id <= now.batch:
            return
        version, folders = now.version + 1, self._listed(now)
        rows = points.select(*[F.col(f"`{name}`") for name in self.schema.fieldNames()], F.lit(version).cast("long").alias(_VERSION))
        for bucket in self._written(rows, f"batch={batch_id}"):
            folders.setdefault(bucket, []).append((f"data/batch={batch_id}/bucket={bucket}", batch_id))
        self._commit(version, batch_id, folders)

    def _newest(self, folders: list[str]) -> DataFrame:
        """For each id of some buckets the row of the newest version."""
        rows = self.spark.read.schema(self.stored).parquet(*[f"{self.path}/{folder}" for folder in folders])
        newest = Window.partitionBy(self.key).orderBy(F.desc(_VERSION))
        return rows.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")

    def read(self, version: int | None = None) -> DataFrame:
        """The points of the newest version, or of the one asked for; later writes do not change this frame.

        Only buckets with several folders are ranked."""
        folders = self.snapshot(version).folders
        single = [some[0] for some in folders.values() if len(some) == 1]
        several = [folder for some in folders.values() if len(some) > 1 for folder in some]
        result = self.spark.createDataFrame([], self.stored)
        if single:
            result = result.unionByName(self.spark.read.schema(self.stored).parquet(*[f"{self.path}/{folder}" for folder in single]))
        if several:
            result = result.unionByName(self._newest(several))
        return result.drop(_VERSION)

    def compact(self, least: int = 2) -> list[int]:
        """Merge the buckets with ``least`` folders or more into one each; which ones they were."""
        now = self.snapshot()
        folders = self._listed(now)
        chosen = sorted(bucket for bucket, some in folders.items() if len(some) >= max(2, least))
        if not chosen:
            return []
        version = now.version + 1
        rows = self._newest([folder for bucket in chosen for folder, _ in folders[bucket]])
        self._written(rows, f"compact={version}")
        for bucket in chosen:
            folders[bucket] = [(f"data/compact={version}/bucket={bucket}", now.batch)]
        self._commit(version, now.batch, folders)
        return chosen

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete what none of the newest ``keep`` versions lists, and older manifests; the folders deleted.

        A reader that was opened on an older version may fail afterwards."""
        versions = self._versions()
        kept = {folder for version in versions[-keep:] for some in self.snapshot(version).folders.values() for folder in some}
        store, path = store_of(self.path)
        gone = []
        for batch in store.get_file_info(fs.FileSelector(f"{path}/data", allow_not_found=True)):
            for bucket in store.get_file_info(fs.FileSelector(batch.path)):
                name = f"data/{batch.base_name}/{bucket.base_name}"
                if bucket.base_name.startswith("bucket=") and name not in kept:
                    remove(f"{self.path}/{name}")
                    gone.append(name)
        for version in versions[:-keep]:
            remove(f"{self.path}/manifest/version={version}")
        return gone
