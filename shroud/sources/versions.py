"""Tables of immutable folders whose list has versions: a writer that read an old version can't commit over a newer one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from shroud.sources.sinks import exists, hadoop_path

#: Versions behind the newest whose lists and folders are kept for readers that have begun.
KEPT = 20


class Versions:
    """Below ``path``: ``data/<name>`` folders of Parquet, and ``versions/<number>`` files that list a version's folders.

    The next number is taken by renaming a finished file to it, which fails if the number is taken, so
    of two writers that read the same version one commits, and the other reads again and tries again.
    The first version is empty and has the number 0. Folders that only a lost writer wrote are in no list.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def newest(self) -> int:
        """The number of the newest version."""
        if not exists(self.spark, f"{self.path}/versions"):
            return 0
        fs, place = hadoop_path(self.spark, f"{self.path}/versions")
        names = [s.getPath().getName() for s in fs.listStatus(place)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def folders(self, version: int) -> list[str]:
        """Names of a version's folders."""
        if not version:
            return []
        fs, place = hadoop_path(self.spark, f"{self.path}/versions/{version:012d}")
        stream = fs.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of a version, of the newest by default."""
        return self.folder(*self.folders(self.newest() if version is None else version))

    def folder(self, *names: str) -> DataFrame:
        """Rows of folders, in a version or only staged."""
        reader = self.spark.read.schema(self.schema).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/data/{n}" for n in names]).drop("f") if names else self.spark.createDataFrame([], self.schema)

    def stage(self, rows: DataFrame, partition_by: list[str] | None = None) -> str:
        """Writes rows that are in no version yet; gives the folder's name."""
        name = f"f={uuid.uuid4().hex}"
        writer = rows.write
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{self.path}/data/{name}")
        return name

    def commit(self, after: int, names: list[str]) -> bool:
        """Makes the folders the version after ``after``; false if another writer has made it."""
        fs, draft = hadoop_path(self.spark, f"{self.path}/drafts/{uuid.uuid4().hex}")
        _, place = hadoop_path(self.spark, f"{self.path}/versions/{after + 1:012d}")
        fs.mkdirs(place.getParent())
        stream = fs.create(draft, False)
        stream.write(json.dumps(names).encode())
        stream.close()
        jvm = self.spark.sparkContext._jvm
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            files.rename(draft, place, none)  # never over a file that is there
        except Exception as error:
            fs.delete(draft, False)
            if fs.exists(place):
                return False
            raise error
        self._forget(after + 1)
        return True

    def _forget(self, version: int) -> None:
        """Deletes a version that is KEPT behind, and folders that it listed and the next one doesn't."""
        old = version - KEPT
        if old < 1 or not exists(self.spark, f"{self.path}/versions/{old:012d}"):
            return
        for name in set(self.folders(old)) - set(self.folders(old + 1)):
            fs, place = hadoop_path(self.spark, f"{self.path}/data/{name}")
            fs.delete(place, True)
        fs, place = hadoop_path(self.spark, f"{self.path}/versions/{old:012d}")
        fs.delete(place, False)

    def drop(self, name: str) -> None:
        """Deletes a folder that was staged and not committed."""
        fs, place = hadoop_path(self.spark, f"{self.path}/data/{name}")
        fs.delete(place, True)
