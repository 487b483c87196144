"""A log of what was done for each batch of a stream, kept as files in a shared folder.

An entry is written whole under another name and then renamed, so it is there or it is not, whenever a driver is lost.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


class BatchLog:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._paths = spark._jvm.org.apache.hadoop.fs
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._paths.Path(f"{self.folder}/{name}" if name else self.folder)

    def has(self, entry: str) -> bool:
        return self._fs.exists(self._path(f"log/{entry}"))

    def record(self, entry: str) -> None:
        """Make an entry; one that is there stays as it is."""
        if self.has(entry):
            return
        self._fs.mkdirs(self._path("log"))
        draft = self._path(f"draft-{uuid.uuid4().hex}")
        self._fs.create(draft, False).close()
        if not self._fs.rename(draft, self._path(f"log/{entry}")):
            self._fs.delete(draft, False)
            if not self.has(entry):
                raise OSError(f"cannot write {entry} to the log in {self.folder}")

    def keep(self, df: DataFrame, name: str) -> None:
        """Write a table of the batch, over what an earlier try has left."""
        df.write.mode("overwrite").parquet(f"{self.folder}/data/{name}")

    def kept(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/data/{name}")

    def forget(self, name: str) -> None:
        self._fs.delete(self._path(f"data/{name}"), True)
