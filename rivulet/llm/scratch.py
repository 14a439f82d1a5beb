"""Tables written to the shared checkpoint folder, to cut lineage.

The folder is the one the cluster names in ``spark.checkpoint.dir``; every
executor and the driver see it, so a table there outlives any executor.  Only
where all of Spark is one process on one machine (tests) and that setting is
absent is a folder of that machine used; elsewhere its absence is an error.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL = "file:///tmp/checkpoints"


def shared_folder(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and (made := spark._jsc.sc().getCheckpointDir()).isDefined():  # SparkContext.setCheckpointDir
        named = made.get()
    if not named:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        named = LOCAL
    return named.rstrip("/")


class Scratch:
    """A fresh folder of intermediate tables for one operator call.

    ``cut`` writes a frame and returns it reread: later stages start from
    files, not from a long lineage.  ``drop`` removes tables that have been read
    for the last time, ``keep`` all but the named ones; tables that a returned
    frame still reads must stay.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/rivulet-{label}-{uuid.uuid4().hex}"
        self._n = 0
        self._live: set[str] = set()

    def cut(self, df: DataFrame, label: str = "t") -> DataFrame:
        self._n += 1
        path = f"{self.root}/{self._n:04d}-{label}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._live.add(path)
        out._rivulet_path = path  # the caller may hand it to drop()
        return out

    def drop(self, *tables: DataFrame) -> None:
        self._remove([t._rivulet_path for t in tables])

    def keep(self, *tables: DataFrame) -> None:
        stay = {t._rivulet_path for t in tables}
        self._remove([p for p in self._live if p not in stay])
        self.collect()

    def collect(self) -> None:
        """Has the driver find shuffles that no frame uses any more, so that
        executors delete their files now and not at the next long collection."""
        self.spark._jvm.System.gc()

    def _remove(self, paths: list[str]) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for name in paths:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
            self._live.discard(name)
