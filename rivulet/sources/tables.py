"""Readers: tables, message streams, and collections with their settings."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


BALANCE = {"range": "org.apache.kafka.clients.consumer.RangeAssignor", "roundrobin": "org.apache.kafka.clients.consumer.RoundRobinAssignor", "sticky": "org.apache.kafka.clients.consumer.StickyAssignor"}


def kafka_options(servers: str, topics: list[str], group: str | None = None, oldest: bool = False, max_per_trigger: int | None = None, balance: str | None = None, retry_ms: int = 5000) -> dict[str, str]:
    """The options of the reader.  Offsets are committed by the query's checkpoint
    once a batch is done, so ``group`` only names the consumer; a fetch that
    fails is tried again after ``retry_ms``."""
    if not topics or any(not t.strip() for t in topics):
        raise ValueError("topic must not be empty")
    out = {"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics), "startingOffsets": "earliest" if oldest else "latest", "fetchOffset.retryIntervalMs": str(retry_ms)}
    if group:
        out["kafka.group.id"] = group
    if max_per_trigger:
        out["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if balance:
        out["kafka.partition.assignment.strategy"] = BALANCE[balance]
    return out


def kafka_stream(spark: SparkSession, servers: str, topic: str, oldest: bool = False, max_per_trigger: int | None = None, **more) -> DataFrame:
    """topic, partition, offset, key, value, timestamp of a topic; needs the
    Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, [topic], oldest=oldest, max_per_trigger=max_per_trigger, **more)).load()


def decode_json(messages: DataFrame, schema: str, value: str = "value", on_error: str = "skip") -> tuple[DataFrame, DataFrame]:
    """(decoded rows, malformed messages).  ``skip``: a poison message never stops a
    stream; ``retry``: it raises, so the batch fails and is tried again, its
    offsets uncommitted, and there are no malformed rows."""
    if on_error not in ("skip", "retry"):
        raise ValueError("on_error is skip or retry")
    p = messages.withColumn("__m", F.from_json(F.col(value).cast("string"), f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"}))
    bad = F.col("__m").isNull() | F.col("__m._bad").isNotNull()
    rest = [c for c in messages.columns if c != value]
    if on_error == "retry":
        good = p.withColumn("__m", F.when(bad, F.raise_error(F.lit("malformed message")).cast(p.schema["__m"].dataType)).otherwise(F.col("__m")))
        return good.select(*rest, "__m.*").drop("_bad"), p.where(F.lit(False)).drop("__m")
    return p.where(~bad).select(*rest, "__m.*").drop("_bad"), p.where(bad).drop("__m")


def send_rows(df: DataFrame, sender, columns: list[str] | None = None, attempts: int = 1) -> None:
    """Hand every row, as a dict, to ``sender(rows)``, a batch a call from the
    executors: a fire-and-forget sink.  Failures beyond ``attempts`` are
    dropped, as nothing waits for an answer."""
    def put(batches):
        for b in batches:
            for _ in range(attempts):
                try:
                    sender(b.to_pylist())
                    break
                except OSError:
                    continue
            yield from ()

    df.select(*(columns or df.columns)).mapInArrow(put, "done boolean").write.format("noop").mode("append").save()


class Collections:
    """Vector collections as parquet folders under ``root``, with dimensions
    and metric in a small JSON file each, read and written through Spark."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        p, fs = self._fs(f"{self.root}/{name}/settings")
        return fs.exists(p)

    def create(self, name: str, dimensions: int, metric: str = "cosine") -> None:
        if metric not in ("cosine", "dot", "euclidean") or dimensions <= 0:
            raise ValueError("bad dimensions or metric")
        if self.exists(name):
            raise ValueError(f"collection {name!r} exists")
        row = json.dumps({"dimensions": dimensions, "metric": metric})
        self.spark.range(1).select(F.lit(row).alias("value")).coalesce(1).write.text(f"{self.root}/{name}/settings")

    def settings(self, name: str) -> dict:
        return json.loads(self.spark.read.text(f"{self.root}/{name}/settings").first().value)

    def drop(self, name: str) -> None:
        p, fs = self._fs(f"{self.root}/{name}")
        fs.delete(p, True)

    def names(self) -> list[str]:
        p, fs = self._fs(self.root)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def write(self, name: str, docs: DataFrame) -> None:
        """Replace the documents by a new version; the old one goes after.
        Vectors of another length raise."""
        d = self.settings(name)["dimensions"]
        checked = docs.withColumn("vector", F.when(F.size("vector") == d, F.col("vector")).otherwise(F.raise_error(F.lit(f"vectors of {name} have {d} dimensions"))))
        old = self.version(name)
        checked.write.parquet(f"{self.root}/{name}/v{old + 1}")
        if old:
            p, fs = self._fs(f"{self.root}/{name}/v{old}")
            fs.delete(p, True)

    def version(self, name: str) -> int:
        p, fs = self._fs(f"{self.root}/{name}")
        done = [s.getPath() for s in fs.listStatus(p) if s.getPath().getName().startswith("v")]
        numbers = [int(x.getName()[1:]) for x in done if fs.exists(self._fs(f"{x}/_SUCCESS")[0])]
        return max(numbers, default=0)

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}/v{self.version(name)}")
