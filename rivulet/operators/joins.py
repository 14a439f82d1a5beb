"""N-way keyed stream join: one slot a topic, the last write wins.

A key's cycle starts with its first contribution, completes when every topic has
one, and then starts anew; a cycle older than the window when its key's next
contribution (or the end) comes has timed out.  A relational join is not the same: it would pair
every contribution with every other.
"""

from __future__ import annotations

import json

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.core import micros
from .windows import admit_keys

OUT = "kind string, join_key string, created_at timestamp_ntz, fired_at timestamp_ntz, messages map<string,string>, missing_topics array<string>"


class Cycle:
    """One key's slots.  ``add`` and ``expire`` return finished cycles."""

    def __init__(self, topics: list[str], window_us: int):
        self.topics, self.window_us, self.slots, self.created = topics, window_us, {}, None

    def expire(self, now: int) -> list[tuple]:
        if not self.slots or now - self.created < self.window_us:
            return []
        out = ("timeout", self.created, self.created + self.window_us, self.slots, [t for t in self.topics if t not in self.slots])
        self.slots, self.created = {}, None
        return [out]

    def add(self, us: int, topic: str, payload: str) -> list[tuple]:
        out = self.expire(us)
        self.created = us if not self.slots else self.created
        self.slots[topic] = payload
        if len(self.slots) == len(self.topics):
            out.append(("joined", self.created, us, self.slots, []))
            self.slots, self.created = {}, None
        return out


def join_cycles(rows, topics: list[str], window_us: int, end: int | None = None) -> list[tuple]:
    """``rows``: (time in microseconds, topic, payload) in arrival order."""
    c = Cycle(topics, window_us)
    out = [x for r in rows for x in c.add(*r)]
    return out + (c.expire(end) if end is not None else [])


def keyed_join(df: DataFrame, topics: list[str], topic: str, key: str, ts: str, payload: str, window_ms: int, order: list[str], end: str | None = None, max_keys: int = 0) -> DataFrame:
    """Joined and timed-out cycles of each key.  Rows of other topics and rows
    with a null or blank key are skipped.  ``end``: an ISO time by which open
    cycles may time out; without it they stay open.  ``max_keys``: only the keys
    seen first, so many, are joined.  A partition is sorted by Spark and
    streamed, so a hot key costs no memory."""
    if len({*topics}) < 2 or window_ms <= 0:
        raise ValueError("a join needs two distinct topics or more, and a window")
    rows = df.where(F.col(topic).isin(topics) & (F.trim(F.col(key).cast("string")) != ""))
    if max_keys:
        rows, _ = admit_keys(rows, key, order, max_keys)
    picked = rows.select(F.col(key).cast("string").alias("join_key"), micros(df, ts).alias("us"), F.col(topic).alias("t"), F.col(payload).cast("string").alias("p"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    ordered = picked.repartition("join_key").sortWithinPartitions("join_key", *[f"o{i}" for i in range(len(order))]).select("join_key", "us", "t", "p")
    until = int(pd.Timestamp(end).value // 1000) if end else None
    names = ["kind", "join_key", "created_at", "fired_at", "messages", "missing_topics"]
    kinds = [pa.string(), pa.string(), pa.timestamp("us"), pa.timestamp("us"), pa.map_(pa.string(), pa.string()), pa.list_(pa.string())]

    def run(batches):
        cycle, current, out = None, None, []

        def put(found):
            out.extend((kind, current, c, f, [*m.items()], miss) for kind, c, f, m, miss in found)

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)

        for b in batches:
            for k, us, t, p in zip(*(b.column(i).to_pylist() for i in range(4))):
                if cycle is None or k != current:
                    if cycle is not None and until is not None:
                        put(cycle.expire(until))
                    cycle, current = Cycle(topics, window_ms * 1000), k
                put(cycle.add(us, t, p))
            if out:
                yield batch()
                out.clear()
        if cycle is not None and until is not None:
            put(cycle.expire(until))
        if out:
            yield batch()

    return ordered.mapInArrow(run, OUT)


def interval_join(left: DataFrame, right: DataFrame, keys: list[str], left_ts: str, right_ts: str, seconds: int) -> DataFrame:
    """Pairs of equal keys whose right time lies after the left one, by at most
    ``seconds``.  Times are dealt to buckets of that length, so that the interval
    is an equality; a left row meets its own bucket and the next.  Columns of the
    right side must differ from the left's but for keys and times."""
    width = seconds * 1_000_000
    a = left.withColumn("__us", micros(left, left_ts)).withColumn("__bucket", F.explode(F.array(*[F.floor(F.col("__us") / width) + i for i in (0, 1)])))
    b = right.withColumn("__then", micros(right, right_ts)).withColumn("__bucket", F.floor(F.col("__then") / width)).drop(right_ts)
    return a.join(b, [*keys, "__bucket"]).where((F.col("__then") > F.col("__us")) & (F.col("__then") <= F.col("__us") + width)).drop("__us", "__then", "__bucket")


def as_json(messages: dict) -> str:
    return json.dumps(messages, sort_keys=True)
