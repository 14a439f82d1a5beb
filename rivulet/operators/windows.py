"""Keyed windows over arrival order.

Count windows and sliding windows are frames.  Time-tumbling windows are anchored
at the first accepted event, so each window's start depends on the last close:
one ordered fold a key, by the same step as the streaming operator.  Events are
taken in (order) sequence; keys are the unit of parallel work.
"""

from __future__ import annotations

from collections import OrderedDict, deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.core import micros

FUNCTIONS = ("sum", "count", "avg", "min", "max")


def compute(function: str, values: list[float]) -> float:
    """Zero for no values."""
    if function not in FUNCTIONS:
        raise ValueError(f"unknown function {function!r}")
    if function == "count":
        return float(len(values))
    if not values:
        return 0.0
    return {"sum": sum, "avg": lambda v: sum(v) / len(v), "min": min, "max": max}[function](values)


def aggregate_column(function: str, value: str) -> Column:
    if function not in FUNCTIONS:
        raise ValueError(f"unknown function {function!r}")
    c = F.count(value).cast("double") if function == "count" else getattr(F, function)(F.col(value).cast("double"))
    return F.coalesce(c, F.lit(0.0))


def tumbling_count(df: DataFrame, size: int, value: str, key: str | None, order: list[str], function: str = "sum") -> DataFrame:
    """Full windows of ``size`` events: key, window_no, value, count.  The open
    remainder is not emitted."""
    k = F.col(key) if key else F.lit("")
    rn = F.row_number().over(Window.partitionBy("key").orderBy(*order))
    rows = df.withColumn("key", k).withColumn("window_no", F.floor((rn - 1) / size).cast("long"))
    return rows.groupBy("key", "window_no").agg(aggregate_column(function, value).alias("value"), F.count("*").alias("count")).where(F.col("count") == size)


def sliding_count(df: DataFrame, size: int, value: str, key: str, order: list[str], function: str = "sum", out: str = "value_out") -> DataFrame:
    """Each event with the aggregate over the last ``size`` events of its key."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(-(size - 1), 0)
    c = F.count(value).cast("double") if function == "count" else getattr(F, function)(F.col(value).cast("double"))
    return df.withColumn(out, c.over(w))


def sliding_time(df: DataFrame, size_ms: int, value: str, key: str, ts_ms: str, function: str = "sum", out: str = "value_out", order: list[str] | None = None, ascending: bool = False) -> DataFrame:
    """Each event with the aggregate over the events of its key that came before
    it, and itself, from ``size_ms`` before its time on, inclusive.

    ``order`` is the arrival order.  With it, events leave from the front alone,
    as long as the first is too old: an older event behind a newer one stays.
    Without it, times are the order and must ascend and differ.  ``ascending``
    says that times never fall in that order, as where it begins with the time:
    sums, counts and means are frames then, less what follows at the same time."""
    if order is None:
        w = Window.partitionBy(key).orderBy(ts_ms).rangeBetween(-size_ms, 0)
        c = F.count(value).cast("double") if function == "count" else getattr(F, function)(F.col(value).cast("double"))
        return df.withColumn(out, c.over(w))
    if ascending and function in ("sum", "count", "avg"):
        w = Window.partitionBy(key).orderBy(ts_ms).rangeBetween(-size_ms, 0)
        after = Window.partitionBy(key, ts_ms).orderBy(*order).rowsBetween(1, Window.unboundedFollowing)
        v = F.col(value).cast("double")
        total, n = (f(v).over(w) - F.coalesce(f(v).over(after), F.lit(0)) for f in (F.sum, F.count))
        return df.withColumn(out, {"sum": total, "count": n.cast("double"), "avg": total / n}[function])
    names = [c for c in df.columns if c != out]

    class Held:
        def __init__(self, _):
            self.events = deque()

        def add(self, ts, v):
            while self.events and self.events[0][0] < ts - size_ms:
                self.events.popleft()
            self.events.append((ts, v))
            return compute(function, [x for _, x in self.events if x is not None])

    return fold_sorted(df.select(*names), key, order, [F.col(ts_ms).cast("long"), F.col(value).cast("double")], Held, out)


def fold_sorted(df: DataFrame, key: str, order: list[str], inputs: list[Column], make: Callable, out: str | None) -> DataFrame:
    """Rows in (key, order) sequence through one state a key: ``make(key).add(*inputs)``
    is the double ``out`` of a row, or, without ``out``, whether the row stays.
    A partition is sorted by Spark and streamed, so a hot key costs no memory."""
    named = [c.alias(f"__in{i}") for i, c in enumerate(inputs)]
    rows = df.select("*", F.col(key).cast("string").alias("__key"), *named).repartition("__key").sortWithinPartitions("__key", *order)

    size = len(inputs)

    def run(batches):
        state, current, first = None, None, True
        for b in batches:
            ins = [b.column(b.schema.get_field_index(f"__in{i}")).to_pylist() for i in range(size)]
            got = []
            for k, *x in zip(b.column(b.schema.get_field_index("__key")).to_pylist(), *ins):
                if first or k != current:
                    state, current, first = make(k), k, False
                got.append(state.add(*x))
            plain = b.select([n for n in b.schema.names if n != "__key" and not n.startswith("__in")])
            yield plain.append_column(out, pa.array(got, pa.float64())) if out else plain.filter(pa.array(got, pa.bool_()))

    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return rows.mapInArrow(run, f"{types}, `{out}` double" if out else types)


def admit_keys(df: DataFrame, key: str, order: list[str], max_keys: int) -> tuple[DataFrame, DataFrame]:
    """(rows of the ``max_keys`` keys seen first, rows of keys beyond)."""
    seen = df.groupBy(key).agg(F.min(F.struct(*order)).alias("__first")).orderBy("__first", key).limit(max_keys).select(key)
    known = F.broadcast(seen) if max_keys <= 100_000 else seen
    return df.join(known, key, "left_semi"), df.join(known, key, "left_anti")


def event_time(df: DataFrame, name: str, override: str | None = None) -> Column:
    """Event time of a field: milliseconds as a number, an RFC 3339 text or
    milliseconds as text; the present where there is none.  ``override`` is a
    field that goes first."""
    def parsed(c: str) -> Column:
        kind = dict(df.dtypes)[c]
        if kind.startswith("timestamp"):
            return F.timestamp_micros(micros(df, c))
        if kind == "string":
            t = F.when(F.col(c).rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d([.]\d+)?(Z|[+-]\d\d:\d\d)$"), F.col(c).try_cast("timestamp"))
            return F.coalesce(t, F.timestamp_millis(F.when(F.col(c).rlike(r"^[+-]?\d+$"), F.col(c)).try_cast("long")))
        return F.timestamp_millis(F.col(c).cast("long"))

    fields = [c for c in (override, name) if c and c in df.columns]
    return F.coalesce(*[parsed(c) for c in fields], F.current_timestamp())


@dataclass
class Settings:
    size_ms: int
    function: str = "sum"
    allowed_lateness_ms: int = 0
    max_buffer: int = 0
    overflow: str = "drop_oldest"  # drop_newest, error

    def __post_init__(self):
        if self.size_ms <= 0 or self.function not in FUNCTIONS or self.overflow not in ("drop_oldest", "drop_newest", "error"):
            raise ValueError("bad window settings")


@dataclass
class AnchoredWindow:
    """State of one key's anchored time window.  Times are microseconds.

    Running values stand for the events, which are kept only where the oldest may
    have to leave.  The overflow rule is applied before the boundary is looked
    at, so a full buffer that rejects new events stays until an idle close
    (documented behaviour)."""

    settings: Settings
    start: int | None = None
    watermark: int | None = None
    size: int = 0
    total: float = 0.0
    low: float | None = None
    high: float | None = None
    ids: list[str] = field(default_factory=list)  # of this window's events, in order, where messages have any
    kept: list[float] = field(default_factory=list)
    late: int = 0
    dropped: int = 0

    def __post_init__(self):
        self.known, self.kept, self.ids = {*self.ids}, deque(self.kept), deque(self.ids)

    def saved(self) -> dict:
        names = ("start", "watermark", "size", "total", "low", "high", "late", "dropped")
        return {k: getattr(self, k) for k in names} | {"ids": list(self.ids), "kept": list(self.kept)}

    def add(self, ts: int, value: float, message_id: str = "") -> tuple[str, dict] | None:
        """None, or ('closed' | 'late' | 'error', row)."""
        s = self.settings
        if message_id and message_id in self.known:
            return None
        self.watermark = ts if self.watermark is None else max(self.watermark, ts)
        if ts < self.watermark:
            if (self.watermark - ts) // 1000 > s.allowed_lateness_ms:
                return "late", {"value": value, "ts": ts, "watermark": self.watermark}
            self.late += 1
        if s.max_buffer and self.size >= s.max_buffer:
            if s.overflow == "error":
                return "error", {"value": value, "ts": ts, "watermark": self.watermark}
            self.dropped += 1
            if s.overflow == "drop_newest":
                return None
            self.kept.popleft()
            self.size -= 1
            if self.ids:
                self.known.discard(self.ids.popleft())
        self.start = ts if self.start is None else self.start
        out = None
        if int((ts - self.start) / 1000) >= s.size_ms:
            out = "closed", self.close(ts)
            self.start = ts
        self.size += 1
        if s.max_buffer and s.overflow == "drop_oldest":
            self.kept.append(value)
            if self.known or message_id:
                self.ids.append(message_id)
        elif message_id:
            self.ids.append(message_id)
        if message_id:
            self.known.add(message_id)
        self.total += value
        self.low = value if self.low is None else min(self.low, value)
        self.high = value if self.high is None else max(self.high, value)
        return out

    def value(self) -> float:
        if self.kept:
            return compute(self.settings.function, list(self.kept))
        f = self.settings.function
        if f == "count" or not self.size:
            return float(self.size)
        return {"sum": self.total, "avg": self.total / self.size, "min": self.low, "max": self.high}[f]

    def close(self, at: int) -> dict:
        row = {"value": self.value(), "count": self.size, "window_start": self.start, "closed_at": at, "late_count": self.late, "dropped_count": self.dropped}
        self.size, self.total, self.low, self.high, self.late, self.dropped, self.start = 0, 0.0, None, None, 0, 0, None
        self.known, self.kept, self.ids = set(), deque(), deque()
        return row


OUT = "kind string, value double, count long, window_start timestamp_ntz, closed_at timestamp_ntz, late_count long, dropped_count long, watermark timestamp_ntz"


def shown(kind: str, r: dict) -> tuple:
    if kind == "closed":
        return kind, r["value"], r["count"], r["window_start"], r["closed_at"], r["late_count"], r["dropped_count"], None
    return kind, r["value"], None, None, r["ts"], None, None, r["watermark"]


def fold(rows: Iterator[tuple], settings: Settings) -> list[tuple]:
    """``rows``: (ts in microseconds, value, message id) in arrival order."""
    w = AnchoredWindow(settings)
    return [shown(*hit) for ts, value, mid in rows if (hit := w.add(ts, value, mid))]


def still_open(w: AnchoredWindow) -> tuple:
    return "open", w.value(), w.size, w.start, None, w.late, w.dropped, w.watermark


def tumbling_time(df: DataFrame, settings: Settings, value: str, ts: str, key: str | None, order: list[str], message_id: str | None = None, with_open: bool = False) -> DataFrame:
    """Closed windows (kind ``closed``), late events (``late``) and overflow
    errors (``error``) of each key; ``with_open``, the state of each key's open
    window too (``open``: its value and size, late and dropped events so far, and
    the watermark).

    ``order`` is the arrival order.  A partition's events are sorted by Spark and
    streamed, so a hot key costs no memory; without ``key`` all events are one
    window sequence, which is one task by its definition."""
    names = ["key", *(c.split()[0] for c in OUT.split(", "))]
    stamp = pa.timestamp("us")
    kinds = [pa.string(), pa.string(), pa.float64(), pa.int64(), stamp, stamp, pa.int64(), pa.int64(), stamp]
    picked = df.select((F.col(key).cast("string") if key else F.lit("")).alias("key"), micros(df, ts).alias("us"), F.col(value).cast("double").alias("v"), (F.col(message_id).cast("string") if message_id else F.lit("")).alias("m"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    rows = (picked.repartition("key") if key else picked.repartition(1)).sortWithinPartitions("key", *[f"o{i}" for i in range(len(order))]).select("key", "us", "v", "m")

    def run(batches):
        w, current, out = None, None, []
        for b in batches:
            for k, us, v, m in zip(*(b.column(i).to_pylist() for i in range(4))):
                if w is None or k != current:
                    if w is not None and with_open and w.size:
                        out.append((current, *still_open(w)))
                    w, current = AnchoredWindow(settings), k
                if hit := w.add(us, v, m):
                    out.append((k, *shown(*hit)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=names)
                out = []
        if w is not None and with_open and w.size:
            yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip((current, *still_open(w)), kinds)], names=names)

    return rows.mapInArrow(run, f"key string, {OUT}")


def window_metrics(found: DataFrame) -> DataFrame:
    """A row a key of ``tumbling_time(..., with_open=True)``: events buffered,
    windows closed, late and rejected events, the watermark."""
    n = lambda kind: F.count(F.when(F.col("kind") == kind, 1))
    open_ = lambda c: F.max(F.when(F.col("kind") == "open", F.col(c)))
    return found.groupBy("key").agg(F.coalesce(open_("count"), F.lit(0)).alias("buffered"), n("closed").alias("closed"), n("late").alias("late"), n("error").alias("rejected"), open_("watermark").alias("watermark"))


class Seen:
    """First sightings of one id; a duplicate does not extend the time."""

    def __init__(self, ttl_us: int):
        self.ttl_us, self.until = ttl_us, None

    def add(self, us: int) -> bool:
        fresh = self.until is None or us >= self.until
        self.until = us + self.ttl_us if fresh else self.until
        return fresh


class SeenStore:
    """First sightings in one store of ``entries`` ids; a new one beyond puts out
    the id that would expire first, which is the one recorded first."""

    def __init__(self, ttl_us: int, entries: int):
        self.ttl_us, self.entries, self.until = ttl_us, entries, OrderedDict()

    def add(self, us: int, i: str) -> bool:
        if i in self.until and us < self.until[i]:
            return False
        if len(self.until) >= self.entries:
            self.until.popitem(last=False)
        self.until.pop(i, None)
        self.until[i] = us + self.ttl_us
        return True


def dedup_ttl(df: DataFrame, message_id: str, ts: str, ttl_ms: int, order: list[str], max_entries: int = 0) -> DataFrame:
    """First sightings: an event passes unless its id passed less than
    ``ttl_ms`` before; a duplicate does not extend that time.  Null ids pass.
    ``max_entries`` bounds the ids remembered over all events: one sequence, so
    one task, with that many ids in memory."""
    known = df.where(F.col(message_id).isNotNull())
    if max_entries:
        one = known.withColumn("__all", F.lit(""))
        found = fold_sorted(one, "__all", order, [micros(df, ts), F.col(message_id).cast("string")], lambda _: SeenStore(ttl_ms * 1000, max_entries), None).drop("__all")
    else:
        found = fold_sorted(known, message_id, order, [micros(df, ts)], lambda _: Seen(ttl_ms * 1000), None)
    return found.unionByName(df.where(F.col(message_id).isNull()))


class TokenBucket:
    """Admits an event if a token is there, or comes within ``max_wait_us``."""

    def __init__(self, rps: float, burst: int, max_wait_us: int = 0):
        self.rps, self.burst, self.max_wait_us, self.tokens, self.last = rps, burst, max_wait_us, float(burst), None

    def add(self, us: int) -> bool:
        if self.last is not None:
            self.tokens = min(float(self.burst), self.tokens + max(0, us - self.last) / 1e6 * self.rps)
        self.last = us
        ok = self.tokens >= 1 or self.burst >= 1 and (1 - self.tokens) * 1e6 <= self.max_wait_us * self.rps
        self.tokens -= ok
        return ok


def token_bucket(times_us: list[int], rps: float, burst: int, max_wait_us: int = 0) -> list[bool]:
    """Which events of an ordered sequence a token bucket admits."""
    b = TokenBucket(rps, burst, max_wait_us)
    return [b.add(t) for t in times_us]


def rate_limit(df: DataFrame, ts: str, rps: float, burst: int, key: str, order: list[str], max_wait_ms: int = 0) -> DataFrame:
    """The events a token bucket a key admits, by event time: at once, or after a
    wait of at most ``max_wait_ms``."""
    return fold_sorted(df, key, order, [micros(df, ts)], lambda _: TokenBucket(rps, burst, max_wait_ms * 1000), None)
