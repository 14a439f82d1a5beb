"""Streaming twins of the keyed folds, by stateful processors.

State is one row a key: the same step as the batch fold, pickled by value.
Within a micro-batch a key's rows are put in order first.
"""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.core import micros
from ..operators.windows import AnchoredWindow, Seen, Settings

OUT = "key string, kind string, value double, count long, window_start_us long, closed_at_us long, late_count long, dropped_count long"


def tumbling_time_stream(events: DataFrame, settings: Settings, value: str, ts: str, key: str, order: str, message_id: str | None = None, idle_timeout_ms: int = 0) -> DataFrame:
    """Closed windows, late events and overflow errors of a stream.  ``order`` is the
    arrival order, which each micro-batch's events of a key are put in.  With an
    idle timeout a key's open window closes after that processing time."""
    rows = events.select(F.col(key).cast("string").alias("key"), micros(events, ts).alias("us"), F.col(value).cast("double").alias("v"), (F.col(message_id).cast("string") if message_id else F.lit("")).alias("m"), F.col(order).alias("o"))
    names = [c.split()[0] for c in OUT.split(", ")]

    def step(k, batches, state: GroupState):
        w = AnchoredWindow(settings)
        if state.exists:
            w = AnchoredWindow(settings, **json.loads(state.get[0]))
        out = []
        if state.hasTimedOut:
            if w.size:
                r = w.close(w.watermark)
                out.append((k[0], "closed", r["value"], r["count"], r["window_start"], r["closed_at"], r["late_count"], r["dropped_count"]))
        else:
            pdf = pd.concat(list(batches)).sort_values("o", kind="stable")
            for us, v, m in zip(pdf.us.tolist(), pdf.v.tolist(), pdf.m.tolist()):
                if hit := w.add(us, v, m):
                    kind, r = hit
                    out.append((k[0], kind, r["value"], r.get("count"), r.get("window_start"), r.get("closed_at", r.get("ts")), r.get("late_count"), r.get("dropped_count")))
        state.update((json.dumps(w.saved()),))
        if idle_timeout_ms and w.size:
            state.setTimeoutDuration(idle_timeout_ms)
        done = pd.DataFrame(out, columns=names)
        yield done.astype({c: "Int64" for c in names if c.endswith(("_us", "count"))})

    timeout = GroupStateTimeout.ProcessingTimeTimeout if idle_timeout_ms else GroupStateTimeout.NoTimeout
    return rows.groupBy("key").applyInPandasWithState(step, OUT, "saved string", "append", timeout)


JOIN_OUT = "join_key string, kind string, created_us long, fired_us long, messages string, missing_topics array<string>"


def keyed_join_stream(events: DataFrame, topics: list[str], topic: str, key: str, ts: str, payload: str, window_ms: int, order: str | None = None) -> DataFrame:
    """The N-way last-write-wins join of a stream by event time; a key's cycle
    that has timed out is emitted when the key is next seen, or after
    ``window_ms`` of processing time without one.  ``order`` is the arrival order
    within a micro-batch; without it events go by time."""
    rows = events.where(F.col(topic).isin(topics)).select(F.col(key).cast("string").alias("join_key"), micros(events, ts).alias("us"), F.col(topic).alias("t"), F.col(payload).cast("string").alias("p"), (F.col(order) if order else F.lit(0)).alias("o"))

    def step(k, batches, state: GroupState):
        slots, created, out = {}, None, []
        if state.exists:
            slots, created = json.loads(state.get[0])

        def expire():
            nonlocal slots, created
            out.append((k[0], "timeout", created, created + window_ms * 1000, json.dumps(slots, sort_keys=True), [t for t in topics if t not in slots]))
            slots, created = {}, None

        if state.hasTimedOut:
            if slots:
                expire()
        else:
            pdf = pd.concat(list(batches)).sort_values("o" if order else ["us", "t"], kind="stable")
            for us, t, p in zip(pdf.us.tolist(), pdf.t.tolist(), pdf.p.tolist()):
                if slots and us - created >= window_ms * 1000:
                    expire()
                created = us if not slots else created
                slots[t] = p
                if len(slots) == len(topics):
                    out.append((k[0], "joined", created, us, json.dumps(slots, sort_keys=True), []))
                    slots, created = {}, None
        if slots:
            state.update((json.dumps([slots, created]),))
            state.setTimeoutDuration(window_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[c.split()[0] for c in JOIN_OUT.split(", ")])

    return rows.groupBy("join_key").applyInPandasWithState(step, JOIN_OUT, "saved string", "append", GroupStateTimeout.ProcessingTimeTimeout)


def dedup_stream(events: DataFrame, message_id: str, ts: str, ttl_ms: int, order: str) -> DataFrame:
    """First sightings of a stream by the rule of ``windows.dedup_ttl``; an id's
    state goes once no event has brought it for ``ttl_ms`` of processing time."""
    names = events.columns
    rows = events.where(F.col(message_id).isNotNull()).select("*", micros(events, ts).alias("__us"))

    def step(_, batches, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        seen = Seen(ttl_ms * 1000)
        seen.until = state.get[0] if state.exists else None
        pdf = pd.concat(list(batches)).sort_values(["__us", order], kind="stable")
        fresh = [seen.add(us) for us in pdf["__us"].tolist()]
        state.update((seen.until,))
        state.setTimeoutDuration(ttl_ms)
        yield pdf[fresh][names]

    return rows.groupBy(message_id).applyInPandasWithState(step, events.schema, "until long", "append", GroupStateTimeout.ProcessingTimeTimeout)


def fire(batch: DataFrame, handlers: dict, kind: str = "kind") -> None:
    """A micro-batch to its handlers: each gets the rows of its kind, ``all``
    gets every row.  The batch is read once."""
    batch.persist()
    try:
        for name, handle in handlers.items():
            handle(batch if name == "all" else batch.where(F.col(kind) == name))
    finally:
        batch.unpersist()


def write_events(stream: DataFrame, handlers: dict, checkpoint: str, kind: str = "kind"):
    """Runs ``fire`` on each micro-batch; its offsets count as done only once all
    handlers have returned."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: fire(batch, handlers, kind)).start()
