import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rivulet.operators import joins, windows
from rivulet.streaming.windows import keyed_join_stream, tumbling_time_stream

S = 1_000_000


def run(settings, events):
    return [(k, v) for k, v, *_ in windows.fold(events, settings)]


def test_closes_without_the_event_that_crosses():
    out = windows.fold([(0, 10.0, ""), (S, 20.0, ""), (2 * S, 30.0, ""), (6 * S, 40.0, "")], windows.Settings(5000))
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in out] == [("closed", 60.0, 3, 0, 6 * S)]


def test_new_window_starts_at_the_event():
    assert run(windows.Settings(1000), [(0, 100.0, ""), (2 * S, 999.0, ""), (4 * S, 1.0, "")]) == [("closed", 100.0), ("closed", 999.0)]


def test_late_duplicates_and_overflow():
    assert run(windows.Settings(5000), [(10 * S, 1.0, "a"), (0, 2.0, "b")]) == [("late", 2.0)]
    assert run(windows.Settings(5000, allowed_lateness_ms=20_000), [(10 * S, 1.0, "a"), (0, 2.0, "b"), (16 * S, 0.0, "c")]) == [("closed", 3.0)]
    assert run(windows.Settings(5000), [(0, 1.0, "a"), (S, 1.0, "a"), (6 * S, 0.0, "c")]) == [("closed", 1.0)]
    assert run(windows.Settings(5000, max_buffer=1), [(0, 1.0, ""), (S, 2.0, ""), (2 * S, 4.0, "")]) == []
    assert run(windows.Settings(5000, max_buffer=2, overflow="error"), [(0, 1.0, ""), (S, 2.0, ""), (2 * S, 4.0, "")]) == [("error", 4.0)]
    # a full buffer that rejects new events stays shut
    assert run(windows.Settings(1000, max_buffer=1, overflow="drop_newest"), [(0, 1.0, ""), (9 * S, 2.0, "")]) == []


def test_functions_and_settings():
    assert [windows.compute(f, [2.0, 4.0]) for f in windows.FUNCTIONS] == [6.0, 2.0, 3.0, 2.0, 4.0]
    assert windows.compute("avg", []) == 0.0
    with pytest.raises(ValueError):
        windows.Settings(0)


def test_token_bucket():
    assert windows.token_bucket([0, 0, 0, S, S], 1, 2) == [True, True, False, True, False]


def test_join_cycles_last_write_wins():
    rows = [(0, "a", "1"), (S, "a", "2"), (2 * S, "b", "3"), (3 * S, "b", "4")]
    assert joins.join_cycles(rows, ["a", "b"], 10 * S) == [("joined", 0, 2 * S, {"a": "2", "b": "3"}, [])]
    assert joins.join_cycles(rows, ["a", "b"], S) == [("timeout", 0, S, {"a": "1"}, ["b"]), ("timeout", S, 2 * S, {"a": "2"}, ["b"]), ("timeout", 2 * S, 3 * S, {"b": "3"}, ["a"])]


@pytest.fixture
def messages(spark, tmp_path):
    rng, t0 = random.Random(4), datetime(2024, 1, 1)
    rows = [(i, f"k{rng.randrange(3)}", t0 + timedelta(seconds=i * 7), float(rng.randrange(50)), rng.choice("ab")) for i in range(300)]
    df = spark.createDataFrame(rows, "event_id long, key string, ts timestamp_ntz, value double, topic string")
    for i in range(3):
        df.where((F.col("event_id") >= 100 * i) & (F.col("event_id") < 100 * i + 100)).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return df, str(tmp_path / "in"), str(tmp_path / "ckpt")


def drain(spark, out, name, ckpt):
    q = out.writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_streaming_window_equals_batch(spark, messages):
    df, path, ckpt = messages
    s = windows.Settings(60_000, "sum")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(path)
    got = drain(spark, tumbling_time_stream(stream, s, "value", "ts", "key", "event_id"), "w_out", ckpt)
    want = windows.tumbling_time(df, s, "value", "ts", "key", ["ts", "event_id"])
    assert sorted(got.select("key", "kind", "value", "count").collect()) == sorted(want.select("key", "kind", "value", "count").collect())


def test_streaming_join_equals_batch(spark, messages):
    df, path, ckpt = messages
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = drain(spark, keyed_join_stream(stream, ["a", "b"], "topic", "key", "ts", "event_id", 3_600_000), "j_out", ckpt)
    want = joins.keyed_join(df, ["a", "b"], "topic", "key", "ts", "event_id", 3_600_000, ["ts", "event_id"])
    assert got.where("kind = 'joined'").count() == want.where("kind = 'joined'").count() > 0
