"""Streams over event files: equal to the batch query, restarted from a checkpoint, late rows dropped and counted."""

import datetime as dt

from dealscope.streaming import events as S

SCHEMA = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"
START = dt.datetime(2024, 1, 1)


def event(i, minutes, user=1, kind="view"):
    return i, START + dt.timedelta(minutes=minutes), user, kind, float(i % 5)


def put(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def as_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_restart_and_late_file(spark, scratch):
    folder, sink, state = (f"{scratch}/{x}" for x in ("in", "sink", "state"))
    schema = spark.createDataFrame([], SCHEMA).schema
    first = [event(i, 3 * i, i % 3, ("view", "click")[i % 2]) for i in range(100)]             # 0 .. 297 minutes
    second = [event(100 + i, 300 + 3 * i, i % 3) for i in range(40)]                           # .. 417
    late = [event(200, 10), event(201, 40), event(202, 415)]                                   # two are over an hour late
    run = lambda: S.drain(S.tumbling(S.event_stream(spark, folder, schema), "30 minutes", "1 hour"), sink, state)

    def batch(rows, watermark):
        found = S.tumbling(spark.createDataFrame(rows, SCHEMA), "30 minutes", "1 hour")
        return [r for r in as_rows(found) if dt.datetime.fromisoformat(r[2]) <= START + dt.timedelta(minutes=watermark)]

    put(spark, folder, first)
    done = run()
    assert done.rows == 100 and done.late_groups == 0
    assert as_rows(spark.read.parquet(sink)) == batch(first, 297 - 60)
    put(spark, folder, second)
    assert run().rows == 40                                      # only the new file; open windows come from the state
    assert as_rows(spark.read.parquet(sink)) == batch(first + second, 417 - 60)
    put(spark, folder, late)
    done = run()
    assert (done.rows, done.late_groups) == (3, 2)
    assert as_rows(spark.read.parquet(sink)) == batch(first + second, 417 - 60)       # written once, late rows left out
    put(spark, folder, [event(300, 2000)])
    run()
    on_time = first + second + late[2:]
    assert as_rows(spark.read.parquet(sink)) == batch(on_time, 2000 - 60)
    assert run().rows == 0


def test_sessions_equal_batch(spark, scratch):
    folder, sink, state = (f"{scratch}/{x}" for x in ("in", "sink", "state"))
    rows = [event(i, 7 * i + (200 if i > 30 else 0), i % 4) for i in range(60)]
    for part in range(3):
        put(spark, folder, rows[part * 20:part * 20 + 20])
    schema = spark.createDataFrame([], SCHEMA).schema
    done = S.drain(S.session_windows(S.event_stream(spark, folder, schema, max_files=1), "40 minutes", "6 hours"), sink, state)
    assert done.batches >= 3
    whole = as_rows(S.session_windows(spark.createDataFrame(rows, SCHEMA), "40 minutes", "6 hours"))
    last = max(r[1] for r in rows) - dt.timedelta(hours=6)
    assert as_rows(spark.read.parquet(sink)) == [r for r in whole if dt.datetime.fromisoformat(r[2]) <= last] != []
