"""Streams give the same result however their input is cut into batches, and go on after a stop without losing or repeating rows."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from millstream.session import shared_path
from millstream.streaming import ordered
from millstream.streaming import streams as st

SCHEMA = "k long, id long, ts timestamp, door string, mixer string, value double"
T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Each of the many small batches starts a task for each of them."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def readings(n, keys=3, seed=1):
    """(k, id, minutes, door, mixer, value), in the order of time."""
    rng = random.Random(seed)
    doors, mixers = ["open", "close", None, "?"], ["RUN", "STOP", None, "idle"]
    return [(rng.randrange(keys), i, i * 2, rng.choice(doors), rng.choice(mixers), round(rng.gauss(10, 3), 2) if i % 90 > 40 else (i % 90) ** 2 / 8) for i in range(n)]


def timed(rows):
    return [(k, i, T0 + dt.timedelta(minutes=m), *rest) for k, i, m, *rest in rows]


def arrive(spark, folder, number, rows):
    spark.createDataFrame(timed(rows), SCHEMA).coalesce(1).write.parquet(f"{folder}/batch={number:03d}")


def stream(spark, folder, files=1):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files).parquet(f"{folder}/batch=*")


CLOSING = [(-1, -1, 10**7, "open", "RUN", 0.0)]


def cut(rows, how, parts=10, seed=2):
    """The rows as one batch, as `parts`, or as `parts` with rows that are late or early by less than an hour."""
    if how == "one":
        return [rows]
    if how == "unordered":
        rng = random.Random(seed)
        # Two rows whose places differ are 50 minutes apart at most, so none is behind the watermark.
        rows = sorted(rows, key=lambda r: r[2] + rng.uniform(0, 50))
    size = -(-len(rows) // parts)
    return [rows[at : at + size] for at in range(0, len(rows), size)]


def plain_cycles(rows):
    found, state = [], {}
    for k, i, minute, door, mixer, _ in sorted(rows, key=lambda r: (r[2], r[1])):
        s = state.setdefault(k, {"door": None, "mixer": None, "start": None})
        start = None if s["start"] is None else T0 + dt.timedelta(minutes=s["start"])
        if door in ("open", "close"):
            if door == "open" and s["door"] == "close":
                found.append((k, i, "door_opened", start))
                s["start"] = minute
            s["door"] = door
        if mixer in ("RUN", "STOP"):
            if mixer == "RUN" and s["mixer"] in (None, "STOP"):
                found.append((k, i, "run_start", start))
            if mixer == "STOP" and s["mixer"] == "RUN":
                found.append((k, i, "run_stop", start))
            s["mixer"] = mixer
    return sorted(r for r in found if r[0] >= 0)


def plain_chart(rows):
    found, seen = [], {}
    for k, i, _, _, _, x in sorted(rows, key=lambda r: (r[2], r[1])):
        held = seen.setdefault(k, [])
        moves = np.diff([*held, x])
        if len(moves) >= 6:
            steps = np.diff(moves[-6:])
            found += [(k, i, e) for e, hit in (("increasing", (steps > 0).all()), ("decreasing", (steps < 0).all())) if hit]
        if len(held) >= 14:
            center, spread = np.mean(held), 3 / 1.128 * np.mean(np.abs(np.diff(held)))
            found += [(k, i, e) for e, hit in (("above", x > center + spread), ("below", x < center - spread)) if hit]
        held.append(x)
    return sorted(r for r in found if r[0] >= 0)


@pytest.mark.parametrize("how", ["one", "ten", "unordered"])
def test_ordered_steps_do_not_depend_on_batches(spark, monkeypatch, how):
    monkeypatch.setattr(ordered, "BLOCK", 7)
    rows, folder = readings(600), shared_path(spark, "arrivals")
    for n, batch in enumerate([*cut(rows, how), CLOSING]):
        arrive(spark, folder, n, batch)
    if how != "ten":
        cycles = st.run_append(st.stream_cycle_detect(stream(spark, folder), "k", "ts", "door", "mixer", "id"), "cycles", settings=ordered.SETTINGS)
        assert sorted(((r.k, r.id, r.transition, r.cycle_start) for r in cycles.collect()), key=str) == sorted(plain_cycles(rows), key=str)
    chart = st.run_append(st.stream_spc(stream(spark, folder), "k", "ts", "value", "id"), "chart", settings=ordered.SETTINGS)
    found = chart.collect()
    assert sorted((r.k, r.id, r.event) for r in found) == plain_chart(rows) and {r.event for r in found} >= {"increasing", "above"}


def test_rows_behind_the_watermark_are_left_out_and_idle_keys_leave_the_state(spark):
    folder, place = shared_path(spark, "arrivals"), shared_path(spark, "place")
    rows = readings(200)
    arrive(spark, folder, 0, rows[20:])
    arrive(spark, folder, 1, rows[:20])  # hours behind the watermark of the first batch
    arrive(spark, folder, 2, CLOSING)

    def last_state(idle):
        made = st.stream_cycle_detect(stream(spark, folder), "k", "ts", "door", "mixer", "id", idle=idle)
        before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
        spark.conf.set(*next(iter(ordered.SETTINGS.items())))
        out = f"{place}-{idle.replace(' ', '')}"
        query = made.writeStream.format("parquet").trigger(availableNow=True).option("checkpointLocation", f"{out}/_chk").start(f"{out}/data")
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
        query.awaitTermination()
        found = spark.read.schema(made.schema).parquet(f"{out}/data").collect()
        return sorted(((r.k, r.id, r.transition, r.cycle_start) for r in found), key=str), query.lastProgress["stateOperators"][0]["numRowsTotal"]

    kept, many = last_state("100000 days")
    gone, few = last_state("1 day")
    assert kept == gone == sorted(plain_cycles(rows[20:]), key=str)
    assert few < many  # only the closing row's key is left


def test_a_stopped_stream_goes_on(spark):
    """The same steps in one run and in three, the second of which starts with the checkpoint of the first."""
    rows, folder, place = readings(300), shared_path(spark, "arrivals"), shared_path(spark, "place")
    for n, batch in enumerate([*cut(rows, "unordered", 4), CLOSING]):
        arrive(spark, folder, n, batch)
        if n in (1, 3, 4):
            made = st.stream_cycle_detect(stream(spark, folder), "k", "ts", "door", "mixer", "id")
            found = st.run_append(made, "cycles", place, ordered.SETTINGS)
    assert sorted(((r.k, r.id, r.transition, r.cycle_start) for r in found.collect()), key=str) == sorted(plain_cycles(rows), key=str)


FORMS = {
    "append_source": lambda s, place: st.run_append(st.stream_append_source(s, "ts", "door", "k", ["id"]), "x", place),
    "tumbling": lambda s, place: st.run_updates(st.stream_tumbling_stats(s, "k", "ts", ["value"], "1 hour"), ["bucket_ts", "k"], "x", place=place),
    "sliding": lambda s, place: st.run_updates(st.stream_sliding_stats(s, "k", "ts", ["value"]), ["bucket_ts", "k"], "x", place=place),
    "sessions": lambda s, place: st.run_append(st.stream_session_segments(s, "k", "ts", "15 minutes"), "x", place).filter("k >= 0"),
    "dedup": lambda s, place: st.run_append(st.stream_dedup(s, ["k", "id"], "ts", "20 days"), "x", place),
    "latest": lambda s, place: st.run_updates(st.stream_latest_state(s, "k", "ts", ["value"], ["id"]), ["k"], "x", place=place),
}


def test_alerts_are_matched_once_a_place_and_the_latest_count(spark, monkeypatch):
    """Alerts without sensor meet the subscriptions of all sensors; one batch needs no search for the latest."""
    folder, place, pairs = shared_path(spark, "arrivals"), shared_path(spark, "place"), []
    plain = st.al.alert_best_per_recipient

    def best(candidates, *more):
        if "alert_id" in candidates.columns:
            pairs.append(candidates.count())
        return plain(candidates, *more)

    monkeypatch.setattr(st.al, "alert_best_per_recipient", best)
    schema = "alert_id long, sensor_id string, alert_level string, threshold_type int, factory string, building string, floor int, area string"

    def run(n, ids, first):
        spark.createDataFrame([(i, None, "red", 0, "f", "b", 1, "a") for i in ids], schema).coalesce(1).write.parquet(f"{folder}/n={n}")
        subs = spark.range(first, first + 100).selectExpr(
            "id subscription_id", "'u' subscriber", "cast(id % 2 as int) notify_id", "'red' min_level", "0 threshold_type", "concat('s', id) sensor_id",
            "'f' factory", "cast(null as string) building", "cast(null as int) floor", "cast(null as string) area", "true enabled",
        )
        return st.stream_alerts(spark.readStream.schema(schema).parquet(f"{folder}/*"), subs, "x", place)

    one = run(0, range(6), 100)
    assert "Aggregate" not in one._jdf.queryExecution().executedPlan().toString() and one.count() == 12
    two = run(1, range(4, 9), 50)
    assert sorted((r.alert_id, r.notify_id, r.subscription_id) for r in two.collect()) == [(i, k, (100 if i < 4 else 50) + k) for i in range(9) for k in (0, 1)]
    assert pairs == [12, 10]


def numbers(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("form", FORMS)
def test_each_row_counts_once_over_a_stop(spark, form):
    rows, folder, place = readings(200), shared_path(spark, "arrivals"), shared_path(spark, "place")
    for n, batch in enumerate([rows[:110], rows[110:], CLOSING]):
        arrive(spark, folder, n, batch)
        if n == 0:
            FORMS[form](stream(spark, folder), place)
    assert numbers(FORMS[form](stream(spark, folder), place)) == numbers(FORMS[form](stream(spark, folder, 100 if form != "sessions" else 1), None))


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_killed_batch_is_done_anew_and_counts_once(spark, when):
    """A run that dies while its third batch is written, or once it is written but not committed."""
    rows, folder, place = readings(200), shared_path(spark, "arrivals"), shared_path(spark, "place")
    for n, batch in enumerate(cut(rows, "ten", 4)):
        arrive(spark, folder, n, batch)
    written = []

    def write(batch, epoch, out):
        if epoch == 2 and when == "before" and epoch not in written:
            written.append(epoch)
            batch.limit(3).write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")
            raise RuntimeError("killed")
        batch.select("k", "id").write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")
        if epoch == 2 and when == "after" and epoch not in written:
            written.append(epoch)
            raise RuntimeError("killed")
        return {"written": True}

    with pytest.raises(StreamingQueryException):
        st.run_batches(stream(spark, folder), write, place, "append", "written boolean")
    half = st.committed(spark, place, "data")
    assert half.count() == 100  # the two whole batches; the third is not there
    st.run_batches(stream(spark, folder), write, place, "append", "written boolean")
    assert sorted(r.id for r in st.committed(spark, place, "data").collect()) == list(range(200))


def test_a_committed_batch_is_not_written_again(spark):
    place, calls = shared_path(spark, "place"), []
    folder = shared_path(spark, "arrivals")
    arrive(spark, folder, 0, readings(5))

    def write(batch, epoch, out):
        calls.append(epoch)
        batch.write.mode("overwrite").parquet(f"{out}/data/epoch={epoch}")
        return {"written": True}

    st.run_batches(stream(spark, folder), write, place, "append", "written boolean")
    # The commit record is there, but the checkpoint has lost the batch: it comes once more and is passed over.
    other = stream(spark, folder).writeStream.foreachBatch(lambda b, e: None if st.commit_record(spark, place, e) else calls.append("again"))
    other.trigger(availableNow=True).option("checkpointLocation", shared_path(spark, "chk")).start().awaitTermination()
    assert calls == [0]


def test_late_rows_go_to_the_rerun_table(spark):
    folder, place = shared_path(spark, "arrivals"), shared_path(spark, "place")
    rows = [(1, i, i * 10, None, None, float(i)) for i in range(60)]  # ten hours
    late = [(1, 100, 5, None, None, 7.0), (2, 101, 30, None, None, 1.0), (1, 102, 400, None, None, 2.0)]
    for n, batch in enumerate([rows[:20], rows[20:40], rows[40:] + late]):
        arrive(spark, folder, n, batch)
        windows, found = st.stream_late_data(stream(spark, folder), "k", "ts", "value", "1 hour", "1 hour", "late", place)
    # The latest time of the batches before is 390 minutes, so windows that end at 330 or before are closed.
    assert sorted(r.id for r in found.collect()) == [100, 101]
    whole = spark.createDataFrame(timed(rows + late), SCHEMA)
    done = st.rerun_windows(windows, found, whole, "k", "ts", "value", "1 hour")
    expected = whole.groupBy(F.window("ts", "1 hour")["start"].alias("bucket_ts"), "k").agg(
        F.count("*").alias("n"), F.sum("value").alias("total"), F.min("value").alias("least"), F.max("value").alias("most")
    )
    assert numbers(done) == numbers(expected) and numbers(windows) != numbers(expected)
    none = found.filter("false")
    assert numbers(st.rerun_windows(windows, none, whole, "k", "ts", "value", "1 hour")) == numbers(windows)


def test_rows_without_time_are_late(spark):
    folder = shared_path(spark, "arrivals")
    spark.createDataFrame([(1, 1, None, None, None, 1.0), (1, 2, T0, None, None, 2.0)], SCHEMA).coalesce(1).write.parquet(f"{folder}/batch=000")
    windows, late = st.stream_late_data(stream(spark, folder), "k", "ts", "value", "1 hour", "1 hour", "late")
    assert [r.id for r in late.collect()] == [1] and [r.n for r in windows.collect()] == [1]


def test_blocks_keep_their_rows():
    rows = pd.DataFrame({"event_us": [3, 1], "id": ["a", None], "x": [1.5, None]})
    assert ordered._unpacked(ordered._packed(rows)).equals(rows)


def test_cycle_step_makes_no_pandas_columns(spark, monkeypatch):
    """A key has few rows in a batch; what the step costs then is pandas operations, not rows."""
    import pandas as pd

    kept = []
    monkeypatch.setattr(st, "in_time_order", lambda stream, keys, ts, tie, columns, step, *a: (kept.append(step), stream.selectExpr("k", "id", "'' transition", "0L cycle_us"))[1])
    st.stream_cycle_detect(spark.createDataFrame([], "k long, ts timestamp, id long, door string, mixer string"), "k", "ts", "door", "mixer", "id")
    rows = pd.DataFrame({"event_us": [1, 2, 3, 4, 5, 6], "id": range(6), "door": ["close", None, "open", "x", "open", "close"], "mixer": [None, "RUN", None, "STOP", "RUN", "?"]})
    monkeypatch.setattr(pd.Series, "isin", None)
    held, made = kept[0]((7,), None, rows)
    assert held == ("close", "RUN", 3)
    assert [tuple(r) for r in made[["id", "transition"]].to_numpy()] == [(2, "door_opened"), (1, "run_start"), (4, "run_start"), (3, "run_stop")]
    assert made["cycle_us"].isna().tolist() == [True, True, False, False]


def test_keys_share_a_state(spark, monkeypatch):
    """The state has rows for groups of keys, not for keys, and each key its own results; null is a key too."""
    monkeypatch.setattr(ordered, "GROUPS", 4)
    monkeypatch.setattr(ordered, "BLOCK", 50)
    folder, place = shared_path(spark, "arrivals"), shared_path(spark, "place")
    rows = readings(900, keys=30)
    for n, batch in enumerate([*cut(rows, "unordered", 3), CLOSING]):
        arrive(spark, folder, n, [(None if k == 29 else k, *rest) for k, *rest in batch])
    made = st.stream_spc(stream(spark, folder), "k", "ts", "value", "id", idle="100000 days")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set(*next(iter(ordered.SETTINGS.items())))
    query = made.writeStream.format("parquet").trigger(availableNow=True).option("checkpointLocation", f"{place}/_chk").start(f"{place}/data")
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    query.awaitTermination()
    found = spark.read.schema(made.schema).parquet(f"{place}/data").collect()
    assert sorted((29 if r.k is None else r.k, r.id, r.event) for r in found) == plain_chart(rows) and any(r.k is None for r in found)
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 30
