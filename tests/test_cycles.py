"""Cycle detection and features against a literal walk over the rows."""

import datetime as dt
import random

import numpy as np
import pytest

from millstream.operators import cycles
from millstream.operators.cycles import select_peaks


def walk_peaks(x, prominence, distance):
    """Peaks by definition: plateau midpoints, higher peaks first within the distance, then prominence."""
    peaks = []
    i = 1
    while i < len(x) - 1:
        if x[i - 1] < x[i]:
            j = i
            while j + 1 < len(x) and x[j + 1] == x[i]:
                j += 1
            if j + 1 < len(x) and x[j + 1] < x[i]:
                peaks.append((i + j) // 2)
            i = j
        i += 1
    kept = set(peaks)
    for p in sorted(peaks, key=lambda p: (x[p], p), reverse=True):
        if p in kept:
            kept -= {q for q in peaks if q != p and abs(q - p) < distance}
    out = []
    for p in sorted(kept):
        left = p
        while left > 0 and x[left - 1] <= x[p]:
            left -= 1
        right = p
        while right < len(x) - 1 and x[right + 1] <= x[p]:
            right += 1
        if x[p] - max(min(x[left : p + 1]), min(x[p : right + 1])) >= prominence:
            out.append(p)
    return out


def turning(x):
    runs = []
    for i, v in enumerate(x):
        if runs and runs[-1][2] == v:
            runs[-1][1] = i + 1
        else:
            runs.append([i + 1, i + 1, v])
    rows = []
    for i, (left, right, v) in enumerate(runs):
        before = runs[i - 1][2] if i else None
        after = runs[i + 1][2] if i + 1 < len(runs) else None
        if before is None or after is None or (v > before) == (v > after):
            rows.append((left, right, v, before is not None and after is not None and v > before and v > after))
    return [np.array(c) for c in zip(*rows)]


@pytest.mark.parametrize("seed", range(8))
def test_select_peaks_equals_walk(seed):
    rng = random.Random(seed)
    x = [float(rng.randrange(0, 12) * 30) for _ in range(120)]
    for prominence, distance in ((100, 4), (60, 1), (0, 10)):
        assert list(select_peaks(*turning(x), prominence, distance)) == walk_peaks(x, prominence, distance)


def test_peak_count_fills_with_median(spark, at):
    x = [0, 0, 150, 0, None, 300, None, 20, 150, 150, 20, 0]
    rows = [("m", i, at(i * 30), None if v is None else float(v)) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "k string, id int, ts timestamp_ntz, v double")
    known = sorted(v for v in x if v is not None)
    middle = float(np.median(known))
    filled = [middle if v is None else float(v) for v in x]
    got = cycles.peak_count(df, "k", "ts", "v", 100, 2, ["id"]).collect()
    assert got[0]["peak_count"] == len(walk_peaks(filled, 100, 2))


def test_boundaries_and_features(spark):
    base = dt.datetime(2024, 1, 1, 6)

    def row(sec, door=None, mixer=None, stage=None, motor=0.0, temp=100.0, mode=None):
        return ("m", base + dt.timedelta(seconds=sec), door, mixer, stage, float(motor), float(temp), mode)

    rows = [
        row(0, "close", "STOP", "load"),
        row(10, None, "RUN", "load", 10, 200, None),
        row(20, None, None, "mix", 300, 100, "Auto"),
        row(50, None, None, "discharge", 20, 106, None),
        row(90, None, None, "load", 400, 104, None),
        row(100, "open", None, None, 10, 120, None),
        row(110, "close", "STOP", None, 10, 120, None),
        row(130, None, "RUN", "mix", 10, 90, "Semi"),
        row(150, None, None, "load", 10, 91, None),
        row(170, "open", None, None, 10, 92, None),
        row(180, None, "STOP", None, 10, 93, None),
        row(400, None, None, None, 10, 93, None),
    ]
    schema = "k string, ts timestamp_ntz, door string, mixer string, stage string, motor double, temp double, mode string"
    df = spark.createDataFrame(rows, schema)
    marked = cycles.mark_transitions(df, "k", "ts", "door", "mixer")
    found = cycles.cycle_boundaries(marked, "k", "ts")
    spans = sorted(((r["start"] - base).seconds, (r["end"] - base).seconds) for r in found.collect())
    # The second cycle starts at the run start inside it; the last ends at the first stop after the last opening.
    assert spans == [(10, 100), (130, 170), (170, 180)]
    got = cycles.cycle_features(df, found, "k", "ts", "temp", "motor", "stage", "mode", prominence=100, distance=1,
                                min_mix_sec=15, min_peaks=0).collect()
    by_start = {(r["start"] - base).seconds: r for r in got}
    assert set(by_start) == {10, 130}
    first = by_start[10]
    assert (first["mix_duration_sec"], first["max_temp"], first["run_mode_start"]) == (70.0, 106.0, "Auto")
    assert first["peak_count"] == 1 and first["is_3_stage"] is True
    assert by_start[130]["mix_duration_sec"] == 20.0 and by_start[130]["run_mode_start"] == "Semi"


def test_peaks_of_many_cycles_are_counted_in_one_stream(spark, at):
    rng = random.Random(8)
    long_, rows = {}, []
    for k in [None, *range(60)]:
        long_[k] = [float(rng.randint(0, 9)) for _ in range(200 if k == 7 else rng.randint(1, 20))]
        rows += [(k, at(i), x) for i, x in enumerate(long_[k])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # cycles end inside batches and go on over several
    try:
        got = cycles.peak_count(spark.createDataFrame(rows, "k long, ts timestamp_ntz, v double"), "k", "ts", "v", 3, 4)
        assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString()
        assert {r["k"]: r["peak_count"] for r in got.collect()} == {k: len(walk_peaks(v, 3, 4)) for k, v in long_.items()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_features_make_no_python_group_per_cycle(spark):
    schema = "k long, ts timestamp_ntz, temp double, motor double, stage string, mode string"
    found = spark.createDataFrame([], "k long, start timestamp_ntz, end timestamp_ntz")
    got = cycles.cycle_features(spark.createDataFrame([], schema), found, "k", "ts", "temp", "motor", "stage", "mode")
    assert "FlatMapGroups" not in got._jdf.queryExecution().executedPlan().toString() and got.collect() == []


def machine_rows(n=400, seed=4):
    """(k, id, ts, door, mixer, stage, motor, temp, mode) with null keys and readings, and rows at one time."""
    rng = random.Random(seed)
    t0 = dt.datetime(2024, 1, 1)
    pick = rng.choice
    return [
        (pick([1, 2, 3, None]), i, t0 + dt.timedelta(minutes=7 * (i // 2)), pick(["open", "close", None]), pick(["RUN", "STOP", None]),
         pick(["mix", "load", None]), pick([None, float(rng.randrange(400))]), float(rng.randrange(90, 120)), pick(["Auto", None]))
        for i in range(n)
    ]


def machine_results(spark):
    schema = "k int, id int, ts timestamp_ntz, door string, mixer string, stage string, motor double, temp double, mode string"
    df = spark.createDataFrame(machine_rows(), schema)
    marked = cycles.mark_transitions(df, "k", "ts", "door", "mixer", ["id"])
    found = cycles.cycle_boundaries(marked, "k", "ts")
    made = [marked, found, cycles.in_cycles(df, found, "k", "ts"), cycles.state_duration(df, "k", "ts", "stage", tiebreak=["id"])]
    made.append(cycles.peak_count(df, "k", "ts", "motor", 100.0, 2, ["id"]))
    made.append(cycles.cycle_features(df, found, "k", "ts", "temp", "motor", "stage", "mode", tiebreak=["id"], distance=2, min_peaks=1))
    return [sorted(map(str, m.collect())) for m in made]


def test_whole_keys_equal_chunks(spark, monkeypatch):
    whole = machine_results(spark)
    monkeypatch.setattr(cycles.chunked, "WHOLE_ROWS", 0)
    assert machine_results(spark) == whole and all(whole)


def test_short_keys_take_one_shuffle(spark):
    """Keys with few rows aren't cut into chunks, of which each row would be one."""
    df = spark.createDataFrame(machine_rows(40), "k int, id int, ts timestamp_ntz, door string, mixer string, stage string, motor double, temp double, mode string")
    marked = cycles.mark_transitions(df, "k", "ts", "door", "mixer", ["id"])
    assert marked._jdf.queryExecution().sparkPlan().toString().count("Window") == 1
    assert "Join" not in marked._jdf.queryExecution().sparkPlan().toString()


def test_the_distance_of_the_query_drops_peaks(spark, monkeypatch):
    from millstream.plans import cycles as plan

    folder = "/root/testdata/sf0.001"
    apart = {(r["user_id"], r["start"]): r["peak_count"] for r in plan.peak_count(spark, folder).collect()}
    monkeypatch.setattr(plan, "APART", 1, raising=False)
    every = {(r["user_id"], r["start"]): r["peak_count"] for r in plan.peak_count(spark, folder).collect()}
    assert apart.keys() == every.keys() and all(apart[k] <= every[k] for k in every)
    assert 0 < sum(apart.values()) < sum(every.values()) and max(apart.values()) > 1
