"""Machine cycles over the event stream: view/click stand for door close/open, signup/error for mixer RUN/STOP."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.operators import cycles, sequences, temporal
from millstream.operators.cycles import peak_count as count_peaks
from millstream.plans.registry import Tables, query
from millstream.session import settle

DOOR = {"click": "open", "view": "close"}
MIXER = {"signup": "RUN", "error": "STOP"}
STAGE = {"purchase": "mix", "view": "load", "click": "discharge"}


def states(spark, sf):
    """One machine per user; each event reports one of the state signals."""
    from millstream.functions.cleaning import labelled

    kind = F.col("event_type")
    return Tables(spark, sf).events.select(
        "event_id", "user_id", "ts", labelled(kind, DOOR).alias("door"), labelled(kind, MIXER).alias("mixer"),
        labelled(kind, STAGE).alias("stage"), F.when(F.col("event_id") % 5 == 0, F.lit("Auto")).when(F.col("event_id") % 7 == 0, "Semi").alias("run_mode"),
        (F.col("value") * 10).alias("motor"), (F.col("value") + 60).alias("temp"),
    )


STATES = """s AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'click' THEN 'open' WHEN 'view' THEN 'close' END AS door, CASE event_type WHEN 'signup' THEN 'RUN' WHEN 'error' THEN 'STOP' END AS mixer,
  CASE event_type WHEN 'purchase' THEN 'mix' WHEN 'view' THEN 'load' END AS stage, CASE WHEN event_id % 5 = 0 THEN 'Auto' WHEN event_id % 7 = 0 THEN 'Semi' END AS run_mode, value * 10 AS motor, value + 60 AS temp FROM events)"""
MARKS = f"""{STATES}, h AS (SELECT *, last_value(door IGNORE NULLS) OVER w AS pd, last_value(mixer IGNORE NULLS) OVER w AS pm FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  m AS (SELECT *, COALESCE(door = 'open' AND pd = 'close', false) AS door_opened, COALESCE(mixer = 'RUN' AND (pm = 'STOP' OR pm IS NULL), false) AS run_start, COALESCE(mixer = 'STOP' AND pm = 'RUN', false) AS run_stop FROM h)"""
BOUNDS = f"""{MARKS}, e AS (SELECT user_id, COALESCE(min(ts) FILTER (run_start), min(ts)) AS st, max(ts) FILTER (door_opened) AS lm, max(ts) AS mx FROM m GROUP BY 1),
  x AS (SELECT e.user_id, st, COALESCE(min(ts) FILTER (run_stop AND (lm IS NULL OR ts > lm)), mx) AS en FROM e JOIN m ON e.user_id = m.user_id GROUP BY e.user_id, st, mx),
  b AS (SELECT user_id, st AS mark FROM x UNION SELECT user_id, en FROM x UNION SELECT user_id, ts FROM m WHERE door_opened),
  p AS (SELECT user_id, mark AS st, lead(mark) OVER (PARTITION BY user_id ORDER BY mark) AS en FROM b),
  c AS (SELECT p.user_id, COALESCE(max(m.ts), p.st) AS st, p.en FROM p LEFT JOIN m ON m.user_id = p.user_id AND m.run_start AND m.ts >= p.st AND m.ts < p.en WHERE p.en IS NOT NULL GROUP BY p.user_id, p.st, p.en)"""


def marked(spark, sf):
    return cycles.mark_transitions(states(spark, sf), "user_id", "ts", "door", "mixer", ["event_id"])


@query("edge_detect", f"WITH {MARKS} SELECT event_id, door_opened, run_start, run_stop FROM m")
def edge_detect(spark, sf):
    return marked(spark, sf).select("event_id", "door_opened", "run_start", "run_stop")


@query("cycle_boundaries", f'WITH {BOUNDS} SELECT user_id, st AS "start", en AS "end" FROM c')
def cycle_boundaries(spark, sf):
    return cycles.cycle_boundaries(marked(spark, sf), "user_id", "ts")


@query(
    "state_duration",
    f"""WITH {STATES}, f AS (SELECT *, last_value(stage IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS st, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nx FROM s)
        SELECT user_id, round(COALESCE(sum(CASE WHEN st = 'mix' THEN date_diff('microsecond', ts, nx) / 1000000.0 END), 0), 4) AS mix_duration_sec FROM f GROUP BY user_id""",
)
def state_duration(spark, sf):
    spent = cycles.state_duration(states(spark, sf), "user_id", "ts", "stage", tiebreak=["event_id"])
    return spent.withColumn("mix_duration_sec", F.round("mix_duration_sec", 4))


# Peaks of a cycle: runs of equal values are one point; a peak's prominence is its height over the higher of the lowest
# points on its two sides, each up to the nearest higher point. Two peaks are always two rows apart, so that the least
# distance of `cycle_features` leaves all of them.
PEAKS = f"""{BOUNDS}, pr AS (SELECT c.user_id, c.st, s.ts, s.event_id, s.motor FROM c JOIN s ON s.user_id = c.user_id AND s.ts >= c.st AND s.ts < c.en),
   pf AS (SELECT user_id, st, ts, event_id, COALESCE(motor, quantile_cont(motor, 0.5) OVER (PARTITION BY user_id, st)) AS v FROM pr),
   pl AS (SELECT *, lag(v) OVER (PARTITION BY user_id, st ORDER BY ts, event_id) AS pv FROM pf WHERE v IS NOT NULL),
   pk AS (SELECT user_id, st, v, row_number() OVER z AS k, lag(v) OVER z AS a, lead(v) OVER z AS b FROM pl WHERE pv IS NULL OR v <> pv WINDOW z AS (PARTITION BY user_id, st ORDER BY ts, event_id)),
   tops AS (SELECT t.user_id, t.st, t.k, t.v, COALESCE(max(h.k) FILTER (h.k < t.k AND h.v > t.v), 0) AS lo, COALESCE(min(h.k) FILTER (h.k > t.k AND h.v > t.v), 1000000000) AS hi
            FROM pk t JOIN pk h ON h.user_id = t.user_id AND h.st = t.st WHERE t.v > t.a AND t.v > t.b GROUP BY 1, 2, 3, 4),
   high AS (SELECT t.user_id, t.st, t.k FROM tops t JOIN pk h ON h.user_id = t.user_id AND h.st = t.st AND h.k > t.lo AND h.k < t.hi GROUP BY t.user_id, t.st, t.k, t.v
            HAVING t.v - greatest(min(h.v) FILTER (h.k <= t.k), min(h.v) FILTER (h.k >= t.k)) >= 100),
   peaks AS (SELECT x.user_id, x.st, count(k) AS peak_count FROM (SELECT DISTINCT user_id, st FROM pl) x LEFT JOIN high ON high.user_id = x.user_id AND high.st = x.st GROUP BY 1, 2)"""


#: Least rows between two peaks of `peak_count`: cycles have 5 rows on average and 25 at most at sf0.1.
APART = 4
# As PEAKS, with the places of the peaks: the middle of a run of equal values. Higher peaks, of equal ones the later, come
# first and drop those nearer than APART; what is left must stand out.
APART_PEAKS = f"""{PEAKS}, num AS (SELECT user_id, st, v, pv, row_number() OVER (PARTITION BY user_id, st ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id, st) AS n FROM pl),
   runs AS (SELECT user_id, st, row_number() OVER z AS k, i AS l, COALESCE(lead(i) OVER z, n) - 1 AS r FROM num WHERE pv IS NULL OR v <> pv WINDOW z AS (PARTITION BY user_id, st ORDER BY i)),
   placed AS (SELECT t.user_id, t.st, t.k, t.v, (l + r) // 2 AS pos FROM tops t JOIN runs ON runs.user_id = t.user_id AND runs.st = t.st AND runs.k = t.k),
   first AS (SELECT user_id, st, unnest(list_reduce(list(pos ORDER BY v DESC, pos DESC), lambda kept, p: CASE WHEN len(list_filter(kept, lambda q: abs(q - p) < {APART})) > 0 THEN kept ELSE list_append(kept, p) END, CAST([] AS BIGINT[]))) AS pos FROM placed GROUP BY 1, 2),
   apart AS (SELECT p.user_id, p.st, p.k FROM placed p JOIN first f ON f.user_id = p.user_id AND f.st = p.st AND f.pos = p.pos JOIN high h ON h.user_id = p.user_id AND h.st = p.st AND h.k = p.k)"""


@query(
    "peak_count",
    f"""WITH {APART_PEAKS} SELECT x.user_id, x.st AS "start", count(k) AS peak_count FROM (SELECT DISTINCT user_id, st FROM pl) x LEFT JOIN apart ON apart.user_id = x.user_id AND apart.st = x.st GROUP BY 1, 2""",
)
def peak_count(spark, sf):
    """Peaks of every machine cycle."""
    found = cycles.cycle_boundaries(marked(spark, sf), "user_id", "ts")
    rows = states(spark, sf).select("user_id", "event_id", "ts", "motor")
    rows = settle(cycles.in_cycles(rows, settle(found), "user_id", "ts"))
    return count_peaks(rows, ["user_id", "start"], "ts", "motor", 100.0, APART, ["event_id"])


def features(spark, sf):
    table = states(spark, sf)
    found = cycles.cycle_boundaries(marked(spark, sf), "user_id", "ts")
    return cycles.cycle_features(
        table, found, "user_id", "ts", "temp", "motor", "stage", "run_mode", tiebreak=["event_id"], distance=2, min_peaks=1
    )


@query(
    "cycle_features",
    f"""WITH {PEAKS}, r AS (SELECT c.st, c.en, s.* FROM c JOIN s ON s.user_id = c.user_id AND s.ts >= c.st AND s.ts < c.en),
        f AS (SELECT *, last_value(stage IGNORE NULLS) OVER (PARTITION BY user_id, st ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sg, lead(ts) OVER (PARTITION BY user_id, st ORDER BY ts, event_id) AS nx, min(ts) OVER (PARTITION BY user_id, st) AS t0 FROM r),
        g AS (SELECT user_id, st, en, arg_min(run_mode, (ts, event_id)) FILTER (run_mode IS NOT NULL) AS run_mode_start, sum(CASE WHEN sg = 'mix' THEN date_diff('microsecond', ts, nx) / 1000000.0 END) AS mix, max(temp) FILTER (ts >= t0 + INTERVAL 30 SECOND) AS max_temp FROM f GROUP BY 1, 2, 3)
        SELECT g.user_id, g.st AS "start", en AS "end", run_mode_start, round(mix, 1) AS mix_duration_sec, max_temp, COALESCE(peak_count, 0) AS peak_count, COALESCE(peak_count > 1 AND max_temp > 105, false) AS is_3_stage
        FROM g LEFT JOIN peaks p ON p.user_id = g.user_id AND p.st = g.st WHERE COALESCE(mix, 0) > 60""",
)
def cycle_features(spark, sf):
    return features(spark, sf)


@query(
    "cycle_summary",
    f"""WITH {BOUNDS}, r AS (SELECT c.st, c.en, s.* FROM c JOIN s ON s.user_id = c.user_id AND s.ts >= c.st AND s.ts < c.en),
        f AS (SELECT *, last_value(stage IGNORE NULLS) OVER (PARTITION BY user_id, st ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sg, lead(ts) OVER (PARTITION BY user_id, st ORDER BY ts, event_id) AS nx, min(ts) OVER (PARTITION BY user_id, st) AS t0 FROM r)
        SELECT user_id, st AS "start", en AS "end", arg_min(run_mode, (ts, event_id)) FILTER (run_mode IS NOT NULL) AS run_mode_start, round(sum(CASE WHEN sg = 'mix' THEN date_diff('microsecond', ts, nx) / 1000000.0 END), 1) AS mix_duration_sec,
          round(max(temp) FILTER (ts >= t0 + INTERVAL 30 SECOND), 6) AS max_temp FROM f GROUP BY user_id, st, en HAVING COALESCE(sum(CASE WHEN sg = 'mix' THEN date_diff('microsecond', ts, nx) / 1000000.0 END), 0) > 60""",
)
def cycle_summary(spark, sf):
    return features(spark, sf).select(
        "user_id", "start", "end", "run_mode_start", "mix_duration_sec", F.round("max_temp", 6).alias("max_temp")
    )


@query(
    "model_score_cycles",
    f"""WITH {BOUNDS}, r AS (SELECT c.st, c.en, s.* FROM c JOIN s ON s.user_id = c.user_id AND s.ts >= c.st AND s.ts < c.en),
        n AS (SELECT *, row_number() OVER (PARTITION BY user_id, st ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id, st) AS n FROM r),
        g AS (SELECT DISTINCT user_id, st, n, unnest(range(20)) AS point FROM n),
        v AS (SELECT g.user_id, g.st, a.motor + (COALESCE(b.motor, a.motor) - a.motor) * (point * (g.n - 1) / 19.0 - a.i) AS y FROM g JOIN n a ON a.user_id = g.user_id AND a.st = g.st AND a.i = CAST(floor(point * (g.n - 1) / 19) AS BIGINT)
              LEFT JOIN n b ON b.user_id = g.user_id AND b.st = g.st AND b.i = a.i + 1),
        pb AS (SELECT user_id, st, avg(y) / 2000 AS pr FROM v GROUP BY 1, 2), q AS (SELECT user_id, st, count(*) >= 3 AS three FROM r GROUP BY 1, 2)
        SELECT user_id, st AS "start", round(pr, 9) AS anomaly_prob, pr < 0.1 AS is_anomaly, pr < 0.1 AND three AS result FROM pb JOIN q USING (user_id, st)""",
)
def model_score_cycles(spark, sf):
    found = cycles.cycle_boundaries(marked(spark, sf), "user_id", "ts")
    rows = states(spark, sf).select("user_id", "event_id", "ts", "motor")
    rows = settle(cycles.in_cycles(rows, settle(found), "user_id", "ts"))
    points = temporal.resample_linear(rows, ["user_id", "start"], "ts", ["motor"], 20, ["event_id"])
    vectors = temporal.point_vectors(points, ["user_id", "start"], ["motor"])
    long = rows.groupBy("user_id", "start").agg((F.count(F.lit(1)) >= 3).alias("is_3_stage"))

    def load():
        return lambda matrix: matrix.mean(axis=1) / 2000

    scored = sequences.model_score_cycles(vectors.join(long, ["user_id", "start"]), "vector", sequences.batch_scorer(load))
    return scored.select("user_id", "start", F.round("anomaly_prob", 9).alias("anomaly_prob"), "is_anomaly", "result")


@query(
    "cycle_shift_report",
    f"""WITH {BOUNDS} SELECT user_id, st AS "start", 'mixer03_' || strftime(st, '%Y%m%d') || '_' || row_number() OVER (PARTITION BY strftime(st, '%Y%m%d') ORDER BY st, user_id) AS no FROM c""",
)
def cycle_shift_report(spark, sf):
    found = cycles.cycle_boundaries(marked(spark, sf), "user_id", "ts")
    return temporal.sequence_no(found, "start", ["start", "user_id"], "mixer03").select("user_id", "start", "no")


@query(
    "udf_python_check",
    "SELECT count(*) FILTER (value > 200 OR event_type = 'error') AS failed_rows FROM events",
)
def udf_python_check(spark, sf):
    def check(df):
        return df.filter((F.col("value") > 200) | (F.col("event_type") == "error"))

    return sequences.udf_python_check(Tables(spark, sf).events, check)
