"""Control charts over the driver's tables: one series per event type or user, ordered by time."""

from __future__ import annotations

from pyspark.sql import functions as F

from millstream.functions.spc_constants import spc_coefficients
from millstream.operators import spc
from millstream.plans.registry import Tables, query

N = 5
# Published factors of subgroups of 5 (d2 2.326, d3 0.8641, c4 0.939986) and of moving ranges (d2 1.128, d3 0.8525), as SQL.
A2, R_UPPER, R_LOWER = "(3 / (2.326 * sqrt(5)))", "(1 + 3 * 0.8641 / 2.326)", "greatest(0, 1 - 3 * 0.8641 / 2.326)"
A3, S_UPPER, S_LOWER = "(3 / (0.939986 * sqrt(5)))", "(1 + 3 / 0.939986 * sqrt(1 - 0.939986 ** 2))", "greatest(0, 1 - 3 / 0.939986 * sqrt(1 - 0.939986 ** 2))"
MR_UPPER, MR_LOWER = "(1 + 3 * 0.8525 / 1.128)", "greatest(0, 1 - 3 * 0.8525 / 1.128)"


def rounded(df, digits=6, cols=("value", "ucl", "cl", "lcl")):
    return df.withColumns({c: F.round(c, digits) for c in cols})


SERIES = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events"
GROUPS = f"SELECT *, (rn - 1) // {N} + 1 AS idx FROM ({SERIES})"


def events(spark, sf):
    return Tables(spark, sf).events.select("user_id", "event_id", "event_type", "ts", "value")


@query(
    "spc_p_chart",
    f"""WITH g AS (SELECT user_id, idx, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS d, count(*) AS n FROM ({GROUPS}) GROUP BY 1, 2),
        t AS (SELECT user_id, sum(d) / (count(*) FILTER (n = {N}) * {N}) AS p FROM g GROUP BY 1)
        SELECT user_id, idx, CAST(d AS BIGINT) AS defects, round(d / {N}, 6) AS value, round(p + 3 * sqrt(p * (1 - p) / {N}), 6) AS ucl, round(p, 6) AS cl, round(greatest(p - 3 * sqrt(p * (1 - p) / {N}), 0), 6) AS lcl
        FROM g JOIN t USING (user_id) WHERE n = {N}""",
)
def spc_p_chart(spark, sf):
    return rounded(spc.spc_p_chart(events(spark, sf), "user_id", "ts", F.col("event_type") == "error", N, ["event_id"]))


@query(
    "spc_u_chart",
    f"""WITH g AS (SELECT user_id, idx, sum(event_id % 4) AS d, count(*) AS n FROM ({GROUPS}) GROUP BY 1, 2),
        t AS (SELECT user_id, sum(d) / (count(*) FILTER (n = {N}) * {N}) AS u FROM g GROUP BY 1)
        SELECT user_id, idx, CAST(d AS BIGINT) AS defects, round(d / {N}, 6) AS value, round(u + 3 * sqrt(u / {N}), 6) AS ucl, round(u, 6) AS cl, round(greatest(u - 3 * sqrt(u / {N}), 0), 6) AS lcl
        FROM g JOIN t USING (user_id) WHERE n = {N}""",
)
def spc_u_chart(spark, sf):
    return rounded(spc.spc_u_chart(events(spark, sf), "user_id", "ts", F.col("event_id") % 4, N, ["event_id"]))


def variable_sql(spread: str, chart: str, upper: str, lower: str, width: str) -> str:
    return f"""WITH g AS (SELECT user_id, idx, avg(value) AS m, {spread} AS s, sum(value) AS sm, count(*) AS n FROM ({GROUPS}) GROUP BY 1, 2),
        t AS (SELECT user_id, sum(sm) / sum(n) AS mm, avg(s) FILTER (n = {N}) AS sb FROM g GROUP BY 1), x AS (SELECT * FROM g JOIN t USING (user_id) WHERE g.n = {N})
        SELECT user_id, 'xbar' AS chart, idx, round(m, 8) AS value, round(mm + {width} * sb, 8) AS ucl, round(mm, 8) AS cl, round(mm - {width} * sb, 8) AS lcl FROM x
        UNION ALL SELECT user_id, '{chart}', idx, round(s, 8), round({upper} * sb, 8), round(sb, 8), round({lower} * sb, 8) FROM x"""


@query("spc_xbar_r", variable_sql("max(value) - min(value)", "r", R_UPPER, R_LOWER, A2))
def spc_xbar_r(spark, sf):
    return rounded(spc.spc_xbar_r(events(spark, sf), "user_id", "ts", "value", N, ["event_id"]), 8)


@query("spc_xbar_s", variable_sql("stddev_pop(value)", "s", S_UPPER, S_LOWER, A3))
def spc_xbar_s(spark, sf):
    return rounded(spc.spc_xbar_s(events(spark, sf), "user_id", "ts", "value", N, ["event_id"]), 8)


IMR = f"""x AS (SELECT user_id, rn, value, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY rn)) AS mr FROM ({SERIES})),
   t AS (SELECT user_id, avg(value) AS m, avg(mr) AS b FROM x GROUP BY 1)"""


@query(
    "spc_imr",
    f"""WITH {IMR} SELECT user_id, 'i' AS chart, rn AS idx, round(value, 8) AS value, round(m + 3 * b / 1.128, 8) AS ucl, round(m, 8) AS cl, round(m - 3 * b / 1.128, 8) AS lcl FROM x JOIN t USING (user_id)
        UNION ALL SELECT user_id, 'mr', rn - 1, round(mr, 8), round(b * {MR_UPPER}, 8), round(b, 8), round(b * {MR_LOWER}, 8) FROM x JOIN t USING (user_id) WHERE rn > 1""",
)
def spc_imr(spark, sf):
    return rounded(spc.spc_imr(events(spark, sf), "user_id", "ts", "value", ["event_id"]), 8)


@query(
    "spc_coefficients",
    """WITH t(n, d2, d3, c4) AS (VALUES
         (2, 1.128, 0.8525, 0.797885), (3, 1.693, 0.8884, 0.886227), (4, 2.059, 0.8794, 0.921318), (5, 2.326, 0.8641, 0.939986), (6, 2.534, 0.848, 0.951533),
         (7, 2.704, 0.8332, 0.959369), (8, 2.847, 0.8198, 0.96503), (9, 2.97, 0.8078, 0.969311), (10, 3.078, 0.7971, 0.972659), (11, 3.173, 0.7873, 0.97535),
         (12, 3.258, 0.7785, 0.977559), (13, 3.336, 0.7704, 0.979406), (14, 3.407, 0.763, 0.980971), (15, 3.472, 0.7562, 0.982316), (16, 3.532, 0.7499, 0.983484),
         (17, 3.588, 0.7441, 0.984506), (18, 3.64, 0.7386, 0.98541), (19, 3.689, 0.7335, 0.986214), (20, 3.735, 0.7287, 0.986934), (21, 3.778, 0.7242, 0.987583),
         (22, 3.819, 0.7199, 0.98817), (23, 3.858, 0.7159, 0.988705), (24, 3.895, 0.7121, 0.989193), (25, 3.931, 0.7084, 0.98964)),
       p AS (SELECT p_partkey, p_size % 30 + 2 AS n FROM part),
       c AS (SELECT p_partkey, p.n, CAST(d2 AS DOUBLE) AS d2, CAST(d3 AS DOUBLE) AS d3, COALESCE(CAST(c4 AS DOUBLE), 4.0 * (p.n - 1) / (4.0 * p.n - 3)) AS c4 FROM p LEFT JOIN t ON t.n = p.n)
       SELECT p_partkey, n, round(COALESCE(3 / (d2 * sqrt(n)), 0), 6) AS a2, round(3 / (c4 * sqrt(n)), 6) AS a3, round(greatest(0, 1 - 3 / c4 * sqrt(1 - c4 * c4)), 6) AS b3,
              round(1 + 3 / c4 * sqrt(1 - c4 * c4), 6) AS b4, round(COALESCE(CASE WHEN d2 IS NOT NULL THEN greatest(0, 1 - 3 * d3 / d2) END, 0), 6) AS d3,
              round(COALESCE(1 + 3 * d3 / d2, 0), 6) AS d4 FROM c""",
)
def coefficients(spark, sf):
    rows = [spc_coefficients(n) for n in range(2, 32)]
    table = spark.createDataFrame(
        [(k.n, k.a2, k.a3, k.b3, k.b4, k.d3_limit, k.d4_limit) for k in rows],
        "n int, a2 double, a3 double, b3 double, b4 double, d3 double, d4 double",
    )
    parts = Tables(spark, sf).part.select("p_partkey", (F.col("p_size") % 30 + 2).alias("n"))
    joined = parts.join(F.broadcast(table), "n")  # thirty rows
    return rounded(joined, 6, ("a2", "a3", "b3", "b4", "d3", "d4")).select("p_partkey", "n", "a2", "a3", "b3", "b4", "d3", "d4")


# Chart with narrow limits around the centre, so that every rule is hit somewhere.
POINTS = f"""SELECT user_id, rn AS idx, value, m + w AS ucl, m AS cl, m - w AS lcl FROM ({SERIES}) JOIN (
   SELECT user_id, avg(value) AS m, 3 * avg(mr) / 1.128 AS w FROM (SELECT user_id, value, abs(value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS mr FROM events) GROUP BY user_id) USING (user_id)"""
FLAGS = f"""SELECT *, CASE WHEN value > ucl OR value < lcl THEN true ELSE false END AS rule_1,
   COALESCE(sum(CAST(value > cl AND value < ucl AS INTEGER)) OVER r9 = 9, false) OR COALESCE(sum(CAST(value < cl AND value > lcl AS INTEGER)) OVER r9 = 9, false) AS rule_2,
   COALESCE(sum(CAST(dir = 1 AS INTEGER)) OVER r5 = 5, false) OR COALESCE(sum(CAST(dir = -1 AS INTEGER)) OVER r5 = 5, false) AS rule_3,
   COALESCE(sum(CAST(dir * pdir = -1 AS INTEGER)) OVER r12 = 12, false) AS rule_4
   FROM (SELECT *, lag(dir) OVER (PARTITION BY user_id ORDER BY idx) AS pdir FROM (SELECT *, sign(value - lag(value) OVER (PARTITION BY user_id ORDER BY idx)) AS dir FROM ({POINTS})))
   WINDOW r9 AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN 8 PRECEDING AND CURRENT ROW), r5 AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN 4 PRECEDING AND CURRENT ROW),
          r12 AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""


def points(spark, sf):
    return spc.spc_imr(events(spark, sf), "user_id", "ts", "value", ["event_id"]).filter("chart = 'i'").drop("chart")


def register_rule(rule: int) -> None:
    @query(f"nelson_rule_{rule}", f"SELECT user_id, idx, value FROM ({FLAGS}) WHERE rule_{rule}")
    def rule_query(spark, sf):
        return spc.nelson_rule(points(spark, sf), "user_id", rule).select("user_id", "idx", "value")


for _rule in (1, 2, 3, 4):
    register_rule(_rule)


@query(
    "nelson_first_violation",
    f"SELECT user_id, idx, CASE WHEN rule_1 THEN 1 WHEN rule_2 THEN 2 WHEN rule_3 THEN 3 WHEN rule_4 THEN 4 ELSE 0 END AS violated_rule FROM ({FLAGS})",
)
def nelson_first_violation(spark, sf):
    return spc.nelson_first_violation(points(spark, sf), "user_id").select("user_id", "idx", "violated_rule")


@query(
    "nelson_tail_violation",
    f"""WITH f AS (SELECT *, last_value(rule_3) OVER w AS t3, last_value(rule_4) OVER w AS t4 FROM ({FLAGS}) WINDOW w AS (PARTITION BY user_id ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        SELECT user_id, idx, CASE WHEN rule_1 THEN 1 WHEN rule_2 THEN 2 WHEN t3 THEN 3 WHEN t4 THEN 4 ELSE 0 END AS violated_rule FROM f""",
)
def nelson_tail_violation(spark, sf):
    tail = spc.nelson_first_violation(points(spark, sf), "user_id", tail_only=True)
    return tail.select("user_id", "idx", "violated_rule")


IMR_SERIES = f"""WITH s AS (SELECT user_id, event_id, ts, value AS tmax, value - (event_id % 20) AS tmin, value - (value - (event_id % 20)) AS diff FROM events),
   x AS (SELECT *, tmax - lag(tmax) OVER w AS sm, diff - lag(diff) OVER w AS sd, row_number() OVER w AS rn FROM s WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
   t AS (SELECT user_id, avg(tmax) AS xm, avg(abs(sm)) AS bm, avg(diff) AS xd, avg(abs(sd)) AS bd FROM x GROUP BY 1)"""
IMR_COLS = """round(abs(sm), 8) AS mr_max, round(sm, 8) AS mr_sign_max, round(abs(sd), 8) AS mr_diff, round(sd, 8) AS mr_sign_diff, round(xm, 8) AS xbar_max, round(bm, 8) AS mr_bar_max, round(xd, 8) AS xbar_diff, round(bd, 8) AS mr_bar_diff"""


def imr(spark, sf):
    rows = events(spark, sf).select("user_id", "event_id", "ts", F.col("value").alias("tmax"), (F.col("value") - F.col("event_id") % 20).alias("tmin"))
    return spc.imr_series(rows, "user_id", "ts", "tmax", "tmin", ["event_id"])


@query(
    "imr_series",
    f"""{IMR_SERIES} SELECT user_id, event_id, {IMR_COLS}, round(xm + 3 * bm / 1.128, 8) AS ucl_i_max, round(xm - 3 * bm / 1.128, 8) AS lcl_i_max, round(bm * {MR_UPPER}, 8) AS ucl_mr_max,
        round(xd + 3 * bd / 1.128, 8) AS ucl_i_diff, round(xd - 3 * bd / 1.128, 8) AS lcl_i_diff, round(bd * {MR_UPPER}, 8) AS ucl_mr_diff FROM x JOIN t USING (user_id)""",
)
def imr_series(spark, sf):
    cols = ["mr_max", "mr_sign_max", "mr_diff", "mr_sign_diff", "xbar_max", "mr_bar_max", "xbar_diff", "mr_bar_diff",
            "ucl_i_max", "lcl_i_max", "ucl_mr_max", "ucl_i_diff", "lcl_i_diff", "ucl_mr_diff"]
    return rounded(imr(spark, sf), 8, cols).select("user_id", "event_id", *cols)


@query(
    "limit_events",
    f"""{IMR_SERIES}, l AS (SELECT * FROM x JOIN t USING (user_id) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1),
        e AS (SELECT user_id, ts, xd + 3 * bd / 1.128 AS ud, xd - 3 * bd / 1.128 AS ld, xm + 3 * bm / 1.128 AS um, xm - 3 * bm / 1.128 AS lm, bd * {MR_UPPER} AS rd, bm * {MR_UPPER} AS rm, tmax, diff, sm, sd FROM l)
        SELECT user_id, ts, 'i' AS "check", CASE WHEN diff > ud THEN 'AboveIUcl' WHEN diff < ld THEN 'BelowILcl' WHEN tmax > um THEN 'AboveIUcl' WHEN tmax < lm THEN 'BelowILcl' ELSE 'NoIssue' END AS event_type,
          CASE WHEN diff > ud OR diff < ld OR tmax > um OR tmax < lm THEN 'Warning' ELSE 'Info' END AS event_level,
          round(CASE WHEN diff > ud THEN ud WHEN diff < ld THEN ld WHEN tmax > um THEN um WHEN tmax < lm THEN lm END, 6) AS set_value, round(CASE WHEN diff > ud OR diff < ld THEN diff WHEN tmax > um OR tmax < lm THEN tmax END, 6) AS mea_value FROM e
        UNION ALL SELECT user_id, ts, 'mr', CASE WHEN sd > rd OR sm > rm THEN 'AboveMrUcl' ELSE 'NoIssue' END, CASE WHEN sd > rd OR sm > rm THEN 'Warning' ELSE 'Info' END,
          round(CASE WHEN sd > rd THEN rd WHEN sm > rm THEN rm END, 6), round(CASE WHEN sd > rd THEN sd WHEN sm > rm THEN sm END, 6) FROM e""",
)
def limit_events(spark, sf):
    found = spc.limit_events(imr(spark, sf), "user_id", "ts", "tmax")
    return rounded(found, 6, ("set_value", "mea_value"))


@query(
    "latest_event_batch",
    """SELECT l_suppkey, l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE true QUALIFY rank() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC) = 1 AND l_returnflag IN ('R', 'A')""",
)
def latest_event_batch(spark, sf):
    log = Tables(spark, sf).lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_returnflag", "l_shipdate")
    return spc.latest_event_batch(log, "l_suppkey", "l_shipdate", "l_returnflag", ["R", "A"]).drop("l_shipdate")
