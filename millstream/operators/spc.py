"""Statistical process control: chart points with limits, run rules, individual / moving-range series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.functions.spc_constants import SIGMAS, spc_coefficients
from millstream.operators import chunked
from millstream.operators.chunked import BLOCK_ROWS, CHUNK, names

HALO = 13  # rows before a point that the longest run rule (14 points) looks at


def _subgroups(df: DataFrame, keys, ts: str, n: int, tiebreak: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
    """Consecutive subgroups of `n` rows per key, with their row count; chunked by subgroup number."""
    df = chunked.with_time_chunk(df, ts)
    df = chunked.numbered(df, keys, [ts, *tiebreak], "__rn").drop(CHUNK)
    df = df.withColumn("idx", F.floor((F.col("__rn") - 1) / n).cast("long") + 1)
    points = df.groupBy(*names(keys), "idx").agg(F.count(F.lit(1)).alias("__size"), *aggs)
    return points.withColumn(CHUNK, F.floor(F.col("idx") / BLOCK_ROWS).cast("long"))


def _attribute_chart(df, keys, ts, defects: Column, n, tiebreak, variance, limits) -> DataFrame:
    keys = names(keys)
    points = _subgroups(df, keys, ts, n, tiebreak, [F.sum(defects).alias("defects")])
    # Defects of the incomplete last subgroup count in the total, its inspections do not.
    points = chunked.with_totals(
        points,
        keys,
        {"__defects": F.sum("defects"), "__groups": F.count_if(F.col("__size") == n)},
        {"__defects": "sum", "__groups": "sum"},
    ).filter(F.col("__size") == n)
    center = F.col("__defects") / (F.col("__groups") * n)
    sigma = F.sqrt(variance(center) / n)
    if limits:
        ucl, lcl = F.lit(float(limits[0])), F.lit(float(limits[1]))
    else:
        ucl, lcl = center + SIGMAS * sigma, F.greatest(center - SIGMAS * sigma, F.lit(0.0))
    return points.select(
        *keys, "idx", "defects", (F.col("defects") / n).alias("value"), ucl.alias("ucl"), center.alias("cl"),
        lcl.alias("lcl"),
    )


def spc_p_chart(df: DataFrame, keys, ts: str, defective: Column, n: int, tiebreak=(), limits=None) -> DataFrame:
    """Fraction defective per subgroup of `n` inspections."""
    return _attribute_chart(df, keys, ts, defective.cast("int"), n, tiebreak, lambda p: p * (1 - p), limits)


def spc_u_chart(df: DataFrame, keys, ts: str, defects: Column, n: int, tiebreak=(), limits=None) -> DataFrame:
    """Defects per unit and subgroup of `n` units."""
    return _attribute_chart(df, keys, ts, defects, n, tiebreak, lambda u: u, limits)


def _variable_chart(df, keys, ts, c, n, tiebreak, spread: Column, charts) -> DataFrame:
    """`charts(mean of all values, mean spread)` gives {chart: (value column, ucl, cl, lcl)}; stacked to rows."""
    keys = names(keys)
    points = _subgroups(
        df, keys, ts, n, tiebreak,
        [F.avg(c).alias("__mean"), spread.alias("__spread"), F.sum(c).alias("__sum"), F.count(c).alias("__n")],
    )
    full = F.col("__size") == n
    points = chunked.with_totals(
        points,
        keys,
        {
            "__all_sum": F.sum("__sum"),
            "__all_n": F.sum("__n"),
            "__spreads": F.sum(F.when(full, F.col("__spread"))),
            "__groups": F.count_if(full),
        },
        {"__all_sum": "sum", "__all_n": "sum", "__spreads": "sum", "__groups": "sum"},
    ).filter(full)
    rows = charts(F.col("__all_sum") / F.col("__all_n"), F.col("__spreads") / F.col("__groups"))
    stacked = F.array(
        *[
            F.struct(F.lit(name).alias("chart"), v.alias("value"), u.alias("ucl"), m.alias("cl"), l.alias("lcl"))
            for name, (v, u, m, l) in rows.items()
        ]
    )
    return points.select(*keys, "idx", F.explode(stacked).alias("__p")).select(*keys, "idx", "__p.*").select(
        *keys, "chart", "idx", "value", "ucl", "cl", "lcl"
    )


def spc_xbar_r(df: DataFrame, keys, ts: str, c: str, n: int, tiebreak=()) -> DataFrame:
    """Mean and range charts."""
    k = spc_coefficients(n)
    return _variable_chart(
        df, keys, ts, c, n, tiebreak, F.max(c) - F.min(c),
        lambda mean, r: {
            "xbar": (F.col("__mean"), mean + k.a2 * r, mean, mean - k.a2 * r),
            "r": (F.col("__spread"), k.d4_limit * r, r, k.d3_limit * r),
        },
    )


def spc_xbar_s(df: DataFrame, keys, ts: str, c: str, n: int, tiebreak=()) -> DataFrame:
    """Mean and standard-deviation charts; the deviation divides by n."""
    k = spc_coefficients(n)
    return _variable_chart(
        df, keys, ts, c, n, tiebreak, F.stddev_pop(c),
        lambda mean, s: {
            "xbar": (F.col("__mean"), mean + k.a3 * s, mean, mean - k.a3 * s),
            "s": (F.col("__spread"), k.b4 * s, s, k.b3 * s),
        },
    )


def spc_imr(df: DataFrame, keys, ts: str, c: str, tiebreak=()) -> DataFrame:
    """Individual values and moving ranges of two; the range chart starts with the second row."""
    keys, k = names(keys), spc_coefficients(2)
    order = [ts, *tiebreak]
    df = _with_ranges(df.select(*keys, *order, c), keys, ts, order, {"v": c}, "idx")
    df = df.withColumn("__mr", F.abs("mr_sign_v"))
    mean, mr = F.col("xbar_v"), F.col("mr_bar_v")
    rows = {
        "i": (F.col(c).cast("double"), mean + SIGMAS * mr / k.d2, mean, mean - SIGMAS * mr / k.d2),
        "mr": (F.col("__mr").cast("double"), mr * k.d4_limit, mr, mr * k.d3_limit),
    }
    stacked = F.array(
        *[
            F.struct(F.lit(name).alias("chart"), v.alias("value"), u.alias("ucl"), m.alias("cl"), l.alias("lcl"))
            for name, (v, u, m, l) in rows.items()
        ]
    )
    points = df.select(*keys, "idx", F.explode(stacked).alias("__p")).select(*keys, "idx", "__p.*")
    in_chart = (F.col("chart") == "i") | (F.col("idx") > 1)
    number = F.when(F.col("chart") == "mr", F.col("idx") - 1).otherwise(F.col("idx"))
    return points.filter(in_chart).withColumn("idx", number).select(
        *keys, "chart", "idx", "value", "ucl", "cl", "lcl"
    )


def _with_ranges(df: DataFrame, keys, ts: str, order, series: dict[str, str], rn: str) -> DataFrame:
    """Row number `rn`, and per series n: signed moving range mr_sign_n, mean xbar_n, mean moving range mr_bar_n.

    One scan: a chunk contributes its sums, its inner ranges and its first and last value; the ranges across chunk
    edges are added while scanning.
    """
    df = chunked.with_keys(chunked.with_time_chunk(df, ts), keys)
    local = chunked.local_window(keys, order)
    df = df.withColumns({f"__near_{n}": F.col(c) - F.lag(c).over(local) for n, c in series.items()})
    parts = {"__rows": F.count(F.lit(1))}
    for n, c in series.items():
        parts |= {
            f"__s_{n}": F.sum(c),
            f"__k_{n}": F.count(c),
            f"__r_{n}": F.coalesce(F.sum(F.abs(f"__near_{n}")), F.lit(0.0)),
            f"__first_{n}": F.min_by(c, chunked.order_struct(order)),
            f"__last_{n}": F.max_by(c, chunked.order_struct(order)),
        }

    def scan(w):
        found = {"__base": F.sum("__rows").over(w.rowsBetween(Window.unboundedPreceding, -1))}
        return found | {f"__before_{n}": F.lag(f"__last_{n}").over(w) for n in series}

    def means(w):
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        found = {}
        for n in series:
            edge = F.coalesce(F.abs(F.col(f"__first_{n}") - F.col(f"__before_{n}")), F.lit(0.0))
            ranges = F.sum("__rows").over(whole) - 1
            found[f"xbar_{n}"] = F.sum(f"__s_{n}").over(whole) / F.sum(f"__k_{n}").over(whole)
            found[f"mr_bar_{n}"] = F.try_divide(F.sum(F.col(f"__r_{n}") + edge).over(whole), ranges)
        return found

    df = chunked.carry(df, keys, parts, scan, means)
    signed = {f"mr_sign_{n}": F.coalesce(f"__near_{n}", F.col(c) - F.col(f"__before_{n}")) for n, c in series.items()}
    number = F.row_number().over(local).cast("long") + F.coalesce(F.col("__base"), F.lit(0))
    helpers = ["__base", CHUNK, *[f"__{x}_{n}" for n in series for x in ("near", "before")]]
    return chunked.bare(df.withColumns({**signed, rn: number}), keys, *helpers)


def nelson_flags(points: DataFrame, keys, idx: str = "idx", rules: Sequence[int] = (1, 2, 3, 4)) -> DataFrame:
    """Boolean `rule_k` per point of a chart (columns value, ucl, cl, lcl; `idx` counts 1, 2, ... per key).

    1: outside the limits. 2: nine in a row strictly between the centre and one limit. 3: six in a row rising or
    falling. 4: fourteen in a row alternating. Each rule looks back from its point. Points are cut into blocks
    with the 13 points before them, so no key is sorted in one task.
    """
    keys = names(keys)
    blocks = chunked.in_blocks(points, idx, before=HALO)
    w = Window.partitionBy(*keys, CHUNK).orderBy(idx)
    v = F.col("value")
    step = F.signum(v - F.lag(v).over(w))
    blocks = blocks.withColumn("__dir", step)
    turn = F.coalesce((F.col("__dir") * F.lag("__dir").over(w) == -1).cast("int"), F.lit(0))
    blocks = blocks.withColumn("__turn", turn)

    def run(flag: Column, length: int) -> Column:
        return F.sum(F.coalesce(flag.cast("int"), F.lit(0))).over(w.rowsBetween(-(length - 1), 0)) == length

    above = (v > F.col("cl")) & (v < F.col("ucl"))
    below = (v < F.col("cl")) & (v > F.col("lcl"))
    flags = {
        1: F.coalesce((v > F.col("ucl")) | (v < F.col("lcl")), F.lit(False)),
        2: run(above, 9) | run(below, 9),
        3: run(F.col("__dir") == 1, 5) | run(F.col("__dir") == -1, 5),
        4: run(F.col("__turn") == 1, 12),
    }
    blocks = blocks.withColumns({f"rule_{r}": flags[r] for r in rules})
    return blocks.filter("__own").drop("__own", "__dir", "__turn", CHUNK)


def nelson_rule(points: DataFrame, keys, rule: int, idx: str = "idx") -> DataFrame:
    """Points that violate one rule."""
    return nelson_flags(points, keys, idx, [rule]).filter(F.col(f"rule_{rule}")).drop(f"rule_{rule}")


def nelson_first_violation(
    points: DataFrame, keys, idx: str = "idx", rules: Sequence[int] = (1, 2, 3, 4), tail_only: bool = False
) -> DataFrame:
    """`violated_rule` per point: the first violated rule in the order 1 to 4, else 0.

    With `tail_only` rules 3 and 4 are read at the end of the whole series and given to every point.
    """
    keys = names(keys)
    flagged = nelson_flags(points, keys, idx, rules)
    if tail_only:
        tails = [r for r in rules if r in (3, 4)]
        flagged = flagged.withColumn(CHUNK, F.floor(F.col(idx) / BLOCK_ROWS).cast("long"))
        last = {f"__t{r}": F.max_by(F.col(f"rule_{r}").cast("int"), F.col(idx)) for r in tails}

        def scan(w):
            whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
            return {f"__t{r}": F.last(f"__t{r}").over(whole) for r in tails}

        flagged = chunked.carry(flagged, keys, last, scan)
        flagged = flagged.withColumns({f"rule_{r}": F.col(f"__t{r}") == 1 for r in tails})
        flagged = chunked.bare(flagged, keys, CHUNK, *[f"__t{r}" for r in tails])
    violated = F.when(F.lit(False), F.lit(0))
    for r in sorted(rules):
        violated = violated.when(F.col(f"rule_{r}"), r)
    return flagged.withColumn("violated_rule", violated.otherwise(0)).drop(*[f"rule_{r}" for r in rules])


def imr_series(df: DataFrame, keys, ts: str, tmax: str, tmin: str, tiebreak=()) -> DataFrame:
    """Per reading: difference, moving ranges (absolute and signed) of maximum and difference, their means, and the
    individual and moving-range limits."""
    keys, k = names(keys), spc_coefficients(2)
    order = [ts, *tiebreak]
    df = df.withColumn("diff", F.col(tmax) - F.col(tmin))
    series = {"max": tmax, "diff": "diff"}
    df = _with_ranges(df, keys, ts, order, series, "rn")
    df = df.withColumns({f"mr_{n}": F.abs(F.col(f"mr_sign_{n}")) for n in series})
    limits = {}
    for n in series:
        mean, mr = F.col(f"xbar_{n}"), F.col(f"mr_bar_{n}")
        limits[f"ucl_i_{n}"] = mean + SIGMAS * mr / k.d2
        limits[f"lcl_i_{n}"] = mean - SIGMAS * mr / k.d2
        limits[f"ucl_mr_{n}"] = mr * k.d4_limit
    return df.withColumns(limits)


def limit_events(series: DataFrame, keys, ts: str, tmax: str) -> DataFrame:
    """Two events for the last reading of each key: against the individual limits (difference before maximum) and
    against the moving-range limits."""
    rest = [c for c in series.columns if c not in names(keys)]
    last = series.groupBy(*names(keys)).agg(F.max_by(F.struct(*rest), F.struct(ts, "rn")).alias("__l"))
    last = last.select(*names(keys), "__l.*")

    def event(kind: str, cases) -> Column:
        event_type, level = F.when(F.lit(False), F.lit("")), F.when(F.lit(False), F.lit(""))
        set_value, measured = F.when(F.lit(False), F.lit(0.0)), F.when(F.lit(False), F.lit(0.0))
        for hit, name, limit, value in cases:
            event_type, level = event_type.when(hit, name), level.when(hit, "Warning")
            set_value, measured = set_value.when(hit, limit), measured.when(hit, value)
        return F.struct(
            F.lit(kind).alias("check"),
            event_type.otherwise("NoIssue").alias("event_type"),
            level.otherwise("Info").alias("event_level"),
            set_value.alias("set_value"),
            measured.alias("mea_value"),
        )

    c = F.col
    single = event(
        "i",
        [
            (c("diff") > c("ucl_i_diff"), "AboveIUcl", c("ucl_i_diff"), c("diff")),
            (c("diff") < c("lcl_i_diff"), "BelowILcl", c("lcl_i_diff"), c("diff")),
            (c(tmax) > c("ucl_i_max"), "AboveIUcl", c("ucl_i_max"), c(tmax)),
            (c(tmax) < c("lcl_i_max"), "BelowILcl", c("lcl_i_max"), c(tmax)),
        ],
    )
    moving = event(
        "mr",
        [
            (c("mr_sign_diff") > c("ucl_mr_diff"), "AboveMrUcl", c("ucl_mr_diff"), c("mr_sign_diff")),
            (c("mr_sign_max") > c("ucl_mr_max"), "AboveMrUcl", c("ucl_mr_max"), c("mr_sign_max")),
        ],
    )
    return last.select(*names(keys), ts, F.explode(F.array(single, moving)).alias("__e")).select(
        *names(keys), ts, "__e.*"
    )


def latest_event_batch(df: DataFrame, scope: str, ts: str, level: str, levels: Sequence[str] | None = None) -> DataFrame:
    """All events at the latest event time of their scope, then only the wanted levels."""
    w = Window.partitionBy(scope).orderBy(F.col(ts).desc())
    batch = df.withColumn("__rank", F.rank().over(w)).filter("__rank = 1").drop("__rank")
    return batch if levels is None else batch.filter(F.col(level).isin(list(levels)))
