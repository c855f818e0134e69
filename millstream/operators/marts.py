"""Production, maintenance and work-in-progress marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millstream.functions.cleaning import safe_divide
from millstream.functions.timekeys import month_start
from millstream.functions.wallclock import seconds_between
from millstream.operators import aggregates, joins, temporal
from millstream.operators.chunked import join_null_safe, names
from millstream.session import settle

# Operation codes and their group.
OP_GROUPS = {"IPI": "IP", "OSP": "OS", "PHH": "PH", "PHM": "PH"}


def op_group(c: str, groups: dict[str, str] = OP_GROUPS) -> Column:
    pairs = [F.lit(x) for pair in groups.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[F.col(c)], F.col(c))


def plan_prod_defect_mart(
    plan: tuple[DataFrame, str], prod: tuple[DataFrame, str], defect: tuple[DataFrame, str], keys: Sequence[str]
) -> DataFrame:
    """Plan, production and defect quantity per key, with quality and achievement rate in percent."""
    mart = joins.full_outer_chain({"plan_qty": plan, "prod_qty": prod, "defect_qty": defect}, keys)
    good = (F.col("prod_qty") - F.col("defect_qty")) * 100.0
    return mart.withColumns(
        {
            "quality_rate": F.round(F.coalesce(safe_divide(good, "prod_qty"), F.lit(0.0)), 2),
            "achievement_rate": F.round(
                F.coalesce(safe_divide(F.col("prod_qty") * 100.0, "plan_qty"), F.lit(0.0)), 2
            ),
        }
    )


def shift_slice_mart(
    plan: DataFrame, prod: DataFrame, defect: DataFrame, keys: Sequence[str], start: Column, end: Column,
    plan_ts: str, prod_start: str, prod_end: str, defect_day: str, qty: str,
) -> DataFrame:
    """Plan, production and defects of one running shift: plan hours inside the shift, runs that start and finish in
    it, and defects of its business date."""
    inside = plan.filter((F.col(plan_ts) >= start) & (F.col(plan_ts) < end))
    runs = prod.filter((F.col(prod_start) >= start) & (F.col(prod_end) < end))
    bad = defect.filter(F.col(defect_day).cast("date") == start.cast("date"))
    return plan_prod_defect_mart((inside, qty), (runs, qty), (bad, qty), keys)


def downtime_mart(orders: DataFrame, targets: DataFrame, keys, stopped: Column, minutes: Column) -> DataFrame:
    """Minutes down per key from orders with the stop flag, next to the target; either may be missing (0)."""
    value = orders.filter(stopped).groupBy(*names(keys)).agg(F.sum(minutes).alias("down_time_value"))
    joined = value.join(targets, names(keys), "full")
    return joined.withColumns(
        {m: F.coalesce(F.col(m).cast("double"), F.lit(0.0)) for m in ("down_time_target", "down_time_value")}
    )


def mttr_mtbf_monthly(
    repairs: DataFrame, process: Column, start: str, repair_minutes: Column, run_hours: Column, targets: DataFrame
) -> DataFrame:
    """Mean repair minutes and mean run hours between failures per process and month, with targets (0 if unset)."""
    monthly = repairs.groupBy(process.alias("process"), month_start(start).alias("process_date")).agg(
        F.avg(repair_minutes).alias("mttr"), (F.sum(run_hours) / F.count(F.lit(1))).alias("mtbf")
    )
    joined = monthly.filter(F.col("process").isNotNull()).join(targets, "process", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("mttr", "mtbf", "mttr_target", "mtbf_target")})


def overlap_seconds(start: Column, end: Column, low: Column, high: Column) -> Column:
    """Seconds two intervals share; 0 when apart."""
    first, last = F.greatest(start, low), F.least(end, high)
    return F.greatest(seconds_between(first, last), F.lit(0.0))


def oee_kpi(
    shifts: DataFrame, status: DataFrame, production: DataFrame, alarms: DataFrame, maintenance: DataFrame,
    config: DataFrame, run_status: str = "RUN", bucket: str = "8 hours",
) -> DataFrame:
    """Availability, performance, quality, OEE, MTTR (minutes) and MTBF (hours) per shift and machine.

    shifts(equip_id, shift_id, shift_start, shift_end), status(equip_id, status_code, start_time, end_time),
    production(equip_id, time, total_cnt, good_cnt), alarms(equip_id, time), maintenance(equip_id, start_time,
    end_time), config(equip_id, std_cycle_time). Intervals and shifts meet in the nodes of a time tree, however long they are.
    """
    keys = ["equip_id", "shift_id", "shift_start", "shift_end"]

    slots = shifts.select(*keys)

    def shared(df: DataFrame, out: str) -> DataFrame:
        """Overlap seconds and count of intervals per shift: those that start in it, and those that it starts in."""
        spans = df.select("equip_id", "start_time", "end_time").filter(F.col("end_time") >= F.col("start_time"))
        starting = temporal.tree_pairs(spans, slots, "equip_id", "start_time", "shift_start", "shift_end", bucket, "left")
        running_on = temporal.tree_pairs(slots, spans, "equip_id", "shift_start", "start_time", "end_time", bucket, "neither")
        pairs = starting.filter(F.col("end_time") > F.col("shift_start")).unionByName(running_on.filter(F.col("shift_end") >= F.col("shift_start")))
        seconds = overlap_seconds(F.col("start_time"), F.col("end_time"), F.col("shift_start"), F.col("shift_end"))
        return pairs.groupBy(*keys).agg(F.sum(seconds).alias(f"{out}_sec"), F.count(F.lit(1)).alias(f"{out}_cnt"))

    def counted(df: DataFrame, aggs: Sequence[Column]) -> DataFrame:
        pairs = temporal.tree_pairs(df, slots, "equip_id", "time", "shift_start", "shift_end", bucket)
        return pairs.groupBy(*keys).agg(*aggs)

    running = shared(status.filter(F.col("status_code") == run_status), "run")
    repaired = shared(maintenance, "repair")
    made = counted(production, [F.sum("total_cnt").alias("total_cnt"), F.sum("good_cnt").alias("good_cnt")])
    failed = counted(alarms, [F.count(F.lit(1)).alias("failure_cnt")])
    kpi = shifts.select(*keys)
    for part in (running, repaired, made, failed):
        kpi = kpi.join(part, keys, "left")
    kpi = kpi.join(config, "equip_id", "left").fillna(
        0, ["run_sec", "repair_sec", "repair_cnt", "total_cnt", "good_cnt", "failure_cnt"]
    )
    planned = seconds_between("shift_start", "shift_end")
    rates = {
        "availability": safe_divide("run_sec", planned),
        "performance": safe_divide(F.col("total_cnt") * F.col("std_cycle_time"), "run_sec"),
        "quality": safe_divide(F.col("good_cnt").cast("double"), "total_cnt"),
        "mttr": safe_divide(F.col("repair_sec") / 60.0, "repair_cnt"),
        "mtbf": safe_divide(F.col("run_sec") / 3600.0, "failure_cnt"),
    }
    kpi = kpi.withColumns({n: F.coalesce(r, F.lit(0.0)) for n, r in rates.items()})
    return kpi.withColumn("oee", F.col("availability") * F.col("performance") * F.col("quality"))


def annual_plan_vs_actual(
    bom: DataFrame, scan: DataFrame, unit: str, sheet: str, plan_year: Column, plan_day: str, plan_qty: str,
    bom_order: Sequence[Column], done: Column, scan_day: str, scan_qty: str,
) -> DataFrame:
    """Sheets planned and produced per year and unit.

    Plan: latest bill of materials per sheet, planned within its own year. Production: finished quantity of each
    sheet on its last production day, in that day's year.
    """
    latest = joins.distinct_on(bom, [unit, sheet], bom_order).withColumn("year", plan_year)
    plan = latest.filter(F.year(plan_day) == F.col("year")).select(
        "year", unit, F.lit(1).alias("plan_cnt"), F.col(plan_qty).alias("plan_total_qty")
    )
    daily = scan.filter(done).groupBy(sheet, unit, scan_day).agg(F.sum(scan_qty).alias("__qty"))
    last = joins.distinct_on(daily, [sheet], [F.col(scan_day).desc(), F.col(unit)])
    made = last.select(
        F.year(scan_day).alias("year"), unit, F.lit(1).alias("prod_cnt"), F.col("__qty").alias("prod_total_qty")
    )
    stacked = plan.unionByName(made, allowMissingColumns=True)
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("plan_cnt", "prod_cnt")]
    sums += [
        F.coalesce(F.round(F.sum(c)), F.lit(0)).cast("long").alias(c) for c in ("plan_total_qty", "prod_total_qty")
    ]
    return stacked.groupBy("year", unit).agg(*sums)


def daily_plan_status(
    plan: DataFrame, scan: DataFrame, keys: Sequence[str], group: Sequence[str], seq: str, planned_today: Column,
    scan_seq: str, scanned_today: Column, qty: str,
) -> DataFrame:
    """Per group the sheets planned or scanned today and their quantity, each (sheet, quantity) once."""
    keys = list(keys)
    latest = joins.tuple_in_max(plan, keys, seq).filter(planned_today).select(*keys)
    seen = scan.filter(scanned_today).groupBy(*keys).agg(F.max(scan_seq).alias(scan_seq))
    scanned = scan.join(seen, [*keys, scan_seq], "left_semi").select(*keys)
    todays = latest.union(scanned).distinct()
    quantities = todays.join(plan.select(*keys, qty), keys, "left").distinct()
    return quantities.groupBy(*group).agg(
        F.count(F.lit(1)).alias("plan_cnt"), F.coalesce(F.sum(qty), F.lit(0)).alias("plan_qty")
    )


def spare_part_analysis(
    usage: DataFrame, production: DataFrame, stock: DataFrame, keys: Sequence[str], zone: Sequence[str], part: str,
    name: str, day: str, qty: str, prod_day: str, prod_qty: str, stock_order: Sequence[Column], stock_qty: str,
    top: int = 10,
) -> DataFrame:
    """Top parts per zone with replacement cycle, last order dates, production between orders, quantity range and stock.

    `usage` has one row per work order and part; `keys` = zone columns and part.
    """
    keys, zone = list(keys), list(zone)
    totals = usage.groupBy(*keys, name).agg(
        F.sum(qty).alias("total_outgoing_qty"), F.count(F.lit(1)).alias("wo_cnt")
    )
    ranked = aggregates.topk_per_group(
        totals, zone, [F.col("total_outgoing_qty").desc(), F.col(part), F.col(name)], top
    )
    # Everything but the ranking concerns the ranked parts only.
    ranked = settle(ranked)
    usage = usage.join(ranked.select(*keys), keys, "left_semi")
    gaps = settle(temporal.lag_gap_days(usage.select(*keys, day), keys, day))
    cycle = aggregates.replacement_cycle(gaps, keys, "gap_days")
    orders = gaps.select(*keys, F.col(day).alias("current_day"), "previous_day")
    periods = joins.wo_period_join(orders, production, zone, "previous_day", "current_day", prod_day, prod_qty)
    last = periods.groupBy(*keys).agg(
        F.max("current_day").alias("current_wo_date"),
        F.max("previous_day").alias("previous_wo_date"),
        F.sum("total_qty").alias("total_qty"),
        F.sum("total_qty_recent").alias("total_qty_recent"),
    )
    bounds = aggregates.positive_min_max(usage, keys, qty)
    latest_stock = joins.distinct_on(stock, [part], stock_order).select(part, F.col(stock_qty).alias("stock_qty"))
    result = ranked
    for side in (cycle, last, bounds):
        result = join_null_safe(result, side, keys, "left")
    return result.join(latest_stock, part, "left").dropDuplicates(keys)
