"""Equi joins, latest-row joins, wildcard and dated joins, existence checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millstream.functions.timekeys import as_ntz, interval
from millstream.functions.wallclock import seconds_between
from millstream.operators import temporal
from millstream.operators.chunked import join_null_safe, names


def inner_equi_join(left: DataFrame, right: DataFrame, keys, where: Column | None = None) -> DataFrame:
    joined = left.join(right, names(keys), "inner")
    return joined if where is None else joined.filter(where)


def composite_key_join(base: DataFrame, steps: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Inner joins in turn, each on its own key list."""
    return reduce(lambda df, step: df.join(step[0], names(step[1]), "inner"), steps, base)


def left_join_with_on_filter(left: DataFrame, right: DataFrame, keys, right_pred: Column) -> DataFrame:
    """LEFT JOIN with constant predicates in ON: the right side is filtered first, unmatched left rows stay."""
    return left.join(right.filter(right_pred), names(keys), "left")


def join_keeping_left(left: DataFrame, right: DataFrame, keys, how: str = "left") -> DataFrame:
    """`left.join(right, keys, how)` for left and left_anti.

    Rows with a null in their key match nothing, so they don't take part in the join: its shuffle would bring them all to
    one task.
    """
    keys = names(keys)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    joined = left.filter(known).join(right, keys, how)
    kept = [*keys, *[c for c in left.columns if c not in keys]]
    added = [] if how == "left_anti" else [F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema if f.name not in keys]
    return joined.union(left.filter(~known).select(*kept, *added))


def left_join_numeric_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Left join on keys read as whole numbers; unreadable keys match nothing."""
    right = right.withColumn("__key", F.col(right_key).try_cast("long")).filter("__key is not null").drop(right_key)
    return join_keeping_left(left.withColumn("__key", F.col(left_key).try_cast("long")), right, "__key").drop("__key")


def left_join_neutralised(left: DataFrame, right: DataFrame, keys, right_pred: Column) -> DataFrame:
    """LEFT JOIN whose WHERE tests the right side, which is an inner join."""
    return left.join(right, names(keys), "left").filter(right_pred)


def full_outer_chain(
    sides: dict[str, tuple[DataFrame, str]], keys: Sequence[str], fill=0
) -> DataFrame:
    """Sum of each side's measure per key, over the keys of all sides; missing measures are `fill`.

    Equal to full outer joins of the grouped sides with coalesced keys, in one shuffle: the sides are
    stacked and grouped once, with partial sums before the shuffle.
    """
    stacked = None
    for name, (df, measure) in sides.items():
        part = df.select(*keys, F.col(measure).alias(name))
        stacked = part if stacked is None else stacked.unionByName(part, allowMissingColumns=True)
    return stacked.groupBy(*keys).agg(*[F.coalesce(F.sum(n), F.lit(fill)).alias(n) for n in sides])


def cross_join_params(df: DataFrame, params: dict[str, object]) -> DataFrame:
    """Attach one row of parameters to every row, as literals."""
    return df.withColumns({name: value if isinstance(value, Column) else F.lit(value) for name, value in params.items()})


def cross_join_alarm_map(df: DataFrame, bits: str, positions: dict[str, int]) -> DataFrame:
    """One row per (row, alarm) with `status_value` = bit at the alarm's position. The map is a fixed literal."""
    entries = F.array(
        *[F.struct(F.lit(n).alias("alarm_name"), F.lit(p).alias("bit_pos")) for n, p in positions.items()]
    )
    exploded = df.withColumn("__alarm", F.explode(entries)).select(*df.columns, "__alarm.*")
    bit = F.substring(F.col(bits), F.col("bit_pos"), F.lit(1))
    return exploded.withColumn("status_value", bit.try_cast("int"))


def lateral_latest(
    dim: DataFrame, fact: DataFrame, key: str, ts: str, cols: Sequence[str], max_age: str | None = None, as_of=None
) -> DataFrame:
    """Latest fact row per dimension row; dimension rows without facts keep nulls.

    `max_by` combines before the shuffle, so a busy device costs no more than a quiet one.
    """
    if max_age:
        fact = fact.filter(F.col(ts) >= as_ntz(as_of) - interval(max_age))
    latest = fact.groupBy(key).agg(
        F.max_by(F.struct(ts, *cols), F.struct(ts, *cols)).alias("__latest")
    )
    return dim.join(latest, key, "left").select(*dim.columns, "__latest.*")


def wo_period_join(orders: DataFrame, production: DataFrame, keys, prev: str, cur: str, day: str, qty: str) -> DataFrame:
    """Production between the previous and the current work order (both days included) and after the current one.

    Days are dates. Running totals per key replace the many-to-many join: total(prev..cur) = C(cur) - C(prev - 1). C is
    worked out on the days that production or orders have, and on no others, so a key has a row for each of these.
    Repeated work orders count once each, as in the joined form.
    """
    keys = names(keys)
    made = production.filter(F.col(day).isNotNull()).select(*keys, F.col(day).alias("__day"), F.col(qty).alias("__qty"))
    grouped = orders.groupBy(*orders.columns).agg(F.count(F.lit(1)).alias("__times"))
    grouped = grouped.withColumns({"__at_cur": F.col(cur), "__at_prev": F.date_sub(prev, 1)})
    asked = grouped.select(*keys, F.explode(F.array("__at_cur", "__at_prev")).alias("__day")).filter(F.col("__day").isNotNull())
    # Sums go through the shuffle a row for each key and day; days that are only asked for add nothing.
    asked = asked.distinct().withColumn("__qty", F.lit(0).cast(made.schema["__qty"].dataType))
    days = made.unionByName(asked).groupBy(*keys, "__day").agg(F.sum("__qty").alias("__qty"))
    w = Window.partitionBy(*keys).orderBy("__day")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = days.select(
        *keys,
        "__day",
        F.coalesce(F.sum("__qty").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)).alias("__run"),
        F.coalesce(F.sum("__qty").over(whole), F.lit(0)).alias("__all"),
    )
    at_cur = totals.select(*keys, F.col("__day").alias("__at_cur"), F.col("__run").alias("__upto"), "__all")
    at_prev = totals.select(*keys, F.col("__day").alias("__at_prev"), F.col("__run").alias("__before"))
    grouped = join_null_safe(grouped, at_cur, [*keys, "__at_cur"], "left")
    grouped = join_null_safe(grouped, at_prev, [*keys, "__at_prev"], "left")
    between = F.when(F.col(prev) <= F.col(cur), F.coalesce(F.col("__upto") - F.col("__before"), F.lit(0))).otherwise(0)
    after = F.coalesce(F.col("__all") - F.col("__upto"), F.lit(0))
    helpers = ["__times", "__at_cur", "__at_prev", "__upto", "__before", "__all"]
    return grouped.withColumns(
        {"total_qty": between * F.col("__times"), "total_qty_recent": after * F.col("__times")}
    ).drop(*helpers)


def semi_exists(main: DataFrame, detail: DataFrame, key, conditions: Sequence[Column]) -> DataFrame:
    """Rows that have at least one detail row for each condition. One pass over the detail, one semi join."""
    flags = [F.max(c.cast("int")).alias(f"__f{i}") for i, c in enumerate(conditions)]
    relevant = reduce(lambda a, b: a | b, conditions)
    found = detail.filter(relevant).groupBy(*names(key)).agg(*flags)
    for i in range(len(conditions)):
        found = found.filter(F.col(f"__f{i}") == 1)
    return main.join(found.select(*names(key)), names(key), "left_semi")


def semi_by_keys(df: DataFrame, keys_df: DataFrame, key) -> DataFrame:
    return df.join(keys_df.select(*names(key)), names(key), "left_semi")


def anti_join_null_safe(df: DataFrame, bad: DataFrame, key) -> DataFrame:
    """Drop rows whose key is in `bad`; null keys are kept."""
    return join_keeping_left(df, bad.select(*names(key)), key, "left_anti")


def tuple_in_max(df: DataFrame, keys, seq: str) -> DataFrame:
    """Rows whose `seq` is the largest of their keys; ties stay. Spark limits the groups before the shuffle."""
    w = Window.partitionBy(*names(keys)).orderBy(F.col(seq).desc())
    return df.filter(F.col(seq).isNotNull()).withColumn("__rank", F.rank().over(w)).filter("__rank = 1").drop("__rank")


def join_to_max_per_group(df: DataFrame, keys, ts: str) -> DataFrame:
    """Rows at the latest time of their key; ties stay."""
    return tuple_in_max(df, keys, ts)


def cross_check_join(a: DataFrame, b: DataFrame, key: str, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Join two records of one thing and compare column pairs.

    Adds `<name>_match` per pair (a null on either side is no match), `all_match`, and `valid_comparison`
    (no null in any pair).
    """
    left = a.select(key, *[F.col(l).alias(f"a_{n}") for n, (l, _) in pairs.items()])
    right = b.select(key, *[F.col(r).alias(f"b_{n}") for n, (_, r) in pairs.items()])
    joined = left.join(right, key, "inner")
    same = {f"{n}_match": F.coalesce(F.col(f"a_{n}") == F.col(f"b_{n}"), F.lit(False)) for n in pairs}
    present = [F.col(f"{side}_{n}").isNotNull() for n in pairs for side in "ab"]
    joined = joined.withColumns(same)
    return joined.withColumns(
        {
            "all_match": reduce(lambda x, y: x & y, [F.col(c) for c in same]),
            "valid_comparison": reduce(lambda x, y: x & y, present),
        }
    )


def match_statistics(checked: DataFrame) -> DataFrame:
    """Counts of valid comparisons and matches, and the match percentage."""
    valid = F.count_if("valid_comparison")
    matched = F.count_if(F.col("valid_comparison") & F.col("all_match"))
    return checked.agg(
        F.count(F.lit(1)).alias("n_rows"),
        valid.alias("n_valid"),
        matched.alias("n_match"),
        F.round(F.coalesce(F.try_divide(matched * 100.0, valid), F.lit(0.0)), 2).alias("match_pct"),
    )


def self_join_hierarchy(
    fact: DataFrame, loc: DataFrame, key: str, loc_id: str, parent: str, name: str, levels: Sequence[str]
) -> DataFrame:
    """Names of a location and its ancestors through one self-referencing dimension."""
    step = key
    for i, level in enumerate(levels):
        dim = loc.select(
            F.col(loc_id).alias(f"__id{i}"), F.col(name).alias(f"{level}_name"), F.col(parent).alias(f"__up{i}")
        )
        fact = fact.join(dim, F.col(step) == F.col(f"__id{i}"), "left").drop(f"__id{i}")
        step = f"__up{i}"
    return fact.drop(*[f"__up{i}" for i in range(len(levels))])


def wildcard_match_join(
    alerts: DataFrame, subs: DataFrame, alert_id: str, sub_id: str, exact: str, fields: Sequence[str],
    equal: Sequence[str] = (), alert_cols: Sequence[str] = (), sub_cols: Sequence[str] = (),
) -> DataFrame:
    """(alert, subscription) pairs, with `alert_cols` and `sub_cols` of the two sides. A null subscription field matches everything.

    A subscription that names `exact` (the sensor) matches that sensor, whatever its other fields; with another
    sensor in the alert it never matches; an alert without sensor falls through to the fields. `equal` columns
    must be equal.

    Each subscription has a mask of the fields it names. An alert is looked up once per mask that occurs among them, by
    equality on the masked values, so this is an equi join and not a nested loop over all pairs. All alerts share the
    mask without fields, and one sensor may send most of them; a plain join of two shuffled sides lets Spark split the
    alerts of such a key over tasks.
    """
    equal, s = list(equal), subs
    needed = list(dict.fromkeys([alert_id, *alert_cols, exact, *fields, *equal]))
    # An alert may give very many pairs, and a small file of alerts is read by a task or two: rows are dealt out before they multiply.
    a = alerts.select(*needed).repartition(*needed)

    def masked(df: DataFrame, mask: Column | None) -> list[Column]:
        out = []
        for i, f in enumerate(fields):
            value = F.col(f).cast("string")
            out.append((value if mask is None else F.when(F.substring(mask, i + 1, 1) == "1", value)).alias(f"__f{i}"))
        return out

    own_mask = F.concat(*[F.when(F.col(f).isNotNull(), "1").otherwise("0") for f in fields])
    masks = s.agg(F.collect_set(own_mask).alias("__masks"))  # one row of 2 ** fields masks at most
    left = a.withColumn("__mask", F.explode(masks.scalar())).select(
        alert_id, *alert_cols, F.col(exact).alias("__a_exact"), *equal, "__mask", *masked(a, F.col("__mask"))
    )
    # A named field can only match an alert that has it.
    named = [(F.substring("__mask", i + 1, 1) == "0") | F.col(f"__f{i}").isNotNull() for i in range(len(fields))]
    left = left.filter(reduce(lambda x, y: x & y, named))
    right = s.select(
        sub_id, *sub_cols, F.col(exact).alias("__s_exact"), *equal, own_mask.alias("__mask"), *masked(s, None)
    )
    on = ["__mask", *[f"__f{i}" for i in range(len(fields))], *equal]
    by_field = join_null_safe(left, right, on).filter(F.col("__s_exact").isNull() | F.col("__a_exact").isNull())
    by_sensor = a.select(alert_id, *alert_cols, exact, *equal).join(
        s.filter(F.col(exact).isNotNull()).select(sub_id, *sub_cols, exact, *equal), [exact, *equal], "inner"
    )
    pair = [alert_id, *alert_cols, sub_id, *sub_cols]
    return by_field.select(*pair).union(by_sensor.select(*pair))


def effective_dated_join(
    fact: DataFrame, mapping: DataFrame, key: str, ts: str, valid_from: str, valid_to: str, width: str = "30 days"
) -> DataFrame:
    """Join to the mapping rows in force at the fact's time, both ends included; an open end is null.

    The versions of a key are cut at all their bounds into elementary ranges, each with the versions in force there, which
    are one where versions don't overlap. A fact finds its range by one scan in the order of time, so it meets no version
    but its own. Facts without time match only versions that are open at both ends. `width` is best near the usual time
    between the facts of a key or longer.
    """
    rest = [c for c in mapping.columns if c != key]
    low, high = F.col(valid_from).cast("timestamp_ntz"), F.col(valid_to).cast("timestamp_ntz")
    far = [F.lit(t).cast("timestamp_ntz") for t in ("0001-01-01 00:00:00", "9999-12-31 23:59:59.999999")]
    spans = mapping.filter(F.col(key).isNotNull()).select(
        F.col(key), F.struct(*rest).alias("__version"), F.coalesce(low, far[0]).alias("__low"), F.coalesce(high, far[1]).alias("__high"), high.alias("__end")
    )
    spans = spans.filter("__low <= __high")
    ends = F.array("__low", F.col("__end") + F.expr("interval 1 microsecond"))
    cuts = spans.select(key, F.explode(ends).alias("__cut")).filter(F.col("__cut").isNotNull()).distinct()
    held = temporal.tree_pairs(cuts, spans, key, "__cut", "__low", "__high", "1 day").groupBy(key, "__cut").agg(F.collect_list("__version").alias("__versions"))
    ranges = cuts.join(held, [key, "__cut"], "left")
    timed = fact.withColumn("__at", F.col(ts).cast("timestamp_ntz"))
    found = temporal.asof_join(timed, ranges, key, "__at", "__cut", ["__versions"], "__range", strict=False, width=width)
    rows = found.select(*fact.columns, F.explode("__range.__versions").alias("__version"))
    always = mapping.filter(F.col(valid_from).isNull() & F.col(valid_to).isNull())
    untimed = fact.filter(F.col(ts).isNull()).join(always, key)
    names_ = [key, *[c for c in fact.columns if c != key]]
    return rows.select(*names_, "__version.*").unionByName(untimed.select(*names_, *rest))


def distinct_on(df: DataFrame, keys, order: Sequence[Column]) -> DataFrame:
    """First row per key in the given order. Spark keeps one row per key and task before the shuffle."""
    w = Window.partitionBy(*names(keys)).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def worksheet_detail_join(
    plan: DataFrame, scan: DataFrame, bom: DataFrame, plan_key, seq: str, status: str, scan_order: Sequence[Column],
    bom_key, bom_order: Sequence[Column],
) -> DataFrame:
    """Latest plan step, with the latest scan of each status and the latest bill of materials."""
    plan_key, bom_key = names(plan_key), names(bom_key)
    steps = tuple_in_max(plan, plan_key, seq)
    scans = distinct_on(scan, [*plan_key, status], scan_order)
    boms = distinct_on(bom, bom_key, bom_order)
    return steps.join(scans, plan_key, "left").join(boms, bom_key, "left")


def orphan_rows(child: DataFrame, parent: DataFrame, keys) -> DataFrame:
    return join_keeping_left(child, parent.select(*names(keys)), keys, "left_anti")


def orphan_check(child: DataFrame, parent: DataFrame, keys) -> DataFrame:
    """Number of child rows without a parent; null keys are orphans."""
    return orphan_rows(child, parent, keys).agg(F.count(F.lit(1)).alias("orphans"))


def not_in_use_devices(devices: DataFrame, in_use: DataFrame, key: str) -> DataFrame:
    return orphan_rows(devices, in_use, key)


def dict_lookup_merge(
    master: DataFrame, plan: DataFrame, prod: DataFrame, keys, measures: Sequence[str], plan_qty: str, prod_qty: str
) -> DataFrame:
    """Master rows with plan and production measures (default 0) and their percentage."""
    keys = names(keys)
    joined = master.join(plan, keys, "left").join(prod, keys, "left")
    joined = joined.withColumns({m: F.coalesce(m, F.lit(0)) for m in measures})
    rate = F.when(F.col(plan_qty) > 0, F.round(F.col(prod_qty) / F.col(plan_qty) * 100, 2)).otherwise(0.0)
    return joined.withColumn("rate", rate)


def lookup_or_self(df: DataFrame, dim: DataFrame, code: str, name: str, allow: Sequence[str] | None = None) -> DataFrame:
    """Name of a code, or the code itself where unknown; then only the allowed names."""
    dim = dim.select(F.col(code), F.col(name).alias("__name")).dropDuplicates([code])
    joined = df.join(dim, code, "left").withColumn(name, F.coalesce("__name", F.col(code))).drop("__name")
    return joined if allow is None else joined.filter(F.col(name).isin(list(allow)))


def season_name(
    df: DataFrame, dim: DataFrame, code: str, dim_key: str, dim_name: str, key_from: int = 1, year_from: int = 3
) -> DataFrame:
    """Season label: dimension name followed by the two-digit year inside the code; the code itself if unknown.

    `key_from` is where the two-character season key starts in the code, `year_from` where the year starts.
    """
    dim = dim.select(F.col(dim_key).alias("__key"), F.col(dim_name).alias("__name")).dropDuplicates(["__key"])
    keyed = df.withColumn("__key", F.substring(code, key_from, 2))
    label = F.when(F.col("__name").isNotNull(), F.concat("__name", F.substring(code, year_from, 2)))
    return (
        keyed.join(dim, "__key", "left")
        .withColumn("season", F.coalesce(label, F.col(code)))
        .drop("__key", "__name")
    )


def feedback_translate(df: DataFrame, dim: DataFrame, key: str, lang: str, default: str = "en") -> DataFrame:
    """Category name in the asked language, else in the default one. `dim` has one column per language."""
    chosen = F.col(lang) if lang in dim.columns else F.lit(None).cast("string")
    named = dim.select(key, F.coalesce(chosen, F.col(default)).alias("category"))
    return df.join(named, key, "left")


def plant_lookback_window(df: DataFrame, offsets: DataFrame, plant: str, ts: str, as_of) -> DataFrame:
    """Readings inside each plant's window (as_of - hours_from, as_of - hours_to]; plants without offsets drop out.

    The widest window of all plants bounds the time itself, so that the scan leaves out what lies outside."""
    back = seconds_between(F.col(ts), as_ntz(as_of)) / 3600.0

    def before(hours: Column) -> Column:
        return as_ntz(as_of) - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (hours * 3600).cast("decimal(18,6)"))

    earliest = offsets.select(before(F.max("hours_from") + 1)).scalar()
    latest = offsets.select(before(F.min("hours_to") - 1)).scalar()
    df = df.filter((F.col(ts) >= earliest) & (F.col(ts) <= latest))
    return df.join(offsets, plant, "inner").filter((back <= F.col("hours_from")) & (back >= F.col("hours_to")))


def sensor_location_enrich(
    df: DataFrame, sensors: DataFrame, locations: DataFrame, sensor: str, loc: str, filters: Column | None = None
) -> DataFrame:
    """Readings with their location; unknown sensors and locations drop out."""
    joined = df.join(sensors.select(sensor, loc), sensor, "inner").join(locations, loc, "inner")
    return joined if filters is None else joined.filter(filters)
