"""Scalar cleaning: text, keys, codes, status labels. All return Columns."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from millstream.functions.wallclock import col

# Last two characters of a location name and the status they stand for.
STATUS_BY_SUFFIX = {
    "입고": "I",
    "투입": "T",
    "완료": "O",
    "보관": "K",
    "중단": "S",
    "대기": "H",
    "도착": "A",
    "발행": "P",
    "삭제": "D",
}

# Numeric machine ranges and their line.
LINE_RANGES = [(1, 8, "LINE 1"), (9, 16, "LINE 2"), (17, 24, "LINE 3"), (25, 30, "LINE 4")]

# Codes of the PLC state tags.
PLC_STATE_LABELS = {
    "mixer_run": {0: "STOP", 1: "RUN"},
    "run_mode": {0: "manual", 1: "Semi", 2: "Auto"},
    "process_stage": {0: "load", 1: "mix", 2: "discharge"},
    "drop_door_position": {0: "open", 1: "close"},
}

# Fixed value: token that keeps a null apart from a blank in a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

EARTH_RADIUS_MILES = 3961
KM_PER_MILE = 1.60934


def clean_string(c: str | Column) -> Column:
    """Commas become blanks, outer blanks go."""
    return F.trim(F.translate(col(c), ",", " "))


def zero_pad(c: str | Column, width: int) -> Column:
    """Left-pad with zeros; longer values stay whole."""
    c = col(c).cast("string")
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)


def normalize_key(c: str | Column, pad: int | None = None, upper: bool = False) -> Column:
    key = F.trim(col(c).cast("string"))
    key = F.upper(key) if upper else key
    return zero_pad(key, pad) if pad else key


def machine_code_case(workshop, line, no, table) -> Column:
    """Machine code of a mould change, built per workshop (PL, IP, CP, OS); other workshops give null."""
    workshop, line, no, table = map(col, (workshop, line, no, table))
    spare_station = F.substring(table, 1, 3) == "ST6"
    side = F.substring(table, 4, 1)
    position = F.substring(table, 5, 1)
    shifted = position.try_cast("int") + F.when(side == "C", 0).otherwise(4)
    press = F.concat(
        F.lpad(F.substring(no, 3, 2), 3, "0"),
        F.lit("_MC"),
        F.lpad(F.substring(table, 3, 1), 3, "0"),
        F.lit("_"),
        F.when(spare_station, F.lit("P")).otherwise(side),
        F.lit("_"),
        F.lpad(F.when(spare_station, shifted.cast("string")).otherwise(position), 3, "0"),
    )
    injection = F.concat(F.lit("IPI-"), no, F.lit("-"), F.substring(table, 3, 2), F.lit("-"), position)
    return (
        F.when(workshop == "PL", press)
        .when(workshop == "IP", injection)
        .when(workshop == "CP", F.concat(line, F.lit("_"), no, F.lit("_"), table))
        .when(workshop == "OS", F.concat(F.substring(line, 3, 2), F.lit("-"), no))
    )


def split_station(c: str | Column) -> tuple[Column, Column]:
    """(station, side): the last two '-' tokens, null when there are fewer than two."""
    parts = F.split(col(c), "-")
    enough = F.size(parts) >= 2
    return F.when(enough, F.element_at(parts, -2)), F.when(enough, F.element_at(parts, -1))


def split_tag(c: str | Column) -> tuple[Column, Column]:
    """'st_1_Plate Temperature UR' -> ('st_1', 'Plate Temperature UR'); null prop without a third token."""
    parts = F.split(col(c), "_", 3)
    return F.concat_ws("_", F.get(parts, F.lit(0)), F.get(parts, F.lit(1))), F.get(parts, F.lit(2))


def right_key(c: str | Column, n: int) -> Column:
    c = col(c).cast("string")
    return F.substring(c, F.greatest(F.length(c) - n + 1, F.lit(1)), F.lit(n))


def tail_substring(c: str | Column, from_end: int, n: int) -> Column:
    """`n` characters starting `from_end` characters before the last one."""
    c = col(c)
    return F.substring(c, F.length(c) - from_end, F.lit(n))


def labelled(c: str | Column, mapping: dict) -> Column:
    """Code to label through a literal map; unmapped codes give null."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*pairs)[col(c)]


def suffix_status_map(c: str | Column, mapping: dict[str, str] = STATUS_BY_SUFFIX) -> Column:
    return labelled(right_key(c, 2), mapping)


def packed_xy(c: str | Column) -> tuple[Column, Column]:
    c = col(c)
    return F.split_part(c, F.lit("/"), F.lit(1)), F.split_part(c, F.lit("/"), F.lit(2))


def tag_decode(c: str | Column, mapping: dict[int, str]) -> Column:
    return labelled(col(c).cast("int"), mapping)


def null_above(c: str | Column, limit: float) -> Column:
    """Readings above `limit` are sensor faults."""
    c = col(c)
    return F.when(~(c > limit), c)


def keyword_search(cols: Sequence[str | Column], keyword: str) -> Column:
    """True where any column contains the keyword, whatever the case."""
    return reduce(lambda a, b: a | b, [col(c).ilike(f"%{keyword}%") for c in cols])


def optional_filters(params: dict[str, tuple[str, object]]) -> Column:
    """AND of the filters whose value is given. Kinds: eq, ieq, like, ge, le, lt, in."""
    build = {
        "eq": lambda c, v: c == F.lit(v),
        "ieq": lambda c, v: F.upper(c) == F.upper(F.lit(v)),
        "like": lambda c, v: c.like(f"%{v}%"),
        "ge": lambda c, v: c >= F.lit(v),
        "le": lambda c, v: c <= F.lit(v),
        "lt": lambda c, v: c < F.lit(v),
        "in": lambda c, v: c.isin(list(v)),
    }
    given = [build[kind](F.col(name), value) for name, (kind, value) in params.items() if value is not None]
    return reduce(lambda a, b: a & b, given, F.lit(True))


def worksheet_status(prod_status: str | Column, op_chk: str | Column | None = None) -> Column:
    """Y in, C out, otherwise not started; with `op_chk` an unchecked and unscanned step is X."""
    status = col(prod_status)
    label = F.when(status == "Y", "I").when(status == "C", "O")
    if op_chk is None:
        return label.otherwise("N")
    return label.when((col(op_chk) == "N") & status.isNull(), "X").when(status.isNull(), "N")


def null_default(c: str | Column, value=0) -> Column:
    return F.coalesce(col(c), F.lit(value))


def process_name_map(c: str | Column, mapping: dict[str, str], default: str | None = None) -> Column:
    name = labelled(c, mapping)
    return F.coalesce(name, F.lit(default)) if default is not None else name


def range_to_line(code: str | Column, ranges=LINE_RANGES, default: str = "UNKNOWN") -> Column:
    code = col(code).try_cast("int")
    chain = F.when(F.lit(False), F.lit(default))
    for low, high, label in ranges:
        chain = chain.when(code.between(low, high), label)
    return chain.otherwise(default)


def round_value(c: str | Column, digits: int = 3) -> Column:
    return F.round(col(c), digits)


def iso_time(ts: str | Column) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")


def bitstring_alarm(c: str | Column, position: int) -> Column:
    """Character at `position` (from 1); '0' where the string is missing or too short."""
    bit = F.substring(col(c), position, 1)
    return F.when(bit != "", bit).otherwise("0")


def to_number(c: str | Column, dtype: str = "decimal(10,2)") -> Column:
    """Numeric value of a text reading; blank and malformed text give null."""
    return F.nullif(F.trim(col(c)), F.lit("")).try_cast(dtype)


def surrogate_key(*cols: str | Column) -> Column:
    texts = [F.coalesce(col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *texts))


def safe_add(*cols: str | Column) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in cols])


def safe_subtract(*cols: str | Column) -> Column:
    return reduce(lambda a, b: a - b, [F.coalesce(col(c), F.lit(0)) for c in cols])


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    return F.try_divide(col(numerator), col(denominator))


def width_bucket(c, low, high, buckets) -> Column:
    return F.width_bucket(col(c), *[col(x) if isinstance(x, (str, Column)) else F.lit(x) for x in (low, high, buckets)])


def haversine(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    lat1, lon1, lat2, lon2 = (F.radians(col(c)) for c in (lat1, lon1, lat2, lon2))
    half = F.pow(F.sin((lat2 - lat1) / 2), F.lit(2)) + F.cos(lat1) * F.cos(lat2) * F.pow(
        F.sin((lon2 - lon1) / 2), F.lit(2)
    )
    miles = F.lit(2 * EARTH_RADIUS_MILES) * F.asin(F.sqrt(half))
    return miles * KM_PER_MILE if unit == "km" else miles


_SCHEME = r"^(?:[a-z][a-z0-9+.-]*://)?"


def url_host(c: str | Column) -> Column:
    return F.regexp_extract(col(c), _SCHEME + r"([^/?#]+)", 1)


def url_path(c: str | Column) -> Column:
    """Path without its leading slash and without query or fragment."""
    return F.regexp_extract(col(c), _SCHEME + r"[^/?#]+/([^?#]*)", 1)


def url_parameter(c: str | Column, key: str) -> Column:
    found = F.regexp_extract(col(c), rf"[?&]{key}=([^&#]*)", 1)
    return F.nullif(found, F.lit(""))


def slugify(c: str | Column) -> Column:
    slug = F.regexp_replace(F.lower(col(c)), "[ -]+", "_")
    slug = F.regexp_replace(slug, "[^a-z0-9_]+", "")
    return F.regexp_replace(slug, "^([0-9])", "_$1")


def diff_level(diff, level_a="level_a_to", level_b="level_b_to", level_c="level_c_to") -> dict[str, Column]:
    """Band A/B/C/D of a temperature difference, its event level and set value (defaults 10 / 20 / 40)."""
    diff = col(diff)
    a, b, c = (F.coalesce(col(x), F.lit(d)) for x, d in ((level_a, 10.0), (level_b, 20.0), (level_c, 40.0)))
    band = F.when(diff < a, "A").when(diff < b, "B").when(diff < c, "C").when(diff >= c, "D").otherwise("Unknown")
    warns = b + (c - b) * 0.6
    return {
        "diff_level": band,
        "event_level": F.when(band.isin("A", "B"), "Info")
        .when(band == "C", F.when(diff <= warns, "Info").otherwise("Warning"))
        .when(band == "D", "Urgent")
        .otherwise("Error"),
        "set_value": F.when(band == "A", F.lit(0.0)).when(band == "B", a).when(band == "C", b).when(band == "D", c),
    }


def warning_temp_check(tmax, limit) -> dict[str, Column]:
    """Event level of a reading against its warning temperature; no limit is an Info event of its own."""
    tmax, limit = col(tmax), col(limit)
    over = tmax >= limit
    return {
        "event_type": F.when(limit.isNull() | over, "AboveWarning").otherwise("NoIssue"),
        "event_level": F.when(over, "Warning").otherwise("Info"),
        "set_value": limit,
    }
