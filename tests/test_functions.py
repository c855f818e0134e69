"""Scalar functions, golden values and edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millstream.functions import cleaning as c
from millstream.functions import timekeys as tk
from millstream.functions.spc_constants import spc_coefficients
from millstream.functions.wallclock import bucket_start, us_to_ntz, wall_us


def one(spark, *cols):
    return spark.range(1).select(*[x.alias(f"c{i}") for i, x in enumerate(cols)]).collect()[0]


def test_surrogate_key_golden(spark):
    rows = [("a", "b", "c"), ("a", "", "c"), (None, None, "c"), (None, None, None)]
    df = spark.createDataFrame(rows, "x string, y string, z string")
    first = [r[0] for r in df.select(c.surrogate_key("x")).collect()]
    every = [r[0] for r in df.select(c.surrogate_key("x", "y", "z")).collect()]
    assert first[0] == "0cc175b9c0f1b6a831c399e269772661"
    assert first[2] == "f14cc5cdce0420f4a5a6b6d9d7b85f39"
    assert every[0] == "7b193b3d33184464106f41ddf733783b"
    assert every[3] == "2fa5491950d66d153d23cfbcfea4e164"


@pytest.mark.parametrize("amount,bucket", [(190000.0, 0), (290000.0, 1), (399999.99, 2), (400000.0, 3), (600000.0, 5)])
def test_width_bucket_golden(spark, amount, bucket):
    assert one(spark, c.width_bucket(F.lit(amount), 200000.0, 600000.0, 4))[0] == bucket


def test_haversine_golden(spark):
    args = [F.lit(x) for x in (48.864716, 2.349014, 52.379189, 4.899431)]
    km, mi = one(spark, c.haversine(*args, unit="km"), c.haversine(*args))
    assert (round(km), round(mi)) == (430, 267)


def test_url_parts_golden(spark):
    bare = F.lit("www.google.co.uk?utm_source=google&utm_medium=cpc")
    full = F.lit("http://witanddelight.com/2018/01/tips/?a=1")
    row = one(spark, c.url_host(bare), c.url_path(bare), c.url_host(full), c.url_path(full), c.url_parameter(bare, "utm_medium"))
    assert tuple(row) == ("www.google.co.uk", "", "witanddelight.com", "2018/01/tips/", "cpc")


def test_safe_divide_golden(spark):
    none = F.lit(None).cast("double")
    row = one(spark, c.safe_divide(F.lit(6.0), F.lit(0.0)), c.safe_divide(F.lit(10.0), F.lit(5.0)), c.safe_divide(F.lit(17.0), none))
    assert tuple(row) == (None, 2.0, None)


def test_slugify(spark):
    row = one(spark, *[c.slugify(F.lit(x)) for x in ("venmo App", "ca$h-money", "1337pay")])
    assert tuple(row) == ("venmo_app", "cah_money", "_1337pay")


def test_padding_never_truncates(spark):
    assert tuple(one(spark, c.zero_pad(F.lit("7"), 2), c.zero_pad(F.lit("123"), 2))) == ("07", "123")


def test_station_and_tag(spark):
    row = one(spark, *c.split_station(F.lit("IPI-03-02-L")), *c.split_station(F.lit("alone")), *c.split_tag(F.lit("st_1_Plate Temperature_UR")))
    assert tuple(row) == ("02", "L", None, None, "st_1", "Plate Temperature_UR")


def test_status_suffix(spark):
    assert tuple(one(spark, c.suffix_status_map(F.lit("A동 입고")), c.suffix_status_map(F.lit("??")))) == ("I", None)


def test_bitstring_short(spark):
    assert tuple(one(spark, c.bitstring_alarm(F.lit("011"), 2), c.bitstring_alarm(F.lit("011"), 9), c.bitstring_alarm(F.lit(None).cast("string"), 1))) == ("1", "0", "0")


@pytest.mark.parametrize(
    "text,shift",
    [
        ("2024-01-01 06:29", None),  # Monday before the start: Sunday's night has no shift
        ("2024-01-01 06:30", 1),
        ("2024-01-02 06:29", 3),
        ("2024-01-04 22:30", 3),
        ("2024-01-05 14:45", 1),
        ("2024-01-05 22:29", 2),
        ("2024-01-06 06:00", 3),
        ("2024-01-06 11:30", 2),
        ("2024-01-06 21:30", None),
        ("2024-01-07 12:00", None),
    ],
)
def test_cycle_shift(spark, text, shift):
    assert one(spark, tk.shift_of_timestamp(tk.as_ntz(text)))[0] == shift


def test_friday_calendars_differ(spark):
    at = tk.as_ntz("2024-01-05 22:45")
    assert tuple(one(spark, tk.shift_of_timestamp(at, "cycle"), tk.shift_of_timestamp(at, "productivity"))) == (3, 2)


def test_shift_window_quirks(spark):
    start, end, day = one(spark, *tk.shift_window(tk.as_ntz("2024-01-05 23:10")))
    assert (start, end, day) == (dt.datetime(2024, 1, 5, 22, 30), dt.datetime(2024, 1, 6, 6, 30), dt.date(2024, 1, 5))
    assert tuple(one(spark, *tk.shift_window(tk.as_ntz("2024-01-07 10:00")))) == (None, None, dt.date(2024, 1, 7))


@pytest.mark.parametrize(
    "key,start,end",
    [
        ("2024", "2024-01-01", "2025-01-01"),
        ("202412", "2024-12-01", "2025-01-01"),
        ("2024-02", "2024-02-01", "2024-03-01"),
        ("20240229", "2024-02-29", "2024-03-01"),
        ("2024-02-29T10:15", "2024-02-29 10:15:00", "2024-02-29 10:16:00"),
        ("nonsense", None, None),
    ],
)
def test_date_key_range(spark, key, start, end):
    got = one(spark, *[x.cast("string") for x in tk.date_key_range(F.lit(key))])
    want = [None if x is None else x if ":" in x else f"{x} 00:00:00" for x in (start, end)]
    assert list(got) == want


def test_wall_clock_ignores_zone(spark):
    text = "2024-03-10 02:30:00.123456"  # does not exist in New York
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        us, back, bucket = one(spark, wall_us(tk.as_ntz(text)), us_to_ntz(wall_us(tk.as_ntz(text))), bucket_start(tk.as_ntz(text), "10 minutes"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert us == 1710037800123456
    assert back == dt.datetime(2024, 3, 10, 2, 30, 0, 123456) and bucket == dt.datetime(2024, 3, 10, 2, 30)


def test_coefficients():
    five = spc_coefficients(5)
    assert (round(five.a2, 3), round(five.d4_limit, 3), five.d3_limit) == (0.577, 2.114, 0)
    assert spc_coefficients(30).a2 == 0 and spc_coefficients(30).a3 > 0
