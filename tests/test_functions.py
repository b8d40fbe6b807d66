"""Scalar column functions against hand-checked fixtures."""

import datetime as dt
import math

from pyspark.sql import functions as F

from tabcast.functions.dates import date_features, parse_mixed, parse_strict
from tabcast.functions.location import parse_location
from tabcast.functions.mathx import (
    clamp_min,
    guarded_ratio,
    inverse_target,
    physical_features,
    shift_log,
    true_false_code,
    yes_no_code,
)


def test_parse_location_cases(spark):
    rows = [
        (1, "12 Main St, Springfield, IL 62704"),
        (2, "PSC 1234, Box 5, APO AE 09012"),
        (3, "USNS Ship, fpo AP 96543"),
        (4, None),
        (5, "Missing"),
        (6, "12345 Harbor Rd, no state"),
        (7, "Apo street 1, ZZ 1234"),
    ]
    df = spark.createDataFrame(rows, "id int, Hospital_Location string")
    got = {r.id: (r.Location_State, r.Location_Zip, r.Location_Is_Military)
           for r in parse_location(df).collect()}
    assert got[1] == ("IL", "62704", 0)
    assert got[2] == ("AE", "09012", 1)
    assert got[3] == ("AP", "96543", 1)  # lower-case fpo counts, AP as a word counts
    assert got[4] == ("Missing", "Missing", 0)
    assert got[5] == ("Missing", "Missing", 0)
    assert got[6] == ("Missing", "12345", 0)  # a five-digit house number is taken as the zip
    assert got[7] == ("Missing", "Missing", 1)  # 'Apo' as a word, any case


def test_strict_date_two_digit_year_pivot(spark):
    df = spark.createDataFrame([("01/05/95",), ("01/05/24",), ("13/45/99",), (None,), ("01/05/69",), ("01/05/68",)],
                               "s string")
    got = [r.d for r in df.select(parse_strict("s").alias("d")).collect()]
    assert got == [dt.date(1995, 1, 5), dt.date(2024, 1, 5), None, None, dt.date(1969, 1, 5), dt.date(2068, 1, 5)]


def test_mixed_date_parse(spark):
    df = spark.createDataFrame([("03/04/95",), ("03/04/1995",), ("1995-03-04",), ("junk",)], "s string")
    got = [r.d for r in df.select(parse_mixed("s").alias("d")).collect()]
    assert got == [dt.date(1995, 3, 4)] * 3 + [None]


def test_date_features_weekday_and_lead(spark):
    df = spark.createDataFrame([("01/01/24", "01/08/24"), ("01/08/24", "01/01/24")],
                               "Order_Placed_Date string, Delivery_Date string")
    r = date_features(df).collect()
    assert r[0].Order_DayOfWeek == 0.0  # 2024-01-01 is a Monday
    assert r[0].Delivery_Time == 7.0 and r[1].Delivery_Time == -7.0
    assert r[0].Order_Quarter == 1.0 and "Order_Placed_Date" not in df.select("*").drop("Order_Placed_Date").columns


def test_guarded_ratio_three_valued(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0), (1.0, None), (None, 2.0), (1.0, -1.0)], "a double, b double")
    got = [r.r for r in df.select(guarded_ratio("a", "b").alias("r")).collect()]
    assert got == [0.5, 0.0, 0.0, None, 0.0]


def test_physical_features(spark):
    df = spark.createDataFrame([(2.0, 3.0, 12.0, 24.0)],
                               "Equipment_Height double, Equipment_Width double, Equipment_Weight double, "
                               "Equipment_Value double")
    r = physical_features(df).first()
    assert (r.Equipment_Area, r.Weight_per_Area, r.Value_per_Weight, r.Value_per_Area) == (6.0, 2.0, 2.0, 4.0)


def test_shift_log_roundtrip(spark):
    df = spark.createDataFrame([(1, -5.0), (2, 10.0), (3, 0.0)], "k int, y double")
    out = shift_log(df, "y", "ly").withColumn("back", inverse_target("ly", F.col("Target_Shift_Value")))
    rows = out.collect()
    assert all(r.Target_Shift_Value == 6.0 for r in rows)
    for r in rows:
        assert math.isclose(r.back, r.y, abs_tol=1e-9)
        assert math.isclose(r.ly, math.log1p(r.y + 6.0))
    pos = spark.createDataFrame([(1, 5.0)], "k int, y double")
    assert shift_log(pos, "y").first().Target_Shift_Value == 0.0


def test_flag_codes_and_clamp(spark):
    df = spark.createDataFrame([("Yes",), ("No",), ("Missing",), ("maybe",), (None,)], "f string")
    got = [(r.a, r.b) for r in df.select(yes_no_code("f").alias("a"), true_false_code("f").alias("b")).collect()]
    assert got == [(1, 1), (0, 0), (-1, None), (None, None), (None, None)]
    b = spark.createDataFrame([(True,), (False,)], "f boolean").select(true_false_code("f").alias("c")).collect()
    assert [r.c for r in b] == [1, 0]
    c = spark.createDataFrame([(-3.0,), (2.0,)], "x double").select(clamp_min("x").alias("c")).collect()
    assert [r.c for r in c] == [0.0, 2.0]
