from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelwise.functions import bands, dates, numbers, text


def values(spark, expr, rows, ddl):
    return [r[0] for r in spark.createDataFrame(rows, ddl).select(expr).collect()]


def test_lateness_bucket_boundaries(spark):
    got = values(spark, bands.lateness_bucket(F.col("d")),
                 [(d,) for d in (-8, -7, -1, 0, 1, 3, 4, 7, 8, 15, 16, None)], "d int")
    assert [g[0] for g in got] == list("122344556" + "67N")


def test_weight_band_boundaries(spark):
    got = values(spark, bands.weight_band(F.col("g")),
                 [(g,) for g in (None, 499, 500, 1999, 2000, 9999, 10000)], "g int")
    assert [g[0] for g in got] == list("U122334")


@pytest.mark.parametrize("cell, label", [
    ((4, 3, 4), "1"), ((4, 2, 4), "2"), ((3, 5, 5), "2"), ((2, 5, 4), "3"),
    ((5, 2, 3), "4"), ((2, 5, 2), "5"), ((3, 3, 3), "6"), ((4, 3, 3), "6"),
])
def test_segment_rules_apply_in_order(spark, cell, label):
    r, f, m = (F.lit(x) for x in cell)
    assert spark.range(1).select(bands.rfm_segment(r, f, m)).first()[0].startswith(label)


def test_stage_days_counts_complete_hours(spark):
    rows = [("2018-01-01 10:50:00", "2018-01-01 12:00:00"),
            ("2018-01-01 12:00:00", "2018-01-01 10:50:00"),
            ("2018-01-01 00:00:00", "2018-01-02 12:00:00"), (None, "2018-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert [r[0] for r in df.select(dates.stage_days("a", "b")).collect()] == [
        0.042, -0.042, 1.5, None]


def test_sunday_weeks(spark):
    days = [date(2017, 1, 1), date(2016, 1, 1), date(2016, 1, 3), date(2018, 12, 31),
            date(2017, 12, 30), date(2017, 12, 31), date(2018, 1, 6), date(2018, 1, 7)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = df.select(dates.sunday_week(F.col("d")), dates.week_start(F.col("d"))).collect()
    assert [r[0] for r in got] == [int(d.strftime("%U")) for d in days]
    assert all(r[1].isoweekday() == 7 and 0 <= (d - r[1]).days < 7 for d, r in zip(days, got))


def test_rounding_is_half_up_on_the_decimal_value(spark):
    got = values(spark, numbers.fixed("x", 2), [(61.725,), (2.675,), (-1.005,), (None,)],
                 "x double")
    assert got == [61.73, 2.68, -1.01, None]


def test_ratio_mean_and_tally(spark):
    df = spark.createDataFrame([(1, True), (2, False), (None, None)], "x int, b boolean")
    r = df.agg(numbers.mean("x", 2), numbers.mean_if(~F.col("b"), "x"), numbers.tally("b"),
               numbers.safe_ratio(F.sum("x"), F.lit(0)),
               numbers.floored_ratio(F.sum("x"), F.lit(0))).first()
    assert tuple(r) == (1.5, 2.0, 1, None, 3.0)


def test_keys_and_routes(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 1)], "s string, n int")
    got = df.select(text.composite_key("s", "n"), text.route_label(F.col("s"), F.lit(None)),
                    text.same_place(F.col("s"), F.lit(None).cast("string"))).collect()
    assert [tuple(r) for r in got] == [("a-1", "a -> ??", False), (None, "a -> ??", False),
                                      (None, "?? -> ??", True)]


def test_text_normalisation(spark):
    names = spark.createDataFrame([("ji-parana d'oeste (SP)",), (None,)], "s string")
    assert [r[0] for r in names.select(text.title_name("s")).collect()] == [
        "Ji-Parana D'oeste (Sp)", None]
    df = spark.createDataFrame([("  AbC dE ",)], "s string")
    r = df.select(text.lower_code("s"), text.upper_code("s"), text.title_name("s"),
                  text.has_text("s"), text.has_text(F.lit("  "))).first()
    assert tuple(r) == ("abc de", "ABC DE", "Abc De", True, False)
