import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import calendar, casts, geo, masks


def test_safe_cast_never_raises(spark):
    df = spark.createDataFrame(
        [("2024-01-31", "1.5", "7", "true"), ("2024-02-30", "abc", "7.5x", "maybe"), (None, None, None, None)],
        "d string, x string, i string, b string")
    out = df.select(
        casts.safe_cast("d", "date").alias("d"), casts.safe_cast("x", "double").alias("x"),
        casts.safe_cast("i", "int").alias("i"), casts.safe_cast("b", "boolean").alias("b"),
        casts.safe_cast("d", "timestamp").alias("t")).collect()
    assert tuple(out[0])[:4] == (dt.date(2024, 1, 31), 1.5, 7, True)
    assert tuple(out[1]) == (None, None, None, None, None)
    assert tuple(out[2]) == (None, None, None, None, None)


def test_percent_of_nothing_is_zero(spark):
    row = spark.range(1).select(casts.percent(F.lit(0), F.lit(0), 2).alias("p")).first()
    assert row.p == 0.0


def test_partition_month_layouts(spark):
    paths = [
        ("file:/x/transactions/2026/07/data.csv", "2026-07"),
        ("s/transactions/txn_year=2025/txn_month=01/part-0.csv", "2025-01"),
        ("s/logs/year=2025/month=11/day=03/part-0.json", "2025-11"),
        ("s/transactions/daily_drops/txn_date=2024-12-31/part-0.csv", "2024-12"),
        ("s/transactions/full_load/part-0.csv", None),
        ("s/customers/20/07/data.csv", None),
    ]
    df = spark.createDataFrame(paths, "p string, want string")
    for row in df.select("want", calendar.partition_month("p").alias("got")).collect():
        assert row.got == row.want


def test_bucketize_edges_are_inclusive(spark):
    df = spark.createDataFrame([(1,), (2,), (7,), (8,), (366,), (None,)], "x int")
    got = [r.b for r in df.select(calendar.bucketize("x", (1, 7, 365), ("a", "b", "c", "d")).alias("b")).collect()]
    assert got == ["a", "b", "b", "c", "d", None]


def test_age_at_birthdays_and_month_ends(spark):
    today = F.lit("2024-02-29").cast("date")
    df = spark.createDataFrame([("2006-02-28",), ("2006-03-01",), ("2006-02-27",)], "d string")
    ages = [r.a for r in df.select((calendar.age_years(F.col("d").cast("date"), today) < 18).alias("a")).collect()]
    # The last days of both months count as the same day.
    assert ages == [False, True, False]


def test_haversine_known_and_antipodal(spark):
    df = spark.createDataFrame([(52.52, 13.405, 48.8566, 2.3522), (0.0, 0.0, 0.0, 180.0), (1.0, 2.0, 1.0, 2.0),
                                (90.0, 0.0, -90.0, 0.0)], "a double, b double, c double, d double")
    got = [r.x for r in df.select(geo.haversine_km(*[F.col(c) for c in "abcd"]).alias("x")).collect()]
    assert abs(got[0] - 877.46) < 0.5
    assert abs(got[1] - 20015.09) < 0.1 and abs(got[3] - 20015.09) < 0.1
    assert got[2] == 0.0


def test_elapsed_has_a_floor_of_one_second(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.9", "2024-01-01 00:00:00.1"),
                                ("2024-01-01 01:00:00", "2024-01-01 00:00:00")], "a string, b string")
    got = [r.h for r in df.select(geo.elapsed_hours(
        F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")).alias("h")).collect()]
    assert got == [1 / 3600.0, 1.0]


def test_masking_by_level(spark):
    df = spark.createDataFrame([("c1", "Ann", "shop", (1.5, "Rome")), ("c2", None, None, None)],
                               "customer_id string, full_name string, merchant_name string, geo struct<lat double, city string>")
    out = masks.mask_pii(df, {"customer_id": "Medium", "full_name": "High", "merchant_name": "Low",
                              "geo.lat": "High", "geo.city": "Medium", "absent": "High"})
    assert out.schema["geo"].dataType == df.schema["geo"].dataType
    first, second = out.orderBy("merchant_name", ascending=False).collect()
    assert len(first.customer_id) == 64 and first.full_name is None and first.merchant_name == "shop"
    assert first.geo.lat is None and len(first.geo.city) == 64
    assert second.geo is None
