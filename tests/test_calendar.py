import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillmark.functions.calendar import calendar_parts, clock_hour, clock_text, day_part


def parts_of(spark, *days, **kwargs):
    df = spark.createDataFrame([(d,) for d in days], "d string").withColumn(
        "d", F.col("d").cast("date")
    )
    columns = calendar_parts(F.col("d"), **kwargs)
    return [r for r in rows(df.select(*[c.alias(n) for n, c in columns.items()]))]


def test_day_numbers_names_and_weekend(spark):
    # 2024-03-03 is a Sunday
    week = parts_of(spark, *[f"2024-03-0{d}" for d in range(3, 10)])
    assert [p["day_of_week"] for p in week] == [0, 1, 2, 3, 4, 5, 6]
    assert [p["day_name"] for p in week] == [
        "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"
    ]
    assert [p["is_weekend"] for p in week] == [False] * 5 + [True] * 2


def test_weekend_is_a_parameter(spark):
    saturday, sunday = parts_of(spark, "2024-03-09", "2024-03-10", weekend=(6, 0))
    assert saturday["is_weekend"] and sunday["is_weekend"]


def test_iso_week_at_year_end(spark):
    (last,) = parts_of(spark, "2024-12-30")
    assert (last["order_year"], last["order_month"], last["order_week"]) == (2024, 12, 1)


def test_missing_date(spark):
    (p,) = parts_of(spark, None)
    assert p["day_name"] is None and p["order_year"] is None and p["is_weekend"] is False


@pytest.mark.parametrize(
    ("time", "part"),
    [
        ("00:00:00", "Late Night"), ("10:59:59", "Late Night"), ("11:00:00", "Lunch"),
        ("14:59:59", "Lunch"), ("15:00:00", "Afternoon"), ("16:59:59", "Afternoon"),
        ("17:00:00", "Dinner"), ("21:59:59", "Dinner"), ("22:00:00", "Late Night"),
        (None, "Late Night"),
    ],
)
def test_day_part_edges(spark, time, part):
    df = spark.createDataFrame([(time,)], "t string").select(
        day_part(clock_hour(clock_text(F.col("t")))).alias("p")
    )
    assert rows(df) == [{"p": part}]


def test_clock_text_normalises_and_rejects(spark):
    df = spark.createDataFrame([("9:05:00",), ("09:05:07",), ("18:30",), (None,)], "t string")
    got = [r["c"] for r in rows(df.select(clock_text(F.col("t")).alias("c")))]
    assert got == ["09:05:00", "09:05:07", "18:30:00", None]
    bad = spark.createDataFrame([("25:00:00",)], "t string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.select(clock_text(F.col("t"))).collect()
