"""Report queries over the Gold marts. Sorting happens here, not in the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.numeric import TOTAL_MONEY
from tillmark.operators.gold import ITEM_KEYS


# Ties are settled by the columns that name a row, so that a report comes in one order only.


def _by(*columns: str) -> list[Column]:
    return [F.asc_nulls_last(c) for c in columns]


def report_menu_performance(mart: DataFrame) -> DataFrame:
    return mart.orderBy(F.desc_nulls_last("total_revenue"), *_by(*ITEM_KEYS))


def report_location_comparison(mart: DataFrame) -> DataFrame:
    return mart.orderBy(
        *_by("order_year", "order_month"),
        F.desc_nulls_last("total_revenue"),
        *_by("location_id", "location_name"),
    )


def report_revenue_trends(mart: DataFrame) -> DataFrame:
    return mart.orderBy(*_by("location_id", "order_year", "order_month", "location_name"))


def report_time_analysis(mart: DataFrame) -> DataFrame:
    """Site by day and hour, sorted by day name and hour, then site."""
    return (
        mart.groupBy("location_name", "day_name", "order_hour")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_revenue").cast(TOTAL_MONEY).alias("total_revenue"),
        )
        .orderBy(*_by("day_name", "order_hour", "location_name"))
    )
