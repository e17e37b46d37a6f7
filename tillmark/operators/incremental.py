"""Batch selection by high-water mark, and keyed upserts as DataFrame operations.

The mark is a date. A batch holds what is dated strictly after it; rows that arrive later than
their day's batch are not picked up, as the mark has passed them. Where the mark's own day may still
grow, `orders_since` takes that day too, but for the orders that a ledger says are loaded.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.config import SILVER_PARTITIONS


def high_water_mark(orders: DataFrame) -> DataFrame:
    """One row per incrementally loaded table with the latest order date; none without orders."""
    latest = orders.agg(F.max(F.col("order_date").cast("date")).alias("high_water"))
    return (
        latest.filter(F.col("high_water").isNotNull())
        .withColumn("table", F.explode(F.array(F.lit("orders"), F.lit("order_items"))))
        .select("table", "high_water")
    )


def orders_after(orders: DataFrame, mark: date | str | Column | None) -> DataFrame:
    """Orders dated after the mark; all of them where no mark is known yet (None)."""
    if mark is None:
        return orders
    bound = mark if isinstance(mark, Column) else F.lit(str(mark)).cast("date")
    return orders.filter(F.col("order_date").cast("date") > bound)


def orders_since(orders: DataFrame, mark: date | str | None, loaded: DataFrame) -> DataFrame:
    """Orders dated after the mark, and those of the mark's own day that are not in `loaded`.

    `loaded` needs the order ids of the mark's day alone, so only that day's orders are compared: an
    anti-join of a day with a day, whatever the history. An order of that day without an id can't be
    told from a loaded one and stays out.
    """
    if mark is None:
        return orders
    day = F.lit(str(mark)).cast("date")
    same_day = orders.filter(F.col("order_date").cast("date") == day)
    late = same_day.filter(F.col("order_id").isNotNull()).join(
        loaded.select("order_id").distinct(), "order_id", "left_anti"
    )
    return orders_after(orders, mark).unionByName(late.select(*orders.columns))


def items_after(items: DataFrame, orders: DataFrame, mark: date | str | Column | None) -> DataFrame:
    """Lines whose order is dated after the mark; all lines where no mark is known yet.

    A line without an order has no date and falls out. An order listed twice repeats its lines.
    """
    if mark is None:
        return items
    return items.join(orders_after(orders, mark).select("order_id"), "order_id", "inner").select(
        *items.columns
    )


def latest_day(target: DataFrame) -> date | None:
    """The newest order date of a table partitioned by month; None when it is empty.

    Reads the dates of the newest month only; the months themselves are partition values.
    """
    months = target.filter(F.col("order_month").isNotNull()).select(*SILVER_PARTITIONS)
    newest = months.distinct().orderBy(*[F.desc(c) for c in SILVER_PARTITIONS]).first()
    if newest is None:
        return None
    there = [F.col(c) == F.lit(newest[c]) for c in SILVER_PARTITIONS]
    return target.filter(there[0] & there[1]).agg(F.max("order_date")).first()[0]


def silver_delta(orders: DataFrame, target: DataFrame) -> DataFrame:
    """Orders newer than anything in a Silver table; nothing while that is empty.

    With typed orders and Silver orders these are the orders to add. With Silver orders and costed
    lines they are the orders to cost lines for (lines hold no refunds, so a last day of refunds
    only is offered again); their own months then prune the scan.
    """
    day = latest_day(target)
    if day is None:
        return orders.filter(F.lit(False))
    fresh = orders_after(orders, day)
    if set(SILVER_PARTITIONS) <= set(orders.columns):
        year, month = (F.col(c) for c in SILVER_PARTITIONS)
        fresh = fresh.filter((year > day.year) | (year == day.year) & (month >= day.month))
    return fresh


def append_new_columns(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Union by name; a column only one side has is null in the rows of the other."""
    return target.unionByName(batch, allowMissingColumns=True)


def upsert_by_key(target: DataFrame, batch: DataFrame, key: str = "surrogate_key") -> DataFrame:
    """Target rows whose key the batch brings are replaced by the batch's rows; the rest stay.

    The batch's keys are made distinct first, so a key repeated in the batch cannot pile up in
    one task of the join.
    """
    keys = batch.select(key).distinct()
    return append_new_columns(target.join(keys, key, "left_anti").select(*target.columns), batch)
