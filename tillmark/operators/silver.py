"""Silver: enriched orders and costed order lines."""

from __future__ import annotations

import time
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.config import LOCATION_CODES, WEEKEND_DAYS
from tillmark.functions.calendar import calendar_parts, clock_hour, day_part
from tillmark.functions.keys import surrogate_key
from tillmark.functions.numeric import LINE_MONEY, percent


IDS = {"stg_orders": "order_id", "stg_order_items": "order_item_id"}


def stg_orders(
    orders: DataFrame,
    locations: Iterable[str] = LOCATION_CODES,
    weekend: Iterable[int] = WEEKEND_DAYS,
) -> DataFrame:
    """Typed orders of the known locations with key, calendar and day-part columns.

    Refunds stay in, flagged.
    """
    parts = calendar_parts(F.col("order_date"), weekend)
    known = orders.filter(F.col("order_id").isNotNull() & F.col("location_id").isin(*locations))
    return known.withColumn("order_hour", clock_hour(F.col("order_time"))).select(
        surrogate_key(F.col("order_id")).alias("surrogate_key"),
        "order_id",
        "location_id",
        "location_name",
        "order_date",
        "order_time",
        *[column.alias(name) for name, column in parts.items()],
        "order_hour",
        day_part(F.col("order_hour")).alias("day_part"),
        "order_type",
        "cashier_id",
        "subtotal",
        "discount_amount",
        "tax_amount",
        "total_amount",
        "payment_method",
        "is_refund",
    )


def join_items_orders(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines with the site, date and refund flag of their order. Large to large, on order_id."""
    header = orders.select("order_id", "location_id", "location_name", "order_date", "is_refund")
    return items.join(header, "order_id", "inner")


def join_items_menu(items: DataFrame, menu: DataFrame) -> DataFrame:
    """Lines with cost and subcategory of their item, null where the item is not on the menu.

    No broadcast hint: a menu is small, but nothing bounds it. Spark broadcasts it while its
    measured size is under the session's threshold and sorts and merges (splitting hot items)
    beyond.
    """
    return items.join(menu.select("item_id", "subcategory", "cost_price"), "item_id", "left")


def line_margin(lines: DataFrame, cost: str = "cost_price") -> DataFrame:
    """Adds total_cost, gross_profit and margin_pct.

    Lines that brought in nothing have margin 0; otherwise an unknown cost leaves all three null.
    """
    spent: Column = F.col(cost) * F.col("quantity")
    profit = (F.col("line_total") - spent).cast(LINE_MONEY)
    return lines.withColumns(
        {
            "total_cost": spent.cast(LINE_MONEY),
            "gross_profit": profit,
            "margin_pct": F.when(
                F.col("line_total") > 0, percent(profit, F.col("line_total"))
            ).otherwise(F.lit(0.0)),
        }
    )


def stg_order_items(items: DataFrame, orders: DataFrame, menu: DataFrame) -> DataFrame:
    """Costed lines of orders that are not refunds.

    `orders` is Silver orders, `items` and `menu` are typed views. Both filters run before the
    joins, so refunds and empty lines are not shuffled.
    """
    sold = items.filter(F.col("quantity") > 0)
    kept = orders.filter(F.col("is_refund") == F.lit(False))
    lines = line_margin(join_items_menu(join_items_orders(sold, kept), menu))
    return lines.select(
        surrogate_key(F.col("order_item_id")).alias("surrogate_key"),
        "order_item_id",
        "order_id",
        "location_id",
        "location_name",
        "order_date",
        "is_refund",
        "item_id",
        "item_name",
        "category",
        "subcategory",
        "size",
        "quantity",
        "unit_price",
        "cost_price",
        "total_cost",
        "discount_applied",
        "line_total",
        "gross_profit",
        "margin_pct",
        "promo_id",
    )


def derived(table: str) -> dict[str, Column]:
    """The key of a Silver table, which follows from the rows' ids."""
    return {"surrogate_key": surrogate_key(F.col(IDS[table]))}


def stamped(
    df: DataFrame, name: str = "_transformed_at", at: Column | None = None
) -> DataFrame:
    """Adds the audit timestamp, one value for the whole run."""
    return df.withColumn(name, F.current_timestamp() if at is None else at)


def this_moment() -> Column:
    """A timestamp for rows that are written in several parts."""
    return F.timestamp_micros(F.lit(time.time_ns() // 1000))


def by_month(lines: DataFrame) -> DataFrame:
    """Adds the year and month of the order date, by which Silver is partitioned."""
    return lines.withColumns(
        {"order_year": F.year("order_date"), "order_month": F.month("order_date")}
    )
