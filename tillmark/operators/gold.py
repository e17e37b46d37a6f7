"""Gold: aggregates, windows and the four marts.

Raw rows are never shuffled by location or item alone. Groupings with a distinct order count
first meet on (keys, order_id), so a site or item that holds a third of all rows spreads over
all tasks, and only one partial row per task and group moves on.

Everything that reads orders or lines is by month; the marts are made from the monthly figures, as
are all windows. How the nightly run keeps those up to date is in `additive`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillmark.config import MENU_QUADRANTS, ORDER_TYPES, OTHER_QUADRANT
from tillmark.functions.numeric import exact_avg, percent, round2, total

ITEM_KEYS = ("item_id", "item_name", "category", "subcategory", "size")
MONTH_KEYS = ("location_id", "location_name", "order_year", "order_month")
HEATMAP_KEYS = (*MONTH_KEYS, "day_of_week", "day_name", "is_weekend", "order_hour", "day_part")

# Output column of the orders of each type.
TYPE_COLUMNS = dict(zip(ORDER_TYPES, ("dine_in_orders", "takeout_orders", "delivery_orders")))


def not_refunded(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("is_refund") == F.lit(False))


# ---- menu ----------------------------------------------------------------------------------


# Averages of the item figures and what they are taken over.
ITEM_AVERAGES = {
    "avg_margin_pct": "margin_pct", "avg_selling_price": "unit_price", "avg_cost_price": "cost_price",
}


def monthly_items(items: DataFrame) -> DataFrame:
    """Item by month: sums and counts that add up over months, as an order has one month."""
    averaged = {
        name: F.col(column).cast("decimal(18,2)") for name, column in ITEM_AVERAGES.items()
    }
    return items.groupBy(*ITEM_KEYS, "order_year", "order_month").agg(
        F.sum("quantity").alias("total_units_sold"),
        F.countDistinct("order_id").alias("total_orders"),
        total(F.col("line_total")).alias("total_revenue"),
        total(F.col("gross_profit")).alias("total_gross_profit"),
        *[total(c).alias(f"{name}_sum") for name, c in averaged.items()],
        *[F.count(c).alias(f"{name}_n") for name, c in averaged.items()],
    )


def item_stats(monthly: DataFrame) -> DataFrame:
    """Figures of each item over all months."""
    return monthly.groupBy(*ITEM_KEYS).agg(
        F.sum("total_units_sold").alias("total_units_sold"),
        F.sum("total_orders").alias("total_orders"),
        total(F.col("total_revenue")).alias("total_revenue"),
        total(F.col("total_gross_profit")).alias("total_gross_profit"),
        *[
            round2(
                F.try_divide(
                    F.sum(f"{name}_sum").cast("double"), F.sum(f"{name}_n").cast("double")
                )
            ).alias(name)
            for name in ITEM_AVERAGES
        ],
    )


def menu_thresholds(stats: DataFrame) -> DataFrame:
    """One row: average units and average margin over the items."""
    return stats.agg(
        exact_avg(F.col("total_units_sold")).alias("avg_units"),
        exact_avg(F.col("avg_margin_pct").cast("decimal(18,2)")).alias("avg_margin"),
    )


def classify_menu(stats: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Places each item in the popularity/margin quadrants.

    The one threshold row enters as scalar subqueries, so no join is planned for it.
    """
    placed = stats.withColumns(
        {
            "avg_units": thresholds.select("avg_units").scalar(),
            "avg_margin": thresholds.select("avg_margin").scalar(),
        }
    )
    popular = F.col("total_units_sold") >= F.col("avg_units")
    profitable = F.col("avg_margin_pct") >= F.col("avg_margin")
    placement = F.struct(*[F.lit(text).alias(f"_{i}") for i, text in enumerate(OTHER_QUADRANT)])
    for is_popular, is_profitable, name, advice in MENU_QUADRANTS:
        there = (popular == F.lit(is_popular)) & (profitable == F.lit(is_profitable))
        placement = F.when(
            there, F.struct(F.lit(name).alias("_0"), F.lit(advice).alias("_1"))
        ).otherwise(placement)
    return placed.withColumns(
        {"menu_class": placement["_0"], "recommendation": placement["_1"]}
    )


def mart_menu_performance(stats: DataFrame) -> DataFrame:
    """The menu matrix of item figures. Thresholds and classes both read them, so they had better
    be a stored table: computed on the fly they take two passes over all lines."""
    return classify_menu(stats, menu_thresholds(stats))


# ---- locations -----------------------------------------------------------------------------


def order_profit(items: DataFrame) -> DataFrame:
    """Profit and average line margin of each order."""
    return items.groupBy("order_id").agg(
        total(F.col("gross_profit")).alias("gross_profit"),
        exact_avg(F.col("margin_pct").cast("decimal(18,2)")).alias("margin_pct"),
    )


def join_preaggregated(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders with the profit of their lines; aggregated first, so order totals do not fan out."""
    return orders.join(order_profit(items), "order_id", "left")


def monthly_locations(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Site by month figures of the location mart, without the share.

    Four distinct counts in one grouping would make Spark repeat every row four times. Here the
    rows of an order within a group meet first (the join has already put them together), carrying
    sums and counts so that repeated order ids keep their weight; then orders are counted.
    """
    sums = ("total_amount", "discount_amount", "gross_profit")
    # The average of an order is a double; a fixed ten places keep the sum free of order effects.
    margin = F.col("margin_pct").cast("decimal(20,10)")
    per_order = (
        join_preaggregated(not_refunded(orders), items)
        .groupBy(*MONTH_KEYS, "order_id")
        .agg(
            *[F.sum(c).alias(c) for c in sums],
            F.count("total_amount").alias("tickets"),
            F.sum(margin).alias("margin"),
            F.count(margin).alias("margins"),
            *[
                F.bool_or(F.col("order_type") == F.lit(t)).alias(c)
                for t, c in TYPE_COLUMNS.items()
            ],
        )
    )
    return per_order.groupBy(*MONTH_KEYS).agg(
        F.count("order_id").alias("total_orders"),
        total(F.col("total_amount")).alias("total_revenue"),
        round2(
            F.try_divide(F.sum("total_amount").cast("double"), F.sum("tickets").cast("double"))
        ).alias("avg_ticket"),
        total(F.col("discount_amount")).alias("total_discounts"),
        total(F.col("gross_profit")).alias("total_gross_profit"),
        round2(
            F.try_divide(F.sum("margin").cast("double"), F.sum("margins").cast("double"))
        ).alias("avg_margin_pct"),
        *[F.count_if(F.col(c)).alias(c) for c in TYPE_COLUMNS.values()],
    )


def month_total() -> Column:
    """Revenue of all sites in the row's month."""
    return F.sum("total_revenue").over(Window.partitionBy("order_year", "order_month"))


def revenue_share(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn(
        "revenue_share_pct", percent(F.col("total_revenue"), month_total())
    )


def mart_location_comparison(monthly: DataFrame) -> DataFrame:
    return revenue_share(monthly)


# ---- trends and heatmap --------------------------------------------------------------------


def sales_by(orders: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Orders, revenue, discounts and average ticket of unrefunded orders per group."""
    return not_refunded(orders).groupBy(*keys).agg(
        F.countDistinct("order_id").alias("total_orders"),
        total(F.col("total_amount")).alias("total_revenue"),
        total(F.col("discount_amount")).alias("total_discounts"),
        round2(exact_avg(F.col("total_amount"))).alias("avg_ticket"),
    )


def monthly_revenue(orders: DataFrame) -> DataFrame:
    return sales_by(orders, MONTH_KEYS)


# A renamed site has two rows in a month; in both windows the name settles their order.


def _site_months() -> WindowSpec:
    return Window.partitionBy("location_id").orderBy("order_year", "order_month", "location_name")


def _site_year_to_date() -> WindowSpec:
    return (
        Window.partitionBy("location_id", "order_year")
        .orderBy("order_month", "location_name")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def prev_month_revenue(monthly: DataFrame) -> DataFrame:
    """Revenue of the site's previous row; months without sales are not filled in."""
    return monthly.withColumn("prev_month_revenue", F.lag("total_revenue").over(_site_months()))


def mom_growth(monthly: DataFrame) -> DataFrame:
    before = F.col("prev_month_revenue")
    return prev_month_revenue(monthly).withColumn(
        "mom_growth_pct", percent(F.col("total_revenue") - before, before)
    )


def ytd_revenue(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("ytd_revenue", F.sum("total_revenue").over(_site_year_to_date()))


def all_locations_revenue(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("all_locations_revenue", month_total())


def mart_revenue_trends(monthly: DataFrame) -> DataFrame:
    return all_locations_revenue(ytd_revenue(mom_growth(monthly)))


def mart_time_analysis(orders: DataFrame) -> DataFrame:
    """Monthly by itself: the month is one of its keys."""
    return sales_by(orders, HEATMAP_KEYS)
