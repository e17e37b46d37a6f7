"""Typed views over Bronze: columns picked and cast by name, from text or from typed input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.functions.calendar import clock_text
from tillmark.functions.numeric import MONEY


def whole_number(name: str) -> Column:
    """Integer cast that also takes '2.0', as an export writes a column that has gaps."""
    return F.rint(F.col(name).cast("double")).cast("int")


def money(name: str) -> Column:
    return F.col(name).cast(MONEY)


def _ingested(raw: DataFrame) -> list[str]:
    """When Bronze loaded the row, where the rows come from Bronze."""
    return ["_ingested_at"] if "_ingested_at" in raw.columns else []


def src_orders(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_id",
        "location_id",
        "location_name",
        F.col("order_date").cast("date").alias("order_date"),
        clock_text(F.col("order_time")).alias("order_time"),
        "order_type",
        "cashier_id",
        *[money(c).alias(c) for c in ("subtotal", "discount_amount", "tax_amount", "total_amount")],
        "payment_method",
        F.col("is_refund").cast("boolean").alias("is_refund"),
        *_ingested(raw),
    )


def src_order_items(raw: DataFrame) -> DataFrame:
    return raw.select(
        "order_item_id",
        "order_id",
        "item_id",
        "item_name",
        "category",
        "size",
        whole_number("quantity").alias("quantity"),
        *[money(c).alias(c) for c in ("unit_price", "discount_applied", "line_total")],
        "promo_id",
        *_ingested(raw),
    )


def src_menu(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("item_id").isNotNull()).select(
        "item_id",
        "item_name",
        "category",
        "subcategory",
        "size",
        money("selling_price").alias("price"),
        money("cost_price").alias("cost_price"),
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def src_locations(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("location_id").isNotNull()).select(
        "location_id",
        "location_name",
        "address",
        whole_number("seating_capacity").alias("seating_capacity"),
        F.col("opening_date").cast("date").alias("opened_date"),
        "manager_name",
        "phone",
        F.col("is_active").cast("boolean").alias("is_active"),
    )


def src_promotions(raw: DataFrame) -> DataFrame:
    return raw.select(
        "promo_id",
        "promo_name",
        "discount_type",
        money("discount_value").alias("discount_value"),
        "applies_to",
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        "location_id",
        "day_of_week",
    )


def src_menu_price_history(raw: DataFrame) -> DataFrame:
    return raw.select(
        "price_history_id",
        "item_id",
        money("selling_price").alias("selling_price"),
        money("cost_price").alias("cost_price"),
        F.col("effective_from").cast("date").alias("effective_from"),
        F.col("effective_to").cast("date").alias("effective_to"),
        F.col("is_current").cast("boolean").alias("is_current"),
        "change_reason",
    )
