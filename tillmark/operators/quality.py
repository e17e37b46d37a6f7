"""The quality gate and the table assertions, as violation counts.

Every table is scanned once for its row-wise checks. Duplicate ids need a shuffle of the ids, so
they are counted apart, over that one column, instead of sending all counters along with each id.
Lines off the menu are found from counts per item, which carry the counters of the row checks.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.config import MENU_CLASSES, QualityRules
from tillmark.functions.numeric import ratio


def number(name: str) -> Column:
    """A raw amount as a double: the gate sees amounts as exported, not rounded to cents."""
    return F.col(name).cast("double")


def order_checks(rules: QualityRules) -> dict[str, Column]:
    sale = F.col("is_refund").cast("boolean") == F.lit(False)
    day = F.col("order_date").cast("date")
    gap = F.abs(number("total_amount") - number("subtotal") - number("tax_amount"))
    return {
        "orders_no_null_order_id": F.col("order_id").isNull(),
        "orders_no_null_location": F.col("location_id").isNull(),
        "orders_valid_locations": ~F.col("location_id").isin(*rules.locations),
        "orders_valid_order_types": ~F.col("order_type").isin(*rules.order_types),
        "orders_tax_positive": (number("tax_amount") < 0) & sale,
        "orders_total_matches_subtotal": (gap > rules.total_tolerance) & sale,
        "orders_no_future_dates": day > F.lit(rules.last_day).cast("date"),
        "orders_date_range_valid": day < F.lit(rules.first_day).cast("date"),
        "orders_not_on_closed_days": day.isin(
            *[F.lit(d).cast("date") for d in rules.closed_days]
        ),
    }


def item_checks(rules: QualityRules) -> dict[str, Column]:
    price = number("unit_price")
    return {
        "items_no_null_order_id": F.col("order_id").isNull(),
        "items_quantity_positive": number("quantity") <= 0,
        "items_price_in_range": (price < rules.lowest_price) | (price > rules.highest_price),
        "items_no_null_item_id": F.col("item_id").isNull(),
    }


def menu_checks(rules: QualityRules) -> dict[str, Column]:
    cost, price = number("cost_price"), number("selling_price")
    return {
        "menu_47_items": F.lit(True),  # counts the rows
        "menu_cost_lt_price": cost >= price,
        "menu_food_cost_reasonable": ratio(cost, price) > rules.highest_cost_ratio,
    }


@dataclass(frozen=True)
class Check:
    """A caller's own check of a table: rows that meet the condition are counted, and the count
    must equal `expected`, or with `at_most` not exceed it."""

    table: str  # orders, order_items or menu
    name: str
    condition: Column
    expected: int = 0
    at_most: bool = False


def of_table(checks: Iterable[Check], table: str) -> list[Check]:
    return [c for c in checks if c.table == table]


def count_violations(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, result) rows from one aggregation over the table."""
    counted = df.agg(*[F.count_if(c).alias(name) for name, c in checks.items()])
    return counted.unpivot([], list(checks), "check", "result")


def duplicate_orders(orders: DataFrame) -> DataFrame:
    """Rows beyond the first of each order id; rows without an id count as duplicates."""
    return orders.agg(
        (F.count(F.lit(1)) - F.countDistinct("order_id")).alias("duplicates")
    )


def unmatched_items(items: DataFrame, menu: DataFrame) -> DataFrame:
    """Lines whose item is not on the menu, lines without an item among them.

    Lines are counted per item first, so an anti-join that has to shuffle moves items, not lines.
    (While the menu is small enough to broadcast, Spark runs the join before the count.)
    """
    lines = items.groupBy("item_id").agg(F.count(F.lit(1)).alias("lines"))
    return (
        lines.join(menu.select("item_id").distinct(), "item_id", "left_anti")
        .agg(F.coalesce(F.sum("lines"), F.lit(0).cast("bigint")).alias("unmatched"))
    )


def graded(
    counts: DataFrame, table: str, expected: dict[str, int], at_most: Iterable[str] = ()
) -> DataFrame:
    """Adds table, expected count (0 unless stated) and verdict to (check, result) rows."""
    wanted = F.lit(0).cast("bigint")
    for name, rows in expected.items():
        wanted = F.when(F.col("check") == name, F.lit(rows).cast("bigint")).otherwise(wanted)
    passed = F.col("result") == wanted
    bounded = list(at_most)
    if bounded:
        passed = passed | F.col("check").isin(*bounded) & (F.col("result") < wanted)
    return counts.select(
        "check",
        F.lit(table).alias("table"),
        "result",
        wanted.alias("expected"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def _graded(
    counts: DataFrame, table: str, own: list[Check], expected: dict[str, int] | None = None
) -> DataFrame:
    wanted = (expected or {}) | {c.name: c.expected for c in own}
    return graded(counts, f"bronze_{table}", wanted, [c.name for c in own if c.at_most])


def _conditions(own: list[Check]) -> dict[str, Column]:
    return {c.name: c.condition for c in own}


def _single(df: DataFrame, check: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.col(df.columns[0]).alias("result"))


def quality_checks_orders(
    orders: DataFrame, rules: QualityRules, own: Iterable[Check] = ()
) -> DataFrame:
    own = of_table(own, "orders")
    counts = count_violations(orders, order_checks(rules) | _conditions(own)).unionByName(
        _single(duplicate_orders(orders), "orders_no_duplicate_order_ids")
    )
    return _graded(counts, "orders", own)


def quality_checks_items(
    items: DataFrame, menu: DataFrame, rules: QualityRules, own: Iterable[Check] = ()
) -> DataFrame:
    """One scan of the lines: the counters of the row checks are kept per item, so the search for
    items that are not on the menu moves one row per task and item."""
    own = of_table(own, "order_items")
    checks = item_checks(rules) | _conditions(own)
    per_item = items.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("items_valid_item_ids"),
        *[F.count_if(c).alias(name) for name, c in checks.items()],
    )
    known = menu.select("item_id").distinct().withColumn("known", F.lit(True))
    names = [*checks, "items_valid_item_ids"]
    counts = (
        per_item.join(known, "item_id", "left")
        .withColumn(
            "items_valid_item_ids",
            F.when(F.col("known").isNull(), F.col("items_valid_item_ids")).otherwise(0),
        )
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias(n) for n in names])
        .unpivot([], names, "check", "result")
    )
    return _graded(counts, "order_items", own)


def quality_checks_menu(
    menu: DataFrame, rules: QualityRules, own: Iterable[Check] = ()
) -> DataFrame:
    own = of_table(own, "menu")
    counts = count_violations(menu, menu_checks(rules) | _conditions(own))
    return _graded(counts, "menu", own, {"menu_47_items": rules.menu_rows})


def quality_checks(
    orders: DataFrame,
    items: DataFrame,
    menu: DataFrame,
    rules: QualityRules,
    own: Iterable[Check] = (),
) -> DataFrame:
    """The 18 checks and a caller's own: check, table, result, expected, status."""
    own = list(own)
    return (
        quality_checks_orders(orders, rules, own)
        .unionByName(quality_checks_items(items, menu, rules, own))
        .unionByName(quality_checks_menu(menu, rules, own))
    )


def _summary_columns() -> list[Column]:
    passed = F.count_if(F.col("status") == "PASS")
    rate = F.try_divide(passed.cast("double"), F.count(F.lit(1)).cast("double")) * 100
    return [
        F.count(F.lit(1)).alias("total"),
        passed.alias("passed"),
        F.count_if(F.col("status") == "FAIL").alias("failed"),
        F.format_string("%.1f%%", rate).alias("pass_rate"),
    ]


def quality_summary(results: DataFrame) -> DataFrame:
    return results.agg(*_summary_columns())


def quality_report(results: DataFrame) -> DataFrame:
    """The report document: one row with timestamp, summary and the list of checks.

    One pass over the results, so the checks run once. It collects one entry per check, so its
    size is the length of the check list.
    """
    document = results.agg(*_summary_columns(), F.collect_list(F.struct("*")).alias("checks"))
    return document.select(
        F.current_timestamp().alias("run_timestamp"),
        F.struct("total", "passed", "failed", "pass_rate").alias("summary"),
        "checks",
    )


# ---- table assertions ----------------------------------------------------------------------


def _assertion(df: DataFrame, test: str, table: str, column: str) -> DataFrame:
    return df.select(
        F.lit(test).alias("test"),
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.col("violations"),
    )


def stacked(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def assert_not_null(df: DataFrame, table: str, columns: Iterable[str]) -> DataFrame:
    """Rows without a value, for all columns in one scan."""
    columns = list(columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counted.unpivot([], columns, "column", "violations")
    return rows.select(
        F.lit("not_null").alias("test"), F.lit(table).alias("table"), "column", "violations"
    )


def assert_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that occur more than once; missing values are not values."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")
    )
    repeated = counts.agg(F.count_if(F.col("n") > 1).alias("violations"))
    return _assertion(repeated, "unique", table, column)


def assert_accepted_range(
    df: DataFrame, table: str, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Values outside the bounds, both inclusive; missing values pass."""
    outside = F.lit(False)
    if low is not None:
        outside = outside | (F.col(column) < F.lit(low))
    if high is not None:
        outside = outside | (F.col(column) > F.lit(high))
    return _assertion(
        df.agg(F.count_if(outside).alias("violations")), "accepted_range", table, column
    )


def assert_accepted_values(
    df: DataFrame, table: str, column: str, values: Iterable[str]
) -> DataFrame:
    """Values outside the list; missing values pass."""
    return _assertion(
        df.agg(F.count_if(~F.col(column).isin(*values)).alias("violations")),
        "accepted_values", table, column,
    )


def assert_menu_classified(menu_mart: DataFrame) -> DataFrame:
    return assert_accepted_values(
        menu_mart, "mart_menu_performance", "menu_class", MENU_CLASSES
    )


def assert_no_negative_revenue(menu_mart: DataFrame) -> DataFrame:
    return assert_accepted_range(menu_mart, "mart_menu_performance", "total_revenue", low=0)


def bronze_assertions(
    orders: DataFrame, items: DataFrame, menu: DataFrame, locations: DataFrame
) -> DataFrame:
    """Declared tests of the typed views."""
    return stacked(
        [
            assert_not_null(orders, "src_orders", ["order_id", "location_id"]),
            assert_unique(orders, "src_orders", "order_id"),
            assert_not_null(items, "src_order_items", ["order_item_id"]),
            assert_unique(items, "src_order_items", "order_item_id"),
            assert_not_null(menu, "src_menu", ["item_id"]),
            assert_unique(menu, "src_menu", "item_id"),
            assert_not_null(locations, "src_locations", ["location_id"]),
            assert_unique(locations, "src_locations", "location_id"),
        ]
    )


def row_assertions(
    df: DataFrame, table: str, not_null: Iterable[str], lowest: dict[str, float] | None = None
) -> DataFrame:
    """not_null and accepted_range tests of a table, from one scan."""
    tests = {("not_null", c): F.col(c).isNull() for c in not_null}
    tests |= {("accepted_range", c): F.col(c) < F.lit(low) for c, low in (lowest or {}).items()}
    counted = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(test).alias("test"), F.lit(table).alias("table"),
                    F.lit(column).alias("column"), F.count_if(broken).alias("violations"),
                )
                for (test, column), broken in tests.items()
            ]
        ).alias("tests")
    )
    return counted.select(F.inline("tests"))


def silver_assertions(
    orders: DataFrame, items: DataFrame, order_keys: DataFrame | None = None,
    item_keys: DataFrame | None = None,
) -> DataFrame:
    """Declared tests of the Silver tables.

    Keys that a batch didn't touch were unique before; with the batch's keys (a column order_id or
    order_item_id) only rows with such a key are counted, so a night shuffles no other.
    """
    keyed = [
        (orders, "stg_orders", "order_id", order_keys),
        (items, "stg_order_items", "order_item_id", item_keys),
    ]
    return stacked(
        [
            row_assertions(
                orders, "stg_orders",
                ["surrogate_key", "order_id", "location_id", "total_amount"], {"total_amount": 0},
            ),
            row_assertions(items, "stg_order_items", ["surrogate_key", "gross_profit"]),
            *[
                assert_unique(
                    df if keys is None else df.join(keys.distinct(), key, "left_semi"),
                    table, "surrogate_key",
                )
                for df, table, key, keys in keyed
            ],
        ]
    )


def gold_assertions(menu_mart: DataFrame) -> DataFrame:
    return stacked([assert_menu_classified(menu_mart), assert_no_negative_revenue(menu_mart)])
