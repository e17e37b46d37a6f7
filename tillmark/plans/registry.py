"""Every operator as a query over a folder of star-schema tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.functions.calendar import calendar_parts
from tillmark.functions.keys import surrogate_key
from tillmark.functions.numeric import round2
from tillmark.operators import gold, incremental, pricing, quality, reports, silver, typed
from tillmark.plans import pipeline
from tillmark.session import configure, materialized, scratch_path, shuffles_freed
from tillmark.sources import bronze, exports, star, state
from tillmark.sources.csv_export import scan_csv
from tillmark.sources.tables import in_parts, merge_table, read_table, replace_table, source_bytes
from tillmark.streaming import arrivals

CORRECTED_FROM = "1998-06-30"


class Tables:
    """The layers of one folder, as lazy DataFrames."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return star.EXPORTS[name](self.spark, self.sf_dir)

    @cached_property
    def resent(self) -> DataFrame:
        return star.raw_orders_resent(self.spark, self.sf_dir)

    @cached_property
    def orders(self) -> DataFrame:
        return typed.src_orders(self.raw("orders"))

    @cached_property
    def items(self) -> DataFrame:
        return typed.src_order_items(self.raw("order_items"))

    @cached_property
    def menu(self) -> DataFrame:
        return typed.src_menu(self.raw("menu"))

    @cached_property
    def history(self) -> DataFrame:
        return typed.src_menu_price_history(self.raw("menu_price_history"))

    @cached_property
    def promotions(self) -> DataFrame:
        return typed.src_promotions(self.raw("promotions"))

    @cached_property
    def stg_orders(self) -> DataFrame:
        return silver.stg_orders(self.orders)

    @cached_property
    def stg_order_items(self) -> DataFrame:
        return silver.stg_order_items(self.items, self.stg_orders, self.menu)

    @cached_property
    def monthly(self) -> DataFrame:
        return gold.monthly_revenue(self.stg_orders)

    @cached_property
    def item_stats(self) -> DataFrame:
        return gold.item_stats(gold.monthly_items(silver.by_month(self.stg_order_items)))

    @cached_property
    def menu_mart(self) -> DataFrame:
        # Held, so that the lines are read once.
        stats = materialized(self.item_stats, scratch_path(self.spark, "item_stats"))
        return gold.mart_menu_performance(stats)

    @cached_property
    def location_mart(self) -> DataFrame:
        return gold.mart_location_comparison(
            gold.monthly_locations(self.stg_orders, self.stg_order_items)
        )

    @cached_property
    def trends_mart(self) -> DataFrame:
        return gold.mart_revenue_trends(self.monthly)

    @cached_property
    def time_mart(self) -> DataFrame:
        return gold.mart_time_analysis(self.stg_orders)

    def up_to_mark(self, df: DataFrame) -> DataFrame:
        return df.filter(F.col("order_date") <= F.lit(star.MARK).cast("date"))

    def corrected(self) -> DataFrame:
        """A batch that replaces half a year of Silver orders and adds all later ones."""
        return self.stg_orders.filter(
            F.col("order_date") > F.lit(CORRECTED_FROM).cast("date")
        ).withColumn("payment_method", F.lit("Voucher"))

    def misdated(self, orders: DataFrame) -> DataFrame:
        """Typed orders as they were first sent: some with a date two months too early."""
        late = F.col("order_date") > F.lit(CORRECTED_FROM).cast("date")
        return orders.withColumn(
            "order_date", F.when(late, F.add_months("order_date", -2)).otherwise(F.col("order_date"))
        )

    def stored(self, name: str, df: DataFrame, table: str = "stg_orders") -> DataFrame:
        """As a Silver table on disk."""
        path = scratch_path(self.spark, name)
        merge_table(self.spark, path, df, derived=silver.derived(table))
        return read_table(self.spark, path)

    def checks(self) -> DataFrame:
        return quality.quality_checks(
            self.resent, self.raw("order_items"), self.raw("menu"), star.RULES
        )


# ---- queries that go through files -----------------------------------------------------------


def csv_scan(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    exported = t.raw("orders").withColumn(
        "location_id", F.coalesce("location_id", F.lit("N/A"))
    )
    exported.write.option("header", True).csv(path)
    return typed.src_orders(scan_csv(t.spark, path))


def bronze_load(t: Tables, table: str) -> DataFrame:
    """Two nights: a first load of the export as it stood at the mark, then the whole export."""
    root = scratch_path(t.spark, "bronze")
    first = t.up_to_mark(t.raw("orders"))
    known = star.raw_order_items(t.spark, t.sf_dir, first)
    exports = ((first, known, None), (t.raw("orders"), t.raw("order_items"), star.MARK))
    for orders, items, mark in exports:
        bronze.load_batch(t.spark, orders, root, "orders", mark)
        bronze.load_batch(t.spark, items, root, "order_items", mark)
    return bronze.read_bronze(t.spark, root, table).drop(bronze.INGESTED)


def load_audit(t: Tables) -> DataFrame:
    """Row counts of all tables of a first run, observed while they are written."""
    where = pipeline.Warehouse(scratch_path(t.spark, "audit"))
    audit = {
        f"bronze_{name}": bronze.load_batch(t.spark, t.raw(name), where.bronze, name, None)
        for name in star.EXPORTS
    }
    audit |= pipeline.build_silver(t.spark, where, {})
    audit |= pipeline.build_gold(t.spark, where)
    pipeline.record_audit(t.spark, where, audit, date(2001, 12, 31))
    return pipeline.read_audit(t.spark, where).select("table", "rows")


def load_state(t: Tables) -> DataFrame:
    """The marks after two nights."""
    path = scratch_path(t.spark, "state")
    for orders in (t.up_to_mark(t.raw("orders")), t.raw("orders")):
        state.advance_marks(incremental.high_water_mark(orders), path)
    return state.current_marks(t.spark, path)


def rebuild_table(t: Tables) -> DataFrame:
    """A table that is written twice; the second time is what counts."""
    path = scratch_path(t.spark, "rebuilt")
    for df in (t.up_to_mark(t.stg_orders), t.stg_orders):
        replace_table(df, path)
    return read_table(t.spark, path)


def report_files(t: Tables) -> DataFrame:
    """The trends report, read back from its dated CSV file."""
    report = reports.report_revenue_trends(t.trends_mart)
    path = exports.write_report(
        report, scratch_path(t.spark, "reports"), "revenue_trends", date(2001, 12, 31)
    )
    return t.spark.read.schema(report.schema).option("header", True).csv(path)


def gold_by_month(t: Tables) -> DataFrame:
    """Two nights: all orders as first sent, then the corrected months alone."""
    where = pipeline.Warehouse(scratch_path(t.spark, "months"))
    first = silver.stg_orders(t.misdated(t.orders))
    batch = t.stg_orders.filter(F.col("order_date") > F.lit(CORRECTED_FROM).cast("date"))
    for orders in (first, batch):
        items = silver.by_month(silver.stg_order_items(t.items, orders, t.menu))
        items = in_parts(items, "order_id", source_bytes(t.items))
        pipeline.merge_silver(t.spark, where, "stg_orders", orders, "order_id")
        pipeline.merge_silver(
            t.spark, where, "stg_order_items", items, "order_id", orders.select("order_id")
        )
        pipeline.build_gold(t.spark, where)
    return read_table(t.spark, where.gold("mart_location_comparison"))


def silver_merge(t: Tables) -> DataFrame:
    """The second batch moves orders to the months that they belong to."""
    path = scratch_path(t.spark, "silver")
    merge_table(t.spark, path, silver.stg_orders(t.up_to_mark(t.misdated(t.orders))))
    merge_table(t.spark, path, t.corrected())
    return read_table(t.spark, path)


def streamed_orders(t: Tables) -> DataFrame:
    """The orders land in two deliveries; each is picked up and merged into Silver."""
    root = scratch_path(t.spark, "arrivals")
    mark = F.lit(star.MARK).cast("date")
    for delivery in (F.col("order_date") <= mark, F.col("order_date") > mark):
        t.raw("orders").filter(delivery).write.mode("append").option("header", True).csv(
            f"{root}/landing"
        )
        arrivals.load_orders(
            t.spark, f"{root}/landing", f"{root}/stg_orders", f"{root}/checkpoint"
        ).awaitTermination()
    return read_table(t.spark, f"{root}/stg_orders").drop("_transformed_at")


def streamed_order_items(t: Tables) -> DataFrame:
    """Lines land before their orders; some orders are sent again with another date, or as the
    refunds that they are."""
    root = scratch_path(t.spark, "arrivals")
    lines = arrivals.Lines(f"{root}/bronze", f"{root}/stg_order_items", t.menu)
    orders = t.raw("orders")
    late = F.col("order_date") > F.lit(CORRECTED_FROM).cast("date")
    known = F.col("order_date") <= F.lit(star.MARK).cast("date")
    first = t.misdated(orders.filter(known)).withColumn(
        "is_refund", F.when(late, F.lit(False)).otherwise(F.col("is_refund"))
    )

    def land(delivery: DataFrame, name: str) -> None:
        with shuffles_freed(t.spark):
            delivery.write.mode("append").option("header", True).option(
                "compression", "gzip"
            ).csv(f"{root}/{name}")

    land(t.raw("order_items"), "lines")

    def load_orders(delivery: DataFrame) -> None:
        land(delivery, "orders")
        arrivals.load_orders(
            t.spark, f"{root}/orders", f"{root}/stg_orders", f"{root}/c1", lines
        ).awaitTermination()

    arrivals.load_order_items(
        t.spark, f"{root}/lines", lines, f"{root}/stg_orders", f"{root}/c2"
    ).awaitTermination()
    load_orders(first)
    load_orders(orders.filter(late))
    return read_table(t.spark, lines.silver).drop("_transformed_at", "order_year", "order_month")


def late_rows(t: Tables) -> DataFrame:
    """Two nights that take late rows: in the first, the afternoon of the mark's day is missing, and of
    every order the second line; all other lines are there, whether their order is or not."""
    where = pipeline.Warehouse(scratch_path(t.spark, "late"))
    morning = (F.col("order_date") < F.lit(star.MARK).cast("date")) | morning_of_the_mark()
    second = F.col("order_item_id").rlike("^[0-9]+-2-")
    first = {
        "orders": t.raw("orders").filter(morning),
        "order_items": t.raw("order_items").filter(~second),
    }
    for exports in (first, {}):
        night = pipeline.night_of(t.spark, where, late=True)
        pipeline.load_bronze_late(
            t.spark, lambda name: exports.get(name, t.raw(name)), where, night
        )
        pipeline.build_silver_late(t.spark, where, night)
        pipeline.complete(t.spark, where, night, date(2001, 12, 31))
    return read_table(t.spark, where.silver("stg_order_items")).drop(
        "_transformed_at", "order_year", "order_month"
    )


def morning_of_the_mark() -> Column:
    return (F.col("order_date") == F.lit(star.MARK).cast("date")) & (F.col("order_time") < "12:00:00")


# ---- queries over the lazy layers --------------------------------------------------------------


def append_new_columns(t: Tables) -> DataFrame:
    mark = F.lit(star.MARK).cast("date")
    batch = t.stg_orders.filter(F.col("order_date") > mark).withColumn(
        "loyalty_id", F.concat(F.lit("L-"), "cashier_id")
    )
    return incremental.append_new_columns(t.up_to_mark(t.stg_orders), batch)


def silver_items_delta(t: Tables) -> DataFrame:
    costed = t.stored(
        "costed", silver.by_month(t.up_to_mark(t.stg_order_items)), "stg_order_items"
    )
    fresh = incremental.silver_delta(t.stored("orders", t.stg_orders), costed)
    return silver.stg_order_items(t.items, fresh, t.menu)


def join_preaggregated(t: Tables) -> DataFrame:
    return gold.join_preaggregated(t.stg_orders, t.stg_order_items).select(
        "order_id", "order_date", "total_amount", "gross_profit",
        round2(F.col("margin_pct")).alias("margin_pct"),
    )


def assert_not_null(t: Tables) -> DataFrame:
    return quality.stacked(
        [
            quality.assert_not_null(df, table, columns)
            for df, table, columns in [
                (t.orders, "src_orders", ["order_id", "location_id"]),
                (t.items, "src_order_items", ["order_item_id"]),
                (t.menu, "src_menu", ["item_id"]),
                (typed.src_locations(t.raw("locations")), "src_locations", ["location_id"]),
                (t.stg_orders, "stg_orders",
                 ["surrogate_key", "order_id", "location_id", "total_amount"]),
                (t.stg_order_items, "stg_order_items", ["surrogate_key", "gross_profit"]),
            ]
        ]
    )


def assert_unique(t: Tables) -> DataFrame:
    return quality.stacked(
        [
            quality.assert_unique(df, table, column)
            for df, table, column in [
                (typed.src_orders(t.resent), "src_orders", "order_id"),
                (t.items, "src_order_items", "order_item_id"),
                (t.menu, "src_menu", "item_id"),
                (typed.src_locations(t.raw("locations")), "src_locations", "location_id"),
                (t.stg_orders, "stg_orders", "surrogate_key"),
                (t.stg_order_items, "stg_order_items", "surrogate_key"),
            ]
        ]
    )


def _months(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*gold.MONTH_KEYS, *columns)


QUERIES: dict[str, Callable[[Tables], DataFrame]] = {
    # sources
    "csv_scan": csv_scan,
    "src_orders": lambda t: t.orders,
    "src_order_items": lambda t: t.items,
    "src_menu": lambda t: t.menu,
    "src_locations": lambda t: typed.src_locations(t.raw("locations")),
    "src_promotions": lambda t: t.promotions,
    "src_menu_price_history": lambda t: t.history,
    "bronze_load": lambda t: bronze_load(t, "orders"),
    "bronze_lines": lambda t: bronze_load(t, "order_items"),
    "load_audit": load_audit,
    "load_state": load_state,
    "rebuild_table": rebuild_table,
    # incremental load
    "incremental_orders": lambda t: incremental.orders_after(t.orders, star.MARK),
    "incremental_order_items": lambda t: incremental.items_after(t.items, t.orders, star.MARK),
    "boundary_day_orders": lambda t: incremental.orders_since(
        t.orders, star.MARK, t.orders.filter(morning_of_the_mark())
    ),
    "late_rows": late_rows,
    "high_water_mark": lambda t: incremental.high_water_mark(t.raw("orders")),
    "silver_orders_delta": lambda t: silver.stg_orders(
        incremental.silver_delta(t.orders, t.stored("orders", t.up_to_mark(t.stg_orders)))
    ),
    "silver_items_delta": silver_items_delta,
    "upsert_by_key": lambda t: incremental.upsert_by_key(
        t.up_to_mark(t.stg_orders), t.corrected()
    ),
    "silver_merge": silver_merge,
    "append_new_columns": append_new_columns,
    "streamed_orders": streamed_orders,
    "streamed_order_items": streamed_order_items,
    # silver
    "surrogate_key": lambda t: t.orders.select(
        "order_id", surrogate_key(F.col("order_id")).alias("surrogate_key")
    ),
    "calendar_parts": lambda t: t.orders.select(
        "order_id", "order_date",
        *[c.alias(n) for n, c in calendar_parts(F.col("order_date")).items()],
    ),
    "day_part": lambda t: t.stg_orders.select("order_id", "order_time", "order_hour", "day_part"),
    "stg_orders": lambda t: t.stg_orders,
    "join_items_orders": lambda t: silver.join_items_orders(t.items, t.stg_orders),
    "join_items_menu": lambda t: silver.join_items_menu(t.items, t.menu),
    "line_margin": lambda t: t.stg_order_items.select(
        "order_item_id", "quantity", "line_total", "cost_price", "total_cost", "gross_profit",
        "margin_pct",
    ),
    "stg_order_items": lambda t: t.stg_order_items,
    # gold
    "item_stats": lambda t: t.item_stats,
    "menu_thresholds": lambda t: gold.menu_thresholds(t.item_stats),
    "mart_menu_performance": lambda t: t.menu_mart,
    "order_profit": lambda t: gold.order_profit(t.stg_order_items),
    "join_preaggregated": join_preaggregated,
    "orders_by_type": lambda t: _months(
        gold.monthly_locations(t.stg_orders, t.stg_order_items),
        "total_orders", *gold.TYPE_COLUMNS.values(),
    ),
    "monthly_locations": lambda t: gold.monthly_locations(t.stg_orders, t.stg_order_items),
    "revenue_share": lambda t: _months(t.location_mart, "total_revenue", "revenue_share_pct"),
    "mart_location_comparison": lambda t: t.location_mart,
    "monthly_revenue": lambda t: t.monthly,
    "prev_month_revenue": lambda t: _months(
        gold.prev_month_revenue(t.monthly), "total_revenue", "prev_month_revenue"
    ),
    "mom_growth": lambda t: _months(
        gold.mom_growth(t.monthly), "total_revenue", "mom_growth_pct"
    ),
    "ytd_revenue": lambda t: _months(gold.ytd_revenue(t.monthly), "total_revenue", "ytd_revenue"),
    "all_locations_revenue": lambda t: _months(
        gold.all_locations_revenue(t.monthly), "total_revenue", "all_locations_revenue"
    ),
    "mart_revenue_trends": lambda t: t.trends_mart,
    "mart_time_analysis": lambda t: t.time_mart,
    "gold_by_month": gold_by_month,
    # reports
    "report_menu_performance": lambda t: reports.report_menu_performance(t.menu_mart),
    "report_location_comparison": lambda t: reports.report_location_comparison(t.location_mart),
    "report_revenue_trends": lambda t: reports.report_revenue_trends(t.trends_mart),
    "report_files": report_files,
    "report_time_analysis": lambda t: reports.report_time_analysis(t.time_mart),
    # quality
    "quality_checks": lambda t: t.checks(),
    "quality_checks_orders": lambda t: quality.quality_checks_orders(t.resent, star.RULES),
    "quality_checks_items": lambda t: quality.quality_checks_items(
        t.raw("order_items"), t.raw("menu"), star.RULES
    ),
    "quality_checks_menu": lambda t: quality.quality_checks_menu(t.raw("menu"), star.RULES),
    "quality_summary": lambda t: quality.quality_summary(t.checks()),
    "duplicate_orders": lambda t: quality.duplicate_orders(t.resent),
    "unmatched_items": lambda t: quality.unmatched_items(t.raw("order_items"), t.raw("menu")),
    "assert_not_null": assert_not_null,
    "assert_unique": assert_unique,
    "assert_accepted_range": lambda t: quality.assert_accepted_range(
        t.stg_orders, "stg_orders", "total_amount", low=0
    ),
    "assert_menu_classified": lambda t: quality.assert_menu_classified(t.menu_mart),
    "assert_no_negative_revenue": lambda t: quality.assert_no_negative_revenue(t.menu_mart),
    # prices and promotions
    "price_as_of_order": lambda t: pricing.price_as_of_order(t.stg_order_items, t.history).select(
        "order_item_id", "item_id", "order_date", "unit_price", "price_then", "cost_then"
    ),
    "margin_price_history": lambda t: pricing.margin_price_history(t.stg_order_items, t.history),
    "promo_performance": lambda t: pricing.promo_performance(t.stg_order_items, t.promotions),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(query: Callable[[Tables], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: query(Tables(spark, sf_dir.rstrip("/")))

    return {name: bound(query) for name, query in QUERIES.items()}
