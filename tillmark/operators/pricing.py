"""Price history and promotions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillmark.functions.numeric import exact_avg, percent, round2, total
from tillmark.operators.silver import line_margin


# Days that one piece of the calendar spans. A price changes once a day at most, so this is also the
# most steps that a line is compared with, however long its item's history is.
SPAN = 512


def _piece(day: Column) -> Column:
    return F.floor(F.unix_date(day) / SPAN).cast("int")


def _pieces(since: str, until: str) -> Column:
    """The pieces of the calendar from one day to the day before another."""
    return F.sequence(_piece(F.col(since)), _piece(F.date_sub(until, 1)))


# What a period is to a piece: it begins or ends on a day in it, or passes through it.
_ENTRIES = "array<struct<piece:int,day:date,passes:boolean>>"


def _entry(day: Column) -> Column:
    return F.struct(_piece(day).alias("piece"), day.alias("day"), F.lit(False).alias("passes"))


def _passing(piece: Column) -> Column:
    return F.struct(
        piece.alias("piece"), F.lit(None).cast("date").alias("day"), F.lit(True).alias("passes")
    )


def price_as_of_order(lines: DataFrame, history: DataFrame) -> DataFrame:
    """Costed lines with the price and cost in force on the order date, null where none was.

    One row per line: where periods touch or overlap, the one that began last counts. A step lies in
    every piece of the calendar that it reaches into, up to the piece after the history's last change,
    which stands for all days to come. A line meets the steps of its item and piece, so a hot item is
    split by date, with the step in force carried into each piece, and no line meets a long history.

    Steps are always sorted and merged. Spark would broadcast them by the size of the history's files, which
    says little: each period becomes several rows here, out of columns that compress well.
    """
    # One row, a scalar subquery: the piece after the last day on which any price changes.
    changes = F.greatest(F.max("effective_from"), F.max(F.date_add("effective_to", 1)))
    last = history.agg((_piece(changes) + 1).alias("_last")).scalar()
    steps = price_steps(history)
    until = F.coalesce(_piece(F.date_sub("_until", 1)), last)
    steps = steps.withColumn(
        "_piece", F.explode(F.sequence(_piece(F.col("_since")), until))
    )
    day = F.col("order_date")
    in_force = (
        (F.col("item_id") == F.col("_item")) & (F.col("_day_piece") == F.col("_piece"))
        & (F.col("_since") <= day) & (F.col("_until").isNull() | (F.col("_until") > day))
    )
    return lines.withColumn("_day_piece", F.least(_piece(day), last)).join(
        steps.hint("merge"), in_force, "left"
    ).drop("_item", "_since", "_until", "_piece", "_day_piece")


def price_steps(history: DataFrame) -> DataFrame:
    """The history without overlaps: _item, _since, _until (exclusive, null: for ever), price_then,
    cost_then. Works on the history alone.

    Both ends of a period count. Steps begin where a period begins or the day after one ends; of
    the periods around a step's first day the one that began last counts, and of those that began
    on one day the one with the greater `price_history_id`. Periods without an end are followed in the
    order of their beginnings; those with an end are looked at with the steps that begin in the pieces
    of the calendar that they reach into. One shuffle by item serves all of it.
    """
    end = F.date_add("effective_to", 1)
    period = F.struct("effective_from", "price_history_id", "selling_price", "cost_price")
    periods = history.filter(
        F.col("effective_from").isNotNull() & F.col("item_id").isNotNull()
    ).select(F.col("item_id").alias("_item"), "effective_from", end.alias("_end"), period.alias("_price"))
    periods = periods.repartition("_item")
    first, endless = F.col("effective_from"), F.col("_end").isNull()
    reached = F.when(F.col("_end") > first, _pieces("effective_from", "_end"))
    entries = F.concat(
        F.filter(F.array(_entry(first), _entry(F.col("_end"))), lambda e: e["day"].isNotNull()),
        F.coalesce(
            F.transform(reached, lambda piece: _passing(piece)), F.array().cast(_ENTRIES)
        ),
    )
    pieces = (
        periods.withColumn("_entry", F.explode(entries))
        .groupBy("_item", F.col("_entry.piece").alias("_piece"))
        .agg(
            F.collect_set("_entry.day").alias("_days"),
            F.collect_list(
                F.when(F.col("_entry.passes"), F.struct("_price", "_end"))
            ).alias("_passing"),
            F.collect_list(
                F.when((F.col("_entry.day") == first) & endless, F.col("_price"))
            ).alias("_begun"),
        )
    )
    since = F.col("_since")
    passing = F.filter(
        "_passing", lambda p: (p["_price"]["effective_from"] <= since) & (p["_end"] > since)
    )
    begun = F.filter("_begun", lambda p: p["effective_from"] == since)
    following = Window.partitionBy("_item").orderBy("_since")
    return (
        pieces.withColumn("_since", F.explode("_days"))
        .select(
            "_item", "_since", F.array_max(begun).alias("_began"),
            F.array_max(F.transform(passing, lambda p: p["_price"])).alias("_price"),
        )
        .withColumns(
            {
                "_price": F.greatest("_price", F.max("_began").over(following)),  # skips nulls
                "_until": F.lead("_since").over(following),
            }
        )
        .filter(F.col("_price").isNotNull())
        .select(
            "_item", "_since", "_until",
            F.col("_price.selling_price").alias("price_then"),
            F.col("_price.cost_price").alias("cost_then"),
        )
    )


def margin_price_history(lines: DataFrame, history: DataFrame) -> DataFrame:
    """Per item: profit and margin at the cost of the order date, beside those at today's cost."""
    then = line_margin(
        price_as_of_order(lines, history).withColumns(
            {"profit_now": F.col("gross_profit"), "margin_now": F.col("margin_pct")}
        ),
        cost="cost_then",
    )
    return then.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("lines"),
        total(F.col("line_total")).alias("total_revenue"),
        total(F.col("profit_now")).alias("profit_current_cost"),
        total(F.col("gross_profit")).alias("profit_historical_cost"),
        round2(exact_avg(F.col("margin_now").cast("decimal(18,2)"))).alias("margin_current_cost"),
        round2(exact_avg(F.col("margin_pct").cast("decimal(18,2)"))).alias(
            "margin_historical_cost"
        ),
    )


def promo_performance(lines: DataFrame, promotions: DataFrame) -> DataFrame:
    """Per promotion: lines, orders, units, revenue and discount; zero where it was never used.

    A promotion that only lines name has no `promo_name`. Lines are aggregated per promotion
    before they meet the promotions.
    """
    used = (
        lines.filter(F.col("promo_id").isNotNull())
        .groupBy("promo_id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.countDistinct("order_id").alias("orders"),
            F.sum("quantity").alias("units"),
            total(F.col("line_total")).alias("revenue"),
            total(F.col("discount_applied")).alias("discount"),
        )
    )
    zero = F.lit(0)
    return promotions.join(used, "promo_id", "full").select(
        "promo_id",
        "promo_name",
        *[F.coalesce(c, zero).cast("bigint").alias(c) for c in ("lines", "orders", "units")],
        *[F.coalesce(c, zero).cast("decimal(38,2)").alias(c) for c in ("revenue", "discount")],
        percent(F.col("discount"), F.col("revenue") + F.col("discount")).alias("discount_pct"),
    )
