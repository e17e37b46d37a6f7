"""The six raw exports, derived from a star schema of orders, lines, parts and customers.

Every row of the source tables is used. Arithmetic on keys sets column values only: a few
missing or unknown codes, so that the quality rules and null branches have work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.config import QualityRules
from tillmark.functions.numeric import round2

# Bounds of the quality gate that suit this data.
RULES = QualityRules(
    first_day="1995-01-01",
    last_day="2001-12-31",
    closed_days=("1996-12-25", "1997-01-01"),
    lowest_price=100.0,
    highest_price=60000.0,
    menu_rows=2000,
)

# The mark that splits the orders into a first load and a batch.
MARK = "1998-12-31"

# The discount, in percent, of a promotion that the lines name and the promotions lack.
UNKNOWN_STEP = 7

# Price periods: number, factor, first and last day.
PRICE_PERIODS = (
    (1, 0.8, "1995-01-01", "1997-01-01"),
    (2, 0.9, "1997-01-01", "1999-05-31"),
    (3, 0.7, "1998-06-01", "1998-08-31"),
    (4, 1.0, "1999-07-01", None),
)

# Region key -> site code.
SITES = ("LOC-GRM", "LOC-WTD", "LOC-DUN", "LOC-WIN", "LOC-PTC")


# Columns of the source tables. Stating them spares a look into the files for each read.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _site(region: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in SITES]), region)


def _size(p_size: Column) -> Column:
    return F.when(p_size <= 16, "S").when(p_size <= 33, "M").otherwise("L")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    price = F.col("o_totalprice")
    seconds = key * 7919 % 86400
    regions = (
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "r_regionkey", "r_name")
    )
    customers = (
        table(spark, sf_dir, "customer")
        .join(regions, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "r_regionkey", "r_name")
    )
    return (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("O-"), key.cast("string")).alias("order_id"),
            F.when(key % 1009 == 0, None)
            .when(key % 503 == 7, "LOC-XXX")
            .otherwise(_site(F.col("r_regionkey")))
            .alias("location_id"),
            F.col("r_name").alias("location_name"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.concat_ws(
                ":",
                *[
                    F.lpad(part.cast("string"), 2, "0")
                    for part in (
                        F.floor(seconds / 3600), F.floor(seconds % 3600 / 60), seconds % 60
                    )
                ],
            ).alias("order_time"),
            F.when(key % 401 == 3, "Curbside")
            .when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Delivery")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Takeout")
            .otherwise("Dine-In")
            .alias("order_type"),
            F.concat(F.lit("C-"), (F.col("o_custkey") % 100).cast("string")).alias("cashier_id"),
            round2(price / 1.13).alias("subtotal"),
            round2(price * (key % 5) / 100).alias("discount_amount"),
            round2(
                price - price / 1.13 + F.when(key % 97 == 0, 0.5).otherwise(0.0)
            ).alias("tax_amount"),
            price.alias("total_amount"),
            F.get(
                F.array(F.lit("Cash"), F.lit("Card"), F.lit("App")),
                (F.col("o_custkey") % 3).cast("int"),
            ).alias("payment_method"),
            (F.col("o_orderstatus") == "F").alias("is_refund"),
        )
    )


def raw_orders_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders, those of the last weeks delivered a second time."""
    orders = raw_orders(spark, sf_dir)
    return orders.unionByName(orders.filter(F.col("order_date") >= F.lit("2001-06-15").cast("date")))


def raw_order_items(
    spark: SparkSession, sf_dir: str, orders: DataFrame | None = None
) -> DataFrame:
    """All lines, or those of some orders: these are found among the numbers of the source table,
    much narrower than the texts made of them."""
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    order_id = F.concat(F.lit("O-"), F.col("l_orderkey").cast("string"))
    lines = table(spark, sf_dir, "lineitem")
    if orders is not None:
        lines = lines.join(orders.select("order_id"), order_id == F.col("order_id"), "left_semi")
    return (
        lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat_ws(
                "-",
                *[F.col(c).cast("string")
                  for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
            ).alias("order_item_id"),
            order_id.alias("order_id"),
            F.concat(F.lit("I-"), F.col("l_partkey").cast("string")).alias("item_id"),
            F.col("p_name").alias("item_name"),
            F.col("p_type").alias("category"),
            _size(F.col("p_size")).alias("size"),
            F.when((F.col("l_partkey") % 211 == 5) & (F.col("l_linenumber") == 1), 0)
            .otherwise(quantity.cast("int"))
            .alias("quantity"),
            round2(price / quantity).alias("unit_price"),
            round2(price * F.col("l_discount")).alias("discount_applied"),
            F.when((quantity == 13) & (F.col("l_linenumber") == 2), 0.0)
            .otherwise(round2(price * (1 - F.col("l_discount"))))
            .alias("line_total"),
            F.when(F.col("l_discount") > 0, _promo(F.col("l_discount"))).alias("promo_id"),
        )
    )


def _promo(discount: Column) -> Column:
    return F.concat(F.lit("P-"), F.round(discount * 100).cast("int").cast("string"))


def raw_menu(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All parts; those of one brand lost their item id, so their lines match no menu row."""
    price = F.col("p_retailprice")
    return table(spark, sf_dir, "part").select(
        F.when(
            F.col("p_brand") != "Brand#13", F.concat(F.lit("I-"), F.col("p_partkey").cast("string"))
        ).alias("item_id"),
        F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        _size(F.col("p_size")).alias("size"),
        price.alias("selling_price"),
        round2(price * F.when(F.col("p_partkey") % 89 == 0, 0.5).otherwise(0.3)).alias("cost_price"),
        (F.col("p_partkey") % 20 != 0).alias("is_active"),
        F.lit("1995-01-01").cast("date").alias("launch_date"),
        (F.col("p_partkey") % 10 == 0).alias("is_seasonal"),
    )


def raw_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        _site(F.col("r_regionkey")).alias("location_id"),
        F.col("r_name").alias("location_name"),
        F.lit("1 Main St").alias("address"),
        (40 + 10 * F.col("r_regionkey")).alias("seating_capacity"),
        F.lit("1994-01-01").cast("date").alias("opening_date"),
        F.col("r_name").alias("manager_name"),
        F.lit("555-0100").alias("phone"),
        F.lit(True).alias("is_active"),
    )


def raw_promotions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One promotion per discount step that occurs in the lines, but for one step."""
    steps = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_discount") > 0)
        .select(F.round(F.col("l_discount") * 100).cast("int").alias("step"))
        .filter(F.col("step") != UNKNOWN_STEP)
        .distinct()
    )
    name = F.concat(F.lit("P-"), F.col("step").cast("string"))
    return steps.select(
        name.alias("promo_id"),
        F.concat(F.col("step").cast("string"), F.lit(" percent off")).alias("promo_name"),
        F.lit("percent").alias("discount_type"),
        F.col("step").cast("double").alias("discount_value"),
        F.lit("all").alias("applies_to"),
        F.lit("1995-01-01").cast("date").alias("start_date"),
        F.lit("2001-12-31").cast("date").alias("end_date"),
        F.lit(None).cast("string").alias("location_id"),
        F.lit(None).cast("string").alias("day_of_week"),
    )


def raw_menu_price_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four prices of every menu row: the second touches the first, the third overlaps it and ends
    inside it, the fourth follows the gap after it."""
    steps = F.array(
        *[
            F.struct(
                F.lit(n).alias("n"), F.lit(factor).alias("factor"),
                F.lit(since).cast("date").alias("since"), F.lit(until).cast("date").alias("until"),
            )
            for n, factor, since, until in PRICE_PERIODS
        ]
    )
    menu = raw_menu(spark, sf_dir).select(
        "item_id", "selling_price", "cost_price", F.explode(steps).alias("step")
    )
    return menu.select(
        F.concat_ws("-", "item_id", F.col("step.n").cast("string")).alias("price_history_id"),
        "item_id",
        round2(F.col("selling_price") * F.col("step.factor")).alias("selling_price"),
        round2(F.col("cost_price") * F.col("step.factor")).alias("cost_price"),
        F.col("step.since").alias("effective_from"),
        F.col("step.until").alias("effective_to"),
        F.col("step.until").isNull().alias("is_current"),
        F.lit("repricing").alias("change_reason"),
    )


EXPORTS = {
    "orders": raw_orders,
    "order_items": raw_order_items,
    "menu": raw_menu,
    "locations": raw_locations,
    "promotions": raw_promotions,
    "menu_price_history": raw_menu_price_history,
}
