"""What Spark makes of the jobs: pruning, pushed filters, joins, shuffles, skew."""

import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tillmark.config import QualityRules
from tillmark.operators import gold, incremental, quality, silver
from tillmark.plans.registry import Tables, bronze_load
from tillmark.session import sifted_joins
from tillmark.sources import bronze, star, tables
from tillmark.sources.tables import around, _write_partitions, merge_table, read_table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Silver tables on disk, as the marts read them."""
    root = tmp_path_factory.mktemp("silver")
    tables = Tables(spark, SF)
    merge_table(spark, f"{root}/orders", tables.stg_orders)
    merge_table(spark, f"{root}/items", silver.by_month(tables.stg_order_items))
    return read_table(spark, f"{root}/orders"), read_table(spark, f"{root}/items")


@pytest.fixture
def conf(spark):
    """Sets options for one test."""
    before = {}

    def change(**options):
        for name, value in options.items():
            key = "spark.sql." + name.replace("__", ".")
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_heatmap_reads_only_its_columns_and_pushes_the_refund_filter(stored, conf):
    conf(maxMetadataStringLength="10000")
    text = plan(gold.mart_time_analysis(stored[0]))
    (schema,) = re.findall(r"ReadSchema: struct<(.*?)>", text)
    names = {c.split(":")[0] for c in schema.split(",")}
    assert "cashier_id" not in names and "subtotal" not in names and "total_amount" in names
    assert "EqualTo(is_refund,false)" in text or "Not(EqualTo(is_refund,true))" in text


def test_months_prune_the_scan(stored):
    text = plan(stored[0].filter("order_year = 1996 and order_month in (1, 2)"))
    (filters,) = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", text)
    assert "order_year" in filters and "order_month" in filters


def test_key_search_of_a_merge_reads_keys_only_and_skips_by_their_bounds(stored, conf):
    conf(maxMetadataStringLength="10000")
    keys = stored[0].filter("order_month = 3").select("order_id").distinct()
    text = plan(around(stored[0], keys, "order_id").select("order_id", "order_year"))
    assert "GreaterThanOrEqual(order_id," in text and "LessThanOrEqual(order_id," in text
    assert "ReadSchema: struct<order_id:string>" in text


def test_menu_join_is_broadcast_while_the_menu_is_small(spark):
    tables = Tables(spark, SF)
    text = final_plan(silver.join_items_menu(tables.items, tables.menu))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text.split("Initial Plan")[0]


def test_menu_join_shuffles_once_the_menu_is_large(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    tables = Tables(spark, SF)
    assert "Broadcast" not in final_plan(silver.join_items_menu(tables.items, tables.menu))


def test_no_unpartitioned_window_and_no_cross_join(spark):
    tables = Tables(spark, SF)
    for df in (tables.trends_mart, tables.location_mart, tables.menu_mart):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        for window in re.findall(r"Window \[.*", text):
            assert "windowspecdefinition(specifiedwindowframe" not in window


def test_thresholds_read_the_lines_once(stored):
    """The item figures are held, so the classified mart scans them and not the lines."""
    tables = Tables(stored[1].sparkSession, SF)
    tables.stg_order_items = stored[1]
    text = plan(tables.menu_mart)
    assert "item_stats-" in text and "/items" not in text


def test_location_mart_counts_orders_without_repeating_rows(stored):
    text = plan(gold.mart_location_comparison(gold.monthly_locations(*stored)))
    assert "Expand" not in text
    # both sides of the join, the sites by month, the share window
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 4


def test_row_checks_scan_each_table_once(spark):
    tables = Tables(spark, SF)
    menu, items = tables.raw("menu"), tables.raw("order_items")
    checks = quality.count_violations(menu, quality.menu_checks(QualityRules()))
    assert plan(checks).count("FileScan") == 1
    assert plan(quality.quality_checks_items(items, menu, QualityRules())).count("lineitem") == 1


def test_silver_rows_are_tested_in_one_scan(stored):
    text = plan(quality.row_assertions(stored[0], "t", ["order_id", "location_id"], {"subtotal": 0}))
    assert text.count("FileScan") == 1 and "hashpartitioning" not in text
    keys = stored[0].filter("order_month = 3").select("order_id")
    text = plan(quality.silver_assertions(*stored, keys, stored[1].select("order_item_id")))
    # per table: one scan for the rows, one for the keys of the batch, and the batch's own
    assert text.count("FileScan") == 6 and text.count("LeftSemi") == 2


def test_no_plan_deals_rows_out_at_random(spark):
    tables = Tables(spark, SF)
    for df in (tables.stg_order_items, tables.item_stats, tables.location_mart, tables.checks(),
               tables.promotions, tables.trends_mart):
        assert "RoundRobin" not in plan(df)


def test_a_hot_null_item_meets_a_shuffled_menu(hot_lines, many_orders, large_menu, conf):
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__coalescePartitions__enabled="false", shuffle__partitions="16",
    )
    lines = hot_lines.withColumn(
        "item_id", F.when(F.col("item_id") != "I0", F.col("item_id"))
    )
    joined = silver.join_items_menu(lines, large_menu)
    assert "SortMergeJoin(skew=true)" in final_plan(joined).split("Initial Plan")[0]
    assert joined.count() == 120_000
    nulls = joined.filter("item_id is null")
    assert nulls.count() == lines.filter("item_id is null").count() >= 40_000
    assert nulls.filter("cost_price is not null").count() == 0


def test_lines_are_counted_per_item_before_a_shuffled_anti_join(spark, conf):
    """With a small menu Spark moves the then broadcast join below the count; no shuffle either."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    tables = Tables(spark, SF)
    text = plan(quality.unmatched_items(tables.raw("order_items"), tables.raw("menu")))
    assert text.index("LeftAnti") < text.index("partial_count(1)")


@pytest.fixture
def loads(conf, monkeypatch):
    """The plans of what is loaded into Bronze, while no join is broadcast."""
    conf(autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1")
    written, counted = [], bronze.counted
    monkeypatch.setattr(
        bronze, "counted", lambda df, write: written.append(plan(df)) or counted(df, write)
    )
    return written


def test_loads_shuffle_numbers_and_the_lines_of_the_batch(spark, loads):
    before = dict(spark.conf.getAll)
    bronze_load(Tables(spark, SF), "order_items")
    assert dict(spark.conf.getAll) == before
    _, known, _, batch = loads
    texts, numbers = known.split("LeftSemi")
    assert "concat_ws" in texts and "p_partkey" in texts and "concat_ws" not in numbers
    shuffles, sifted = batch.split("might_contain", 1)
    assert "hashpartitioning(order_id" in shuffles and "hashpartitioning(l_partkey" in shuffles
    assert "FileScan" not in shuffles and "l_discount" in sifted


@pytest.mark.parametrize("keys", [0, 1, 10**9])
def test_sifting_loses_and_adds_no_line(spark, tmp_path, loads, monkeypatch, keys):
    """Whatever the filter's size; with orders sent twice, orders and lines without an id."""
    monkeypatch.setattr(bronze, "sifted_joins", lambda spark, _: sifted_joins(spark, keys))
    t = Tables(spark, SF)
    lines, orders = t.raw("order_items"), t.raw("orders")
    unnamed = F.lit(None).cast("string")
    lines = lines.unionByName(lines.limit(9).withColumn("order_id", unnamed))
    again = orders.filter("order_date > '2001-01-01'")
    orders = orders.unionByName(again).unionByName(again.withColumn("order_id", unnamed))
    bronze.load_batch(spark, orders, str(tmp_path), "orders", star.MARK)
    n = bronze.load_batch(spark, lines, str(tmp_path), "order_items", star.MARK)
    assert "might_contain" in loads[1]
    got = bronze.read_batch(spark, str(tmp_path), "order_items", star.MARK).drop(bronze.INGESTED)
    wanted = incremental.items_after(lines, orders, star.MARK)
    assert got.count() == wanted.count() == n > 0
    assert got.exceptAll(wanted).isEmpty() and wanted.exceptAll(got).isEmpty()


def test_writes_are_rebalanced_by_month(stored, tmp_path, monkeypatch):
    hinted = stored[0].hint("rebalance", "order_year", "order_month")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(hinted)
    _write_partitions(stored[0], str(tmp_path / "t"), ("order_year", "order_month"), "append")
    months = list((tmp_path / "t").glob("order_year=*/order_month=*"))
    files = list((tmp_path / "t").glob("order_year=*/order_month=*/*.parquet"))
    assert len(files) == len(months) > 12


def test_derived_columns_are_computed_after_the_rows_are_dealt(stored, tmp_path, monkeypatch):
    written = []
    monkeypatch.setattr(
        tables, "counted", lambda df, write: written.append(plan(df)) or write(df) or 0
    )
    _write_partitions(
        stored[0], str(tmp_path / "t"), ("order_year", "order_month"), "append",
        silver.derived("stg_orders"),
    )
    (text,) = written
    assert "md5" in text.split("REBALANCE_PARTITIONS_BY_COL")[0]
    got = stored[0].sparkSession.read.schema(stored[0].schema).parquet(str(tmp_path / "t"))
    assert got.select("order_id", "surrogate_key").exceptAll(
        stored[0].select("order_id", "surrogate_key")
    ).isEmpty()
    assert got.count() == stored[0].count()


# ---- one key with a large share of all rows ----------------------------------------------------


@pytest.fixture
def hot_lines(spark):
    """Lines of which a third belong to one order and a third to one item."""
    number = F.col("id")
    return spark.range(0, 120_000, 1, 8).select(
        F.concat(F.lit("L"), number.cast("string")).alias("order_item_id"),
        F.when(number % 3 == 0, "O0").otherwise(
            F.concat(F.lit("O"), (number % 5000).cast("string"))
        ).alias("order_id"),
        F.when(number % 3 == 1, "I0").otherwise(
            F.concat(F.lit("I"), (number % 300).cast("string"))
        ).alias("item_id"),
        F.lit("x").alias("item_name"), F.lit("y").alias("category"), F.lit("S").alias("size"),
        F.lit(1).alias("quantity"),
        F.lit(10).cast("decimal(10,2)").alias("unit_price"),
        F.lit(0).cast("decimal(10,2)").alias("discount_applied"),
        F.lit(10).cast("decimal(10,2)").alias("line_total"),
        F.lit(None).cast("string").alias("promo_id"),
    )


@pytest.fixture
def many_orders(spark):
    number = F.col("id")
    return spark.range(0, 5000, 1, 4).select(
        F.concat(F.lit("O"), number.cast("string")).alias("order_id"),
        F.lit("LOC-GRM").alias("location_id"), F.lit("G").alias("location_name"),
        F.lit("2024-03-08").cast("date").alias("order_date"), F.lit(False).alias("is_refund"),
    )


@pytest.fixture
def large_menu(spark):
    return spark.range(0, 300, 1, 2).select(
        F.concat(F.lit("I"), F.col("id").cast("string")).alias("item_id"),
        F.lit("z").alias("subcategory"), F.lit(4).cast("decimal(10,2)").alias("cost_price"),
    )


def test_hot_order_and_hot_item_are_split(hot_lines, many_orders, large_menu, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="64KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="128KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__coalescePartitions__enabled="false",
        shuffle__partitions="16",
    )
    lines = silver.stg_order_items(hot_lines, many_orders, large_menu)
    text = final_plan(lines).split("Initial Plan")[0]
    assert text.count("SortMergeJoin(skew=true)") == 2
    assert lines.count() == 120_000
    # the grouping that follows on the join key does not keep the join from being split
    profit = gold.order_profit(lines)
    assert "SortMergeJoin(skew=true)" in final_plan(profit).split("Initial Plan")[0]
    hot = {r["order_id"]: r["gross_profit"] for r in rows(profit.filter("order_id = 'O0'"))}
    assert hot == {"O0": 40_000 * 6 + 6 * sum(1 for i in range(120_000) if i % 5000 == 0 and i % 3)}


def test_hot_item_spreads_before_it_is_counted(hot_lines, many_orders, large_menu):
    """Rows of one item meet by (item, order) first, so they are shared by all tasks."""
    lines = silver.stg_order_items(hot_lines, many_orders, large_menu)
    stats = gold.item_stats(gold.monthly_items(silver.by_month(lines)))
    text = plan(stats)
    shuffles = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert any(s.startswith("order_id#") or "order_id#" in s for s in shuffles)
    got = {r["item_id"]: r["total_orders"] for r in rows(stats)}
    direct = lines.filter("item_id = 'I0'").select("order_id").distinct().count()
    assert got["I0"] == direct


def test_hot_null_and_hot_unknown_item_are_counted_per_item_first(spark):
    lines = spark.range(90_000).select(
        F.when(F.col("id") % 3 == 0, None)
        .when(F.col("id") % 3 == 1, "gone")
        .otherwise("I1")
        .alias("item_id")
    )
    menu = spark.sql("select 'I1' as item_id union all select 'I1' union all select null")
    assert rows(quality.unmatched_items(lines, menu)) == [{"unmatched": 60_000}]
