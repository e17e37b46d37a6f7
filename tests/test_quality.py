import json
from datetime import date

import pytest

from tests.conftest import by, default_exports, frame, line, one, order, rows
from tillmark.config import QualityRules
from tillmark.operators import quality
from tillmark.sources import exports

RULES = QualityRules(menu_rows=3)


def results(spark, orders, items, menu=None, rules=RULES):
    found = quality.quality_checks(
        frame(spark, orders), frame(spark, items),
        frame(spark, menu or default_exports()["menu"]), rules,
    )
    return by(found, "check")


def test_clean_data_passes_all_18_checks(spark):
    got = results(spark, [order(1, "2024-03-08"), order(2, "2024-03-09")], [line(1, 1), line(2, 2)])
    assert len(got) == 18 and {r["status"] for r in got.values()} == {"PASS"}
    assert got["menu_47_items"]["result"] == got["menu_47_items"]["expected"] == 3


def test_each_order_check_counts_its_violations(spark):
    got = results(
        spark,
        [
            order(1, "2024-03-08"),
            order(1, "2024-03-08"),
            order(2, "2024-03-08") | {"order_id": None},
            order(3, "2024-03-08") | {"location_id": None},
            order(4, "2024-03-08") | {"location_id": "LOC-ABC"},
            order(5, "2024-03-08", kind="Drive-In"),
            order(6, "2024-03-08", kind=None),
            order(7, "2024-03-08", tax="-1.00", subtotal="12.30"),
            order(8, "2024-03-08", tax="-1.00", subtotal="12.30", refund="True"),
            order(9, "2024-03-08", total="11.40"),
            order(10, "2024-03-08", total="11.40", refund="True"),
            order(11, "2025-01-01"),
            order(12, "2023-12-31"),
            order(13, "2024-12-25"),
            order(14, "2024-01-01"),
            order(15, "2024-12-31", discount="5.00"),  # the discount plays no part in the total
        ],
        [line(1, 1)],
    )
    counts = {k: r["result"] for k, r in got.items() if r["table"] == "bronze_orders"}
    assert counts == {
        "orders_no_null_order_id": 1,
        "orders_no_null_location": 1,
        "orders_valid_locations": 1,
        "orders_valid_order_types": 1,
        "orders_tax_positive": 1,
        "orders_total_matches_subtotal": 1,
        "orders_no_future_dates": 1,
        "orders_date_range_valid": 1,
        "orders_not_on_closed_days": 2,
        "orders_no_duplicate_order_ids": 2,  # the repeat and the row without an id
    }
    assert got["orders_valid_locations"]["status"] == "FAIL"


def test_each_item_and_menu_check_counts_its_violations(spark):
    menu = default_exports()["menu"] + [
        {"item_id": "M9", "selling_price": "5.00", "cost_price": "5.00"}
        | {k: "x" for k in ("item_name", "category", "subcategory", "size", "is_active",
                            "launch_date", "is_seasonal")},
        {"item_id": None, "selling_price": "0", "cost_price": "0"}
        | {k: "x" for k in ("item_name", "category", "subcategory", "size", "is_active",
                            "launch_date", "is_seasonal")},
    ]
    columns = list(menu[0])
    got = results(
        spark,
        [order(1, "2024-03-08")],
        [
            line(1, 1), line(2, 1) | {"order_id": None}, line(3, 1, quantity="0"),
            line(4, 1) | {"unit_price": "0.98"}, line(5, 1) | {"unit_price": "90"},
            line(6, 1) | {"unit_price": "89.99"}, line(7, 1) | {"item_id": None},
            line(8, 1) | {"item_id": "gone"}, line(9, 1) | {"item_id": "gone"},
        ],
        [{c: m[c] for c in columns} for m in menu],
    )
    counts = {k: r["result"] for k, r in got.items() if r["table"] != "bronze_orders"}
    assert counts == {
        "items_no_null_order_id": 1,
        "items_quantity_positive": 1,
        "items_price_in_range": 2,
        "items_no_null_item_id": 1,
        "items_valid_item_ids": 3,
        "menu_47_items": 5,
        "menu_cost_lt_price": 2,
        "menu_food_cost_reasonable": 1,  # no price, no ratio
    }


def test_own_checks_and_upper_bounds(spark):
    from pyspark.sql import functions as F

    own = [
        quality.Check("orders", "few_discounts", F.col("discount_amount").cast("double") > 0, 1, at_most=True),
        quality.Check("orders", "one_takeout", F.col("order_type") == "Takeout", 1),
        quality.Check("order_items", "few_free_lines", F.col("line_total").cast("double") == 0, 0,
                      at_most=True),
        quality.Check("menu", "two_large", F.col("size") == "L", 2, at_most=True),
    ]
    found = quality.quality_checks(
        frame(spark, [order(1, "2024-03-08"), order(2, "2024-03-08", kind="Takeout")]),
        frame(spark, [line(1, 1, line_total="0"), line(2, 2)]),
        frame(spark, default_exports()["menu"]), RULES, own,
    )
    got = by(found, "check")
    assert len(got) == 22
    assert {c.name: (got[c.name]["result"], got[c.name]["status"]) for c in own} == {
        "few_discounts": (0, "PASS"), "one_takeout": (1, "PASS"), "few_free_lines": (1, "FAIL"),
        "two_large": (1, "PASS"),
    }


def test_no_lines_at_all(spark):
    empty = frame(spark, [line(1, 1)]).limit(0)
    found = quality.quality_checks_items(empty, frame(spark, default_exports()["menu"]), RULES)
    assert {r["result"] for r in rows(found)} == {0}


def test_summary_and_report_document(spark, tmp_path):
    found = spark.sql(
        "select * from values ('a', 't', 0L, 0L, 'PASS'), ('b', 't', 2L, 0L, 'FAIL'),"
        " ('c', 't', 0L, 0L, 'PASS') v(check, table, result, expected, status)"
    )
    assert one(quality.quality_summary(found)) == {
        "total": 3, "passed": 2, "failed": 1, "pass_rate": "66.7%"
    }
    path = exports.write_quality_report(
        quality.quality_report(found), str(tmp_path), date(2024, 3, 8)
    )
    assert path.endswith("quality_report_20240308")
    (part,) = (tmp_path / "quality_report_20240308").glob("part-*.json")
    document = json.loads(part.read_text())
    assert set(document) == {"run_timestamp", "summary", "checks"}
    assert document["summary"]["pass_rate"] == "66.7%"
    assert {c["check"]: c["status"] for c in document["checks"]} == {
        "a": "PASS", "b": "FAIL", "c": "PASS"
    }


def test_assertions(spark):
    df = spark.sql(
        "select * from values (1, 'a', 5.0), (2, 'a', -1.0), (3, null, null), (3, 'b', 9.0)"
        " t(id, name, amount)"
    )
    nulls = by(quality.assert_not_null(df, "t", ["id", "name", "amount"]), "column")
    assert {c: r["violations"] for c, r in nulls.items()} == {"id": 0, "name": 1, "amount": 1}
    assert one(quality.assert_unique(df, "t", "id"))["violations"] == 1
    assert one(quality.assert_unique(df, "t", "name"))["violations"] == 1
    assert one(quality.assert_accepted_range(df, "t", "amount", low=0))["violations"] == 1
    assert one(quality.assert_accepted_range(df, "t", "amount", 0, 5))["violations"] == 2
    assert one(quality.assert_accepted_values(df, "t", "name", ["a"]))["violations"] == 1


def test_mart_assertions(spark):
    mart = spark.sql(
        "select * from values ('Star', 1.0), ('Cow', -2.0), ('Dog', 0.0) t(menu_class, total_revenue)"
    )
    got = by(quality.gold_assertions(mart), "test")
    assert got["accepted_values"]["violations"] == 1
    assert got["accepted_range"]["violations"] == 1


@pytest.mark.parametrize("column", ["check", "table", "result", "expected", "status"])
def test_result_columns(spark, column):
    found = quality.quality_checks_menu(frame(spark, default_exports()["menu"]), RULES)
    assert column in found.columns and len(rows(found)) == 3
