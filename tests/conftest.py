from __future__ import annotations

import csv
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tillmark.config import RAW_COLUMNS  # noqa: E402
from tillmark.session import configure  # noqa: E402


def pytest_sessionstart(session):
    """Test modules go by their bare names: two of one name would keep pytest from collecting."""
    found = [p.name for p in Path(__file__).parent.rglob("test_*.py")]
    repeated = sorted({n for n in found if found.count(n) > 1})
    if repeated:
        raise pytest.UsageError(f"test modules of one name: {repeated}")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    os.environ.setdefault("PYSPARK_PYTHON", sys.executable)
    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tillmark-tests")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("scratch")))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session
    session.stop()


def rows(df) -> list[dict]:
    return [r.asDict(recursive=True) for r in df.collect()]


def one(df) -> dict:
    found = rows(df)
    assert len(found) == 1, found
    return found[0]


def by(df, key: str) -> dict:
    return {r[key]: r for r in rows(df)}


# ---- a small, clean business ---------------------------------------------------------------

MENU = [
    # id, name, category, subcategory, size, price, cost
    ("M1", "Poutine", "Sides", "Fries", "L", "10.00", "3.00"),
    ("M2", "Burger", "Mains", "Beef", "M", "20.00", "8.00"),
    ("M3", "Soup, of the day", "Starters", "Soup", "S", "5.00", "1.00"),
]
SITES = [("LOC-GRM", "Green Mount"), ("LOC-WTD", "Westend")]


def order(number: int, day: str, *, site: int = 0, time: str = "12:30:00", kind: str = "Dine-In",
          total: str = "11.30", subtotal: str = "10.00", tax: str = "1.30", discount: str = "0.00",
          refund: str = "False", **extra) -> dict:
    code, name = SITES[site]
    return {
        "order_id": f"O{number}", "location_id": code, "location_name": name, "order_date": day,
        "order_time": time, "order_type": kind, "cashier_id": "C1", "subtotal": subtotal,
        "discount_amount": discount, "tax_amount": tax, "total_amount": total,
        "payment_method": "Card", "is_refund": refund, **extra,
    }


def line(number: int, order_number: int, *, item: int = 0, quantity: str = "1",
         line_total: str | None = None, promo: str = "NA", **extra) -> dict:
    item_id, name, category, _, size, price, _ = MENU[item]
    return {
        "order_item_id": f"L{number}", "order_id": f"O{order_number}", "item_id": item_id,
        "item_name": name, "category": category, "size": size, "quantity": quantity,
        "unit_price": price, "discount_applied": "0.00",
        "line_total": line_total if line_total is not None else price, "promo_id": promo, **extra,
    }


def default_exports() -> dict[str, list[dict]]:
    return {
        "orders": [],
        "order_items": [],
        "menu": [
            {"item_id": i, "item_name": n, "category": c, "subcategory": s, "size": z,
             "selling_price": p, "cost_price": k, "is_active": "True",
             "launch_date": "2023-01-01", "is_seasonal": "False"}
            for i, n, c, s, z, p, k in MENU
        ],
        "locations": [
            {"location_id": code, "location_name": name, "address": "1 Main St",
             "seating_capacity": "40", "opening_date": "2020-05-01", "manager_name": "Sam",
             "phone": "555-0100", "is_active": "True"}
            for code, name in SITES
        ],
        "promotions": [
            {"promo_id": "P1", "promo_name": "Lunch deal", "discount_type": "percent",
             "discount_value": "10", "applies_to": "all", "start_date": "2024-01-01",
             "end_date": "2024-12-31", "location_id": "NA", "day_of_week": "NA"}
        ],
        "menu_price_history": [
            {"price_history_id": f"{i}-1", "item_id": i, "selling_price": p, "cost_price": k,
             "effective_from": "2023-01-01", "effective_to": "", "is_current": "True",
             "change_reason": "launch"}
            for i, _, _, _, _, p, k in MENU
        ],
    }


def write_exports(folder: Path, **tables: list[dict]) -> str:
    folder.mkdir(parents=True, exist_ok=True)
    for name, records in (default_exports() | tables).items():
        columns = list(records[0]) if records else list(RAW_COLUMNS[name])
        with open(folder / f"{name}.csv", "w", newline="") as f:
            writer = csv.DictWriter(f, columns)
            writer.writeheader()
            writer.writerows(records)
    return str(folder)


def frame(spark, records: list[dict], schema: str | None = None):
    """Text columns unless a schema says otherwise."""
    columns = list(records[0])
    schema = schema or ", ".join(f"`{c}` string" for c in columns)
    return spark.createDataFrame([tuple(r[c] for c in columns) for r in records], schema)
