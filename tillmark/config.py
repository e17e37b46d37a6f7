"""Names, codes and bounds the jobs share."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: the columns each raw export must have -----------------------------------

RAW_COLUMNS: dict[str, tuple[str, ...]] = {
    "orders": (
        "order_id", "location_id", "location_name", "order_date", "order_time", "order_type",
        "cashier_id", "subtotal", "discount_amount", "tax_amount", "total_amount",
        "payment_method", "is_refund",
    ),
    "order_items": (
        "order_item_id", "order_id", "item_id", "item_name", "category", "size", "quantity",
        "unit_price", "discount_applied", "line_total", "promo_id",
    ),
    "menu": (
        "item_id", "item_name", "category", "subcategory", "size", "selling_price",
        "cost_price", "is_active", "launch_date", "is_seasonal",
    ),
    "locations": (
        "location_id", "location_name", "address", "seating_capacity", "opening_date",
        "manager_name", "phone", "is_active",
    ),
    "promotions": (
        "promo_id", "promo_name", "discount_type", "discount_value", "applies_to",
        "start_date", "end_date", "location_id", "day_of_week",
    ),
    "menu_price_history": (
        "price_history_id", "item_id", "selling_price", "cost_price", "effective_from",
        "effective_to", "is_current", "change_reason",
    ),
}

# Loaded by high-water mark; the other exports are replaced on every run.
INCREMENTAL_TABLES = ("orders", "order_items")

# --- Fixed values: codes and bands used in Silver and Gold ----------------------------------

LOCATION_CODES = ("LOC-GRM", "LOC-WTD", "LOC-DUN", "LOC-WIN", "LOC-PTC")

ORDER_TYPES = ("Dine-In", "Takeout", "Delivery")

DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

WEEKEND_DAYS = (5, 6)  # days count from Sunday = 0

DAY_PARTS = (("Lunch", 11, 14), ("Afternoon", 15, 16), ("Dinner", 17, 21))  # whole hours, both ends
OTHER_DAY_PART = "Late Night"

# (popular, profitable) -> class, recommendation; a missing margin counts as the last pair.
MENU_QUADRANTS = (
    (True, True, "Star", "Keep & Promote"),
    (True, False, "Plow Horse", "Increase Price"),
    (False, True, "Puzzle", "Remarket"),
)
OTHER_QUADRANT = ("Dog", "Consider Removing")
MENU_CLASSES = ("Star", "Plow Horse", "Puzzle", "Dog")

# --- Fixed values: texts a CSV export may use for a missing value (the pandas default set) ---

NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SILVER_PARTITIONS = ("order_year", "order_month")


@dataclass(frozen=True)
class QualityRules:
    """Bounds of the quality gate. The defaults are the fixed values of the production gate."""

    locations: tuple[str, ...] = LOCATION_CODES
    order_types: tuple[str, ...] = ORDER_TYPES
    first_day: str = "2024-01-01"
    last_day: str = "2024-12-31"
    closed_days: tuple[str, ...] = ("2024-12-25", "2024-01-01")
    total_tolerance: float = 0.02
    lowest_price: float = 0.99
    highest_price: float = 89.99
    menu_rows: int = 47
    highest_cost_ratio: float = 0.45
