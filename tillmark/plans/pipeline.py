"""The nightly run, in one Spark application.

Arrival check, Bronze load, quality gate, Silver, Gold, assertions, reports; only then does the
mark move on. A run that stops anywhere can be started again and picks up the same batch: Bronze
overwrites the batch's folder, Silver replaces by key, and reports are rebuilt. Gold follows Silver
by the rows that its versions brought and removed. Months are noted before Silver changes in them, and
stay noted until Gold is done, for the case that these rows are not kept any more.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.config import INCREMENTAL_TABLES, RAW_COLUMNS, SILVER_PARTITIONS, QualityRules
from tillmark.operators import additive, gold, quality, reports, silver, typed
from tillmark.operators.incremental import high_water_mark
from tillmark.session import configure, shuffles_freed
from tillmark.sources import bronze, exports, published, state
from tillmark.sources.csv_export import read_export
from tillmark.sources.lines import LineStore
from tillmark.sources.paths import check_arrival, path_exists, remove_path
from tillmark.sources.tables import (
    Merged,
    around,
    in_parts,
    merge_table,
    partition_groups,
    read_table,
    replace_partitions,
    replace_table,
    source_bytes,
    table_exists,
    within,
)


class QualityGateError(Exception):
    """Quality checks or assertions failed; the report holds the details."""


@dataclass(frozen=True)
class Warehouse:
    """Where the tables, the load state and the reports of one business live."""

    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    def silver(self, table: str) -> str:
        return f"{self.root}/silver/{table}"

    def gold(self, mart: str) -> str:
        return f"{self.root}/gold/{mart}"

    def monthly(self, name: str) -> str:
        """Figures by month, of which the marts are made."""
        return f"{self.root}/gold/monthly/{name}"

    @property
    def touched(self) -> str:
        return f"{self.root}/state/touched_months"

    @property
    def audit(self) -> str:
        return f"{self.root}/state/load_audit"

    @property
    def state(self) -> str:
        return f"{self.root}/state/high_water"

    @property
    def nights(self) -> str:
        return f"{self.root}/state/nights"

    @property
    def last_day(self) -> str:
        """Orders loaded of the mark's own day."""
        return f"{self.root}/state/last_day"

    @property
    def lines(self) -> str:
        """All lines by order, where late ones count."""
        return f"{self.root}/bronze/lines"

    @property
    def reports(self) -> str:
        return f"{self.root}/reports"


@dataclass
class RunResult:
    audit: dict[str, int] = field(default_factory=dict)  # table -> rows written
    marks: dict[str, date] = field(default_factory=dict)


@dataclass(frozen=True)
class Night:
    """What a night goes on from: the marks, and the names of its batches in Bronze.

    Strictly, a batch is named by the mark. With late rows several nights may start from one mark, so
    the night's number is part of the name."""

    number: int
    marks: dict[str, date]
    late: bool = False

    @property
    def names(self) -> dict[str, date | str]:
        if not self.late:
            return self.marks
        return {
            t: f"{self.marks.get(t, bronze.FIRST_BATCH)}.{self.number}" for t in INCREMENTAL_TABLES
        }


def night_of(spark: SparkSession, where: Warehouse, late: bool) -> Night:
    if not late:
        return Night(0, state.read_marks(spark, where.state))
    done, mark = state.last_night(spark, where.nights)
    marks = {} if mark is None else {t: mark for t in INCREMENTAL_TABLES}
    return Night(done + 1, marks, late)


REPORTS = {
    "menu_performance": ("mart_menu_performance", reports.report_menu_performance),
    "location_comparison": ("mart_location_comparison", reports.report_location_comparison),
    "revenue_trends": ("mart_revenue_trends", reports.report_revenue_trends),
    "time_analysis": ("mart_time_analysis", reports.report_time_analysis),
}


def load_bronze(
    spark: SparkSession, raw_dir: str, where: Warehouse, marks: dict[str, date]
) -> dict[str, int]:
    return {
        f"bronze_{table}": bronze.load_batch(
            spark, read_export(spark, raw_dir, table), where.bronze, table, marks.get(table)
        )
        for table in RAW_COLUMNS
    }


def load_bronze_late(
    spark: SparkSession, export: Callable[[str], DataFrame], where: Warehouse, night: Night
) -> dict[str, int]:
    """The night's batches with late rows: orders of the mark's own day, and lines of any order."""
    loaded = state.loaded_on(spark, where.last_day, night.marks.get("orders"))
    lines = LineStore(spark, where.lines)
    tables = list(RAW_COLUMNS)
    if lines.taken("nights") >= night.number:
        # An earlier try of this night got as far as Silver: its lines are seen, its batch stays.
        tables.remove("order_items")
    return {
        f"bronze_{table}": bronze.load_late(
            spark, export(table), where.bronze, table,
            night.marks.get("orders"), night.names.get(table), loaded, lines,
        )
        for table in tables
    }


def quality_gate(
    spark: SparkSession, where: Warehouse, marks: dict[str, date], rules: QualityRules, day: date,
    own: Iterable[quality.Check] = (),
) -> None:
    """Checks the batch just loaded; writes the report, then raises if a check failed."""
    batch = {
        t: bronze.read_batch(spark, where.bronze, t, marks.get(t))
        for t in ("orders", "order_items", "menu")
    }
    results = quality.quality_checks(batch["orders"], batch["order_items"], batch["menu"], rules, own)
    report = quality.quality_report(results)
    path = exports.write_quality_report(report, where.reports, day)
    summary = spark.read.schema(report.schema).json(path).select("summary.*").first()
    if summary.failed:
        raise QualityGateError(f"{summary.failed} data quality checks failed. See {path}")


def build_silver(
    spark: SparkSession, where: Warehouse, marks: dict[str, date]
) -> dict[str, int]:
    """Merges the batch into Silver.

    The batch itself is the delta: it is what Bronze loaded after the mark. Filtering once more
    by the newest day in Silver would lose rows when a run broke off between two tables.
    Rows are matched by their ids, of which the surrogate keys are hashes: equal matches, but ids
    mostly grow over time, so that a merge can skip files by them.
    """
    audit = {}
    raw = {
        t: bronze.read_batch(spark, where.bronze, t, marks.get(t))
        for t in ("orders", "order_items", "menu")
    }
    orders = silver.stg_orders(typed.src_orders(raw["orders"]))
    audit["stg_orders"] = merge_silver(spark, where, "stg_orders", silver.stamped(orders), "order_id")
    # Lines are costed against the orders of the batch: the same rows that were just merged.
    items = silver.stg_order_items(
        typed.src_order_items(raw["order_items"]), orders, typed.src_menu(raw["menu"])
    )
    items = silver.stamped(silver.by_month(items), at=silver.this_moment())
    # Lines go by their order: all costed lines of an order in the batch are replaced.
    audit["stg_order_items"] = merge_silver(
        spark, where, "stg_order_items",
        in_parts(items, "order_id", source_bytes(raw["order_items"])), "order_id",
        raw["orders"].select("order_id").filter("order_id is not null"),
    )
    return audit


def build_silver_late(spark: SparkSession, where: Warehouse, night: Night) -> dict[str, int]:
    """Merges the batch into Silver, and with it all lines of the orders that it touches.

    These are the batch's orders, those of its lines, and those that earlier versions of its lines were
    in. Their lines come from the buckets they fall into, so a line finds its order whichever of them
    came first, and however many nights ago.
    """
    batch = {
        t: bronze.read_batch(spark, where.bronze, t, night.names.get(t))
        for t in ("orders", "order_items", "menu")
    }
    store = LineStore(spark, where.lines)
    ids = batch["orders"].select("order_id").union(batch["order_items"].select("order_id"))
    if store.exists():
        ids = ids.union(store.orders_before(batch["order_items"]))
    # As first found: once the lines are in the store, their own version is the last one.
    path = f"{where.lines}/touched/night={night.number}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        with shuffles_freed(spark):
            ids.filter("order_id is not null").distinct().write.mode("overwrite").parquet(path)
    ids = spark.read.schema("order_id string").parquet(path)

    orders = silver.stg_orders(typed.src_orders(batch["orders"]))
    audit = {"stg_orders": merge_silver(
        spark, where, "stg_orders", silver.stamped(orders), "order_id"
    )}
    store.add(batch["order_items"].drop(bronze.INGESTED), night.number, "nights")
    # The batch's own orders are at hand; for those that came before, Silver is searched.
    before = ids.join(orders.select("order_id"), "order_id", "left_anti")
    earlier = around(read_table(spark, where.silver("stg_orders")), before, "order_id").join(
        before, "order_id", "left_semi"
    )
    known = orders.unionByName(earlier.select(*orders.columns))
    menu, at = typed.src_menu(batch["menu"]), silver.this_moment()
    items = [
        silver.stg_order_items(typed.src_order_items(lines), known.filter(own), menu)
        for lines, own in store.parts_of(ids)
    ]
    audit["stg_order_items"] = merge_silver(
        spark, where, "stg_order_items",
        [silver.stamped(silver.by_month(part), at=at) for part in items], "order_id", ids,
    )
    return audit


def merge_silver(
    spark: SparkSession, where: Warehouse, table: str, batch: DataFrame | Sequence[DataFrame], key: str,
    keys: DataFrame | None = None,
) -> int:
    def note(months: tuple[tuple, ...]) -> None:
        rows = spark.createDataFrame(months, "order_year int, order_month int")
        rows.write.mode("append").json(where.touched)

    merged: Merged = merge_table(
        spark, where.silver(table), batch, key, keys=keys, before=note, derived=silver.derived(table)
    )
    return merged.rows


# Figures by month that add up, of which the marts are made, from Silver orders and costed lines.
MONTHLY: dict[str, Callable[[DataFrame, DataFrame], DataFrame]] = {
    "sales": lambda orders, items: additive.sales(orders),
    "hours": lambda orders, items: additive.hours(orders),
    "profits": lambda orders, items: additive.profits(items),
    "items": lambda orders, items: additive.items(items),
}
# The one Silver table that each of them reads, and what it is grouped by.
FOLLOWS = {
    "sales": ("stg_orders", gold.MONTH_KEYS), "hours": ("stg_orders", gold.HEATMAP_KEYS),
    "profits": ("stg_order_items", gold.MONTH_KEYS),
    "items": ("stg_order_items", (*gold.ITEM_KEYS, "order_year", "order_month")),
}


def touched_months(spark: SparkSession, where: Warehouse) -> list[tuple] | None:
    """Months to compute again; None for all of them, before the first time."""
    if not all(table_exists(spark, where.monthly(name)) for name in MONTHLY):
        return None
    if not path_exists(spark, where.touched):
        return []
    noted = spark.read.schema("order_year int, order_month int").json(where.touched)
    return [tuple(r) for r in noted.distinct().collect()]  # at most the months of Silver


def update_months(spark: SparkSession, where: Warehouse) -> None:
    """Brings the monthly figures up to Silver.

    Each follows its Silver table by the rows that the versions since brought and removed, and reads no
    others. Where these are not kept, since many merges came in between, the touched months are
    computed again. With its rows a version's number is published, so none is counted twice.
    """
    months = touched_months(spark, where)
    silver_now = {t: published.current(spark, where.silver(t)) for t in ("stg_orders", "stg_order_items")}
    for name in MONTHLY:
        source = FOLLOWS[name][0]
        now, done = silver_now[source], published.current(spark, where.monthly(name))
        last = done.taken.get(source) if done else None
        if now is None or last == now.number:
            continue
        changes = None
        if last is not None:
            changes = published.changes_since(spark, where.silver(source), last)
        if changes is None:
            recompute(spark, where, name, months)
        else:
            follow(spark, where, name, changes)
    remove_path(spark, where.touched)


def recompute(
    spark: SparkSession, where: Warehouse, name: str, months: list[tuple] | None
) -> None:
    """Computes one of the monthly figures again for some months, or for all (None): as many months
    at once as one job had better shuffle."""
    source = FOLLOWS[name][0]
    now = published.current(spark, where.silver(source))
    tables = [read_table(spark, where.silver(t)) for t in ("stg_orders", "stg_order_items")]
    folders = now.folders
    if months is not None:
        folders = [f for f in folders if published.values_of(f, now.schema) in months]
    parts = [
        MONTHLY[name](*[df.filter(within(SILVER_PARTITIONS, group)) for df in tables])
        for group in partition_groups(spark, where.silver(source), now, folders) or [[]]
    ]
    replace_partitions(
        parts, where.monthly(name), SILVER_PARTITIONS, months or (), {source: now.number}
    )


def follow(
    spark: SparkSession, where: Warehouse, name: str, changes: list[published.Version]
) -> None:
    """Adds to monthly figures what the changes of a Silver table brought, less what they removed.

    An order may change several times: each version is counted for itself, as within one every order is
    whole.
    """
    source, keys = FOLLOWS[name]
    path, figures = where.silver(source), MONTHLY[name]
    months = {
        published.values_of(f, v.schema) for v in changes for f in (*v.change.added, *v.change.removed)
    }
    known = read_table(spark, where.monthly(name))

    def whole(group: list[tuple]) -> DataFrame:
        parts = [known.filter(within(SILVER_PARTITIONS, group))]
        for version in changes:
            for folders, sign in ((version.change.added, 1), (version.change.removed, -1)):
                if own := [f for f in folders if published.values_of(f, version.schema) in group]:
                    rows = published.read_folders(spark, path, version.schema, own)
                    part = figures(rows, rows)
                    parts.append(part if sign > 0 else additive.less(part, keys))
        return additive.together(parts, keys)

    touched = [f for v in changes for f in (*v.change.added, *v.change.removed)]
    groups = partition_groups(spark, path, changes[-1], touched) or [[]]
    replace_partitions(
        [whole(group) for group in groups], where.monthly(name), SILVER_PARTITIONS, months,
        {source: changes[-1].number},
    )


def build_gold(spark: SparkSession, where: Warehouse) -> dict[str, int]:
    """The marts, from monthly figures, which follow Silver by its changes."""
    update_months(spark, where)
    monthly = {name: read_table(spark, where.monthly(name)) for name in MONTHLY}
    replace_table(
        gold.item_stats(additive.monthly_items(monthly["items"])), where.gold("_item_stats")
    )
    marts = {
        "mart_menu_performance": gold.mart_menu_performance(
            read_table(spark, where.gold("_item_stats"))
        ),
        "mart_location_comparison": gold.mart_location_comparison(
            additive.monthly_locations(monthly["sales"], monthly["profits"])
        ),
        "mart_revenue_trends": gold.mart_revenue_trends(additive.monthly_revenue(monthly["sales"])),
        "mart_time_analysis": additive.mart_time_analysis(monthly["hours"]),
    }
    return {name: replace_table(mart, where.gold(name)) for name, mart in marts.items()}


def all_assertions(spark: SparkSession, where: Warehouse, marks: dict[str, date]) -> DataFrame:
    """Declared tests of all layers: test, table, column, violations."""
    raw = {
        t: bronze.read_batch(spark, where.bronze, t, marks.get(t))
        for t in ("orders", "order_items", "menu", "locations")
    }
    return quality.stacked(
        [
            quality.bronze_assertions(
                typed.src_orders(raw["orders"]),
                typed.src_order_items(raw["order_items"]),
                typed.src_menu(raw["menu"]),
                typed.src_locations(raw["locations"]),
            ),
            quality.silver_assertions(
                read_table(spark, where.silver("stg_orders")),
                read_table(spark, where.silver("stg_order_items")),
                raw["orders"].select("order_id"),
                raw["order_items"].select("order_item_id"),
            ),
            quality.gold_assertions(read_table(spark, where.gold("mart_menu_performance"))),
        ]
    )


def check_assertions(spark: SparkSession, where: Warehouse, marks: dict[str, date]) -> None:
    broken = all_assertions(spark, where, marks).filter("violations > 0").collect()
    if broken:
        named = [f"{r.test}({r.table}.{r.column}): {r.violations}" for r in broken]
        raise QualityGateError(f"Assertions failed: {named}")


def write_reports(spark: SparkSession, where: Warehouse, day: date) -> None:
    for name, (mart, query) in REPORTS.items():
        exports.write_report(
            query(read_table(spark, where.gold(mart))), where.reports, name, day
        )


def record_audit(
    spark: SparkSession, where: Warehouse, counts: dict[str, int], day: date
) -> None:
    """Appends the rows written to each table."""
    rows = [(day, table, n) for table, n in counts.items()]
    (
        spark.createDataFrame(rows, "run_day date, table string, rows long")
        .withColumn("loaded_at", F.current_timestamp())
        .coalesce(1)
        .write.mode("append")
        .json(where.audit)
    )


def read_audit(spark: SparkSession, where: Warehouse) -> DataFrame:
    return spark.read.schema(
        "run_day date, table string, rows long, loaded_at timestamp"
    ).json(where.audit)


def complete(spark: SparkSession, where: Warehouse, night: Night, day: date) -> dict[str, date]:
    """Moves the marks on."""
    loaded = bronze.read_batch(spark, where.bronze, "orders", night.names.get("orders"))
    mark = high_water_mark(loaded)
    if not night.late:
        state.advance_marks(mark, where.state)
        return state.read_marks(spark, where.state)
    newest = mark.agg(F.max("high_water")).first()[0]
    if newest is not None:
        # The ledger goes first: the mark must not be without its day's orders.
        state.record_loaded(loaded, where.last_day, newest)
    state.record_night(spark, where.nights, night.number, day, newest)
    state.advance_marks(mark, where.state)  # for whoever reads the marks; late nights have their own
    remove_path(spark, f"{where.lines}/touched")
    return night_of(spark, where, late=True).marks


STEPS = ("ingest", "gate", "silver", "gold", "reports")


def run(
    spark: SparkSession,
    raw_dir: str,
    root: str,
    rules: QualityRules = QualityRules(),
    day: date | None = None,
    steps: Iterable[str] = STEPS,
    checks: Iterable[quality.Check] = (),
    late: bool = False,
) -> RunResult:
    """The given steps of a night. The mark moves on with the last one, so that steps which are
    run one by one work on the same batch.

    Strictly, a batch is what is dated after the mark, with the lines of these orders. With `late` it
    also takes orders of the mark's own day that came after the last load, and lines that came after
    their order or before it. A warehouse is kept one way or the other from its first night on.
    """
    configure(spark)
    steps = set(steps)
    where, day = Warehouse(root.rstrip("/")), day or date.today()
    night = night_of(spark, where, late)
    marks, names = night.marks, night.names
    result = RunResult(marks=marks)

    def wrote(counts: dict[str, int]) -> None:
        result.audit |= counts
        record_audit(spark, where, counts, day)

    if "ingest" in steps:
        check_arrival(spark, raw_dir)
        if late:
            wrote(load_bronze_late(spark, lambda t: read_export(spark, raw_dir, t), where, night))
        else:
            wrote(load_bronze(spark, raw_dir, where, marks))
    if "gate" in steps:
        quality_gate(spark, where, names, rules, day, checks)
    if "silver" in steps:
        wrote(build_silver_late(spark, where, night) if late else build_silver(spark, where, marks))
    if "gold" in steps:
        wrote(build_gold(spark, where))
        check_assertions(spark, where, names)
    if "reports" in steps:
        write_reports(spark, where, day)
        result.marks = complete(spark, where, night, day)
    return result
