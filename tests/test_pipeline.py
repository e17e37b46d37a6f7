import random
import re
from datetime import date

import pytest

from tests.conftest import default_exports, frame, line, order, rows, write_exports
from tillmark.config import QualityRules
from tillmark.operators import additive, gold, typed
from tillmark.operators import silver as silver_operators
from tillmark.plans import pipeline
from tillmark.plans.pipeline import QualityGateError, Warehouse
from tillmark.sources import bronze, published, state, tables
from tillmark.sources.paths import remove_path
from tillmark.sources.tables import read_table

RULES = QualityRules(menu_rows=3)
DAY = date(2024, 4, 2)

NIGHT_ONE = {
    "orders": [
        order(1, "2024-03-08", total="30.00", subtotal="26.55", tax="3.45"),
        order(2, "2024-03-09", total="10.00", subtotal="8.85", tax="1.15", kind="Takeout"),
        order(3, "2024-03-09", site=1, refund="True"),
    ],
    "order_items": [
        line(1, 1, quantity="2", line_total="20.00"), line(2, 1, item=1), line(3, 2, item=2),
        line(4, 3),
    ],
}
NIGHT_TWO = {
    "orders": NIGHT_ONE["orders"] + [
        order(4, "2024-04-01", site=1, total="60.00", subtotal="53.10", tax="6.90"),
        order(5, "2024-03-09", total="99.00", subtotal="87.61", tax="11.39"),  # came too late
    ],
    "order_items": NIGHT_ONE["order_items"] + [line(5, 4, item=1, quantity="3"), line(6, 5)],
}

GOLD = (
    "mart_menu_performance", "mart_location_comparison", "mart_revenue_trends",
    "mart_time_analysis",
)


def content(df, *dropped):
    return sorted(str(sorted(r.items())) for r in rows(df.drop("_transformed_at", *dropped)))


def silver(spark, root, table):
    return content(read_table(spark, Warehouse(root).silver(table)))


def test_two_nights(spark, tmp_path):
    root = str(tmp_path / "w")
    raw = write_exports(tmp_path / "one", **NIGHT_ONE)
    first = pipeline.run(spark, raw, root, RULES, DAY)
    assert first.audit["bronze_orders"] == 3 and first.audit["stg_order_items"] == 3
    assert first.marks == {"orders": date(2024, 3, 9), "order_items": date(2024, 3, 9)}

    raw = write_exports(tmp_path / "two", **NIGHT_TWO)
    second = pipeline.run(spark, raw, root, RULES, DAY)
    assert second.audit["bronze_orders"] == 1 and second.audit["bronze_order_items"] == 1
    assert second.audit["bronze_menu"] == 3
    assert second.marks["orders"] == date(2024, 4, 1)
    assert bronze.read_bronze(spark, Warehouse(root).bronze, "orders").count() == 4

    # the same as one night with all orders that were in time
    whole = str(tmp_path / "whole")
    in_time = {
        "orders": [o for o in NIGHT_TWO["orders"] if o["order_id"] != "O5"],
        "order_items": [i for i in NIGHT_TWO["order_items"] if i["order_id"] != "O5"],
    }
    pipeline.run(spark, write_exports(tmp_path / "all", **in_time), whole, RULES, DAY)
    for table in ("stg_orders", "stg_order_items"):
        assert silver(spark, root, table) == silver(spark, whole, table)
    for mart in GOLD:
        assert content(read_table(spark, Warehouse(root).gold(mart))) == content(
            read_table(spark, Warehouse(whole).gold(mart))
        )
    for report in ("menu_performance", "location_comparison", "revenue_trends", "time_analysis"):
        path = f"{Warehouse(root).reports}/{report}_20240402.csv"
        assert spark.read.option("header", True).csv(path).count() > 0

    audit = {(r["table"], r["rows"]) for r in rows(pipeline.read_audit(spark, Warehouse(root)))}
    assert {("bronze_orders", 3), ("bronze_orders", 1), ("stg_order_items", 3)} <= audit
    stamped = bronze.read_bronze(spark, Warehouse(root).bronze, "orders")
    assert stamped.filter("_ingested_at is null").count() == 0
    assert "_ingested_at" in typed.src_orders(stamped).columns

    # a night without new orders keeps the mark and the tables
    before = silver(spark, root, "stg_orders")
    third = pipeline.run(spark, raw, root, RULES, DAY)
    assert third.audit["bronze_orders"] == third.audit["stg_orders"] == 0
    assert third.marks["orders"] == date(2024, 4, 1)
    assert silver(spark, root, "stg_orders") == before


def spied_figures(monkeypatch):
    """Has Gold's figures note what they are made of."""
    seen, figures = [], dict(pipeline.MONTHLY)
    spied = {
        name: lambda orders, items, f=f: (seen.append((orders, items)), f(orders, items))[1]
        for name, f in figures.items()
    }
    monkeypatch.setattr(pipeline, "MONTHLY", spied)
    return seen, figures


def equals_a_rebuild(spark, where, names):
    again = {name: content(read_table(spark, where.monthly(name))) for name in names}
    marts = {name: content(read_table(spark, where.gold(name))) for name in GOLD}
    remove_path(spark, f"{where.root}/gold")
    pipeline.build_gold(spark, where)
    assert again == {name: content(read_table(spark, where.monthly(name))) for name in names}
    assert marts == {name: content(read_table(spark, where.gold(name))) for name in GOLD}


def monthly_files(tmp_path):
    found = (tmp_path / "w" / "gold" / "monthly").glob("*/written=*/order_year=*/order_month=*/*.parquet")
    return {str(f) for f in found}


def test_a_night_recomputes_its_months_only(spark, tmp_path, monkeypatch):
    """Where the changes of Silver are not kept."""
    root = str(tmp_path / "w")
    pipeline.run(spark, write_exports(tmp_path / "one", **NIGHT_ONE), root, RULES, DAY)
    march = {f for f in monthly_files(tmp_path) if "order_month=3" in f}
    seen, figures = spied_figures(monkeypatch)
    monkeypatch.setattr(published, "changes_since", lambda *_: None)
    pipeline.run(spark, write_exports(tmp_path / "two", **NIGHT_TWO), root, RULES, DAY)
    now = monthly_files(tmp_path)
    assert march <= now and {f for f in now if "order_month=4" in f}
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    assert len(seen) == len(figures)
    for df in (df for pair in seen for df in pair):
        text = df._jdf.queryExecution().executedPlan().toString()
        (pruned,) = re.findall(r"PartitionFilters: \[(.*?)\], Pushed", text)
        assert "2024/4" in pruned and "2024/3" not in pruned
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    # and the figures are those of a rebuild
    equals_a_rebuild(spark, Warehouse(root), figures)


def test_gold_reads_the_rows_of_changed_orders_only(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    where = Warehouse(root)
    pipeline.run(spark, write_exports(tmp_path / "one", **NIGHT_ONE), root, RULES, DAY)
    march = {f for f in monthly_files(tmp_path) if "order_month=3" in f}
    seen, figures = spied_figures(monkeypatch)
    pipeline.run(spark, write_exports(tmp_path / "two", **NIGHT_TWO), root, RULES, DAY)
    assert march <= monthly_files(tmp_path)
    assert len(seen) == len(figures)
    assert {r.order_id for pair in seen for r in pair[0].collect()} == {"O4"}
    # a correction: one order of March moves to May; its lines go with it
    seen.clear()
    orders = silver_operators.stg_orders(typed.src_orders(
        frame(spark, [order(1, "2024-05-08", total="32.00", subtotal="28.55", tax="3.45")])))
    items = silver_operators.by_month(silver_operators.stg_order_items(
        typed.src_order_items(frame(spark, [line(1, 1, quantity="2", line_total="20.00"), line(2, 1, item=1)])),
        orders, typed.src_menu(frame(spark, default_exports()["menu"]))))
    pipeline.merge_silver(spark, where, "stg_orders", orders, "order_id")
    pipeline.merge_silver(spark, where, "stg_order_items", items, "order_id", orders.select("order_id"))
    pipeline.build_gold(spark, where)
    rows_read = [r for pair in seen for r in pair[0].collect()]
    assert len(seen) == 2 * len(figures) and {r.order_id for r in rows_read} == {"O1"}
    assert {r.order_month for r in rows_read} == {3, 5}
    # run again, it counts nothing twice
    before = content(read_table(spark, where.monthly("sales")))
    pipeline.update_months(spark, where)
    assert len(seen) == 2 * len(figures) and content(read_table(spark, where.monthly("sales"))) == before
    equals_a_rebuild(spark, where, figures)


def test_random_merges_between_two_golds(spark, tmp_path):
    """Orders that change several times, move, become refunds; unknown amounts; empty months."""
    where, draw = Warehouse(str(tmp_path / "w")), random.Random(3)
    menu = typed.src_menu(frame(spark, default_exports()["menu"]))

    def merge():
        numbers = draw.sample(range(30), 12)
        records = [
            order(n, f"2024-0{draw.randint(1, 3)}-1{n % 10}", site=draw.randint(0, 1),
                  kind=draw.choice(["Dine-In", "Takeout", "Other"]), refund=draw.choice(["False", "True"]),
                  total=draw.choice(["11.30", "20.05", None]), time=f"{draw.randint(9, 23):02}:00:00",
                  discount=draw.choice(["1.00", None]))
            for n in numbers
        ]
        lines = [
            line(100 * n + i, n, item=draw.randint(0, 2), quantity=str(draw.randint(0, 3)),
                 line_total=draw.choice(["10.00", "0.00", "7.77"]))
            for n in numbers for i in range(draw.randint(0, 3))
        ] or [line(1, 99)]
        schema = ", ".join(f"`{c}` string" for c in records[0])
        orders = silver_operators.stg_orders(typed.src_orders(frame(spark, records, schema)))
        items = silver_operators.by_month(silver_operators.stg_order_items(
            typed.src_order_items(frame(spark, lines)), orders, menu))
        pipeline.merge_silver(spark, where, "stg_orders", orders, "order_id")
        pipeline.merge_silver(
            spark, where, "stg_order_items", items, "order_id", orders.select("order_id"))

    merge()
    pipeline.update_months(spark, where)
    for merges in (1, 2, 4):  # changes of the last are not all kept any more
        for _ in range(merges):
            merge()
        pipeline.update_months(spark, where)
        tables = [read_table(spark, where.silver(t)) for t in ("stg_orders", "stg_order_items")]
        for name, figures in pipeline.MONTHLY.items():
            kept = read_table(spark, where.monthly(name))
            fresh = figures(*tables).select(*kept.columns)
            assert content(kept) == content(fresh), (name, merges)
        # and what is made of them equals the figures of all rows
        monthly = {n: read_table(spark, where.monthly(n)) for n in pipeline.MONTHLY}
        for made, plain in [
            (additive.monthly_revenue(monthly["sales"]), gold.monthly_revenue(tables[0])),
            (additive.mart_time_analysis(monthly["hours"]), gold.mart_time_analysis(tables[0])),
            (additive.monthly_locations(monthly["sales"], monthly["profits"]),
             gold.monthly_locations(*tables)),
            (additive.monthly_items(monthly["items"]), gold.monthly_items(tables[1])),
        ]:
            assert content(made) == content(plain) and made.dtypes == plain.dtypes


def test_figures_month_by_month(spark, tmp_path, monkeypatch):
    """Months that are too many for one job: computed anew and followed, each by itself."""
    where = Warehouse(str(tmp_path / "w"))
    menu = typed.src_menu(frame(spark, default_exports()["menu"]))
    monkeypatch.setattr(tables, "PART_BYTES", 1)
    written, write = [], tables.counted
    monkeypatch.setattr(tables, "counted", lambda df, out: written.append(df) or write(df, out))
    for day in ("2024-03-02", "2024-03-05"):
        records = [order(n, f"2024-0{1 + n % 3}-08" if n % 4 else day) for n in range(12)]
        orders = silver_operators.stg_orders(typed.src_orders(frame(spark, records)))
        items = silver_operators.by_month(silver_operators.stg_order_items(
            typed.src_order_items(frame(spark, [line(n, n % 12, item=n % 3) for n in range(30)])),
            orders, menu))
        pipeline.merge_silver(spark, where, "stg_orders", orders, "order_id")
        pipeline.merge_silver(
            spark, where, "stg_order_items", items, "order_id", orders.select("order_id"))
        written.clear()
        pipeline.update_months(spark, where)
        assert len(written) == 4 * 3  # four figures, three months
        silver_now = [read_table(spark, where.silver(t)) for t in ("stg_orders", "stg_order_items")]
        for name, figures in pipeline.MONTHLY.items():
            kept = read_table(spark, where.monthly(name))
            assert content(kept) == content(figures(*silver_now).select(*kept.columns)), name


@pytest.mark.parametrize("late", [False, True])
def test_two_nights_in_parts(spark, tmp_path, monkeypatch, late):
    """Batches that are too large for one job give the same tables."""
    roots = [str(tmp_path / "whole"), str(tmp_path / "parts")]
    for root, size in zip(roots, (tables.PART_BYTES, 3000)):
        monkeypatch.setattr(tables, "PART_BYTES", size)
        for name, night in (("one", NIGHT_ONE), ("two", NIGHT_TWO)):
            pipeline.run(spark, write_exports(tmp_path / name, **night), root, RULES, DAY, late=late)
    assert silver(spark, roots[0], "stg_orders") == silver(spark, roots[1], "stg_orders")
    lines = [read_table(spark, Warehouse(r).silver("stg_order_items")) for r in roots]
    assert content(lines[0]) == content(lines[1])
    for mart in GOLD:
        a, b = (content(read_table(spark, Warehouse(r).gold(mart))) for r in roots)
        assert a == b
    bronze_lines = [bronze.read_bronze(spark, Warehouse(r).bronze, "order_items") for r in roots]
    a, b = (content(df.drop("_ingested_at")) for df in bronze_lines)
    assert a == b


def test_months_stay_noted_until_gold_is_done(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    where = Warehouse(root)
    pipeline.run(spark, write_exports(tmp_path / "one", **NIGHT_ONE), root, RULES, DAY)
    moved = silver_operators.stg_orders(typed.src_orders(
        frame(spark, [order(1, "2024-05-08", total="30.00", subtotal="26.55", tax="3.45")])))
    pipeline.merge_silver(spark, where, "stg_orders", moved, "order_id")
    # the run broke off here; the next one merges the same, which finds nothing in March any more
    pipeline.merge_silver(spark, where, "stg_orders", moved, "order_id")
    assert set(pipeline.touched_months(spark, where)) == {(2024, 3), (2024, 5)}
    pipeline.build_gold(spark, where)
    assert pipeline.touched_months(spark, where) == []
    trends = rows(read_table(spark, where.gold("mart_revenue_trends")))
    assert {(r["order_month"], str(r["total_revenue"])) for r in trends} == {(3, "10.00"), (5, "30.00")}


def test_steps_one_by_one(spark, tmp_path):
    from tillmark.__main__ import main

    root = str(tmp_path / "w")
    raw = write_exports(tmp_path / "one", **NIGHT_ONE)
    for step in ("ingest", "gate", "silver"):
        found = pipeline.run(spark, raw, root, RULES, DAY, steps=[step])
        assert found.marks == {}
    pipeline.run(spark, raw, root, RULES, DAY, steps=["gold", "reports"])
    assert state.read_marks(spark, Warehouse(root).state)["orders"] == date(2024, 3, 9)
    main([raw, root, "--day", "2024-04-03", "--steps", "ingest,silver,gold"])
    assert state.read_marks(spark, Warehouse(root).state)["orders"] == date(2024, 3, 9)
    with pytest.raises(SystemExit):
        main([raw, root, "--steps", "nothing"])


def test_the_pipeline_needs_no_scratch_folder(spark, tmp_path, monkeypatch):
    import tillmark.session

    def refuse(*_):
        raise AssertionError("scratch")

    monkeypatch.setattr(tillmark.session, "scratch_path", refuse)
    root = str(tmp_path / "w")
    for name, night in (("one", NIGHT_ONE), ("two", NIGHT_TWO)):
        pipeline.run(spark, write_exports(tmp_path / name, **night), root, RULES, DAY)
    assert not (tmp_path / "w" / "silver" / "stg_orders" / "_stage").exists()


def test_gate_halts_after_writing_its_report_and_loses_nothing(spark, tmp_path):
    root = str(tmp_path / "w")
    bad = NIGHT_ONE | {"orders": NIGHT_ONE["orders"] + [order(9, "2024-03-10", kind="Drive-In")]}
    raw = write_exports(tmp_path / "bad", **bad)
    with pytest.raises(QualityGateError, match="1 data quality checks failed"):
        pipeline.run(spark, raw, root, RULES, DAY)
    where = Warehouse(root)
    report = spark.read.json(f"{where.reports}/quality_report_20240402").first()
    assert (report.summary.failed, report.summary.total) == (1, 18)
    assert state.read_marks(spark, where.state) == {}

    raw = write_exports(tmp_path / "fixed", **NIGHT_ONE)
    fixed = pipeline.run(spark, raw, root, RULES, DAY)
    assert fixed.audit["bronze_orders"] == 3
    assert read_table(spark, where.silver("stg_orders")).count() == 3


def test_a_run_that_breaks_off_can_be_started_again(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    pipeline.run(spark, write_exports(tmp_path / "one", **NIGHT_ONE), root, RULES, DAY)
    raw = write_exports(tmp_path / "two", **NIGHT_TWO)

    def lost(*_):
        raise RuntimeError("lost")

    for step in ("build_gold", "write_reports"):
        with monkeypatch.context() as m:
            m.setattr(pipeline, step, lost)
            with pytest.raises(RuntimeError, match="lost"):
                pipeline.run(spark, raw, root, RULES, DAY)
        assert state.read_marks(spark, Warehouse(root).state)["orders"] == date(2024, 3, 9)
    result = pipeline.run(spark, raw, root, RULES, DAY)
    assert result.marks["orders"] == date(2024, 4, 1)
    assert bronze.read_bronze(spark, Warehouse(root).bronze, "orders").count() == 4
    got = rows(read_table(spark, Warehouse(root).silver("stg_orders")))
    assert sorted(r["order_id"] for r in got) == ["O1", "O2", "O3", "O4"]


def test_a_run_that_breaks_off_between_the_silver_tables(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "w")
    raw = write_exports(tmp_path / "one", **NIGHT_ONE)
    merge = pipeline.merge_table

    def only_orders(session, path, *rest, **options):
        if path.endswith("stg_order_items"):
            raise RuntimeError("lost")
        return merge(session, path, *rest, **options)

    with monkeypatch.context() as m:
        m.setattr(pipeline, "merge_table", only_orders)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.run(spark, raw, root, RULES, DAY)
    result = pipeline.run(spark, raw, root, RULES, DAY)
    assert result.audit["stg_order_items"] == 3
    assert read_table(spark, Warehouse(root).silver("stg_orders")).count() == 3


def test_broken_assertion_stops_before_the_mark(spark, tmp_path):
    root = str(tmp_path / "w")
    menu = default_exports()["menu"]
    menu[2] = menu[2] | {"item_id": menu[1]["item_id"]}  # the gate does not look for this
    items = [i for i in NIGHT_ONE["order_items"] if i["item_id"] != "M3"]
    raw = write_exports(tmp_path / "one", **(NIGHT_ONE | {"menu": menu, "order_items": items}))
    with pytest.raises(QualityGateError, match=r"unique\(src_menu.item_id\): 1"):
        pipeline.run(spark, raw, root, RULES, DAY)
    assert state.read_marks(spark, Warehouse(root).state) == {}


def test_missing_export_stops_the_run(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="promotions.csv"):
        pipeline.run(spark, str(tmp_path / "nothing"), str(tmp_path / "w"), RULES, DAY)


# ---- late rows ---------------------------------------------------------------------------------


def late_run(spark, tmp_path, root, name, **tables):
    return pipeline.run(spark, write_exports(tmp_path / name, **tables), root, RULES, DAY, late=True)


def silver_ids(spark, root):
    orders = read_table(spark, Warehouse(root).silver("stg_orders"))
    items = read_table(spark, Warehouse(root).silver("stg_order_items"))
    return (sorted(r.order_id for r in orders.collect()),
            sorted((r.order_item_id, r.order_id) for r in items.collect()))


def test_two_loads_on_one_day_lose_none_and_repeat_none(spark, tmp_path):
    root = str(tmp_path / "w")
    late_run(spark, tmp_path, root, "one", **NIGHT_ONE)
    same_day = {
        "orders": NIGHT_ONE["orders"] + [order(5, "2024-03-09", total="99.00", subtotal="87.61", tax="11.39")],
        "order_items": NIGHT_ONE["order_items"] + [line(6, 5)],
    }
    second = late_run(spark, tmp_path, root, "two", **same_day)
    assert second.audit["bronze_orders"] == 1 and second.audit["bronze_order_items"] == 1
    assert second.marks["orders"] == date(2024, 3, 9)
    third = late_run(spark, tmp_path, root, "three", **same_day)
    assert third.audit["bronze_orders"] == third.audit["bronze_order_items"] == 0
    more = same_day | {"orders": same_day["orders"] + [order(7, "2024-03-09"), order(8, "2024-03-08")]}
    fourth = late_run(spark, tmp_path, root, "four", **more)
    assert fourth.audit["bronze_orders"] == 1  # an older day stays closed
    assert silver_ids(spark, root)[0] == ["O1", "O2", "O3", "O5", "O7"]
    loaded = bronze.read_bronze(spark, Warehouse(root).bronze, "orders")
    assert sorted(r.order_id for r in loaded.collect()) == ["O1", "O2", "O3", "O5", "O7"]
    lines = bronze.read_bronze(spark, Warehouse(root).bronze, "order_items")
    assert sorted(r.order_item_id for r in lines.collect()) == ["L1", "L2", "L3", "L4", "L6"]


def test_late_and_early_lines_reach_silver(spark, tmp_path):
    root = str(tmp_path / "w")
    early = NIGHT_ONE["order_items"][:2] + [line(7, 4, item=1)]  # its order comes on the second night
    late_run(spark, tmp_path, root, "one", **(NIGHT_ONE | {"order_items": early}))
    assert silver_ids(spark, root)[1] == [("L1", "O1"), ("L2", "O1")]
    # an export of that night alone, without what was sent before
    night_two = {
        "orders": [order(4, "2024-04-01", site=1, total="60.00", subtotal="53.10", tax="6.90")],
        "order_items": [line(3, 2, item=2), line(2, 1, item=1, quantity="6"), line(8, 99)],
    }
    late_run(spark, tmp_path, root, "two", **night_two)
    assert silver_ids(spark, root)[1] == [("L1", "O1"), ("L2", "O1"), ("L3", "O2"), ("L7", "O4")]
    items = {r.order_item_id: r for r in read_table(spark, Warehouse(root).silver("stg_order_items")).collect()}
    assert items["L2"].quantity == 6
    # Gold follows: March is computed again with the line that came late
    mart = read_table(spark, Warehouse(root).gold("mart_menu_performance"))
    assert {r.item_id: r.total_units_sold for r in mart.collect()} == {"M1": 2, "M2": 7, "M3": 1}


def test_the_same_orders_and_lines_in_time_or_late(spark, tmp_path):
    strict, late = str(tmp_path / "strict"), str(tmp_path / "late")
    pipeline.run(spark, write_exports(tmp_path / "all", **NIGHT_TWO), strict, RULES, DAY)
    first = {
        "orders": [NIGHT_TWO["orders"][0], NIGHT_TWO["orders"][4]],
        "order_items": NIGHT_TWO["order_items"][1:],
    }
    late_run(spark, tmp_path, late, "first", **first)
    late_run(spark, tmp_path, late, "second", **NIGHT_TWO)
    for table in ("stg_orders", "stg_order_items"):
        assert silver(spark, strict, table) == silver(spark, late, table)


@pytest.mark.parametrize("lost", ["after_silver", "advance_marks"])
def test_a_late_night_that_breaks_off_can_be_started_again(spark, tmp_path, monkeypatch, lost):
    root = str(tmp_path / "w")
    late_run(spark, tmp_path, root, "one", **NIGHT_ONE)
    others = [i for i in NIGHT_TWO["order_items"] if i["order_item_id"] != "L2"]
    two = NIGHT_TWO | {"order_items": others + [line(9, 1), line(2, 4, item=1)]}

    def breaks(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        if lost in ("record_night", "advance_marks"):
            m.setattr(state, lost, breaks)
        elif lost == "after_silver":
            merge = pipeline.merge_table
            m.setattr(pipeline, "merge_table", lambda spark_, path, *a, **o: breaks()
                      if path.endswith("items") else merge(spark_, path, *a, **o))
        with pytest.raises(RuntimeError, match="lost"):
            late_run(spark, tmp_path, root, "two", **two)
    late_run(spark, tmp_path, root, "two", **two)
    orders, items = silver_ids(spark, root)
    assert orders == ["O1", "O2", "O3", "O4", "O5"]
    assert items == [("L1", "O1"), ("L2", "O4"), ("L3", "O2"), ("L5", "O4"), ("L6", "O5"), ("L9", "O1")]
    for table, column, expected in [
        ("orders", "order_id", orders),
        ("order_items", "order_item_id", ["L1", "L2", "L2", "L3", "L4", "L5", "L6", "L9"]),
    ]:
        kept = bronze.read_bronze(spark, Warehouse(root).bronze, table)
        assert sorted(r[column] for r in kept.collect()) == expected
