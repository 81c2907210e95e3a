"""Bucketed tables: what a run writes, what readers see, and marts that follow changes."""

import time
import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tradewind import schemas as S
from tradewind.operators import increments
from tradewind.operators.marts import customer_360, daily_revenue_channel, inventory_turnover
from tradewind.operators.quality import QualityGateError
from tradewind.plans import gold as G
from tradewind.plans.silver import SILVER_TABLES
from tradewind.sinks import buckets as B

ORDERS, ITEMS, PRODUCTS = SILVER_TABLES
BUCKETS = 8


def rows_of(spark, schema, rows):
    names = schema.fieldNames()
    data = [tuple(dict(dict.fromkeys(names), **r).values()) for r in rows]
    return spark.createDataFrame(data, schema)


def order(i, day=1, **more):
    return dict(
        dict(order_id=str(i), channel="pos", customer_id=f"c{i % 7}", customer_email="a@b.c",
             created_at=datetime(2026, 1, day), total_amount=10.0 + i, tax_amount=1.0),
        **more,
    )


def item(i, n=1, **more):
    return dict(
        dict(order_item_id=f"{i}-{n}", order_id=str(i), sku=f"S{(i + n) % 5}", title=f"T{(i + n) % 5}",
             quantity=n, unit_price=2.0, total_amount=2.0 * n),
        **more,
    )


@pytest.fixture
def lake(spark, tmp_path):
    """(load, namespace): ``load`` merges rows and makes them live."""
    name = f"b{uuid.uuid4().hex[:8]}"

    def load(version, orders=(), items=()):
        base = B.ensure_buckets(spark, name, SILVER_TABLES, BUCKETS, str(tmp_path))
        staged, warnings = {}, []
        for t, rows in ((ORDERS, orders), (ITEMS, items)):
            staged[t.name], found = B.stage_merge(base, t, rows_of(spark, t.schema, rows), version)
            warnings += found
        return B.commit(base, staged, version)

    return load, name


def files(spark, name, table="orders"):
    rows = B.pinned(spark, name).table(table).select(F.input_file_name().alias("f")).distinct()
    return {r["f"] for r in rows.collect()}


def state(spark, name, tables=("orders", "order_items")):
    return {t: sorted(map(str, spark.table(f"{name}.{t}").drop("_processed_at").collect())) for t in tables}


def test_a_run_writes_the_buckets_of_its_batch_and_no_others(spark, lake, tmp_path):
    load, name = lake
    first = load("1", [order(i) for i in range(200)])
    before = files(spark, name)
    on_disk = {p for p in tmp_path.rglob("*.parquet")}
    second = load("2", [order(3, total_amount=999.0)])
    (bucket,) = second.changed(first, "orders")
    after = files(spark, name)
    slot = first.slots["orders"][bucket]
    # the files of all other buckets keep their names, and only one bucket's rows were written
    assert before - after == {f for f in before if f"_slot={slot}/" in f}
    assert len(after - before) == 1
    written = {p for p in tmp_path.rglob("*.parquet")} - on_disk
    assert {p.parent.parent.name for p in written} == {f"_slot={second.slots['orders'][bucket]}"}
    amounts = {r["order_id"]: r["total_amount"] for r in spark.table(f"{name}.orders").collect()}
    assert len(amounts) == 200 and amounts["3"] == 999.0 and amounts["4"] == 14.0
    # an empty batch writes nothing
    assert load("3").changed(second, "orders") == []


def test_readers_prune_what_is_not_live(spark, lake):
    load, name = lake
    load("1", [order(i) for i in range(50)])
    live = load("2", [order(3)])
    table = spark.table(f"{name}.orders")
    assert table.schema == S.SILVER_ORDERS
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan and "BroadcastHashJoin" in plan
    pinned = live.table("orders", [1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_slot" in pinned.replace("isnotnull(_slot#", "_slot#")


def test_a_driver_lost_before_the_pointer_moves_leaves_one_version(spark, lake, monkeypatch):
    load, name = lake
    load("1", [order(1)], [item(1)])
    old = state(spark, name)

    def lost(*args):
        raise KeyboardInterrupt

    statements = []
    with monkeypatch.context() as m:
        m.setattr(B, "_point", lost)
        with pytest.raises(KeyboardInterrupt):
            load("2", [order(1, total_amount=5.0), order(2)], [item(2)])
    assert state(spark, name) == old
    # the run is repeated under its version, and one statement shows all of its tables
    sql = type(spark).sql
    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", lambda self, q, *a, **k: (statements.append(q), sql(self, q, *a, **k))[1])
        load("2", [order(1, total_amount=5.0), order(2)], [item(2)])
    assert sum("VIEW" in q and "REPLACE" in q for q in statements) == 1
    new = state(spark, name)
    assert [len(new[t]) for t in ("orders", "order_items")] == [2, 2]


def test_a_failed_gate_and_a_rival_change_nothing(spark, lake):
    load, name = lake
    base = load("1", [order(1)], [item(1)])
    old = state(spark, name)
    with pytest.raises(QualityGateError):
        load("2", [order(2)], [item(2, quantity=0)])
    assert state(spark, name) == old
    load("3", [order(3)])
    staged, _ = B.stage_merge(base, ORDERS, rows_of(spark, S.SILVER_ORDERS, [order(4)]), "4")
    with pytest.raises(RuntimeError, match="another run"):
        B.commit(base, {"orders": staged}, "4")
    assert spark.table(f"{name}.orders").count() == 2


def test_a_pinned_state_stays_until_it_is_retired(spark, lake):
    load, name = lake
    first = load("1", [order(1)])
    second = load("2", [order(1, total_amount=5.0)])
    load("3", [order(1, total_amount=6.0)])
    assert [r["total_amount"] for r in first.table("orders").collect()] == [11.0]
    again = B.pinned(spark, name, first.manifest)
    assert again.slots["orders"] == first.slots["orders"]
    gone = B.retire_runs(spark, name, keep=["1"])
    assert gone == sorted(second.slots["orders"].values())
    assert B.pinned(spark, name, second.manifest) is None
    assert [r["total_amount"] for r in first.table("orders").collect()] == [11.0]
    B.retire_runs(spark, name)
    assert B.pinned(spark, name, first.manifest) is None
    assert [r["total_amount"] for r in spark.table(f"{name}.orders").collect()] == [6.0]


def test_keys_replaced_by_nothing_go(spark, lake):
    load, name = lake
    base = load("1", [order(i) for i in range(20)])
    keys = spark.createDataFrame([("3",), ("4",), ("never",)], "order_id string")
    rows = rows_of(spark, S.SILVER_ORDERS, [order(4, total_amount=1.0)])
    staged, _ = B.stage_replace(base, ORDERS, rows, "2", keys)
    live = B.commit(base, {"orders": staged}, "2")
    got = {r["order_id"]: r["total_amount"] for r in spark.table(f"{name}.orders").collect()}
    assert len(got) == 19 and "3" not in got and got["4"] == 1.0
    staged, _ = B.stage_replace(live, ORDERS, rows, "3")
    B.commit(live, {"orders": staged}, "3")
    assert [r["order_id"] for r in spark.table(f"{name}.orders").collect()] == ["4"]


def marts_of(spark, name):
    orders, items = (spark.table(f"{name}.{t}") for t in ("orders", "order_items"))
    marts = {
        G.DAILY: daily_revenue_channel(orders),
        G.INVENTORY: inventory_turnover(items, orders),
        G.CUSTOMERS: customer_360(orders),
    }
    return {t: sorted(map(str, m.collect())) for t, m in marts.items()}


def test_increments_are_what_a_whole_run_gives(spark, lake, monkeypatch):
    load, name = lake
    gold = f"{name}_gold"
    tables = (G.DAILY, G.INVENTORY, G.CUSTOMERS)

    def refresh(version, **more):
        G.refresh_gold(spark, version, silver=name, gold=gold, buckets=BUCKETS, **more)
        assert state(spark, gold, tables) == marts_of(spark, name)

    load("1", [order(i, 1 + i % 20) for i in range(40)], [item(i, n) for i in range(40) for n in (1, 2)])
    refresh("1")
    # from here on no mart may be made from all orders
    seen = []
    for mart in ("daily_revenue_channel", "customer_360", "inventory_turnover"):
        whole = getattr(increments, mart)
        monkeypatch.setattr(
            increments, mart, lambda *a, whole=whole: (seen.append(a[-1].count()), whole(*a))[1]
        )
        monkeypatch.setattr(G, mart, None)
    # a new order, one that leaves its day, one that changes its customer, one that loses it
    load("2", [order(100, 25), order(5, 24), order(6, 3, customer_id="new"), order(7, customer_id=None)],
         [item(100)])
    refresh("2")
    assert seen and max(seen) < 30
    # the only order of its day moves: the day's groups go
    load("3", [order(100, 26)])
    refresh("3")
    assert not [r for r in state(spark, gold, tables)[G.DAILY] if "2026-01-25" in r]
    # only items change, a null SKU title among them; then nothing at all
    load("4", [], [item(8, 1, quantity=50), item(9, 2, sku="S9", title=None)])
    refresh("4")
    live = B.pinned(spark, gold)
    refresh("5")
    assert all(B.pinned(spark, gold).changed(live, t) == [] for t in tables)
    # two loads between two runs of gold
    load("6", [order(11, 5)], [item(11, 3)])
    load("7", [order(11, 6), order(12, 6, channel="amazon")], [])
    refresh("7")


def test_gold_rebuilds_if_its_former_state_is_gone(spark, lake):
    load, name = lake
    gold = f"{name}_gold"
    load("1", [order(1), order(2, 2)], [item(1)])
    G.refresh_gold(spark, "1", silver=name, gold=gold, buckets=2)
    load("2", [order(2, 3)])
    B.retire_runs(spark, name)
    G.refresh_gold(spark, "2", silver=name, gold=gold, buckets=2, keep_versions=[])
    assert state(spark, gold, (G.DAILY,))[G.DAILY] == marts_of(spark, name)[G.DAILY]
    G.refresh_gold(spark, "3", silver=name, gold=gold, full=True)
    assert state(spark, gold, (G.DAILY,))[G.DAILY] == marts_of(spark, name)[G.DAILY]


def test_a_batch_is_placed_without_a_shuffle(spark):
    rows = spark.range(0, 300, 1, 3)
    placed = B._placed(rows, ["id"], 4, "placed")
    assert len(placed.inputFiles()) == 3
    expected = rows.withColumn("_bucket", B.bucket_of(["id"], 4))
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, expected.collect()))


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = disk.getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_steps_leave_neither_their_shuffle_files_nor_their_batch(spark, lake, tmp_path):
    load, name = lake
    gold = f"{name}_gold"
    shared = Path(spark.conf.get("spark.checkpoint.dir"))

    def left():
        return {p.name for p in shared.glob("*") if p.name.startswith(("merge-", "replace-"))}

    files, folders = shuffle_files(spark), left()
    for version, day in (("1", 1), ("2", 2)):
        load(version, [order(i, day) for i in range(60)], [item(i) for i in range(60)])
        G.refresh_gold(spark, version, silver=name, gold=gold, buckets=BUCKETS)
    assert left() <= folders
    until = time.time() + 20
    while shuffle_files(spark) - files and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - files
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    assert state(spark, gold, (G.INVENTORY,)) == {G.INVENTORY: marts_of(spark, name)[G.INVENTORY]}


def test_touched_groups_are_told_without_a_join_of_the_mart(spark, monkeypatch):
    orders = rows_of(spark, S.SILVER_ORDERS, [order(i, 1 + i % 9) for i in range(90)] + [order(97, created_at=None)])
    items = [item(i, n) for i in range(90) for n in (1, 2)]
    odd = [item(3, 8, sku=None), item(97, 1, sku="S1"), item(4, 9, sku="S1", title=None), item(998, 1)]
    items = rows_of(spark, S.SILVER_ORDER_ITEMS, items + odd)
    keys = [("2026-01-04", "S1"), ("2026-01-04", None), (None, "S1"), ("2026-01-05", "S4"), ("2027-01-01", "S1"), ("2026-01-05", "none")]
    touched = spark.createDataFrame(keys, "sales_date string, sku string")
    whole = inventory_turnover(items, orders).collect()
    expected = sorted(str(r) for r in whole if (r["sales_date"], r["sku"]) in keys)
    used, mart = [], increments.inventory_turnover
    monkeypatch.setattr(increments, "inventory_turnover", lambda *a: (used.append(a), mart(*a))[1])
    found = increments.inventory_of(items, orders, touched)
    assert sorted(map(str, found.collect())) == expected and len(expected) == 4
    # orders are cut to the days, and no row of the mart meets the keys in a join
    assert used[0][1].count() == 21
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan[: plan.index("Aggregate", plan.index("Aggregate") + 1)]
