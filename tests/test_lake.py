from datetime import datetime
from types import SimpleNamespace

import pytest

from tests import drops as D
from tradewind import schemas as S
from tradewind.operators import features as FE
from tradewind.operators.quality import ORDER_RULES, QualityGateError
from tradewind.plans import ingest_batch, materialize_features, refresh_gold, refresh_silver
from tradewind.plans.features import snapshots
from tradewind.sinks import ensure_table, merge_statement, publish, retire, shared_dir, upsert_into
from tradewind.sources import feature_source, is_available, load_table, register_view, stamp


def orders(spark, *rows):
    names = S.SILVER_ORDERS.fieldNames()
    data = [tuple(dict(dict.fromkeys(names), **r).values()) for r in rows]
    return spark.createDataFrame(data, S.SILVER_ORDERS)


GOOD = dict(order_id="1", channel="pos", created_at=datetime(2026, 1, 1), total_amount=1.0)


def test_ensure_table_and_guard(spark):
    ensure_table(spark, "guard.orders", S.SILVER_ORDERS, ("channel",))
    ensure_table(spark, "guard.orders", S.SILVER_ORDERS, ("channel",))
    assert spark.table("guard.orders").schema.fieldNames() == S.SILVER_ORDERS.fieldNames()
    assert not is_available(spark, "guard.orders") and not is_available(spark, "guard.nothing")
    publish(orders(spark, GOOD), "guard.orders", "1", S.SILVER_ORDERS, partition_by=("channel",))
    assert is_available(spark, "guard.orders")


def test_a_failed_gate_leaves_the_published_version(spark, tmp_path):
    name = "gated.orders"
    root = str(tmp_path)
    ensure_table(spark, name, S.SILVER_ORDERS, ("channel",), root)
    warnings = publish(
        orders(spark, GOOD), name, "1", S.SILVER_ORDERS, ORDER_RULES, ("channel",), root
    )
    assert [w["severity"] for w in warnings] == ["warning"]
    bad = orders(spark, GOOD, dict(GOOD, total_amount=-5.0))
    with pytest.raises(QualityGateError):
        publish(bad, name, "2", S.SILVER_ORDERS, ORDER_RULES, ("channel",), root)
    assert [r["total_amount"] for r in spark.table(name).collect()] == [1.0]
    # the run can be repeated under the same version
    fixed = orders(spark, GOOD, dict(GOOD, order_id="2"))
    publish(fixed, name, "2", S.SILVER_ORDERS, ORDER_RULES, ("channel",), root)
    assert spark.table(name).count() == 2
    # also after it was swapped in
    publish(fixed, name, "2", S.SILVER_ORDERS, ORDER_RULES, ("channel",), root)
    old = retire(spark, name, keep=["2"])
    assert {t.rsplit("__", 1)[0] for t in old} == {"orders__v0", "orders__v1"}
    # without a version to keep, the one that readers see stays
    assert len(retire(spark, name, keep=[])) == 2
    assert spark.table(name).count() == 2


def test_merge_statement_is_valid_sql(spark):
    text = merge_statement("silver.orders", S.SILVER_ORDERS.fieldNames(), "src")
    assert "t.region = s.region" in text
    assert "t.channel" not in text and "t.currency" not in text
    assert "t.sales_date <=> s.sales_date AND t.channel <=> s.channel" in merge_statement(
        "gold.daily_revenue_channel", S.GOLD_DAILY_REVENUE.fieldNames(), "src"
    )
    ensure_table(spark, "merge_test.orders", S.SILVER_ORDERS)
    register_view(orders(spark, GOOD), "src")
    (table,) = [t.name for t in spark.catalog.listTables("merge_test") if "__v0" in t.name]
    with pytest.raises(Exception) as e:
        spark.sql(merge_statement("silver.orders", S.SILVER_ORDERS.fieldNames(), "src", f"merge_test.{table}"))
    # it parses and resolves; a plain parquet table then declines row-level changes
    assert "MERGE" in str(e.value) and "PARSE" not in str(e.value)


def test_native_merge_gates_the_batch_first(spark):
    ensure_table(spark, "silver.orders_plain", S.SILVER_ORDERS, ("channel",), using="parquet")
    assert spark.table("silver.orders_plain").schema.fieldNames()[-1] == "channel"
    bad = orders(spark, dict(GOOD, channel="fax"))
    with pytest.raises(QualityGateError):
        upsert_into("silver.orders", bad, "1", S.SILVER_ORDERS, ORDER_RULES, native_merge=True)


def test_shared_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark, "x").startswith(root + "/x-")

    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: conf.get(k, d)))

    assert "/x-" in shared_dir(session(**{"spark.master": "local[2]"}), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(**{"spark.master": "yarn"}), "x")


def test_load_table(spark, tmp_path):
    orders(spark, GOOD).write.parquet(str(tmp_path / "t"))
    assert load_table(spark, str(tmp_path / "t")).count() == 1


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Two deliveries through all layers."""
    root = tmp_path_factory.mktemp("lake")
    bronze = {}
    for channel, landing in D.all_channels(root / "day1").items():
        bronze[channel] = [str(root / "bronze" / channel)]
        ingest_batch(spark, channel, landing, bronze[channel][0], datetime(2026, 7, 21))
    refresh_silver(spark, bronze, "1")
    refresh_gold(spark, "1")
    first = {t: sorted(map(str, spark.table(t).drop("_processed_at").collect())) for t in TABLES}
    # the second delivery changes an order, adds one, and adds a row to a known invoice
    day2 = root / "day2"
    more = {
        "pos": D.write(
            day2 / "pos", "p2.json", [D.pos_transaction("t1", total_amount=500.0), D.pos_transaction("t3")]
        ),
        "distributor": D.write(
            day2 / "distributor", "d2.csv", "\n".join([D.CSV_HEADER, D.csv_row("d4", "INV-2")])
        ),
    }
    for channel, landing in more.items():
        ingest_batch(spark, channel, landing, bronze[channel][0], datetime(2026, 7, 22))
    return bronze, first, root


TABLES = (
    "silver.orders",
    "silver.order_items",
    "silver.products",
    "gold.daily_revenue_channel",
    "gold.inventory_turnover",
    "gold.customer_360",
)


def state(spark):
    return {t: sorted(map(str, spark.table(t).drop("_processed_at").collect())) for t in TABLES}


def test_whole_lake(spark, lake):
    bronze, first, root = lake
    assert [len(first[t]) for t in TABLES[:2]] == [8, 9]
    # an increment gives the same lake as a full run
    refresh_silver(spark, bronze, "2", since="2026-07-22")
    refresh_gold(spark, "2")
    increment = state(spark)
    totals = {r["order_id"]: r["total_amount"] for r in spark.table("silver.orders").collect()}
    assert totals["t1"] == 500.0 and totals["t3"] == 236.0 and totals["s1"] == 236.0
    assert totals["INV-1"] == 236.0 and totals["INV-2"] == 236.0
    refresh_silver(spark, bronze, "3")
    refresh_gold(spark, "3")
    assert state(spark) == increment
    # and once more changes nothing
    refresh_silver(spark, bronze, "4")
    refresh_gold(spark, "4")
    assert state(spark) == increment

    daily = {r["channel"]: r for r in spark.table("gold.daily_revenue_channel").collect()}
    assert daily["pos"]["order_count"] == 3 and daily["pos"]["gross_revenue"] == 972.0
    products = {r["sku"]: r["title"] for r in spark.table("silver.products").collect()}
    assert products["SKU-1"] == "Socks" and products["SKU-2"] == "SKU-2"

    end = datetime(2026, 7, 25)
    materialize_features(spark, str(root / "features"), "1", end)
    materialize_features(spark, str(root / "features"), "2", end)
    online = spark.table("online.customer_features")
    assert online.count() == spark.table("gold.customer_360").count()
    requests = spark.createDataFrame([("c1",), ("nobody",)], "customer_id string")
    got = {
        r["customer_id"]: r["total_orders"]
        for r in FE.lookup_features(
            requests, online, ["customer_id"], ["total_orders", "total_spend"]
        ).collect()
    }
    assert got == {"c1": 2, "nobody": None}
    skus = {r["sku"]: r["units_sold"] for r in spark.table("online.product_features").collect()}
    assert skus["SKU-2"] == 2


def test_gold_marts_carry_their_schema(spark, lake):
    assert spark.table("gold.customer_360").schema == S.GOLD_CUSTOMER_360
    assert spark.table("silver.order_items").schema == S.SILVER_ORDER_ITEMS


SOURCE = "customer_id string, v int, at timestamp, made timestamp"
VIEW = FE.FeatureView("v", ("customer_id",), ("v",))


def test_materialize(spark):
    t = datetime
    df = spark.createDataFrame(
        [
            ("a", 1, t(2026, 5, 1), t(2026, 5, 1)),
            ("a", 2, t(2026, 5, 2), t(2026, 5, 3)),
            ("a", 3, t(2026, 5, 2), t(2026, 5, 2)),
            ("b", 4, t(2026, 1, 1), t(2026, 5, 2)),
            ("c", 5, t(2026, 6, 9), t(2026, 6, 9)),
        ],
        SOURCE,
    )
    source = feature_source(df, "at", "made")
    got = {r["customer_id"]: r["v"] for r in FE.materialize(source, VIEW, t(2026, 6, 1)).collect()}
    # b is older than 90 days, c lies after the end, and for a the later created row counts
    assert got == {"a": 2}
    wide = FE.materialize(source, VIEW, t(2026, 7, 1), start=t(2025, 1, 1))
    assert {r["customer_id"] for r in wide.collect()} == {"a", "b", "c"}


def test_stamp(spark):
    at = datetime(2026, 1, 2)
    assert stamp(spark.range(1), at).first()["_processed_at"] == at


def test_a_back_dated_run_reads_no_later_snapshot(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, v int")
    view = FE.FeatureView("v", ("customer_id",), ("v",))
    days = [datetime(2026, 1, 1), datetime(2026, 5, 1), datetime(2026, 5, 20)]
    for n, at in enumerate(days):
        snapshot = view.select(FE.feature_snapshot(rows.withColumn("v", rows.v + 10 * n), at, at))
        snapshot.write.parquet(f"{tmp_path}/day={at:%Y-%m-%d}/snapshot={n}")
    source = snapshots(spark, str(tmp_path), view, datetime(2026, 5, 2))
    assert len({f.split("day=")[1][:10] for f in source.inputFiles()}) >= 1
    plan = source._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]
    got = {r["customer_id"]: r["v"] for r in FE.materialize(source, view, datetime(2026, 5, 2)).collect()}
    assert got == {"a": 11, "b": 12}
    # nothing within the time to live
    early = snapshots(spark, str(tmp_path), view, datetime(2025, 12, 31))
    assert FE.materialize(early, view, datetime(2025, 12, 31)).count() == 0


def test_product_features_are_as_of_the_last_sale(spark):
    mart = spark.createDataFrame(
        [
            ("2026-05-01", "a", "Old", 1, 1.5),
            ("2026-05-20", "a", "New", 2, 2.25),
            ("2026-01-01", "b", "Stale", 4, 4.0),
            ("2026-06-09", "c", "Later", 8, 8.0),
        ],
        "sales_date string, sku string, product_title string, units_sold long, total_sales_amount double",
    )
    end = datetime(2026, 6, 1)
    sold = FE.product_snapshot(mart, end)
    rows = FE.materialize(sold, FE.PRODUCT_FEATURES, end).collect()
    # b was last sold before the 90 days, c after the end
    assert [tuple(r) for r in rows] == [("a", "New", 3, 3.75, datetime(2026, 5, 20), end)]
    state = FE.materialize(FE.product_snapshot(mart, end, end), FE.PRODUCT_FEATURES, end)
    assert {(r["sku"], r["event_timestamp"]) for r in state.collect()} == {(s, end) for s in "abc"}
