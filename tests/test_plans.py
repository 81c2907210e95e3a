"""The physical plans must keep the shape the operators promise."""

import re

import pytest
from pyspark.sql import functions as F

from tradewind.checks.queries import QUERIES
from tradewind.operators.contract import with_verdict
from tradewind.operators.dedupe import dedupe_latest
from tradewind.operators.features import lookup_features
from tradewind.operators.marts import inventory_turnover
from tradewind.operators.quality import UNIQUE, Rule, violations
from tradewind.operators.upsert import upsert
from tradewind.plans.silver import keep_real_titles, latest_rows
from tradewind.schemas import BRONZE
from tradewind.sources.lake import align

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"stream_append_events", "publish_orders", "bucketed_orders", "gold_increment", "lake_guards"}))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


def test_dedupe_trims_before_the_shuffle(spark):
    df = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    text = plan(dedupe_latest(df, ["l_orderkey"], ["l_shipdate"]))
    assert text.count("Exchange") == 1
    final, partial = text.index("Final"), text.index("Partial")
    assert final < text.index("Exchange") < partial


def test_scans_read_only_the_columns_in_use(spark):
    text = plan(QUERIES["daily_revenue_channel"](spark, SF_DIR))
    assert re.search(
        r"ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,"
        r"o_orderpriority:string>",
        text,
    )
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert text.count("Exchange") == 1


def test_date_filters_reach_the_scan(spark):
    text = plan(QUERIES["upsert_orders"](spark, SF_DIR))
    assert "LessThan(o_orderdate" in text and "GreaterThanOrEqual(o_orderdate" in text


def test_one_document_per_file_needs_no_shuffle(spark):
    documents = spark.createDataFrame([("f", "{}")], "file string, text string")
    assert "Exchange" not in plan(with_verdict(documents))


def test_a_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).withColumn("v", F.col("id")).write.parquet(path)
    batch = str(tmp_path / "s")
    spark.range(5).withColumn("v", F.lit(0).cast("bigint")).write.parquet(batch)
    merged = upsert(
        spark.read.parquet(path), spark.read.parquet(batch), ["id"], unique_source=True
    )
    text = plan(merged)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 3
    # the shuffle left is that of the matched keys, at most as many as the batch has
    assert text.count("Exchange hashpartitioning") == 1
    assert merged.count() == 1000


SKEW = {
    "spark.sql.shuffle.partitions": "64",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}
N = 60000


@pytest.fixture
def no_broadcast(spark):
    """Large-data behaviour at test size: no broadcast, and splits from a few kB on."""
    before = {k: spark.conf.get(k, None) for k in SKEW}
    for k, v in SKEW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, path, name):
    """Rows of which every third has the key ``hot``; the others have a key of their own."""
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    spark.range(0, N, 1, 8).select(
        key.alias(name),
        "id",
        F.sha2((F.col("id") % 50).cast("string"), 256).alias("sku"),
        F.sha2((F.col("id") % 5000).cast("string"), 256).alias("title"),
        F.lit(1).alias("quantity"),
        F.lit(1.25).alias("total_amount"),
    ).write.parquet(str(path))
    return spark.read.parquet(str(path))


def splits(df) -> bool:
    return "SortMergeJoin(skew=true)" in plan(df)


def test_a_hot_order_is_split(spark, tmp_path, no_broadcast):
    items = hot_rows(spark, tmp_path / "items", "order_id")
    items.select("order_id").distinct().withColumn(
        "created_at", F.lit("2026-01-01").cast("timestamp")
    ).write.parquet(str(tmp_path / "orders"))
    mart = inventory_turnover(items, spark.read.parquet(str(tmp_path / "orders")))
    rows = mart.collect()
    assert splits(mart) and len(rows) == 50
    assert sum(r["units_sold"] for r in rows) == N
    assert sum(r["total_sales_amount"] for r in rows) == N * 1.25


def test_a_hot_duplicate_is_split(spark, tmp_path, no_broadcast):
    rows = hot_rows(spark, tmp_path / "t", "k")
    broken = violations(rows, (Rule(UNIQUE, "k"),))
    assert len(broken.collect()) == N // 3 and splits(broken)


def test_a_hot_file_is_split(spark, tmp_path, no_broadcast):
    rows = hot_rows(spark, tmp_path / "t", "file")
    text = F.when(F.col("file") == "hot", "{broken").otherwise('{"data":{"orders":{"edges":[]}}}')
    judged = with_verdict(
        rows.select("file", text.alias("text"), "title"), one_document_per_file=False
    )
    got = judged.collect()
    assert sum(r["passed"] for r in got) == N - N // 3 and len(got) == N and splits(judged)


def test_a_hot_request_is_split(spark, tmp_path, no_broadcast):
    requests = hot_rows(spark, tmp_path / "t", "customer_id")
    requests.select("customer_id").distinct().withColumn("v", F.lit(7)).write.parquet(
        str(tmp_path / "online")
    )
    online = spark.read.parquet(str(tmp_path / "online"))
    found = lookup_features(requests, online, ["customer_id"], ["v"])
    got = found.collect()
    assert len(got) == N and all(r["v"] == 7 for r in got) and splits(found)


def test_a_hot_invoice_is_split(spark, tmp_path, no_broadcast):
    rows = align(
        hot_rows(spark, tmp_path / "t", "InvoiceNumber").withColumns(
            {
                "TransactionID": F.col("id").cast("string"),
                "SKU": F.col("title"),
                "ingest_date": F.when(F.col("id") < 2, "2026-07-02").otherwise("2026-07-01"),
            }
        ),
        BRONZE["distributor_sales"],
    )
    touched = latest_rows("distributor", rows, "2026-07-02")
    # what is ranked was cut to the touched invoices' rows before
    logical = touched._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in logical[logical.index("Window") :]
    assert len(touched.collect()) == N // 3 + 1 and splits(touched)


def test_a_hot_target_key_is_split(spark, tmp_path, no_broadcast):
    target = hot_rows(spark, tmp_path / "t", "k")
    target.select("k").distinct().select(
        "k",
        F.lit(0).cast("bigint").alias("id"),
        *(F.lit("new").alias(c) for c in ("sku", "title")),
        F.lit(2).alias("quantity"),
        F.lit(2.0).alias("total_amount"),
    ).write.parquet(str(tmp_path / "s"))
    merged = upsert(target, spark.read.parquet(str(tmp_path / "s")), ["k"], unique_source=True)
    got = merged.collect()
    assert len(got) == N and all(r["quantity"] == 2 for r in got) and splits(merged)


def test_a_hot_key_sends_one_row_per_task(spark, tmp_path):
    rows = hot_rows(spark, tmp_path / "t", "k")
    latest = dedupe_latest(rows, ["k"], ["id"])
    got = {r["k"]: r["id"] for r in latest.collect()}
    assert len(got) == N - N // 3 + 1 and got["hot"] == N - 3


def test_a_placeholder_never_replaces_a_title(spark):
    kind = "sku string, title string, retail_price double"
    current = spark.createDataFrame([("A", "Socks", 1.0), ("B", "B", 1.0), ("C", None, 1.0)], kind)
    new = [("A", "A", 2.0), ("B", "B", 2.0), ("C", "C", 2.0), ("D", "D", 2.0), (None, None, 2.0)]
    found = keep_real_titles(spark.createDataFrame([*new, ("A2", "Hat", 2.0)], kind), current)
    assert sorted(str(r["sku"]) for r in found.collect()) == ["A2", "B", "C", "D", "None"]


def test_bronze_records_are_not_sorted_before_the_shuffle(spark, tmp_path):
    rows = [(None, 1, "a", 1), (None, 2, "a", 2), ("k", 1, "b", 3), ("k", 1, "a", 9), ("k", 1, "b", 4), ("m", 0, None, 5)]
    spark.createDataFrame(rows, "id string, at int, file string, v int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    whole = dedupe_latest(df, ["id"], ["at", "file"], trim_first=False)
    text = plan(whole)
    assert text.count("Exchange") == 1 and "Sort" not in text[text.index("Exchange") :]
    expected = [(None, 2, "a", 2), ("k", 1, "b", 4), ("m", 0, None, 5)]
    for found in (whole, dedupe_latest(df, ["id"], ["at", "file"])):
        assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    for name in ("conform_pos_items", "conform_pos_orders", "conform_amazon_items", "conform_amazon_orders"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert "Sort" not in text[text.index("Exchange") :]
