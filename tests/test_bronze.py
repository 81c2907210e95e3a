import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests import drops as D
from tradewind.functions import route_decoded, split_decoded
from tradewind.plans import bronze_table, channel_rows, ingest_batch, ingest_stream
from tradewind.plans.bronze import distributor_documents
from tradewind.schemas import DISTRIBUTOR_ROW, POS_TRANSACTION
from tradewind.sources import drop_documents, read_shopify, split_recognised
from tradewind.sources.drops import FILE
from tradewind.streaming import stream_append, stream_documents, stream_pos

ONCE = {"availableNow": True}


def routes(df):
    return {r["route"]: r["count"] for r in df.groupBy("route").count().collect()}


def run(spark, channel, landing, root, **kw):
    query = ingest_stream(
        spark, channel, landing, f"{root}/table", f"{root}/checkpoint", trigger=ONCE, **kw
    )
    query.awaitTermination()
    return spark.read.parquet(f"{root}/table")


def test_only_top_level_files_of_the_suffix_are_read(spark, tmp_path):
    path = D.write(tmp_path, "a.json", D.envelope(D.node("s1")))
    D.write(tmp_path / "archive", "b.json", D.envelope(D.node("s2")))
    D.write(tmp_path, "c.txt", "noise")
    rows = read_shopify(spark, path).collect()
    assert [(r[FILE], r["id"]) for r in rows] == [("a.json", "s1")]


def test_documents_one_per_line(spark, tmp_path):
    lines = "\n".join(json.dumps(D.envelope(D.node(f"s{i}"))) for i in range(5))
    path = D.write(tmp_path, "a.json", lines)
    assert drop_documents(spark, path, whole_files=False).count() == 5
    assert read_shopify(spark, path, whole_files=False).count() == 5


def test_shopify_drops_by_route(spark, tmp_path):
    path = D.write(tmp_path / "in", "good.json", D.envelope(D.node("s1"), D.node("s2")))
    D.write(tmp_path / "in", "bad.json", D.envelope(D.node("s3"), D.node("s4", email="x")))
    D.write(tmp_path / "in", "broken.json", "{oops")
    D.write(tmp_path / "in", "other.json", {"something": 1})
    D.write(tmp_path / "in", "empty.json", D.envelope())
    ingest_batch(spark, "shopify", path, str(tmp_path / "t"), datetime(2026, 7, 21))
    table = spark.read.parquet(str(tmp_path / "t"))
    assert routes(table) == {"accepted": 2, "dead_letter": 3}
    dead = table.filter("route = 'dead_letter'")
    assert {r["_ingest_file_name"] for r in dead.collect()} == {"bad.json", "broken.json", "other.json"}
    assert dead.filter("_ingest_file_name = 'broken.json'").first()["dead_payload"] == "{oops"
    accepted = bronze_table(spark, "shopify", [str(tmp_path / "t")])
    assert {r["id"] for r in accepted.collect()} == {"s1", "s2"}
    first = accepted.first()
    assert first["_ingest_time"] == datetime(2026, 7, 21) and first["ingest_date"] == "2026-07-21"
    assert first["_ingest_file_name"] == "good.json"


def test_amazon_without_orders_is_a_dead_letter(spark, tmp_path):
    path = D.write(tmp_path, "a.json", {"Orders": [D.amazon_order("a1")]})
    D.write(tmp_path, "b.json", {"orders": []})
    rows = channel_rows("amazon", drop_documents(spark, path))
    assert routes(rows) == {"accepted": 1, "dead_letter": 1}


def test_pos_records_without_id_are_dead_letters_by_themselves(spark, tmp_path):
    path = D.write(tmp_path, "p.json", [D.pos_transaction("t1"), {"store_id": "x"}])
    D.write(tmp_path, "q.json", "[{")
    D.write(tmp_path, "r.json", D.pos_transaction("t2"))
    rows = channel_rows("pos", drop_documents(spark, path))
    assert routes(rows) == {"accepted": 2, "dead_letter": 2}
    dead = {r["_ingest_file_name"]: r["dead_payload"] for r in rows.filter("route = 'dead_letter'").collect()}
    assert json.loads(dead["p.json"]) == {"store_id": "x"} and dead["q.json"] == "[{"


def test_split_recognised(spark, tmp_path):
    path = D.write(tmp_path, "a.json", {"Orders": []})
    D.write(tmp_path, "b.json", {"x": 1})
    known, unknown = split_recognised(drop_documents(spark, path), "Orders")
    assert [r["file"] for r in known.collect()] == ["a.json"]
    assert [r["file"] for r in unknown.collect()] == ["b.json"]


@pytest.mark.parametrize("channel", ["shopify", "pos", "distributor", "amazon"])
def test_stream_equals_batch(spark, tmp_path, channel):
    landing = D.all_channels(tmp_path / "in")[channel]
    streamed = run(spark, channel, landing, tmp_path / "s")
    ingest_batch(spark, channel, landing, str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    drop = ("_ingest_time", "ingest_date")
    columns = sorted(set(batch.columns) - set(drop))
    assert sorted(map(str, streamed.select(columns).collect())) == sorted(
        map(str, batch.select(columns).collect())
    )


def test_restart_reads_only_new_files(spark, tmp_path):
    landing = D.write(tmp_path / "in", "1.json", D.envelope(D.node("s1")))
    assert run(spark, "shopify", landing, tmp_path / "o").count() == 1
    assert run(spark, "shopify", landing, tmp_path / "o").count() == 1
    D.write(tmp_path / "in", "2.json", D.envelope(D.node("s2")))
    table = run(spark, "shopify", landing, tmp_path / "o")
    assert sorted(r["id"] for r in table.collect()) == ["s1", "s2"]


def test_archive_keeps_every_row_once(spark, tmp_path):
    landing = D.write(tmp_path / "in", "1.json", D.envelope(D.node("s1")))
    archive = str(tmp_path / "archive")
    run(spark, "shopify", landing, tmp_path / "o", archive=archive)
    for i in (2, 3):
        D.write(tmp_path / "in", f"{i}.json", D.envelope(D.node(f"s{i}")))
        table = run(spark, "shopify", landing, tmp_path / "o", archive=archive)
    assert sorted(r["id"] for r in table.collect()) == ["s1", "s2", "s3"]
    archived = [f for _, _, files in os.walk(archive) for f in files if f.endswith(".json")]
    assert "1.json" in archived


def messages(spark, *payloads):
    return spark.createDataFrame([(bytearray(p.encode()),) for p in payloads], "value binary")


def test_corrupt_message_goes_to_the_dead_letters(spark):
    good = json.dumps(D.pos_transaction("t1"))
    df = messages(spark, good, "{cut", "{}", '{"transaction_id": null}')
    accepted, dead = split_decoded(df, "value", POS_TRANSACTION, "transaction_id")
    assert [r["transaction_id"] for r in accepted.collect()] == ["t1"]
    assert {r["dead_payload"] for r in dead.collect()} == {"{cut", "{}", '{"transaction_id": null}'}
    routed = route_decoded(df, "value", POS_TRANSACTION, "transaction_id")
    assert routes(routed) == {"accepted": 1, "dead_letter": 3}
    first = routed.filter("route = 'accepted'").first()
    assert first["items"][0]["quantity"] == "2" and first["total_amount"] == 236.0


def test_message_stream(spark, tmp_path):
    source = str(tmp_path / "messages")
    messages(spark, json.dumps(D.pos_transaction("t1")), "{cut").write.parquet(source)
    stream = stream_pos(spark, "parquet", schema=messages(spark, "").schema, path=source)
    query = stream_append(
        channel_rows("pos", stream),
        str(tmp_path / "t"),
        str(tmp_path / "c"),
        ONCE,
        ("route", "ingest_date"),
    )
    query.awaitTermination()
    table = spark.read.parquet(str(tmp_path / "t"))
    assert routes(table) == {"accepted": 1, "dead_letter": 1}
    assert table.first()["_ingest_file_name"] == "kafka-stream"


def test_two_writers_of_a_channel_are_read_together(spark, tmp_path):
    landing = D.write(tmp_path / "in", "p.json", [D.pos_transaction("t1")])
    run(spark, "pos", landing, tmp_path / "files")
    ingest_batch(spark, "pos", landing, str(tmp_path / "batch"))
    paths = [str(tmp_path / "files/table"), str(tmp_path / "batch"), str(tmp_path / "nowhere")]
    assert bronze_table(spark, "pos", paths).count() == 2
    assert bronze_table(spark, "pos", [str(tmp_path / "nowhere")]) is None


def test_a_column_added_later_reads_as_null_before(spark, tmp_path):
    path = str(tmp_path / "t")
    landing = D.write(tmp_path / "in", "p.json", [D.pos_transaction("t1")])
    rows = channel_rows("pos", drop_documents(spark, landing))
    rows.drop("payment_method").write.mode("append").partitionBy("route", "ingest_date").parquet(path)
    later = rows.withColumn("transaction_id", F.lit("t2"))
    later.write.mode("append").partitionBy("route", "ingest_date").parquet(path)
    got = {r["transaction_id"]: r["payment_method"] for r in bronze_table(spark, "pos", [path]).collect()}
    assert got == {"t1": None, "t2": "CASH"}


def test_documents_stream_reads_whole_files(spark, tmp_path):
    landing = D.write(tmp_path, "a.json", json.dumps(D.envelope(D.node()), indent=2))
    query = (
        stream_documents(spark, landing)
        .writeStream.format("memory")
        .queryName("whole_docs")
        .trigger(**ONCE)
        .start()
    )
    query.awaitTermination()
    assert spark.table("whole_docs").count() == 1


@pytest.mark.parametrize("size", [1, 5_000, 20_000])
def test_a_document_is_one_json_value(spark, tmp_path, size):
    """The same verdict at 1 kB, 5 MB and 20 MB."""
    nodes = [D.node(f"s{i}", name="n" * 1000) for i in range(size)]
    text = json.dumps({"data": {"orders": {"edges": [{"node": n} for n in nodes]}}})
    again = json.dumps({"data": 1})[:-1] + ", " + text[1:]
    bad = {"trailing": text + " garbage", "glued": text + text, "cut": text[:-2], "two": text + "," + text}
    for name, body in {"good": text + "\n ", "repeated": again, **bad}.items():
        (tmp_path / f"{name}.json").write_text(body)
    rows = channel_rows("shopify", drop_documents(spark, str(tmp_path)))
    found = {tuple(r) for r in rows.groupBy("_ingest_file_name", "route").count().collect()}
    assert found == {("good.json", "accepted", size), ("repeated.json", "accepted", size)} | {
        (f"{name}.json", "dead_letter", 1) for name in bad
    }


def test_line_drops_keep_every_document(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    lines = [json.dumps(D.pos_transaction(f"t{i}")) for i in range(3)]
    (landing / "pos.json").write_text("\n".join([*lines, json.dumps([D.pos_transaction("t3")]), "{cut"]))
    ingest_batch(spark, "pos", str(landing), str(tmp_path / "batch"), whole_files=False)
    ingest_stream(
        spark,
        "pos",
        str(landing),
        str(tmp_path / "stream"),
        str(tmp_path / "checkpoint"),
        trigger={"availableNow": True},
        whole_files=False,
    ).awaitTermination()
    for table in ("batch", "stream"):
        assert routes(spark.read.parquet(str(tmp_path / table))) == {"accepted": 4, "dead_letter": 1}


def test_bad_distributor_files_and_lines_are_set_aside(spark, tmp_path):
    header = ",".join(DISTRIBUTOR_ROW.fieldNames())
    good = "d1,D1,North Co,North,I1,2026-07-20,SKU-1,2,10.0,0,3.6,23.6,PAID"
    (tmp_path / "a.csv").write_text(
        f"{header}\r\n{good}\r\nd2,D1\n{good.replace(',2,10.0', ',two,10.0')}\n,{good[3:]}\n\n"
    )
    (tmp_path / "b.csv").write_text(f"Other,{header}\nx,{good}\n")
    rows = channel_rows("distributor", drop_documents(spark, str(tmp_path), suffix="*.csv"))
    assert routes(rows) == {"accepted": 1, "dead_letter": 4}
    assert rows.filter("route = 'accepted'").first()["Quantity"] == 2
    lines = channel_rows(
        "distributor",
        drop_documents(spark, str(tmp_path), False, "a.csv"),
        whole_files=False,
    )
    assert routes(lines) == {"accepted": 1, "dead_letter": 3}


def test_an_amazon_order_without_id_is_a_dead_letter(spark, tmp_path):
    orders = [{"SellerOrderId": "x"}, {"AmazonOrderId": "a1", "OrderItems": [{"QuantityOrdered": 2.0}]}]
    (tmp_path / "a.json").write_text(json.dumps({"Orders": orders}))
    rows = channel_rows("amazon", drop_documents(spark, str(tmp_path)))
    assert routes(rows) == {"accepted": 1, "dead_letter": 1}
    assert rows.filter("route = 'accepted'").first()["OrderItems"][0]["QuantityOrdered"] == "2.0"


CLOSED_EARLY = [
    '{"transaction_id": "a"}] {"transaction_id": "b"}',
    '{"transaction_id": "a"}{"transaction_id": "b"}',
    '{"transaction_id": "a"}, {"transaction_id": "b"}',
    '{"transaction_id": "a"} trailing',
    '{"transaction_id": "a"}, "end"] x',
    '{"transaction_id": "a"}, {"__end__": "x"}] x',
    '[{"transaction_id": "a"}]] [{"transaction_id": "b"}]',
    '[{"transaction_id": "a"}], [{"__end__": "x"}]] x',
]


def test_nothing_after_a_value_is_lost_in_batch_stream_and_messages(spark, tmp_path):
    for i, text in enumerate(CLOSED_EARLY):
        D.write(tmp_path / "in", f"{i}.json", text)
    D.write(tmp_path / "in", "good.json", [D.pos_transaction("t1")])
    ingest_batch(spark, "pos", str(tmp_path / "in"), str(tmp_path / "batch"))
    streamed = run(spark, "pos", str(tmp_path / "in"), tmp_path / "s")
    for table in (spark.read.parquet(str(tmp_path / "batch")), streamed):
        assert routes(table) == {"accepted": 1, "dead_letter": len(CLOSED_EARLY)}
        dead = table.filter("route = 'dead_letter'").collect()
        assert {r["dead_payload"] for r in dead} == set(CLOSED_EARLY)
        assert {tuple(map(tuple, r["dead_errors"])) for r in dead} == {((None, "invalid json"),)}
    routed = channel_rows("pos", messages(spark, json.dumps(D.pos_transaction("t1")), *CLOSED_EARLY))
    assert routes(routed) == {"accepted": 1, "dead_letter": len(CLOSED_EARLY)}


def test_a_web_order_closed_early_is_a_dead_letter_with_its_reasons(spark, tmp_path):
    text = json.dumps(D.envelope(D.node("s1")))
    D.write(tmp_path, "early.json", text + "] " + text)
    D.write(tmp_path, "bad.json", D.envelope(D.node("s1"), D.node("s2", email="x"), D.node(7)))
    D.write(tmp_path, "none.json", {"data": 1})
    D.write(tmp_path, "good.json", text)
    rows = channel_rows("shopify", drop_documents(spark, str(tmp_path))).collect()
    why = {r["_ingest_file_name"]: r["dead_errors"] and [tuple(e) for e in r["dead_errors"]] for r in rows}
    assert why == {
        "early.json": [(None, "invalid json")],
        "bad.json": [(1, "email: pattern"), (2, "id: type")],
        "none.json": [(None, "no envelope")],
        "good.json": None,
    }


def csv_of(names, row):
    return ",".join(row[n] for n in names)


def test_columns_are_named_by_the_header_of_their_file(spark, tmp_path):
    names = DISTRIBUTOR_ROW.fieldNames()
    values = "d1,D1,North Co,North,I1,2026-07-20,SKU-1,2,10.0,0,3.6,23.6,PAID".split(",")
    row = dict(zip(names, values))
    swapped = names[:2] + ["Region", "DistributorName"] + names[4:]
    other = {**row, "TransactionID": "d2", "Region": "South", "DistributorName": '"South, Co"'}
    D.write(tmp_path, "a.csv", "\n".join([",".join(names), csv_of(names, row)]))
    D.write(tmp_path, "b.csv", "\r\n".join([",".join(swapped), csv_of(swapped, other), csv_of(swapped, row)[:9]]))
    D.write(tmp_path, "c.csv", csv_of(names, row))
    for whole in (True, False):
        docs = drop_documents(spark, str(tmp_path), whole, "*.csv")
        rows = channel_rows("distributor", docs, whole_files=whole)
        got = {r["TransactionID"]: (r["DistributorName"], r["Region"]) for r in rows.collect()}
        assert got == {"d1": ("North Co", "North"), "d2": ("South, Co", "South"), None: (None, None)}
        dead = rows.filter("route = 'dead_letter'").collect()
        assert {(r["_ingest_file_name"], r["dead_errors"][0]["error"]) for r in dead} == {
            ("b.csv", "number of fields"),
            ("c.csv", "header"),
        }


def test_a_large_csv_drop_is_many_tasks(spark, tmp_path):
    names = DISTRIBUTOR_ROW.fieldNames()
    line = "d{},D1,North Co,North,I1,2026-07-20,SKU-1,2,10.0,0,3.6,23.6,PAID"
    D.write(tmp_path, "a.csv", "\n".join([",".join(reversed(names))] + [
        ",".join(reversed(line.format(i).split(","))) for i in range(20_000)
    ]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        docs = drop_documents(spark, str(tmp_path), False, "*.csv")
        assert docs.rdd.getNumPartitions() >= 5
        rows = channel_rows("distributor", docs, whole_files=False)
        assert routes(rows) == {"accepted": 20_000}
        assert rows.filter("Region = 'North' AND Quantity = 2").count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_fields_keep_line_breaks_and_quotes(spark, tmp_path):
    names = DISTRIBUTOR_ROW.fieldNames()
    tail = "North,I1,2026-07-20,SKU-1,2,10.0,0,3.6,23.6,PAID"
    long = "x" * 200_000 + "\n" + "y, " * 50_000
    body = [
        ",".join(names),
        f'd1,D1,"two\nlines, ""quoted""",{tail}',
        "",
        f'd2,D1,5" pipe,{tail}',
        f'd3,D1,"{long}",{tail}',
    ]
    D.write(tmp_path, "a.csv", "\n".join(body))
    rows = channel_rows("distributor", drop_documents(spark, str(tmp_path), suffix="*.csv"))
    got = {r["TransactionID"]: r["DistributorName"] for r in rows.collect()}
    assert got["d1"] == 'two\nlines, "quoted"'
    assert got["d2"] == '5" pipe' and got["d3"] == long and len(got) == 3
    with pytest.raises(ValueError, match="whole files"):
        ingest_stream(spark, "distributor", str(tmp_path), "t", "c", whole_files=False)


def test_line_drops_are_parsed_once_and_not_shuffled(spark, tmp_path):
    names = [f.name for f in DISTRIBUTOR_ROW.fields]
    row = dict.fromkeys(names, "1") | {"TransactionID": "t", "InvoiceDate": "2026-07-01"}
    for n, (order, line) in enumerate([(names, row), (names[::-1], row | {"TransactionID": "u", "Quantity": "two"})]):
        lines = [",".join(order), ",".join(line[c] for c in order), '"' + " ".join(names) + '",x']
        (tmp_path / f"{n}.csv").write_text("\r\n".join(lines) + "\r\n")
    (tmp_path / "2.csv").write_text("TransactionID,SKU\nv,1\n")
    got = distributor_documents(drop_documents(spark, str(tmp_path), False, "*.csv"), False)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and text.count("from_csv(") == 1
    rows = {(r["_file"], r["TransactionID"], r["dead_errors"][0]["error"] if r["dead_errors"] else None) for r in got.collect()}
    assert rows == {
        ("0.csv", "t", None),
        ("0.csv", None, "number of fields"),
        ("1.csv", None, "Quantity: type"),
        ("1.csv", None, "number of fields"),
        ("2.csv", None, "header"),
    }
