import pytest
from pyspark.sql import functions as F

from tradewind.operators.dedupe import dedupe_latest, duplicate_keys
from tradewind.operators.upsert import UPSERTS, require_unique, upsert, upsert_table

VERSIONS = "k string, _ingest_time int, v string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_later_version_is_kept(spark):
    df = spark.createDataFrame([("a", 1, "old"), ("a", 2, "new"), ("b", 1, "x")], VERSIONS)
    assert rows(dedupe_latest(df, ["k"])) == [("a", 2, "new"), ("b", 1, "x")]


def test_tie_does_not_depend_on_row_order(spark):
    data = [("a", 1, v) for v in "qzmb"]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, VERSIONS).repartition(4)
        assert rows(dedupe_latest(df, ["k"])) == [("a", 1, "z")]


def test_null_keys_are_one_key_and_null_times_come_last(spark):
    df = spark.createDataFrame(
        [(None, 1, "x"), (None, 2, "y"), ("a", None, "z"), ("a", 1, "w")], VERSIONS
    )
    assert rows(dedupe_latest(df, ["k"])) == [("a", 1, "w"), (None, 2, "y")]


def test_dedupe_twice_is_once(spark):
    df = spark.createDataFrame([("a", i % 3, str(i)) for i in range(20)], VERSIONS)
    once = dedupe_latest(df, ["k"])
    assert rows(dedupe_latest(once, ["k"])) == rows(once)


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z")], VERSIONS)
    assert rows(duplicate_keys(df, ["k"])) == [("a", 2)]


TABLE = "id string, channel string, amount double"


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([("1", "pos", 1.0), ("2", "pos", 2.0)], TABLE)
    source = spark.createDataFrame([("2", "amazon", 9.0), ("3", "amazon", 3.0)], TABLE)
    got = upsert(target, source, ["id"], ["amount"])
    assert rows(got) == [("1", "pos", 1.0), ("2", "pos", 9.0), ("3", "amazon", 3.0)]
    assert rows(upsert(got, source, ["id"], ["amount"])) == rows(got)


def test_update_to_null_is_an_update(spark):
    target = spark.createDataFrame([("1", "pos", 1.0)], TABLE)
    source = spark.createDataFrame([("1", None, None)], TABLE)
    assert rows(upsert(target, source, ["id"])) == [("1", None, None)]


def test_null_key_never_matches_unless_null_safe(spark):
    target = spark.createDataFrame([(None, "pos", 1.0)], TABLE)
    source = spark.createDataFrame([(None, "pos", 2.0)], TABLE)
    assert rows(upsert(target, source, ["id"])) == [(None, "pos", 1.0), (None, "pos", 2.0)]
    assert rows(upsert(target, source, ["id"], null_safe=True)) == [(None, "pos", 2.0)]


def test_repeated_null_source_keys_are_all_inserted(spark):
    target = spark.createDataFrame([("1", "pos", 1.0)], TABLE)
    source = spark.createDataFrame([(None, "x", float(i)) for i in range(5)], TABLE)
    assert upsert(target, source, ["id"]).count() == 6


def test_two_source_rows_for_one_key_are_an_error(spark):
    target = spark.createDataFrame([("1", "pos", 1.0)], TABLE)
    source = spark.createDataFrame([("1", "x", 1.0), ("1", "y", 2.0)], TABLE)
    with pytest.raises(Exception, match="two source rows"):
        upsert(target, source, ["id"]).collect()
    with pytest.raises(Exception, match="two source rows"):
        require_unique(source, ["id"]).collect()


def test_every_target_row_of_a_key_is_updated(spark):
    target = spark.createDataFrame([("1", "a", 1.0), ("1", "b", 2.0)], TABLE)
    source = spark.createDataFrame([("1", "c", 5.0)], TABLE)
    assert rows(upsert(target, source, ["id"], ["amount"])) == [("1", "a", 5.0), ("1", "b", 5.0)]


def test_columns_must_agree(spark):
    target = spark.createDataFrame([("1", "pos", 1.0)], TABLE)
    with pytest.raises(ValueError, match="columns differ"):
        upsert(target, target.drop("amount"), ["id"])
    with pytest.raises(ValueError, match="not updatable"):
        upsert(target, target, ["id"], ["id"])


@pytest.mark.parametrize("name", sorted(UPSERTS))
def test_named_upserts_are_idempotent(spark, name):
    from tradewind.plans.gold import GOLD
    from tradewind.plans.silver import SILVER

    schema = {**SILVER, **GOLD}[name][0]
    spec = UPSERTS[name]

    def frame(ids, mark):
        values = {
            "string": lambda i, c: f"{i}" if c in spec.keys else f"{mark}{i}",
            "int": lambda i, c: i,
            "bigint": lambda i, c: i,
            "double": lambda i, c: float(i),
            "timestamp": lambda i, c: None,
        }
        data = [
            tuple(values[f.dataType.simpleString()](i, f.name) for f in schema.fields) for i in ids
        ]
        return spark.createDataFrame(data, schema)

    target, source = frame(range(0, 6), "old"), frame(range(4, 9), "new")
    once = upsert_table(name, target, source)
    assert once.count() == 9
    assert rows(upsert_table(name, once, source)) == rows(once)
    kept = [c for c in spec.kept]
    if kept:
        got = once.filter(F.col(spec.keys[0]) == "5").select(*kept).first()
        assert all(v.startswith("old") for v in got)
