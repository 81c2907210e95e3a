import json

import pytest
from pyspark.sql import functions as F

from tests import drops as D
from tradewind.operators import contract as C


def docs(spark, *texts):
    rows = [(f"f{i}", t if t is None or isinstance(t, str) else json.dumps(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "file string, text string")


def errors(spark, text, contract=C.SHOPIFY_CONTRACT):
    report = C.contract_report(docs(spark, text), contract).orderBy("record", "error").collect()
    return [(r["record"], r["error"]) for r in report]


def without(name):
    n = D.node()
    del n[name]
    return n


@pytest.mark.parametrize(
    "record, expected",
    [
        (D.node(), []),
        (without("email"), ["email: missing"]),
        (D.node(email=None), ["email: null"]),
        (D.node(email=5), ["email: type"]),
        (D.node(email="nobody"), ["email: pattern"]),
        (D.node(email="a@b.c trailing"), ["email: pattern"]),
        (D.node(customer="c1"), ["customer: type"]),
        (D.node(customer=[1]), ["customer: type"]),
        (D.node(customer={}), []),
        (D.node(id=True, name=1.5), ["id: type", "name: type"]),
        (D.node(tags=None, unknown=1), []),
    ],
)
def test_one_record(spark, record, expected):
    assert errors(spark, D.envelope(record)) == [(0, e) for e in expected]


def test_document_errors(spark):
    assert errors(spark, "{broken") == [(None, "invalid json")]
    assert errors(spark, "") == [(None, "invalid json")]
    assert errors(spark, {"data": {}}) == [(None, "no envelope")]
    assert errors(spark, {"data": {"orders": {"edges": None}}}) == [(None, "no envelope")]
    assert errors(spark, {"data": {"orders": {"edges": {"a": 1}}}}) == [(None, "no envelope")]
    assert errors(spark, []) == [(None, "no envelope")]
    assert errors(spark, D.envelope()) == []


def test_edges(spark):
    def edges(*e):
        return {"data": {"orders": {"edges": list(e)}}}

    missing = sorted((0, f"{f.name}: missing") for f in C.SHOPIFY_CONTRACT)
    assert errors(spark, edges({})) == missing
    assert errors(spark, edges({"cursor": 1})) == missing
    for bad in (None, 5, "x", [], {"node": None}, {"node": "x"}, {"node": []}):
        assert errors(spark, edges(bad)) == [(0, "node: type")]
    assert errors(spark, edges({"node": D.node()}, {"node": D.node(id=1)})) == [(1, "id: type")]


def test_optional_fields_and_all_types(spark):
    fields = (
        C.Field("n", C.NUMBER),
        C.Field("a", C.ARRAY),
        C.Field("o", C.OBJECT),
        C.Field("s", C.STRING, pattern="ab"),
    )
    ok = [{}, {"n": None, "a": None}, {"n": 1}, {"n": 1.5}, {"n": 1e300}, {"n": True}, {"a": []}]
    ok += [{"o": {}}, {"s": "abc"}]
    for record in ok:
        assert errors(spark, D.envelope(record), fields) == []
    bad = {"n": "1", "a": {}, "o": [], "s": "cab"}
    assert errors(spark, D.envelope(bad), fields) == [
        (0, "a: type"),
        (0, "n: type"),
        (0, "o: type"),
        (0, "s: pattern"),
    ]


def test_field_names_are_taken_literally(spark):
    field = (C.Field("a.b c", C.STRING, True),)
    assert errors(spark, D.envelope({"a.b c": "x"}), field) == []


TEXTS = [
    D.envelope(D.node("1")),
    D.envelope(D.node("2"), D.node("3", email="x")),
    "{broken",
    {"data": {}},
    D.envelope(),
    {"data": {"orders": {"edges": [{}]}}},
    None,
]


def test_verdicts(spark):
    got = {r["file"]: r for r in C.file_verdicts(docs(spark, *TEXTS)).collect()}
    assert {f: r["passed"] for f, r in got.items()} == {
        "f0": True, "f1": False, "f2": False, "f3": False, "f4": True, "f5": False, "f6": False,
    }
    assert (got["f1"]["n_records"], got["f1"]["n_errors"]) == (2, 1)
    assert (got["f5"]["n_records"], got["f5"]["n_errors"]) == (1, 10)


@pytest.mark.parametrize("single", [True, False])
def test_routing_is_a_partition(spark, single):
    documents = docs(spark, *TEXTS)
    clean, quarantined = C.route_files(documents, one_document_per_file=single)
    clean, quarantined = ({r["file"] for r in f.collect()} for f in (clean, quarantined))
    assert clean == {"f0", "f4"}
    assert clean | quarantined == {f"f{i}" for i in range(len(TEXTS))}
    assert not clean & quarantined


def test_one_bad_document_fails_its_whole_file(spark):
    rows = [("a", json.dumps(TEXTS[0])), ("a", "{broken"), ("b", json.dumps(TEXTS[0]))]
    documents = spark.createDataFrame(rows, "file string, text string")
    clean, quarantined = C.route_files(documents, one_document_per_file=False)
    assert [r["file"] for r in clean.collect()] == ["b"]
    assert [r["file"] for r in quarantined.collect()] == ["a", "a"]


def test_contract_from_a_definition():
    definition = {"fields": [{"name": "id", "required": True}, {"name": "n", "type": "number"}]}
    assert C.contract_from(definition) == (C.Field("id", C.STRING, True), C.Field("n", C.NUMBER))
    assert C.contract_from({}) == ()


def test_a_document_beyond_the_variant_size(spark):
    nodes = ",".join([json.dumps({"node": D.node("s")})] * 30000)
    bad = json.dumps({"node": D.node("s", email="x")})
    good = '{"data":{"orders":{"edges":[' + nodes + "]}}}"
    assert len(good) > 16 * 1024 * 1024
    documents = docs(spark, good, good[:-4] + "," + bad + "]}}}", good[:-3])
    got = {r["file"]: r for r in C.file_verdicts(documents).collect()}
    assert (got["f0"]["n_records"], got["f0"]["n_errors"]) == (30000, 0)
    assert (got["f1"]["n_records"], got["f1"]["n_errors"]) == (30001, 1)
    assert not got["f2"]["passed"]
    clean, quarantined = C.route_files(documents)
    assert [r["file"] for r in clean.select("file").collect()] == ["f0"]
    assert quarantined.count() == 2


def test_one_look_decides_what_field_by_field_does(spark):
    """A record that keeps the contract is passed by one look; any other one is left to the fields."""
    fields = (C.Field("a.b"), C.Field("mail", pattern="x+"), C.Field("o", C.OBJECT, True), C.Field("it`s"))
    good = {"a.b": "1", "mail": "xx", "o": {"k": 1}, "it`s": "", "more": 1}
    nodes = [
        ({"node": good}, True),
        ({"node": good | {"mail": "y"}}, False),
        ({"node": good | {"a.b": 1}}, False),
        ({"node": good | {"o": "1"}}, False),
        ({"node": good | {"o": None}}, False),
        ({"node": {k: v for k, v in good.items() if k != "it`s"}}, True),
        ({"node": []}, False),
        ({}, False),
        (1, False),
    ]
    rows = spark.createDataFrame([(i, json.dumps(n)) for i, (n, _) in enumerate(nodes)], "i int, edge string")
    edge = F.try_parse_json("edge")
    got = rows.select("i", C.contract_errors(edge, fields).alias("e"), C._keeps(edge, fields).alias("k"))
    for row in got.orderBy("i").collect():
        sound = not row["e"]
        assert sound == nodes[row["i"]][1]
        assert not row["k"] or sound
    assert got.filter("i = 0").first()["k"]
    none = rows.filter("i > 5").select(C.contract_errors(edge, ()).alias("e")).collect()
    assert [len(r["e"]) for r in none] == [1, 0, 1]


def test_a_document_is_read_alike_once_it_is_known_to_be_one(spark):
    from tradewind import schemas as S
    from tradewind.functions.payload import known_json, strict_json
    from tradewind.plans.bronze import shopify_bronze

    edges = [{"node": {"id": "1", "lineItems": {"edges": 5}, "customer": {"id": {"x": [1.50]}}}}, {}, None]
    texts = [
        json.dumps({"data": {"orders": {"edges": edges}}}),
        json.dumps({"data": {"orders": {"edges": [{"node": 1}, {"node": {"tags": "no list", "id": 1.0}}]}}}),
        json.dumps({"data": {"orders": {"edges": []}}}) + " \n",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    text = F.col("text")
    got = rows.select(strict_json(text, S.SHOPIFY_DROP).alias("s"), known_json(text, S.SHOPIFY_DROP).alias("k"))
    assert all(r["s"] == r["k"] for r in got.collect())
    # the text's hash is made once for each look at its end: for its edges, and where it has none
    plan = shopify_bronze(rows.withColumn("file", F.lit("f")))._jdf.queryExecution().analyzed().toString()
    assert plan.count("sha2(") == 2
