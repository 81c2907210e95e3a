"""Ingress contract for web-shop order documents.

A contract is a list of field rules. It compiles to Column expressions over VARIANT, which
keeps a missing field, a JSON null and a wrong type apart; a typed read would not.

A document is checked inside its own row, so a drop with one document per file needs no
shuffle to be accepted or set aside. Files that hold many documents roll up by file name.
"""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind.functions.payload import INVALID_JSON, is_json, reason, strict_json
from tradewind.operators.joins import split_join
from tradewind.schemas import record
from tradewind.sinks.shared import shared_dir

STRING, OBJECT, NUMBER, ARRAY = "string", "object", "number", "array"
DOCUMENT = record(data=record(orders=record(edges=T.ArrayType(T.VariantType()))))


@dataclass(frozen=True)
class Field:
    name: str
    type: str = STRING
    required: bool = False
    pattern: "str | None" = None


# The contract of the web-shop orders.
SHOPIFY_CONTRACT = (
    Field("id", STRING, True),
    Field("name", STRING, True),
    Field("createdAt", STRING, True),
    Field("email", STRING, True, r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"),
    Field("totalPriceSet", OBJECT, True),
    Field("subtotalPriceSet", OBJECT, True),
    Field("totalTaxSet", OBJECT, True),
    Field("customer", OBJECT, True),
    Field("lineItems", OBJECT, True),
    Field("sourceName", STRING, True),
)

def contract_from(definition: dict) -> tuple:
    """A contract from its parsed definition file: a ``fields`` list of name, type, required, pattern."""
    return tuple(
        Field(f["name"], f.get("type", STRING), bool(f.get("required")), f.get("pattern"))
        for f in definition.get("fields", ())
    )


def _get(edge: Column, field: str, kind: str = "variant") -> Column:
    """A field of the record in an edge. The path starts at the edge, so no record is copied."""
    return F.try_variant_get(edge, f"$['node']['{field}']", kind)


def _has_type(edge: Column, field: Field) -> Column:
    """True if the field is there with its type; otherwise false or null."""
    if field.type == OBJECT:
        return _get(edge, field.name, "struct<>").isNotNull()
    if field.type == ARRAY:
        return _get(edge, field.name, "array<variant>").isNotNull()
    kind = F.schema_of_variant(_get(edge, field.name))
    if field.type == STRING:
        return kind == "STRING"
    # a JSON boolean passes as a number
    return kind.rlike("^(BIGINT|DOUBLE|FLOAT|BOOLEAN|DECIMAL.*)$")


def _problem(edge: Column, field: Field) -> Column:
    """The first problem of a field, or null. A sound field costs one look at its value."""
    value = _get(edge, field.name)
    sound = F.lit(None).cast("string")
    if field.pattern and field.type == STRING:
        matches = _get(edge, field.name, "string").rlike(f"^(?:{field.pattern})")
        sound = F.when(~matches, F.lit(f"{field.name}: pattern"))
    missing, null = (f"{field.name}: {p}" if field.required else None for p in ("missing", "null"))
    return (
        F.when(_has_type(edge, field), sound)
        .when(value.isNull(), F.lit(missing))
        .when(F.is_variant_null(value), F.lit(null))
        .otherwise(F.lit(f"{field.name}: type"))
    )


def _keeps(edge: Column, contract) -> Column:
    """True if all fields are there, sound and of their types: one look at the record for all of them.

    Otherwise false or null, and so too for a contract with a field of another type than text or object,
    or a field twice.
    """
    names = [f.name for f in contract]
    if len({n.lower() for n in names}) < len(names) or any(f.type not in (STRING, OBJECT) for f in contract):
        return F.lit(False)
    kinds = {STRING: "variant", OBJECT: "struct<>"}
    quoted = ["`" + f.name.replace("`", "``") + "`: " + kinds[f.type] for f in contract]
    wanted = f"struct<{', '.join(quoted)}>"

    def sound(node: Column) -> Column:
        tests = [node.isNotNull()]
        for field in contract:
            value = node[field.name]
            if field.type == OBJECT:
                tests.append(value.isNotNull())
                continue
            tests.append(F.schema_of_variant(value) == "STRING")
            if field.pattern:
                tests.append(F.try_variant_get(value, "$", "string").rlike(f"^(?:{field.pattern})"))
        return reduce(and_, tests)

    # the lambda binds the fields
    node = F.try_variant_get(edge, "$['node']", wanted)
    return F.transform(F.array(node), sound)[0]


def contract_errors(edge: Column, contract=SHOPIFY_CONTRACT) -> Column:
    """All errors of the record in an edge, in contract order.

    An edge without ``node`` holds an empty record. An edge or a node that is no object is one
    error. Only a record that doesn't plainly keep the contract is looked at field by field.
    """
    is_edge = F.try_variant_get(edge, "$", "struct<>").isNotNull()
    has_record = F.try_variant_get(edge, "$['node']", "struct<>").isNotNull()
    no_record = is_edge & F.try_variant_get(edge, "$['node']", "variant").isNull()
    return (
        F.when(_keeps(edge, contract), F.array().cast("array<string>"))
        .when(
            has_record | no_record,
            F.array_compact(F.array(*(_problem(edge, field) for field in contract))),
        )
        .otherwise(F.array(F.lit("node: type")))
    )


def _edges(text: Column) -> Column:
    """The edge list of a document, null if it has none or the text is not one JSON value.

    Edges are read one by one: a VARIANT holds 16 MB at most, a document of any size may have more.
    """
    return strict_json(text, DOCUMENT)["data"]["orders"]["edges"]


def judged(text: Column, contract=SHOPIFY_CONTRACT) -> Column:
    """Struct of ``n_records`` and ``errors`` of a document, from one parse.

    ``errors`` lists (record, error) pairs. ``record`` is the position in the document, or null
    for an error of the document itself: ``invalid json`` or ``no envelope``. Only a text without
    edges is read once more, to tell these two apart.
    """

    def of_edge(edge: Column, position: Column) -> Column:
        return F.transform(contract_errors(edge, contract), lambda e: reason(position, e))

    def verdict(edges: Column) -> Column:
        errors = (
            F.when(edges.isNotNull(), F.flatten(F.transform(edges, of_edge)))
            .when(is_json(text), F.array(reason(None, "no envelope")))
            .otherwise(F.array(reason(None, INVALID_JSON)))
        )
        records = F.when(edges.isNotNull(), F.size(edges)).otherwise(0)
        return F.struct(records.alias("n_records"), errors.alias("errors"))

    return F.transform(F.array(_edges(text)), verdict)[0]


def check_documents(documents: DataFrame, contract=SHOPIFY_CONTRACT) -> DataFrame:
    """Add ``judged`` of the document to each row of ``file``, ``text``: ``n_records``, ``errors``."""
    return documents.withColumn("_judged", judged(F.col("text"), contract)).select(
        *documents.columns, "_judged.*"
    )


def document_passes(text: "str | Column", contract=SHOPIFY_CONTRACT) -> Column:
    """True if a document has its envelope and no record breaks the contract."""
    text = F.col(text) if isinstance(text, str) else text
    clean = F.forall(_edges(text), lambda edge: F.size(contract_errors(edge, contract)) == 0)
    return F.coalesce(clean, F.lit(False))


def contract_report(documents: DataFrame, contract=SHOPIFY_CONTRACT) -> DataFrame:
    """One row per error: file, record position (null for the document), message."""
    # the outer form, as Spark guards the plain one with a filter that would run every check twice
    errors = check_documents(documents, contract).select("file", F.inline_outer("errors"))
    return errors.filter(F.col("error").isNotNull())


def file_verdicts(documents: DataFrame, contract=SHOPIFY_CONTRACT) -> DataFrame:
    """Per file: documents, records, errors, and whether it passes.

    One error fails the whole file; a file without records passes.
    """
    return (
        check_documents(documents, contract)
        .groupBy("file")
        .agg(
            F.count(F.lit(1)).alias("n_documents"),
            F.sum("n_records").alias("n_records"),
            F.sum(F.size("errors")).alias("n_errors"),
        )
        .withColumn("passed", F.col("n_errors") == 0)
    )


def with_verdict(
    documents: DataFrame, contract=SHOPIFY_CONTRACT, one_document_per_file: bool = True
) -> DataFrame:
    """Add ``passed``: whether the document's file keeps the contract.

    With one document per file the verdict is in the row and nothing is shuffled. Otherwise the
    names of the failed files are joined back; Spark broadcasts them if they are few.
    """
    if one_document_per_file:
        return documents.withColumn("passed", document_passes("text", contract))
    failed = (
        documents.filter(~document_passes("text", contract))
        .select("file")
        .distinct()
        .withColumn("_failed", F.lit(True))
    )
    judged = split_join(documents, failed, ["file"], "left")
    return judged.withColumn("passed", F.col("_failed").isNull()).drop("_failed")


def route_files(
    documents: DataFrame,
    contract=SHOPIFY_CONTRACT,
    one_document_per_file: bool = True,
    place: "str | None" = None,
) -> "tuple[DataFrame, DataFrame]":
    """Split documents into (clean, quarantined) by the verdict on their file.

    The documents are judged once and written below ``place`` (default: a fresh shared folder), each
    route in a folder of its own; the frames read those.
    """
    spark = documents.sparkSession
    place = place or shared_dir(spark, "routed")
    rows = with_verdict(documents, contract, one_document_per_file)
    rows.write.partitionBy("passed").parquet(place)
    written = spark.read.schema(rows.schema).parquet(place)
    return (
        written.filter("passed").select(*documents.columns),
        written.filter("not passed").select(*documents.columns),
    )
