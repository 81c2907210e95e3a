"""Raw drops and messages -> bronze tables.

One transform per channel serves batch and stream. Every input ends up in the same table
under a ``route``: typed rows as ``accepted``; a document that breaks its contract, lacks its
envelope or does not parse as ``dead_letter`` with its text. One pass, one exactly-once sink.
"""

from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradewind import schemas as S
from tradewind.functions.payload import (
    ACCEPTED,
    DEAD_LETTER,
    INVALID_JSON,
    known_json,
    reason,
    route_decoded,
    strict_json,
)
from tradewind.operators.contract import judged
from tradewind.operators.joins import split_join
from tradewind.sinks.lake import append_bronze
from tradewind.sources.drops import drop_documents
from tradewind.sources.meta import with_ingest_meta
from tradewind.streaming.ingest import stream_append, stream_documents, stream_pos

BRONZE_NAME = {
    "shopify": "shopify_orders",
    "pos": "pos_transactions",
    "distributor": "distributor_sales",
    "amazon": "amazon_sales",
}
PARTITIONS = ("route", "ingest_date")
SUFFIX = {"distributor": "*.csv"}


_ERRORS = "array<struct<record:int,error:string>>"


def _routed(
    documents: DataFrame, records: Column, errors: Column, key: "str | None" = None
) -> DataFrame:
    """Documents -> one row per record, or one dead-letter row with the document's text and errors.

    A document with ``errors`` is set aside whole. With ``key``, a record without that field is a dead
    letter by itself, as JSON.
    """
    rows = documents.select(
        F.col("file").alias("_file"), records.alias("_records"), "text", errors.alias("_errors")
    )
    bad = F.size("_errors") > 0
    rows = rows.select(
        "_file",
        F.posexplode_outer(F.when(~bad, F.col("_records"))).alias("_position", "_record"),
        F.when(bad, F.coalesce("text", F.lit(""))).alias("_text"),
        F.when(bad, F.col("_errors")).alias("_errors"),
    )
    # an accepted document without records leaves no row
    rows = rows.filter(F.col("_record").isNotNull() | F.col("_text").isNotNull())
    dead, why = F.col("_text"), F.col("_errors")
    if key is not None:
        unnamed = F.col("_record").isNotNull() & F.col(f"_record.{key}").isNull()
        dead = F.when(unnamed, F.to_json("_record")).otherwise(dead)
        why = F.when(unnamed, F.array(reason(F.col("_position"), f"{key}: missing"))).otherwise(why)
    return rows.withColumns({"dead_payload": dead, "dead_errors": why}).select(
        "_file",
        "_record.*",
        "dead_payload",
        "dead_errors",
        F.when(F.col("dead_payload").isNull(), F.lit(ACCEPTED))
        .otherwise(F.lit(DEAD_LETTER))
        .alias("route"),
    )


def _unless(there: Column, error: str) -> Column:
    """No errors if ``there`` is not null, else this one."""
    return F.when(there.isNotNull(), F.array().cast(_ERRORS)).otherwise(F.array(reason(None, error)))


def shopify_bronze(documents: DataFrame) -> DataFrame:
    """Order nodes of documents that keep the contract; the others with what they break.

    The contract sets aside every text that is not one JSON value, so the nodes are read without
    looking for its end again.
    """
    parsed = known_json(F.col("text"), S.SHOPIFY_DROP)
    nodes = parsed["data"]["orders"]["edges"]["node"]
    return _routed(documents, nodes, judged(F.col("text"))["errors"])


def amazon_bronze(documents: DataFrame) -> DataFrame:
    """Orders of documents that have an ``Orders`` list."""
    orders = strict_json(F.col("text"), S.AMAZON_DROP)["Orders"]
    return _routed(documents, orders, _unless(orders, "no Orders list"), "AmazonOrderId")


def pos_bronze(documents: DataFrame) -> DataFrame:
    """A drop is an array of transactions; a line of a line drop may be one transaction."""
    text = F.col("text")
    one = strict_json(text, S.POS_TRANSACTION)
    drop = F.when(
        F.ltrim(text, F.lit(" \t\r\n")).startswith("["), strict_json(text, T.ArrayType(S.POS_TRANSACTION))
    ).otherwise(F.when(one.isNotNull(), F.array(one)))
    return _routed(documents, drop, _unless(drop, INVALID_JSON), "transaction_id")


def pos_message_bronze(messages: DataFrame, payload: str = "value") -> DataFrame:
    """One transaction per message."""
    return route_decoded(messages, payload, S.POS_TRANSACTION, "transaction_id")


def distributor_bronze(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {
            "dead_payload": F.lit(None).cast("string"),
            "dead_errors": F.lit(None).cast(_ERRORS),
            "route": F.lit(ACCEPTED),
        }
    )


# a field in quotes may hold commas, line breaks and doubled quotes; a quote elsewhere is a letter.
# Every repetition is possessive, so a field of any length is matched without recursion
_FIELD = '(?:"(?:[^"]++|"")*+"[^,\\n]*+|[^,\\n]*+)'
_RECORD = f"({_FIELD}(?:,{_FIELD})*+)"


def _bare(line: "str | Column") -> Column:
    """A line without the carriage return it may end with; the others are not searched for one."""
    line = F.col(line) if isinstance(line, str) else line
    return F.when(F.contains(line, F.lit("\r")), F.regexp_replace(line, "\\r$", "")).otherwise(line)


def _header_of(record: Column) -> Column:
    """The names in a header, null if they are not those of the channel, in any order.

    Only a text that holds every name is split and looked at.
    """
    names = F.array(*[F.lit(n) for n in sorted(S.DISTRIBUTOR_ROW.fieldNames())])
    found = F.transform(
        F.split(F.regexp_replace(record, "^\\uFEFF|\\r$", ""), ","),
        lambda n: F.regexp_replace(F.trim(n), '^"|"$', ""),
    )
    holds = reduce(and_, (F.contains(record, F.lit(n)) for n in S.DISTRIBUTOR_ROW.fieldNames()))
    return F.when(holds, F.when(F.array_sort(found) == names, found))


def _places_in(header: Column) -> Column:
    """Where a header has each field, in the order of the schema; null without a header."""
    places = [F.array_position(header, F.lit(n)).cast("int") - 1 for n in S.DISTRIBUTOR_ROW.fieldNames()]
    return F.when(header.isNotNull(), F.array(*places))


def _records_of_files(documents: DataFrame) -> DataFrame:
    """``_file, _at, _line`` of whole files; a file with another header is one line without places."""
    records = F.filter(
        F.regexp_extract_all(F.regexp_replace("text", "^\\uFEFF", ""), F.lit(_RECORD), F.lit(1)),
        lambda r: F.trim(F.regexp_replace(r, "\\r$", "")) != "",
    )
    rows = documents.select(F.col("file").alias("_file"), "text", records.alias("_records"))
    rows = rows.withColumn("_header", _header_of(F.get("_records", F.lit(0))))
    rows = rows.withColumn("_at", _places_in(F.col("_header")))
    known = F.col("_at").isNotNull()
    lines = F.when(known, F.slice("_records", 2, F.greatest(F.size("_records"), F.lit(1))))
    return rows.select(
        "_file", "_at", F.explode(lines.otherwise(F.array(F.coalesce("text", F.lit(""))))).alias("_line")
    )


def _records_of_lines(lines: DataFrame) -> DataFrame:
    """``_file, _at, _line`` of lines, each with the places of the header its file has anywhere.

    Files are split freely, so the header is found by its names and joined to the file's lines. The
    list has one row of numbers a file, for files the driver has listed; it is broadcast, as the
    lines would else be shuffled by file. A file without a header, or with two that differ, has none.
    """
    rows = lines.select(F.col("file").alias("_file"), F.col("text").alias("_line"))
    rows = rows.filter(F.trim(_bare("_line")) != "")
    headers = (
        rows.select("_file", _header_of(F.col("_line")).alias("_found"))
        .filter(F.col("_found").isNotNull())
        .groupBy("_file")
        .agg(F.min("_found").alias("_least"), F.max("_found").alias("_most"))
        .filter(F.col("_least") == F.col("_most"))
        .select("_file", _places_in(F.col("_least")).alias("_at"))
    )
    data = rows.filter(_header_of(F.col("_line")).isNull())
    return split_join(data, F.broadcast(headers), ["_file"], "left")


def distributor_documents(documents: DataFrame, whole_files: bool = True) -> DataFrame:
    """Records of CSV drops, their fields named by the header of their file, in whatever order.

    A file with other names is one dead letter, or one for each line without ``whole_files``. A record
    with another number of fields, a value of the wrong type or no transaction id is one by itself.
    A quoted field may hold line breaks in whole files; a line drop has one record a line.
    """
    fields = S.DISTRIBUTOR_ROW.fields
    rows = _records_of_files(documents) if whole_files else _records_of_lines(documents)
    places = [f"_{i}" for i in range(len(fields))]
    schema = ", ".join([f"{p} string" for p in places] + ["_corrupt string"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "escape": '"'}
    known = F.col("_at").isNotNull()
    parsed = F.from_csv(_bare("_line"), schema, options)

    def named(row: Column) -> Column:
        """The texts of a record by name, and whether it has as many fields as there are names."""
        values = F.array(*[row[p] for p in places])
        texts = [F.get(values, F.get("_at", F.lit(i))).alias(f.name) for i, f in enumerate(fields)]
        return F.struct(*texts, row["_corrupt"].isNull().alias("_whole"))

    # the lambda binds the parsed record, so a line is parsed once
    rows = rows.withColumn("_text", F.when(known, F.transform(F.array(parsed), named)[0])).select(
        "_file",
        "_line",
        "_at",
        "_text",
        F.struct(*[F.col(f"_text.{f.name}").try_cast(f.dataType).alias(f.name) for f in fields]).alias("_data"),
    )
    mistyped = [
        F.when(
            F.col(f"_text.{f.name}").isNotNull() & F.col(f"_data.{f.name}").isNull(),
            reason(None, f"{f.name}: type"),
        )
        for f in fields
    ]
    errors = (
        F.when(~known, F.array(reason(None, "header")))
        .when(~F.col("_text._whole"), F.array(reason(None, "number of fields")))
        .when(F.col("_text.TransactionID").isNull(), F.array(reason(None, "TransactionID: missing")))
        .otherwise(F.array_compact(F.array(*mistyped)))
    )
    dead = F.size("_errors") > 0
    return rows.withColumn("_errors", errors).select(
        "_file",
        *[F.when(~dead, F.col(f"_data.{f.name}")).alias(f.name) for f in fields],
        F.when(dead, F.col("_line")).alias("dead_payload"),
        F.when(dead, F.col("_errors")).alias("dead_errors"),
        F.when(dead, F.lit(DEAD_LETTER)).otherwise(F.lit(ACCEPTED)).alias("route"),
    )


DOCUMENT_TRANSFORM = {"shopify": shopify_bronze, "amazon": amazon_bronze, "pos": pos_bronze}


def channel_rows(
    channel: str, raw: DataFrame, file_name=None, ingest_time=None, whole_files: bool = True
) -> DataFrame:
    """Raw documents, rows or messages of a channel -> routed bronze rows with lineage."""
    if channel == "distributor" and "text" in raw.columns:
        routed = distributor_documents(raw, whole_files)
    elif channel in DOCUMENT_TRANSFORM and "text" in raw.columns:
        routed = DOCUMENT_TRANSFORM[channel](raw)
    elif channel == "pos":
        routed = pos_message_bronze(raw)
        file_name = file_name or S.STREAM_FILE_NAME
    else:
        routed = distributor_bronze(raw)
    return with_ingest_meta(routed, file_name, ingest_time)


def ingest_batch(
    spark: SparkSession,
    channel: str,
    landing: str,
    path: str,
    ingest_time=None,
    whole_files: bool = True,
) -> None:
    """Append a landing directory to a bronze path as one job. It does not remember files.

    ``whole_files=False`` takes every line of a JSON drop as a document of its own.
    """
    raw = drop_documents(spark, landing, whole_files, SUFFIX.get(channel, "*.json"))
    rows = channel_rows(channel, raw, ingest_time=ingest_time, whole_files=whole_files)
    append_bronze(rows, path, PARTITIONS)


def ingest_stream(
    spark: SparkSession,
    channel: str,
    landing: "str | None",
    path: str,
    checkpoint: str,
    archive: "str | None" = None,
    trigger: "dict | None" = None,
    kafka: "dict | None" = None,
    files_per_trigger: "int | None" = None,
    whole_files: bool = True,
):
    """Load every new file, or Kafka message, of a channel once; returns the running query.

    Lines of a CSV drop take their names from the header of their file, which is joined to them, so
    that form is for batch only; a CSV stream takes whole files.

    ``trigger={"availableNow": True}`` is the scheduled form, the default the continuous one.
    With ``kafka`` options the POS topic is read instead of the landing directory. A backlog
    is worked off in steps with ``files_per_trigger`` or the Kafka option maxOffsetsPerTrigger;
    both only size the steps. ``whole_files=False`` takes every line of a JSON drop as a document.
    """
    if channel == "distributor" and not whole_files:
        raise ValueError("a CSV stream takes whole files; load line drops with ingest_batch")
    if kafka is not None:
        raw = stream_pos(spark, options=kafka)
    else:
        raw = stream_documents(
            spark, landing, archive, files_per_trigger, whole_files, SUFFIX.get(channel, "*.json")
        )
    rows = channel_rows(channel, raw, whole_files=whole_files)
    return stream_append(rows, path, checkpoint, trigger, PARTITIONS)


def bronze_table(
    spark: SparkSession, channel: str, paths: "list[str]", since: "str | None" = None
) -> "DataFrame | None":
    """Accepted bronze rows over all writers' paths; None if there are none yet.

    ``since`` (``yyyy-MM-dd``) keeps later ingest dates only, by partition pruning. The schema is
    given, so no file footers are read for it; a column that older files lack is null.
    """
    schema = S.BRONZE[BRONZE_NAME[channel]]
    stored = T.StructType([*schema.fields, T.StructField("route", T.StringType())])
    out = None
    for path in paths:
        try:
            table = spark.read.schema(stored).parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                continue
            raise
        rows = table.filter(F.col("route") == ACCEPTED)
        if since is not None:
            rows = rows.filter(F.col("ingest_date") >= F.lit(since))
        rows = rows.select(*schema.fieldNames())
        out = rows if out is None else out.unionByName(rows)
    return None if out is None or out.isEmpty() else out
