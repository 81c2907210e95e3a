"""Decoding of JSON message payloads."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ACCEPTED = "accepted"
DEAD_LETTER = "dead_letter"
INVALID_JSON = "invalid json"


def reason(record: "Column | None", error: "Column | str") -> Column:
    """Why something was set aside: the record's position, or null for the whole input, and the error."""
    position = F.lit(None) if record is None else record
    told = F.lit(error) if isinstance(error, str) else error
    return F.struct(position.cast("int").alias("record"), told.alias("error"))


_END = "__end__"


def _one_value(text: Column, schema: T.DataType, mark, last, value) -> Column:
    """``value`` of the first of two list elements, if the text and an end mark are all of the list.

    A plain parse stops after the first value and says nothing of what follows, so the text is read
    as ``[text, mark]``. A text that closes the list early leaves one element, a second value makes
    three, and a text can't hold the mark itself, which is made from its SHA-256. That is computed and
    the list parsed once: the lambdas bind them.
    """

    def listed(end: Column) -> Column:
        both = F.concat(F.lit("["), text, F.lit(","), mark(end), F.lit("]"))
        return F.struct(F.from_json(both, T.ArrayType(schema)).alias("list"), end.alias("end"))

    return F.transform(
        F.transform(F.array(F.sha2(text, 256)), listed),
        lambda b: F.when(
            (F.size(b["list"]) == 2) & last(F.get(b["list"], F.lit(1))).eqNullSafe(b["end"]),
            value(F.get(b["list"], F.lit(0))),
        ),
    )[0]


def _end_record(end: Column) -> Column:
    return F.concat(F.lit(f'{{"{_END}":"'), end, F.lit('"}'))


def strict_json(text: Column, schema: "T.StructType | T.ArrayType") -> Column:
    """The one JSON value a text holds; null if it holds none, several, or anything after it.

    ``schema`` is an object or a list of objects.
    """
    if isinstance(schema, T.StructType):
        marked = T.StructType([*schema.fields, T.StructField(_END, T.StringType())])
        return _one_value(text, marked, _end_record, lambda x: x[_END], lambda x: x.dropFields(_END))
    marked = T.StructType([*schema.elementType.fields, T.StructField(_END, T.StringType())])
    return _one_value(
        text,
        T.ArrayType(marked),
        lambda end: F.concat(F.lit("["), _end_record(end), F.lit("]")),
        lambda x: F.get(x, F.lit(0))[_END],
        lambda x: F.transform(x, lambda r: r.dropFields(_END)),
    )


def known_json(text: Column, schema: T.StructType) -> Column:
    """The JSON object in a text that is known to hold one value; what it gives for others is not told.

    As in ``strict_json`` it is read as a list element, so both read an object alike.
    """
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(schema))
    return F.get(listed, F.lit(0))


def is_json(text: Column) -> Column:
    """True if a text is one JSON value of any kind."""
    found = _one_value(
        text,
        T.StringType(),
        lambda end: F.concat(F.lit('"'), end, F.lit('"')),
        lambda x: x,
        lambda x: F.lit(True),
    )
    return F.coalesce(found, F.lit(False))


def decode_json(df: DataFrame, payload: str, schema: T.StructType, keep: tuple = ()) -> DataFrame:
    """Bytes or text -> typed columns. A payload that is not one JSON object gives all-null columns."""
    data = strict_json(F.col(payload).cast("string"), schema)
    return df.select(*keep, data.alias("_data")).select(*keep, "_data.*")


def route_decoded(
    df: DataFrame, payload: str, schema: T.StructType, key: str, route: str = "route"
) -> DataFrame:
    """Decode and name the route of every message.

    A message that is not one JSON object, or whose ``key`` did not come out, goes to the dead letters
    and keeps its payload as text beside the reason. One pass over the input serves both routes: write
    it partitioned by ``route``.
    """
    text = F.col(payload).cast("string")
    decoded = df.select(text.alias("_text"), strict_json(text, schema).alias("_data"))
    bad = F.col(f"_data.{key}").isNull()
    why = F.when(F.col("_data").isNull(), INVALID_JSON).otherwise(f"{key}: missing")
    return decoded.select(
        "_data.*",
        F.when(bad, F.coalesce("_text", F.lit(""))).alias("dead_payload"),
        F.when(bad, F.array(reason(None, why))).alias("dead_errors"),
        F.when(bad, F.lit(DEAD_LETTER)).otherwise(F.lit(ACCEPTED)).alias(route),
    )


def split_decoded(
    df: DataFrame, payload: str, schema: T.StructType, key: str
) -> "tuple[DataFrame, DataFrame]":
    """Decode into (accepted rows, dead letters)."""
    routed = route_decoded(df, payload, schema, key)
    accepted = routed.filter(F.col("route") == ACCEPTED).drop("route", "dead_payload", "dead_errors")
    dead = routed.filter(F.col("route") == DEAD_LETTER).select("dead_payload")
    return accepted, dead
