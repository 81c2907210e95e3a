"""Mixing sources to target weights: exact targets per source, whole documents as copies.

Tokens are added up per source, a source's repetition rate is its target over its size, and
every document is taken ``floor(rate)`` times plus once more with the probability of the rate's
fraction, by a hash-seeded draw. ``mix`` draws each document by itself. ``mix_plan`` draws them in
strata: a source's documents, dealt to groups by hash, are lined up by size, and a document is drawn
where the running sum of the fraction, begun at the group's hash-seeded number, passes a whole number.
Every document has the same probability there too, and the draws spread evenly over the sizes, so
that a source's sum lies near its target.

Built-in expressions only. Shuffled are totals per source (partial sums first) and, for strata, one
narrow row per distinct document; texts never.
"""

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.sinks.shared import shared_dir

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_RATE = 2.0
# documents of a stratum, about
GROUP = 1000
# a draw has 48 bits
_BITS = float(1 << 48)


def word_count(text: Column) -> Column:
    """Number of words; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame,
    weights: "tuple[int, ...]" = WEIGHTS,
    share: float = SHARE,
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """``source, source_size, n_docs`` (one row per source) -> the same with ``target``.

    Sources in code-point order, null last, take the weights in turn. ``share`` of all sizes is
    dealt out by weight; a source stops at ``max_rate`` times its size and what it can't take is
    dealt out again. Where that ends, every open source stands at one level per weight, so the
    sources are put in the order in which they fill up and the level follows from running sums.
    The input has one row per source, which is what the single-partition windows sort.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = totals.withColumn(
        "_weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]),
            ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"),
        ),
    ).withColumn("_limit", F.col("source_size") * F.lit(max_rate))
    everything = Window.partitionBy()
    filling = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0.0)
    # the level if all sources before this one are full; it rises up to the first open one, then falls
    level = (
        F.sum("source_size").over(everything) * F.lit(share)
        - F.coalesce(F.sum("_limit").over(before), zero)
    ) / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), zero))
    return (
        weighted.withColumn("_level", level)
        .withColumn("_final", F.max("_level").over(everything))
        .select(
            "source",
            "source_size",
            "n_docs",
            F.least("_limit", F.col("_final") * F.col("_weight")).alias("target"),
        )
    )


def _draw(key: Column, seed: Column) -> Column:
    """A number in [0, 1) that depends on the two alone."""
    digest = F.md5(F.concat_ws(":", seed.cast("string"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(_BITS)


def _extra(key: str, seed: Column, part: Column) -> Column:
    return F.when(_draw(F.col(key), seed) < part, 1).otherwise(0)


def source_rates(
    sized: DataFrame,
    weights: "tuple[int, ...]" = WEIGHTS,
    share: float = SHARE,
    max_rate: float = MAX_RATE,
) -> DataFrame:
    """Rows with ``source, size`` -> one row per source: its target and rate.

    Columns: ``source, source_size, n_docs, target, whole, part``. Sources without words have
    target and rate 0.
    """
    totals = sized.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")
    )
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    return (
        source_targets(totals, weights, share, max_rate)
        .withColumn("whole", F.floor(rate).cast("int"))
        .withColumn("part", rate - F.col("whole"))
    )


def _rated(rows: DataFrame, sized: DataFrame, prefix: str, options: dict) -> DataFrame:
    """``rows`` with their source's rate columns, all named with ``prefix``.

    The rates are written: they are one row per source, and Spark sees the size of that table
    before it decides to broadcast it. Rows are not shuffled then.
    """
    spark = rows.sparkSession
    place = shared_dir(spark, "mixing-rates")
    source_rates(sized, **options).write.parquet(place)
    rates = spark.read.parquet(place)
    rates = rates.select(*[F.col(c).alias(prefix + c) for c in rates.columns])
    return rows.join(rates, F.col("source").eqNullSafe(F.col(f"{prefix}source")))


def _sized(docs: DataFrame, key: str) -> DataFrame:
    spark = docs.sparkSession
    place = shared_dir(spark, "mixing-sizes")
    docs.select(key, "source", word_count(F.col("text")).alias("size")).write.parquet(place)
    return spark.read.parquet(place)


def mix_plan(docs: DataFrame, key: str = "doc_id", group: int = GROUP, **options) -> DataFrame:
    """``key, size, source_size, target, copies`` for every row of ``docs``.

    Null texts have size 0. A null key draws like any other value. Rows with one source, key and size
    are drawn side by side, and it makes no difference which of them gets a copy; a key that very many
    rows share is one row with their number until the end. Sizes are written once to the shared
    folder, so that all passes (and one repeated after a lost executor) add up the same table.
    """
    sized = _sized(docs, key)
    p = f"_{uuid.uuid4().hex[:8]}_"
    alike = sized.groupBy("source", F.col(key).alias("key"), "size").agg(
        F.count(F.lit(1)).alias("rows")
    )
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    groups = F.ceil(F.col(f"{p}n_docs") / F.lit(group))
    dealt = _rated(alike, sized, p, options).withColumn(
        "stratum", F.floor(_draw(name, F.lit("g")) * groups).cast("long")
    )
    line = Window.partitionBy("source", "stratum").orderBy(
        "size", _draw(name, F.lit("o")), F.col("key").asc_nulls_last()
    )
    begun = _draw(
        F.concat_ws(":", F.col("stratum").cast("string"), F.coalesce("source", F.lit(""))), F.lit("u")
    )
    part = F.col(f"{p}part")
    each = dealt.select(
        "*",
        begun.alias("begun"),
        (F.sum("rows").over(line.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")).alias(
            "before"
        ),
    ).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    place = F.col("before") + F.col("nth")
    drawn = F.floor(place * part + F.col("begun")) - F.floor((place - 1) * part + F.col("begun"))
    return each.select(
        F.col("key").alias(key),
        "size",
        F.col(f"{p}source_size").alias("source_size"),
        F.col(f"{p}target").alias("target"),
        (F.col(f"{p}whole") + drawn).cast("int").alias("copies"),
    )


def mix(docs: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as its copies, with its own columns.

    Texts are read twice and never shuffled; a document's draw depends on its key alone, so rows of one
    source and key share it. Helper columns have names that ``docs`` can't have.
    """
    p = f"_{uuid.uuid4().hex[:8]}_"
    copies = F.col(f"{p}whole") + _extra(key, F.lit(0), F.col(f"{p}part"))
    rated = _rated(docs, _sized(docs, key), p, options).withColumn(f"{p}copies", copies)
    return (
        rated.filter(F.col(f"{p}copies") > 0)
        .withColumn(f"{p}copy", F.explode(F.sequence(F.lit(1), F.col(f"{p}copies"))))
        .select(*docs.columns)
    )
