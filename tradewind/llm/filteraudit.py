"""Filter interaction audit: what each filter removes in every order the filters can be applied in.

A table-driven byte transducer makes one pass over the UTF-8 bytes of a batch of texts. A byte has
a class and the pass a state (between words, in a word); two tables give for each (state, class) the
next state and what is put out: a word's begin or end, a capital, a symbol, a code point. The next
state depends on the byte alone, so numpy reads the states of a whole block off the bytes before.
Word spans go into an open-addressing hash table by document and 64-bit hash, and a span counts as
met before only if its bytes are those of the span in the slot.

Documents then are 32 counts per part and label: which of the five filters they fail. Every order
and step follows from those. Identical texts meet by their SHA-256, aggregated before any shuffle,
so a text that a third of all documents share is a handful of rows.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.vectext import mix, run_hashes
from tradewind.operators.joins import split_join

# bytes of texts that share a hash table; a longer text has one of its own
BATCH = 1 << 22
# bytes of one block of the pass, cut at a blank
BLOCK = 1 << 20

FILTERS = "ABCDE"

# fixed values: white space, and the symbols of filter D
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
SYMBOLS = b"#$%&*|"

# states, byte classes and outputs of the transducer
GAP, WORD = 0, 1
BLANK, CAPITAL, SYMBOL, PLAIN, TAIL = range(5)
OPENS, CLOSES, UPPER, SIGN, POINT = 1, 2, 4, 8, 16


def _classes() -> np.ndarray:
    out = np.full(256, PLAIN, dtype=np.uint8)
    out[0x80:0xC0] = TAIL
    out[list(BLANKS)] = BLANK
    out[ord("A") : ord("Z") + 1] = CAPITAL
    out[list(SYMBOLS)] = SYMBOL
    return out


CLASS = _classes()
NEXT = np.array([GAP, WORD, WORD, WORD, WORD], dtype=np.uint8)
_INSIDE = np.array([POINT | CLOSES, POINT | UPPER, POINT | SIGN, POINT, 0], dtype=np.uint8)
OUTPUT = np.array(
    [[POINT, *(_INSIDE[1:] | OPENS)], _INSIDE],
    dtype=np.uint8,
)
_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass(frozen=True)
class Limits:
    """Thresholds of the filters; texts beyond them fail."""

    least_words: int = 200
    distinct_percent: int = 50
    capital_percent: int = 3


def _blocks(data: np.ndarray, begin: int, end: int) -> "Iterator[tuple[int, int]]":
    """Consecutive ranges of about ``BLOCK`` bytes, none of which ends within a word."""
    while end - begin > BLOCK:
        cut, step = begin + BLOCK, BLOCK
        while cut < end:
            blank = np.flatnonzero(CLASS[data[cut : min(cut + step, end)]] == BLANK)
            if len(blank):
                cut += int(blank[0])
                break
            cut += step
        cut = min(cut, end)
        yield begin, cut
        begin = cut
    if begin < end:
        yield begin, end


def transduce(data: np.ndarray, at: np.ndarray) -> "tuple[dict, np.ndarray, np.ndarray, np.ndarray]":
    """(counts by name, word begins, word ends, word hashes) of the texts ``data[at[i]:at[i + 1]]``."""
    counts = {k: np.zeros(len(at) - 1, dtype=np.int64) for k in ("points", "capitals", "symbols")}
    spans = []
    for begin, end in _blocks(data, int(at[0]), int(at[-1])):
        block = data[begin:end]
        kind = CLASS[block]
        state = np.empty(len(kind), dtype=np.uint8)
        state[0] = GAP
        state[1:] = NEXT[kind[:-1]]
        # a text begins between words; blocks end at a blank or a text's end, so their begins do too
        edge = at[np.searchsorted(at, begin) : np.searchsorted(at, end)] - begin
        state[edge] = GAP
        put = OUTPUT[state, kind]
        for name, bit in (("points", POINT), ("capitals", UPPER), ("symbols", SIGN)):
            places = np.flatnonzero(put & bit) + begin
            counts[name] += np.diff(np.searchsorted(places, at))
        opened = np.flatnonzero(put & OPENS)
        # a word ends at a blank, at its text's end, or with the block
        stops = np.union1d(np.flatnonzero(put & CLOSES), np.append(edge[edge > 0], len(kind)))
        closed = stops[np.searchsorted(stops, opened, "right")]
        spans.append((opened + begin, closed + begin, run_hashes(_VALUE[block], opened, closed)))
    if not spans:
        none = np.zeros(0, dtype=np.int64)
        return counts, none, none, none.astype(np.uint64)
    return counts, *(np.concatenate(x) for x in zip(*spans))


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the bytes from a and from b are equal over the lengths."""
    out = np.ones(len(a), dtype=bool)
    ends = np.cumsum(length)
    first = 0
    while first < len(a):
        done = ends[first - 1] if first else 0
        last = max(int(np.searchsorted(ends, done + BLOCK, "right")), first + 1)
        n = length[first:last]
        row = np.repeat(np.arange(first, last), n)
        step = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        out[row[data[a[row] + step] != data[b[row] + step]]] = False
        first = last
    return out


def distinct_words(
    data: np.ndarray,
    start: np.ndarray,
    end: np.ndarray,
    hashes: np.ndarray,
    text: np.ndarray,
    n_texts: int,
) -> np.ndarray:
    """For each text, how many different words its spans hold.

    All spans look at their slots at once: those at a free slot write their number there and the one
    that stays has claimed it; a span that finds a verified equal of its text is a repetition; the
    others go on to the next slot.
    """
    bits = max(int(2 * len(start)).bit_length(), 1)
    mask = np.int64((1 << bits) - 1)
    table = np.full(1 << bits, -1, dtype=np.int64)
    key = mix(hashes + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    new = np.zeros(len(start), dtype=bool)
    length = end - start
    pending = np.arange(len(start))
    while len(pending):
        place = slot[pending]
        free = table[place] < 0
        table[place[free]] = pending[free]
        there = table[place]
        own = there == pending
        new[pending[own]] = True
        pending, there = pending[~own], there[~own]
        alike = (
            (key[pending] == key[there])
            & (text[pending] == text[there])
            & (length[pending] == length[there])
        )
        met = np.flatnonzero(alike)
        a, b = pending[met], there[met]
        alike[met] = _same_bytes(data, start[a], start[b], length[a])
        pending = pending[~alike]
        slot[pending] = (slot[pending] + 1) & mask
    return np.bincount(text[new], minlength=n_texts)


def _bytes_of(batch: pa.Array) -> "tuple[np.ndarray, np.ndarray]":
    """The bytes of a batch of texts without nulls, and where each begins (one more: the end)."""
    wide = pa.types.is_large_string(batch.type) or pa.types.is_large_binary(batch.type)
    _, offsets, data = batch.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[batch.offset : batch.offset + len(batch) + 1].astype(np.int64)
    return np.frombuffer(data or b"", np.uint8), at


COUNTS = ("words", "distinct", "points", "capitals", "symbols")


def measure(batch: pa.Array) -> "dict[str, np.ndarray]":
    """``COUNTS`` of each text of an Arrow array without nulls."""
    parts: "dict[str, list]" = {name: [np.zeros(0, np.int64)] for name in COUNTS}
    first = 0
    data, at = _bytes_of(batch) if len(batch) else (None, np.zeros(1, np.int64))
    while first < len(batch):
        last = max(int(np.searchsorted(at, at[first] + BATCH, "right")) - 1, first + 1)
        last = min(last, len(batch))
        counts, start, end, hashes = transduce(data, at[first : last + 1])
        text = np.searchsorted(at[first : last + 1], start, "right") - 1
        counts["words"] = np.bincount(text, minlength=last - first)
        counts["distinct"] = distinct_words(data, start, end, hashes, text, last - first)
        for name in COUNTS:
            parts[name].append(counts[name].astype(np.int64))
        first = last
    return {name: np.concatenate(x) for name, x in parts.items()}


def text_counts(text: Column) -> Column:
    """Struct of ``COUNTS`` (long) of a text; null counts as empty."""

    @F.arrow_udf(", ".join(f"{name} long" for name in COUNTS))
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = measure(batch)
            yield pa.StructArray.from_arrays([pa.array(found[c]) for c in COUNTS], list(COUNTS))

    return counted(F.coalesce(text, F.lit("")))


def _own_failures(counts: Column, limits: Limits) -> Column:
    """Bits 1, 2, 4, 8 for filters A to D."""
    n = {name: counts[name] for name in COUNTS}
    fails = [
        n["words"] < limits.least_words,
        n["distinct"] * 100 < n["words"] * limits.distinct_percent,
        n["capitals"] * 100 > n["points"] * limits.capital_percent,
        n["symbols"] > 0,
    ]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    limits: Limits = Limits(),
) -> DataFrame:
    """``part, pattern, n, good, toxic``: documents of a part that fail just the filters of a pattern.

    ``pattern`` has bit 1 for A, 2 for B, 4 for C, 8 for D, 16 for E. ``labels`` has ``key, quality,
    toxic``; a document counts as good (toxic) if any label row of its key says 1. E fails where a
    smaller key has the same text: repeated rows of the smallest key all pass, and rows without a key,
    which come after all others, pass only if no row with a key has their text.
    """
    found = docs.select(
        F.col(key).alias("key"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("digest"),
        _own_failures(text_counts(F.col(text)), limits).alias("own"),
    )
    marks = (
        labels.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("key"))
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"),
        )
    )
    told = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("is_good", "is_toxic")]
    same = ["digest", "part", "own", "is_good", "is_toxic"]
    rows = split_join(found, marks, ["key"], "left").select("key", "digest", "part", "own", *told)
    by_key = rows.groupBy("key", *same).agg(F.count(F.lit(1)).alias("n"))
    # one row for each text, part and label, however many documents share the text
    by_text = by_key.groupBy(*same).agg(
        F.sum("n").alias("n"),
        F.min("key").alias("first"),
        F.coalesce(F.min_by("n", "key"), F.lit(0)).alias("n_first"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("n_keyless"),
    )
    least = F.min("first").over(Window.partitionBy("digest"))
    passed = F.when(least.isNull(), F.col("n_keyless")).otherwise(
        F.when(F.col("first") == least, F.col("n_first")).otherwise(0)
    )
    split = by_text.withColumn("passed", passed).select(
        "part",
        "is_good",
        "is_toxic",
        F.inline(
            F.array(
                F.struct(F.col("own").alias("pattern"), F.col("passed").alias("n")),
                F.struct((F.col("own") + 16).alias("pattern"), (F.col("n") - F.col("passed")).alias("n")),
            )
        ),
    )
    return split.groupBy("part", "pattern").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("is_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("is_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def orders_and_steps(counts: DataFrame) -> DataFrame:
    """For each part, order of the filters and step: what the step's filter does there.

    ``counts`` is ``failure_counts``. Gives ``part, filter_order, step`` and the counts ``kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley``. A document that fails k filters is
    removed by each of them in 1 of k orders, so its share in ``shapley`` is 120 / k.
    """
    # at most 32 rows a part
    patterns = counts.groupBy("part").agg(
        F.collect_list(F.struct("pattern", "n", "good", "toxic")).alias("patterns")
    )
    orders = F.array(*[F.lit("".join(order)) for order in permutations(FILTERS)])
    steps = (
        patterns.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("own", F.expr("shiftleft(1, ascii(substring(filter_order, step, 1)) - 65)"))
        .withColumn(
            "before",
            F.expr(
                "aggregate(sequence(1, step), 0, (b, i) -> if(i < step, "
                "b | shiftleft(1, ascii(substring(filter_order, i, 1)) - 65), b))"
            ),
        )
    )
    own, before = F.col("own"), F.col("before")

    def total(what: str, holds) -> Column:
        return F.aggregate(
            "patterns",
            F.lit(0).cast("long"),
            lambda acc, p: acc + F.when(holds(p["pattern"]), p[what]).otherwise(0),
        )

    def removed(p: Column) -> Column:
        return (p.bitwiseAND(before) == 0) & (p.bitwiseAND(own) != 0)

    shapley = F.aggregate(
        "patterns",
        F.lit(0).cast("long"),
        lambda acc, p: acc
        + F.when(
            p["pattern"].bitwiseAND(own) != 0,
            p["n"] * F.floor(F.lit(120) / F.bit_count(p["pattern"])),
        ).otherwise(0),
    )
    return steps.select(
        "part",
        "filter_order",
        "step",
        total("n", lambda p: p.bitwiseAND(before.bitwiseOR(own)) == 0).alias("kept"),
        total("n", removed).alias("removed"),
        total("n", lambda p: (p.bitwiseAND(before) != 0) & (p.bitwiseAND(own) != 0)).alias("redundant"),
        total("n", lambda p: p == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        shapley.alias("shapley"),
    )


def audit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    part: str = "lang",
    limits: Limits = Limits(),
) -> DataFrame:
    """``orders_and_steps`` of the documents: 600 rows a part, a null part as the empty text.

    Null texts are empty; empty texts fail A alone, unless another empty one has a smaller key. An
    empty table has no parts. Other columns, whatever their names, are not read.
    """
    return orders_and_steps(failure_counts(docs, labels, key, text, part, limits))
