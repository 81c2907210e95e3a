"""Best-fit packing of tokenised documents by minimum bin slack.

Documents become token ids with an end mark; those longer than a sequence are cut into pieces of a
sequence's length. Sequences are then filled one after another: the longest piece left is put in,
and a bitset subset-sum search over the lengths still available finds the fullest combination for
the rest, which is removed.

Only lengths decide, so the search runs on the number of pieces of each length: at most
``capacity`` numbers, however many documents there are. A combination is taken as often as its
lengths last. The result, again bounded by ``capacity``, says for the k-th piece of a length where
it goes; tasks look that up. Pieces are numbered within their length in groups of bounded size, so
a length that very many pieces share is not one task's work.
"""

import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.vectext import batches
from tradewind.sinks.shared import shared_dir

CAPACITY = 4096
END_ID = 1
# pieces of one length that are numbered together
GROUP = 20_000
# remembered words of a task's tokenizer; it forgets all of them when there are more
REMEMBER = 400_000


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# Parts of these characters alone need no normalising but lower case, and the vocabulary's split
# sees no other letters or digits in them: printable ASCII, and Latin letters with one lower case.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017e"
_PLAIN = re.compile(f"[!-~{_LATIN}]+")
# fixed value: the vocabulary's split, for such parts in lower case
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+")
_SPECIAL = "<|"


class _Words:
    """Ids of parts of texts without blanks, as bytes of 32-bit numbers.

    Most parts are words no text before had, so what counts is the time for a new one: plain parts
    are split here, and the tokenizer's model is asked for the pieces; others take the whole way.
    """

    def __init__(self, path: str):
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model
        self.as_bytes = ByteLevel(add_prefix_space=False, use_regex=False)
        self.known: "dict[str, bytes]" = {}
        self.pieces: "dict[str, bytes]" = {}

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece)
        if found is None:
            shown = piece if piece.isascii() else self.as_bytes.pre_tokenize_str(piece)[0][0]
            ids = [t.id for t in self.model.tokenize(shown)]
            found = self.pieces[piece] = struct.pack(f"<{len(ids)}I", *ids)
        return found

    def learn(self, parts: "set[str]") -> None:
        """Tokenise the parts that are not known."""
        if len(self.known) > REMEMBER:
            self.known.clear()
            self.pieces.clear()
        for part in parts.difference(self.known):
            if _PLAIN.fullmatch(part) and _SPECIAL not in part:
                bits = b"".join(map(self._piece, _SPLIT.findall(part.lower())))
            else:
                ids = self.tokenizer.encode(part, add_special_tokens=False).ids
                bits = struct.pack(f"<{len(ids)}I", *ids)
            self.known[part] = bits


@lru_cache(maxsize=2)
def _words(path: str) -> _Words:
    return _Words(path)


def token_bytes(texts: "list[str]", path: str) -> "list[bytes]":
    """The texts' ids as little-endian 32-bit numbers.

    The vocabulary splits at white space, so the ids of a text are those of its parts between
    spaces and line breaks; each part is tokenised once while it is remembered.
    """
    words = _words(path)
    parts = [t.replace("\n", " ").split(" ") for t in texts]
    words.learn(set(chain.from_iterable(parts)))
    return [b"".join(map(words.known.__getitem__, p)) for p in parts]


def _streamed(texts: "list[str]", path: str) -> "Iterator[bytes]":
    for begin, end in batches(texts):
        yield from token_bytes(texts[begin:end], path)


def _tokenise(path: str, capacity: int, end_id: int, with_ids: bool):
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            rows = []
            texts = frame["text"].fillna("").tolist()
            for key, ids in zip(frame["key"], _streamed(texts, path)):
                ids += end
                for piece, start in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[start : start + 4 * capacity]
                    row = (key, piece, start // 4, len(part) // 4, zlib.crc32(part))
                    rows.append((*row, part) if with_ids else row)
            names = ["key", "piece", "start", "length", "ids_crc32", "ids"]
            yield pd.DataFrame(rows, columns=names[: 5 + with_ids])

    return run


def pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """``key, piece, start, length, ids_crc32`` (and ``ids``, 32-bit little-endian) of ``docs``.

    ``docs`` has ``key, text``. A null or empty text is the end mark alone.
    """
    kind = docs.schema["key"].dataType
    schema = "key string, piece int, start long, length long, ids_crc32 long"
    # as text, a null key doesn't turn the whole numbers beside it into floats
    return (
        docs.select(F.col("key").cast("string"), "text")
        .mapInPandas(
            _tokenise(path, capacity, end_id, with_ids),
            schema + (", ids binary" if with_ids else ""),
        )
        .withColumn("key", F.col("key").cast(kind))
    )


def fullest(counts: "dict[int, int]", lengths: "list[int]", room: int) -> "list[tuple[int, int]]":
    """(length, how many) of a combination of the available lengths that leaves least of ``room``.

    Bit t of the set stands for the sum t. Lengths, longest first, are added in powers of two up to
    their count; the set before each addition is kept to read the combination back.
    """
    full = (1 << (room + 1)) - 1
    sums, steps = 1, []
    done = 1 << room
    for length in lengths:
        if length > room:
            continue
        left, batch = min(counts[length], room // length), 1
        while left and not sums & done:
            take = min(batch, left)
            steps.append((length, take, sums))
            sums |= (sums << (length * take)) & full
            left -= take
            batch *= 2
        if sums & done:
            break
    at = sums.bit_length() - 1
    used: "dict[int, int]" = {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            at -= length * take
            used[length] = used.get(length, 0) + take
    return list(used.items())


def minimum_slack(counts: "dict[int, int]", capacity: int) -> "list[tuple[int, dict[int, int]]]":
    """Combinations that use up all pieces: (how many sequences, pieces of each length in one)."""
    counts = {length: n for length, n in counts.items() if n}
    lengths = sorted(counts, reverse=True)
    out = []
    while lengths:
        longest = lengths[0]
        counts[longest] -= 1
        combination = dict(fullest(counts, lengths, capacity - longest))
        counts[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        times = min(counts[length] // n for length, n in combination.items())
        out.append((times, combination))
        for length, n in combination.items():
            counts[length] -= n * times
            if not counts[length]:
                lengths.remove(length)
    return out


def placement_table(combinations: "list[tuple[int, dict[int, int]]]") -> "dict[str, np.ndarray]":
    """For runs of the k-th pieces of a length: their sequences and where they stand in them.

    Sorted by (length, first k). A row covers ``n`` pieces in each of consecutive sequences.
    """
    rows, used, sequence = [], {}, 0
    for times, combination in combinations:
        offset = 0
        for length in sorted(combination, reverse=True):
            n = combination[length]
            rows.append((length, used.get(length, 0), n, sequence, offset))
            used[length] = used.get(length, 0) + n * times
            offset += n * length
        sequence += times
    rows.sort()
    names = ("length", "first", "n", "sequence", "offset")
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {name: table[:, i].copy() for i, name in enumerate(names)}


def _look_up(table: "dict[str, np.ndarray]", length: np.ndarray, rank: np.ndarray):
    """(sequence, offset) of the rank-th pieces of the lengths."""
    step = np.int64(1) << np.int64(44)
    at = np.searchsorted(table["length"] * step + table["first"], length * step + rank, "right") - 1
    k = rank - table["first"][at]
    n = table["n"][at]
    return table["sequence"][at] + k // n, table["offset"][at] + k % n * length


def pack(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    group: int = GROUP,
) -> DataFrame:
    """One row per piece: ``key, piece, start, length, ids_crc32, sequence_id, offset``.

    Every document has at least one piece. Sequences hold their pieces without gaps from offset 0.
    Repeated rows are packed each for itself; rows that agree in key, piece and ids may change
    places, which changes no row of the result. Pieces are written once, without ids, so the numbers
    given to them are the same in every pass; the driver sees one count per length.
    """
    spark = docs.sparkSession
    place = shared_dir(spark, "packing-pieces")
    renamed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    pieces(renamed, path, capacity, end_id).write.parquet(place)
    cut = spark.read.parquet(place)
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    table = spark.sparkContext.broadcast(placement_table(minimum_slack(counts, capacity)))

    # pieces of a length fall into groups by their key's hash; numbers go on from group to group
    groups = F.ceil(F.col("count") / F.lit(group)).cast("long")
    by_length = spark.createDataFrame(
        [(int(length), int(n)) for length, n in counts.items()], "length long, count long"
    )
    dealt = (
        cut.join(F.broadcast(by_length.withColumn("_groups", groups).drop("count")), "length")
        .withColumn("_group", F.pmod(F.xxhash64("key", "piece", "ids_crc32"), F.col("_groups")))
        .drop("_groups")
    )
    sizes = dealt.groupBy("length", "_group").agg(F.count(F.lit(1)).alias("_size"))
    ahead = Window.partitionBy("length").orderBy("_group").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begins = sizes.select(
        F.col("length").alias("_length"),
        F.col("_group").alias("_of"),
        F.coalesce(F.sum("_size").over(ahead), F.lit(0)).alias("_begin"),
    )
    within = Window.partitionBy("length", "_group").orderBy("key", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("_within", F.row_number().over(within) - 1)
        .join(
            begins, (F.col("length") == F.col("_length")) & (F.col("_group") == F.col("_of"))
        )
        .withColumn("_rank", F.col("_begin") + F.col("_within"))
    )

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = _look_up(table.value, length.to_numpy(), rank.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    return ranked.withColumn("_placed", placed("length", "_rank")).select(
        F.col("key").alias(key), "piece", "start", "length", "ids_crc32", "_placed.*"
    )


def sequences(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """The packed sequences: ``sequence_id, length, ids`` (array of int).

    A sequence has at most ``capacity`` tokens, which bounds every group put together here. Texts
    are tokenised again rather than stored; pieces meet their places by what identifies them, and a
    number among equals where rows are repeated.
    """
    marks = ["key", "piece", "ids_crc32"]
    equals = Window.partitionBy(*marks)
    placed = (
        pack(docs, path, key, text, capacity, end_id)
        .withColumnRenamed(key, "key")
        .withColumn("_one", F.row_number().over(equals.orderBy("sequence_id", "offset")))
    )
    renamed = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    cut = (
        pieces(renamed, path, capacity, end_id, with_ids=True)
        .withColumn("_one", F.row_number().over(equals.orderBy("start")))
        .select(*[F.col(c).alias(f"_{c}") for c in marks], F.col("_one").alias("_two"), "ids")
    )
    same = F.col("_one") == F.col("_two")
    for c in marks:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))

    @F.pandas_udf("array<int>")
    def joined(parts: pd.Series) -> pd.Series:
        return parts.map(
            lambda bits: np.frombuffer(b"".join(bits), dtype="<u4").astype(np.int32)
        )

    return (
        placed.join(cut, same)
        .groupBy("sequence_id")
        .agg(
            F.sum("length").alias("length"),
            F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"),
        )
        .select("sequence_id", "length", joined(F.col("parts.ids")).alias("ids"))
    )
