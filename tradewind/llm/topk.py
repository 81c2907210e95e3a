"""Exact top-k search by inner product: columnar branch and bound.

Rows are quantised to whole numbers and packed into blocks in vertical layout: one array per
dimension. A block of queries meets a block of rows dimension block by dimension block: partial
products are added up, and after each step a row stays for a query only if its partial product plus
a bound of what is left (the product of the two remaining lengths) can reach the query's threshold.
While most pairs stand, the sums are dense; then the survivors are compacted to a list of pairs, and
later dimensions are read for those alone.

A query's first threshold is its k-th best in one block of rows, a valid bound for all others. Every
query block meets every row block in a task of its own; a task returns k rows per query at most.
"""

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.vectors import matrix, usable
from tradewind.sinks.shared import shared_dir

K = 20
ROWS = 4096
QUERIES = 512
DIMENSIONS = 16
# pairs that must have gone before survivors are compacted
COMPACT = 0.25
_EXACT = float(1 << 53)


def quantise(vectors: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, which hold whole numbers exactly up to 2**53."""
    return np.floor(scale * vectors)


def _packed(scale: int, most: int):
    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        waiting: "dict[int, list]" = {}
        for frame in frames:
            for dim, part in frame.groupby(frame["vector"].map(len)):
                ids, rows = part["id"].to_numpy(), quantise(matrix(part["vector"]), scale)
                have = waiting.setdefault(int(dim), [ids[:0], rows[:0]])
                ids, rows = np.concatenate([have[0], ids]), np.concatenate([have[1], rows])
                while len(ids) >= most:
                    yield _block(dim, ids[:most], rows[:most])
                    ids, rows = ids[most:], rows[most:]
                waiting[int(dim)] = [ids, rows]
        for dim, (ids, rows) in waiting.items():
            if len(ids):
                yield _block(dim, ids, rows)

    return run


def _block(dim: int, ids: np.ndarray, rows: np.ndarray) -> pd.DataFrame:
    small = np.abs(rows).max() < 2**24
    kind = np.float32 if small else np.float64
    return pd.DataFrame(
        {
            # a name of its own: blocks of repeated rows have the same keys. Blocks are written,
            # so the name that a task gives one stays
            "name": [uuid.uuid4().hex],
            "dim": [int(dim)],
            "first": [int(ids.min())],
            "ids": [ids.astype("<i8").tobytes()],
            "data": [np.ascontiguousarray(rows.T).astype(kind).tobytes()],
            "wide": [not small],
        }
    )


_BLOCK = "name string, dim int, first long, ids binary, data binary, wide boolean"


def _unpacked(dim: int, ids: bytes, data: bytes, wide: bool) -> "tuple[np.ndarray, np.ndarray]":
    columns = np.frombuffer(data, dtype=np.float64 if wide else np.float32)
    return np.frombuffer(ids, dtype="<i8"), columns.reshape(dim, -1).astype(np.float64)


def survivors(
    queries: np.ndarray, rows: np.ndarray, least: np.ndarray
) -> "tuple[np.ndarray, np.ndarray, np.ndarray]":
    """(query, row, product) of all pairs with product >= the query's ``least``.

    Both in vertical layout: dimensions by count. Products are exact while they stay below 2**53.
    """
    dims = len(queries)
    starts = list(range(0, dims, DIMENSIONS))

    def left_over(m: np.ndarray) -> np.ndarray:
        """Length of what is left after each dimension block."""
        squares = np.add.reduceat(np.square(m), starts, axis=0)
        after = np.cumsum(squares[::-1], axis=0)[::-1]
        return np.sqrt(np.append(after[1:], np.zeros((1, m.shape[1])), axis=0))

    # a little more than the bound, for the rounding of the lengths
    more = 1 + 1e-9
    rest_q, rest_c = left_over(queries), left_over(rows)
    total = np.zeros((queries.shape[1], rows.shape[1]))
    pairs = None
    for step, start in enumerate(starts):
        part = slice(start, start + DIMENSIONS)
        if pairs is None:
            total += queries[part].T @ rows[part]
            stay = total + np.outer(rest_q[step] * more, rest_c[step]) >= least[:, None]
            if step == len(starts) - 1 or stay.mean() < COMPACT:
                pairs = np.nonzero(stay)
                total = total[pairs]
        else:
            q, c = pairs
            total = total + np.einsum("ij,ij->j", queries[part][:, q], rows[part][:, c])
            stay = total + rest_q[step][q] * rest_c[step][c] * more >= least[q]
            pairs, total = (q[stay], c[stay]), total[stay]
    return pairs[0], pairs[1], total


def _exactly(queries: np.ndarray, rows: np.ndarray) -> "tuple[np.ndarray, np.ndarray, np.ndarray]":
    """All products of numbers too large for doubles, in whole numbers, held to a long's range."""
    q = np.array([[int(x) for x in row] for row in queries.T], dtype=object)
    c = np.array([[int(x) for x in row] for row in rows], dtype=object)
    product = np.clip(q.dot(c), -(1 << 63), (1 << 63) - 1).astype(np.int64)
    at = np.nonzero(np.ones(product.shape, dtype=bool))
    return at[0], at[1], product[at]


def _meet(k: int):
    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            for r in frame.itertuples(index=False):
                q_ids, q = _unpacked(r.dim, r.q_ids, r.q_data, r.q_wide)
                c_ids, c = _unpacked(r.dim, r.ids, r.data, r.wide)
                least = np.frombuffer(r.least, dtype="<f8") if r.least else np.full(len(q_ids), -np.inf)
                if r.dim * np.abs(q).max() * np.abs(c).max() < _EXACT:
                    at, row, score = survivors(q, c, least)
                else:
                    at, row, score = _exactly(q, c)
                other = q_ids[at] != c_ids[row]
                at, row, score = at[other], row[other], score[other]
                order = np.lexsort((c_ids[row], -score.astype(np.float64), at))
                if score.dtype == np.int64:
                    order = np.array(
                        sorted(range(len(at)), key=lambda i: (at[i], -int(score[i]), c_ids[row[i]])),
                        dtype=np.int64,
                    )
                at, row, score = at[order], row[order], score[order]
                begins = np.searchsorted(at, np.arange(len(q_ids)))
                best = np.arange(len(at)) - begins[at] < k
                yield pd.DataFrame(
                    {
                        "query_id": q_ids[at[best]],
                        "vec_id": c_ids[row[best]],
                        "score": score[best].astype(np.int64),
                    }
                )

    return run


_FOUND = "query_id long, vec_id long, score long"


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = 64,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k best rows of every query row, exactly.

    The score is the inner product of floor(scale * x), ties go to the smaller key. Null and empty
    vectors and those with a null or non-finite component take no part, nor do rows with a null key;
    vectors of another length than the query's are no candidates of it. Rows with one key count once,
    at their best score. Products beyond a long stand at its end.
    """
    spark = vectors.sparkSession
    rows = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector)))
    every = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"))

    def kept(frame: DataFrame, name: str) -> DataFrame:
        place = shared_dir(spark, f"topk-{name}")
        frame.write.parquet(place)
        return spark.read.parquet(place)

    blocks = kept(every.mapInPandas(_packed(scale, ROWS), _BLOCK), "rows")
    asked = rows.filter(is_query).select(
        F.col(key).cast("long").alias("id"), F.col(vector).alias("vector")
    )
    # few partitions' worth of queries each, so that blocks are full; numbered by their first key
    queries = kept(
        asked.repartition(F.pmod(F.xxhash64("id"), F.lit(64))).mapInPandas(
            _packed(scale, QUERIES), _BLOCK
        ),
        "queries",
    )
    queries = queries.select(
        "dim",
        F.col("name").alias("q_name"),
        F.col("ids").alias("q_ids"),
        F.col("data").alias("q_data"),
        F.col("wide").alias("q_wide"),
    )

    # the block with the smallest key of each length gives every query its first threshold
    chosen = blocks.groupBy("dim").agg(F.min(F.struct("first", "name"))["name"].alias("_chosen"))
    probe = blocks.join(chosen.select("_chosen"), F.col("name") == F.col("_chosen")).drop("_chosen")
    tasks = queries.withColumn("least", F.lit(None).cast("binary"))
    first = kept(_pairs(tasks, probe, k), "first")
    kth = (
        _best(first, k)
        .filter(F.col("rank") == k)
        .select("query_id", F.col("score").cast("double").alias("least"))
    )
    known = kept(_with_least(queries, kth), "thresholds")
    return _best(_pairs(known, blocks, k), k)


def _with_least(queries: DataFrame, kth: DataFrame) -> DataFrame:
    """Query blocks with their queries' thresholds, in the block's order; none is minus infinity."""

    @F.pandas_udf("array<long>")
    def listed(ids: pd.Series) -> pd.Series:
        return ids.map(lambda b: np.frombuffer(b, dtype="<i8"))

    @F.pandas_udf("binary")
    def packed(least: pd.Series) -> pd.Series:
        return least.map(lambda x: np.array(x, dtype="<f8").tobytes())

    each = queries.select("q_name", F.posexplode(listed("q_ids")).alias("place", "id"))
    least = (
        each.join(kth, F.col("id") == F.col("query_id"), "left")
        .groupBy(F.col("q_name").alias("_name"))
        .agg(
            F.array_sort(
                F.collect_list(
                    F.struct("place", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
                )
            ).alias("all")
        )
        .select("_name", packed(F.col("all.least")).alias("least"))
    )
    return queries.join(least, F.col("q_name") == F.col("_name")).drop("_name")


def _pairs(queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """Every query block with every row block of its length, each pair a row of its own.

    A row block is sent once for each query block, by a join with the narrow list of those (one row
    for ``QUERIES`` queries); the pairs are then keyed by the query block, so they spread evenly.
    """
    listed = queries.select(F.col("dim").alias("_dim"), F.col("q_name").alias("_name"))
    sent = blocks.drop("first", "name").join(listed, F.col("dim") == F.col("_dim")).drop("dim", "_dim")
    pairs = sent.join(queries, F.col("_name") == F.col("q_name")).drop("_name", "q_name")
    return pairs.mapInPandas(_meet(k), _FOUND)
