"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by three rounds of random signs and a fast Hadamard transform (padded to a
power of two) and falls into the bucket of the signed axis it is nearest to. Each of ``tables``
independent turnings gives a table; a query looks into the ``probes`` nearest axes' buckets of
every table. Candidates found are ranked by their exact distance on the original vectors. A query
for which fewer than k rows are found probes every axis of a table, which finds all.

The index holds every row once per table. A bucket is searched in cells of at most ``CELL`` rows by
``BLOCK`` queries, dealt by hashes of the ids, so neither a common vector nor many queries make one
task's work grow; a cell returns k rows per query.
"""

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradewind.llm.vectors import matrix, usable
from tradewind.sinks.shared import shared_dir

K = 10
TABLES = 8
PROBES = 12
CELL = 4096
BLOCK = 1024
ROUNDS = 3


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The fast Hadamard transform of every row, scaled to keep lengths; a power of two long."""
    n, d = rows.shape
    step = 1
    while step < d:
        part = rows.reshape(n, d // (2 * step), 2, step)
        rows = np.stack(
            [part[:, :, 0] + part[:, :, 1], part[:, :, 0] - part[:, :, 1]], axis=2
        ).reshape(n, d)
        step *= 2
    return rows / np.sqrt(d)


@lru_cache(maxsize=64)
def _signs(table: int, d: int) -> np.ndarray:
    return np.random.default_rng([table, d, 97]).choice([-1.0, 1.0], (ROUNDS, d))


def nearest_axes(vectors: np.ndarray, table: int, count: int) -> np.ndarray:
    """The ``count`` signed axes nearest to every vector after the table's turning, nearest first.

    Axis j is j, its opposite d + j, for d dimensions after padding.
    """
    d = 1 << max(vectors.shape[1] - 1, 0).bit_length()
    rows = np.zeros((len(vectors), d))
    # scaled by the largest component first, so that squares don't overflow
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    rows[:, : vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
    for signs in _signs(table, d):
        rows = hadamard(rows * signs)
    score = np.concatenate([rows, -rows], axis=1)
    count = min(count, 2 * d)
    return np.argsort(-score, axis=1, kind="stable")[:, :count]


def _hashed(tables: "tuple[int, ...]", probes: int):
    def run(frames: "Iterator[pd.DataFrame]") -> "Iterator[pd.DataFrame]":
        for frame in frames:
            for dim, part in frame.groupby(frame["vector"].map(len)):
                rows = matrix(part["vector"])
                for table in tables:
                    axes = nearest_axes(rows, table, probes)
                    n = axes.shape[1]
                    yield pd.DataFrame(
                        {
                            "dim": dim,
                            "t": table,
                            "axis": axes.reshape(-1),
                            "id": np.repeat(part["id"].to_numpy(), n),
                            "bits": np.repeat(
                                np.array([r.tobytes() for r in rows], dtype=object), n
                            ),
                        }
                    )

    return run


_HASHED = "dim int, t int, axis int, id long, bits binary"


def _cell(k: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        queries, rows = group[group["query"]], group[~group["query"]]
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(rows):
            c = np.frombuffer(b"".join(rows["bits"]), dtype=np.float64).reshape(len(rows), -1)
            ids = rows["id"].to_numpy()
            for q_id, bits in zip(queries["id"], queries["bits"]):
                q = np.frombuffer(bits, dtype=np.float64)
                others = ids != q_id
                with np.errstate(over="ignore"):
                    score = np.sqrt(np.square(c - q).sum(axis=1))
                score = np.where(others, score, np.inf)
                n = min(k, int(others.sum()))
                if not n:
                    continue
                # all that tie with the last one, so that ids decide
                last = np.partition(score, n - 1)[n - 1]
                near = np.flatnonzero((score <= last) & others)
                near = near[np.lexsort((ids[near], score[near]))][:n]
                found["query_id"].extend([q_id] * n)
                found["vec_id"].extend(ids[near].tolist())
                found["score"].extend(score[near].tolist())
        return pd.DataFrame(found).astype({"query_id": "int64", "vec_id": "int64"})

    return run


def build_index(vectors: DataFrame, tables: "tuple[int, ...]") -> DataFrame:
    """Every row's bucket in every table, written to the shared folder. ``vectors``: ``id, vector``."""
    spark = vectors.sparkSession
    place = shared_dir(spark, "ann-index")
    vectors.mapInPandas(_hashed(tables, 1), _HASHED).write.parquet(place)
    return spark.read.parquet(place)


def _search(queries: DataFrame, index: DataFrame, probes: int, tables, k: int) -> DataFrame:
    """``query_id, vec_id, score``: what the probed buckets hold, at most k rows per query and cell."""
    bucket = ["dim", "t", "axis"]
    probed = queries.mapInPandas(_hashed(tables, probes), _HASHED)
    spark = queries.sparkSession
    place = shared_dir(spark, "ann-probes")
    probed.write.parquet(place)
    probed = spark.read.parquet(place)
    # one row per bucket: tables * 2 * dimensions at most
    cells = index.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells"))
    blocks = probed.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = cells.join(blocks, bucket)

    def part(n: str) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(n)), F.col(n))

    def all_of(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    rows = (
        index.join(dealt, bucket)
        .withColumn("cell", part("cells"))
        .withColumn("block", all_of("blocks"))
        .withColumn("query", F.lit(False))
    )
    asked = (
        probed.join(dealt, bucket)
        .withColumn("block", part("blocks"))
        .withColumn("cell", all_of("cells"))
        .withColumn("query", F.lit(True))
    )
    columns = [*bucket, "cell", "block", "query", "id", "bits"]
    return (
        rows.select(*columns)
        .union(asked.select(*columns))
        .groupBy(*bucket, "cell", "block")
        .applyInPandas(_cell(k), "query_id long, vec_id long, score double")
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        found.groupBy("query_id", "vec_id")
        .agg(F.min("score").alias("score"))
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    tables: int = TABLES,
    probes: int = PROBES,
) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest rows found for every query row.

    Null vectors, zero vectors and those with a null or non-finite component take no part, nor do
    rows with a null key; vectors of another length than the query's are no candidates of it. Ties go
    to the smaller key. Rows with one key count once, at the nearer of their vectors. A query alone
    with its length has no row.
    """
    spark = vectors.sparkSession
    not_zero = F.exists(F.col(vector), lambda x: x != 0)
    rows = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector)) & not_zero)
    queries = rows.filter(is_query).select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    every = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    numbers = tuple(range(tables))
    index = build_index(every, numbers)
    place = shared_dir(spark, "ann-found")
    _best(_search(queries, index, probes, numbers, k), k).write.parquet(place)
    best = spark.read.parquet(place)
    full = best.filter(F.col("rank") == k).select(F.col("query_id").alias("_full"))
    short = queries.join(full, F.col("id") == F.col("_full"), "left_anti")
    if short.isEmpty():
        return best
    # few found, as in a small table: every axis of one table
    axes = 2 << (max(1, every.agg(F.max(F.size("vector"))).first()[0] or 1) - 1).bit_length()
    more = _search(short, index.filter("t = 0"), axes, (0,), k)
    return _best(best.select("query_id", "vec_id", "score").union(more), k)
