"""Exact top-k by inner product with multi-resolution segment statistics.

Vectors become integers floor(scale * x). For a segment of n components with means m and deviations d, the inner product
of two vectors is at most n * (m m' + d d'), by Cauchy and Schwarz on the centred parts; equally, their squared distance is
at least n * ((m - m')^2 + (d - d')^2), which is the same bound since the distance is the two norms less twice the product.
Bounds of fewer, longer segments are coarser and cheaper: a query block runs through them coarse to fine, drops candidates
whose bound is below the k-th best score so far, and computes exact products for the survivors only.

Queries and candidates are dealt into blocks of bounded size by a hash of the id; every query block meets every candidate
block once, and each meeting returns k rows a query at most, merged by rank. Before that, each query's k-th best among a
few candidates of its own block gives the first threshold, so that later blocks prune from the start.

Vectors that are null, empty or hold null or non-finite components take no part, nor do rows with a null id. Vectors of different
lengths are compared within their length only. Ties go to the smaller id; repeated rows of a candidate count each; a query's own
rows are left out by id, and an id that is asked with several vectors stands for the shortest and least of them, once. Integers and
scores that a long cannot hold become its ends. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rookery.workspace import stage

QUERY_ROWS = 512
BLOCK_ROWS = 8192
SLACK = 1e-6
RESULT = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, *, key: str, vector: str, scale: int) -> DataFrame:
    """(id, dims, ints): sound vectors as floor(scale * x), x as double."""
    values = F.col(vector).cast("array<double>")
    finite = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    sound = vectors.where(F.col(key).isNotNull() & (F.size(vector) > 0)).where(finite)
    return sound.select(
        F.col(key).cast("long").alias("id"),
        F.size(vector).alias("dims"),
        F.transform(values, lambda x: F.floor(x * scale).cast("long")).alias("ints"),
    )


def levels(dims: int) -> list[np.ndarray]:
    """Segment starts of each resolution, coarse to fine: 1, 4, 16 segments as far as segments keep two components."""
    return [np.arange(n) * dims // n for n in (1, 4, 16) if dims >= 2 * n or n == 1]


def statistics(vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Means and deviations of the segments, scaled so that a plain product of two such rows is the bound."""
    dims = vectors.shape[1]
    n = np.diff(np.append(starts, dims))
    total = np.add.reduceat(vectors, starts, axis=1)
    square = np.add.reduceat(vectors * vectors, starts, axis=1)
    spread = np.sqrt(np.maximum(0.0, square - total * total / n))
    return np.concatenate([total / np.sqrt(n), spread], axis=1)


def wide_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of integers whose products may not fit a long; those that do not are its ends."""
    whole = vectors.astype(object) @ query.astype(object)
    return np.array([max(-(2**63), min(2**63 - 1, p)) for p in whole], np.int64)


def best_of_block(queries, query_ids, vectors, ids, floor, k):
    """(query row, candidate row, score) of the k best candidates above each query's floor, exact."""
    q, v = queries.astype(np.float64), vectors.astype(np.float64)
    stats = [(statistics(q, s), statistics(v, s)) for s in levels(q.shape[1])]
    # rounding of a bound must never drop a candidate: it grows with the lengths of the two rows, whatever their product's sign
    slack = [(SLACK * np.linalg.norm(mine, axis=1), np.linalg.norm(theirs, axis=1)) for mine, theirs in stats]
    wide = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * q.shape[1] >= 2**62
    order = np.argsort(ids, kind="stable")
    found = []
    for i in range(len(q)):
        limit = floor[i]
        left = order[ids[order] != query_ids[i]]
        for (mine, theirs), (own, other) in zip(stats, slack):
            if limit > -np.inf:
                left = left[theirs[left] @ mine[i] + own[i] * other[left] + 1 >= limit]
        if not len(left):
            continue
        exact = wide_products(vectors[left], queries[i]) if wide else vectors[left] @ queries[i]
        take = np.argsort(~exact, kind="stable")[:k]  # falling scores; left is in id order, so ties stay with the smaller id
        take = take[exact[take] >= limit]
        found += [(i, left[t], exact[t]) for t in take.tolist()]
    return found


def top_k(vectors: DataFrame, queries: DataFrame, k: int, *, key: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of ``vectors`` with the highest integer product for each query row."""
    return _ranked(
        stage(quantised(vectors, key=key, vector=vector, scale=scale), "vectors"),
        stage(_one_an_id(quantised(queries, key=key, vector=vector, scale=scale)), "queries"),
        k,
    )


def _one_an_id(queries: DataFrame) -> DataFrame:
    least = queries.groupBy("id").agg(F.min(F.struct("dims", "ints")).alias("q"))
    return least.select("id", "q.dims", "q.ints")


def _blocks(frame: DataFrame, rows: int) -> tuple[DataFrame, int]:
    n = max(1, ceil(frame.count() / rows))
    return frame.withColumn("block", F.pmod(F.xxhash64("id", F.lit(n)), F.lit(n)).cast("int")), n


def _ranked(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    vectors, v_blocks = _blocks(vectors, BLOCK_ROWS)
    queries, q_blocks = _blocks(queries, QUERY_ROWS)
    queries = stage(_with_floor(queries, vectors, q_blocks, v_blocks, k), "query-floors")
    left = queries.withColumn("v_block", F.explode(F.sequence(F.lit(0), F.lit(v_blocks - 1)))).withColumnRenamed(
        "block", "q_block"
    )
    right = vectors.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1)))).withColumnRenamed(
        "block", "v_block"
    )
    met = (
        left.groupBy("dims", "q_block", "v_block")
        .cogroup(right.groupBy("dims", "q_block", "v_block"))
        .applyInArrow(lambda a, b: _meet(a, b, k), RESULT)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def _rows(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy().reshape(len(column), -1)


def _meet(a: pa.Table, b: pa.Table, k: int) -> pa.Table:
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    if not a.num_rows or not b.num_rows:
        return schema.empty_table()
    query_ids, ids = a.column("id").to_numpy(), b.column("id").to_numpy()
    floor = a.column("floor").to_pandas().to_numpy(np.float64, na_value=-np.inf)
    found = best_of_block(_rows(a, "ints"), query_ids, _rows(b, "ints"), ids, floor, k)
    rows = np.array(found, np.int64).reshape(-1, 3)
    return pa.table([query_ids[rows[:, 0]], ids[rows[:, 1]], rows[:, 2]], schema=schema)


def _with_floor(queries: DataFrame, vectors: DataFrame, q_blocks: int, v_blocks: int, k: int) -> DataFrame:
    """Queries with their k-th best score within one candidate block, null where it holds fewer than k."""
    left = queries.withColumn("floor", F.lit(None).cast("double")).withColumnRenamed("block", "q_block")
    right = vectors.where(F.col("block") < q_blocks).withColumn(
        "q_block", F.explode(F.sequence(F.col("block"), F.lit(q_blocks - 1), F.lit(v_blocks)))
    )
    met = (
        left.groupBy("dims", "q_block")
        .cogroup(right.groupBy("dims", "q_block"))
        .applyInArrow(lambda a, b: _meet(a, b, k), RESULT)
    )
    floors = met.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).cast("double").alias("floor"))
    return queries.join(floors, queries["id"] == floors["query_id"], "left").drop("query_id")
