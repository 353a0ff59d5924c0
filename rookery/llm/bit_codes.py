"""Approximate nearest neighbours by inner product over randomly rotated one-bit codes.

A vector less the mean of all is padded with zeros, turned by a random rotation and kept as the signs of its coordinates: one bit for
each. Two scalars correct the estimate: the length of the centred vector and the inner product of its direction with its own code.
For a query direction q, <code, q> / <code, own direction> estimates the inner product of the two directions, and its error is, but for
a chance that falls with the square of ``deviations`` in the exponent, within deviations * sqrt((1 - a^2) / a^2 / (bits - 1)) with a
the second scalar. Padding to more bits narrows the bound.

Each query block meets each block of codes once. There, packed bits are opened tile by tile, all products with the queries are
estimated, and a candidate is reranked by its exact product if its upper bound reaches the k-th best lower bound in the block or
the query's floor, the k-th best exact product found in a first block. Rows come back by rank, k for each query and block at most.

Equal vectors are one candidate that carries their smallest ids, as many as can be returned, so a vector that a third of the rows share
costs what one costs. Rows whose vector is null, empty, zero, of an unusual length (see ``vectors.sound``) or holds null or non-finite
components, and rows with a null id, take no part. Repeated rows of a candidate count each. A query id given with several vectors
stands for its least vector, once. Ties go to the smaller id. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.vectors import TOTALS, matrix, sound, summed, totals_batch
from rookery.workspace import stage

SEED = 13
BITS_PER_DIM = 4
DEVIATIONS = 1.9
QUERY_ROWS = 8192
CODE_ROWS = 32768
TILE_CODES = 4096
TILE_QUERIES = 128
ROUNDING = 1e-5  # of the products in single precision
MEAN_STEPS = 1 << 20
FOUND = "query_id long, first_id long, ids array<long>, score double"
_FOUND = pa.schema([("query_id", pa.int64()), ("first_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])


@lru_cache(maxsize=4)
def rotation(dims: int, bits: int) -> np.ndarray:
    """The first ``dims`` rows of a random rotation of ``bits`` coordinates; the seed makes all tasks use the same."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, dims, bits]).standard_normal((bits, dims)))
    return np.ascontiguousarray((q * np.sign(np.diagonal(r))).T)


def code_length(dims: int, bits_per_dim: int) -> int:
    """Bits of a code: a multiple of eight, and enough for a bound."""
    return max(64, 8 * ceil(dims * bits_per_dim / 8))


def encode(vectors: np.ndarray, centre: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, length of the centred vector, and the direction's product with its own code (1 for the centre itself)."""
    away = vectors - centre
    length = np.linalg.norm(away, axis=1)
    turned = away @ rotation(vectors.shape[1], bits)
    own = np.abs(turned).sum(axis=1) / np.sqrt(bits)
    return np.packbits(turned > 0, axis=1), length, np.divide(own, length, out=np.ones_like(own), where=length > 0)


def open_codes(codes: np.ndarray) -> np.ndarray:
    """Packed bits as a matrix of plus and minus one over the square root of their number."""
    signs = np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1
    return signs / np.float32(np.sqrt(signs.shape[1]))


def bounds(queries: np.ndarray, centre: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, shift: np.ndarray,
           deviations: float) -> tuple[np.ndarray, np.ndarray]:
    """(estimates, errors) of the inner products of queries (rows) and coded vectors (columns).

    ``shift`` is the exact product of the centre and the centred vector, the part of the product that needs no estimate.
    """
    bits = codes.shape[1] * 8
    away = queries - centre
    reach = np.linalg.norm(away, axis=1)
    unit = np.divide(away, reach[:, None], out=np.zeros_like(away), where=reach[:, None] > 0)
    turned = (unit @ rotation(queries.shape[1], bits)).astype(np.float32)
    cosine = np.empty((len(queries), len(codes)))
    for at in range(0, len(codes), TILE_CODES):
        part = slice(at, at + TILE_CODES)
        cosine[:, part] = turned @ open_codes(codes[part]).T
    estimate = cosine * (length / own) * reach[:, None] + shift + (queries @ centre)[:, None]
    spread = np.sqrt(np.maximum(0, 1 / own**2 - 1)) * deviations / np.sqrt(bits - 1) + ROUNDING
    return estimate, reach[:, None] * (length * spread)


def best_of_block(queries, floor, vectors, coded, centre, k, deviations):
    """(query row, candidate row, exact score) of up to k reranked candidates of each query; survivors reranked in all."""
    found, reranked = [], 0
    for at in range(0, len(queries), TILE_QUERIES):
        some = queries[at : at + TILE_QUERIES]
        estimate, error = bounds(some, centre, *coded, deviations)
        lower, upper = estimate - error, estimate + error
        for i in range(len(some)):
            limit = floor[at + i]
            if len(vectors) > k:
                limit = max(limit, float(np.partition(lower[i], -k)[-k]))
            left = np.flatnonzero(upper[i] >= limit)
            reranked += len(left)
            score = vectors[left] @ some[i]
            take = np.lexsort((left, -score))[:k]  # candidates stand in the order of their smallest id
            take = take[score[take] >= floor[at + i]]
            found += zip([at + i] * len(take), left[take].tolist(), score[take].tolist())
    return found, reranked


def _centre(rows: DataFrame) -> np.ndarray:
    """Mean of the vectors, from integer sums so that reruns agree to the last bit; one number for each dimension."""
    dims = rows.select(F.size("vec").alias("dims")).first()["dims"]
    top = rows.agg(F.max(F.array_max(F.transform("vec", F.abs))).alias("top")).first()["top"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1, dims + 1), object)
        for batch in batches:
            if batch.num_rows:
                steps = np.rint(matrix(batch, "vec") / top * MEAN_STEPS).astype(np.int64).sum(axis=0)
                total[0] += np.array([*steps.tolist(), batch.num_rows], object)
        yield from totals_batch(total)

    total = summed(rows.select("vec").mapInArrow(run, TOTALS), (1, dims + 1))[0]
    return total[:dims].astype(np.float64) / total[dims] / MEAN_STEPS * top


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """(first_id, ids, vec): each vector once, with its ``keep`` smallest ids; ranking cuts hot groups before the shuffle."""
    order = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= keep)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids")).select(
        F.col("ids")[0].alias("first_id"), "ids", "vec"
    )


def index(distinct: DataFrame, centre: np.ndarray, bits_per_dim: int) -> DataFrame:
    """Every distinct vector with its code and correction scalars."""
    bits = code_length(len(centre), bits_per_dim)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch, "vec")
            codes, length, own = encode(vectors, centre, bits)
            scalars = [pa.array(length), pa.array(own), pa.array((vectors - centre) @ centre)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([c.tobytes() for c in codes], pa.binary()), *scalars],
                [*batch.schema.names, "code", "length", "own", "shift"],
            )

    kind = "first_id long, ids array<long>, vec array<double>, code binary, length double, own double, shift double"
    return distinct.mapInArrow(run, kind)


def _blocks(frame: DataFrame, by: str, rows: int) -> tuple[DataFrame, int]:
    n = max(1, ceil(frame.count() / rows))
    return frame.withColumn("block", F.pmod(F.xxhash64(by, F.lit(n)), F.lit(n)).cast("int")), n


def _meet(a: pa.Table, b: pa.Table, centre: np.ndarray, k: int, deviations: float) -> pa.Table:
    if not a.num_rows or not b.num_rows:
        return _FOUND.empty_table()
    a, b = (t.combine_chunks() for t in (a, b.sort_by("first_id")))
    queries, vectors = matrix(a.to_batches()[0], "vec"), matrix(b.to_batches()[0], "vec")
    codes = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, -1)
    floor = a.column("floor").to_pandas().to_numpy(np.float64, na_value=-np.inf)
    coded = (codes, *(b.column(c).to_numpy() for c in ("length", "own", "shift")))
    found, _ = best_of_block(queries, floor, vectors, coded, centre, k, deviations)
    rows, columns, scores = zip(*found) if found else ((), (), ())
    columns = pa.array(columns, pa.int64())
    return pa.table(
        [a.column("id").take(pa.array(rows, pa.int64())), b.column("first_id").take(columns), b.column("ids").take(columns),
         pa.array(scores, pa.float64())],
        schema=_FOUND,
    )


def _met(queries: DataFrame, indexed: DataFrame, keys: list[str], centre: np.ndarray, k: int, deviations: float) -> DataFrame:
    return queries.groupBy(*keys).cogroup(indexed.groupBy(*keys)).applyInArrow(
        lambda a, b: _meet(a, b, centre, k, deviations), FOUND
    )


def search(vectors: DataFrame, queries: DataFrame, k: int, *, key: str = "vec_id", vector: str = "embedding",
           bits_per_dim: int = BITS_PER_DIM, deviations: float = DEVIATIONS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each query id, its own rows left out."""
    def usable(frame: DataFrame) -> DataFrame:
        return sound(frame, key, vector).where(F.col("id").isNotNull() & F.exists("vec", lambda x: x != 0))

    rows = stage(usable(vectors), "search-rows")
    asked = usable(queries).groupBy("id").agg(F.min("vec").alias("vec"))
    if rows.isEmpty():
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    own = k + 1  # the query's own row may be among the best
    centre = _centre(rows)
    indexed, n_blocks = _blocks(stage(index(distinct_vectors(rows, own), centre, bits_per_dim), "search-index"), "first_id", CODE_ROWS)
    asked, q_blocks = _blocks(stage(asked.where(F.size("vec") == len(centre)), "search-queries"), "id", QUERY_ROWS)
    asked = asked.withColumnRenamed("block", "q_block")
    # a first block for each query block gives the floors
    first = indexed.where(F.col("block") < q_blocks).withColumn(
        "q_block", F.explode(F.sequence(F.col("block"), F.lit(q_blocks - 1), F.lit(n_blocks)))
    )
    met = _met(asked.withColumn("floor", F.lit(None).cast("double")), first.drop("block"), ["q_block"], centre, own, deviations)
    if n_blocks > 1:
        floors = met.groupBy("query_id").agg(F.when(F.count("*") >= own, F.min("score")).alias("floor"))
        asked = stage(asked.join(floors, asked["id"] == floors["query_id"], "left").drop("query_id"), "search-floors")
        left = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
        right = indexed.withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        met = _met(left, right, ["q_block", "block"], centre, own, deviations)
    by_first = Window.partitionBy("query_id").orderBy(F.desc("score"), "first_id")
    best = met.withColumn("at", F.row_number().over(by_first)).where(F.col("at") <= own)
    each = best.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    by_id = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
