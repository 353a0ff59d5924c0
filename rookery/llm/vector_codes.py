"""Compression of vectors to short codes: a codebook for each part of the vector, found by rounds of exact integer assignment.

Entries become integers floor(scale * x) and vectors are cut into equal consecutive parts. Pruning follows LAESA: the distances of
every part to a few fixed pivots are computed once and written with the row. In each round only the distances of the codebook's
entries to the pivots are new; by the triangle inequality, the largest difference of the two is a lower bound of the distance of part
and entry. Entries are taken in rising order of that bound and their exact squared distance is computed, in integers, until the bound
exceeds the best so far. Bounds are loosened by more than their rounding error, so pruning never changes a result, ties included.

A round is one pass over the staged rows; tasks return sums and counts by part, entry and position (a number fixed by the sizes of the
codebook), which Spark adds exactly. The codebooks (entries x dims integers) are all that the driver holds.

Rows whose vector is null, empty, of an unusual length (see ``vectors.sound``) or holds null or non-finite components are dropped.
Repeated rows each count. Of several rows with one id the lesser vector comes first when the first codebook is filled, null ids come
last. Fewer rows than entries give a smaller codebook; an empty table gives an empty result. Where the length is no multiple of the
number of parts, the parts differ by one component. Rows without a label are one label. Columns that clash with the results' names
are not read. Integers of any size are exact; ``error`` and ``label_error`` are null where a long cannot hold them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.vectors import TOTALS, as_longs, integers, matrix, sound, summed, totals_batch
from rookery.workspace import stage

PIVOTS = 4
SLACK = 1e-9

Book = list[np.ndarray]


def cuts(dims: int, parts: int) -> list[slice]:
    """The parts of a vector; with fewer components than parts some are empty."""
    return [slice(dims * p // parts, dims * (p + 1) // parts) for p in range(parts)]


def exact(x: np.ndarray, width: int) -> np.ndarray:
    """x as 64-bit integers where squared distances of ``width`` components fit, else as Python's."""
    reach = max((abs(int(x.max())), abs(int(x.min()))), default=0) if x.size else 0
    return x.astype(np.int64 if 4 * reach * reach * max(1, width) < 2**63 else object)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    gap = a - b
    return (gap * gap).sum(axis=-1)


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each point to each pivot."""
    out = np.empty((len(points), len(pivots)))
    for p, pivot in enumerate(pivots):
        out[:, p] = np.sqrt(squared(points, pivot).astype(np.float64))
    return out


def fixed_pivots(entries: np.ndarray, count: int) -> np.ndarray:
    """Entries far from one another: each next one is the farthest from those chosen."""
    chosen = [0]
    while len(chosen) < min(count, len(entries)):
        away = np.min([squared(entries, entries[c]).astype(np.float64) for c in chosen], axis=0)
        chosen.append(int(away.argmax()))
    return entries[chosen]


def nearest(points: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each point's nearest entry, ties to the lower index, and the evaluations made."""
    from_entries = distances(entries, pivots)
    bound = np.zeros((len(points), len(entries)))
    for p in range(len(pivots)):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - from_entries[:, p]), out=bound)
    reach = max(to_pivots.max(initial=0), from_entries.max(initial=0))
    bound = np.maximum(0, bound - SLACK * reach) ** 2 * (1 - SLACK)
    order = np.argsort(bound, axis=1, kind="stable")
    code = order[:, 0].copy()
    best = squared(points, entries[code])
    live, made = np.arange(len(points)), len(points)
    for step in range(1, len(entries)):
        entry = order[live, step]
        # bounds rise along a row, so a row that stops here needs none of its later entries
        near = bound[live, entry] <= best[live].astype(np.float64) * (1 + SLACK)
        live, entry = live[near], entry[near]
        if not len(live):
            break
        made += len(live)
        away = squared(points[live], entries[entry])
        better = (away < best[live]) | ((away == best[live]) & (entry < code[live]))
        code[live[better]], best[live[better]] = entry[better], away[better]
    return code, best, made


def assigned(batch: pa.RecordBatch, book: Book, pivots: Book) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, its integers, codes, squared distances) for each part of a batch of staged rows."""
    ints, to_pivots = matrix(batch, "ints"), matrix(batch, "away")
    at = 0
    for part, entries, fixed in zip(cuts(ints.shape[1], len(book)), book, pivots):
        points = ints[:, part]
        both = exact(np.concatenate([points, entries.astype(object), fixed.astype(object)]), points.shape[1])
        own, entries, fixed = np.split(both, [len(points), len(points) + len(entries)])
        code, away, _ = nearest(own, to_pivots[:, at : at + len(fixed)], entries, fixed)
        at += len(fixed)
        yield part, own, code, away


def _with_pivots(rows: DataFrame, pivots: Book, label: str) -> DataFrame:
    """Rows with the distances of their parts to the pivots: computed here once for all rounds."""
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ints = matrix(batch, "ints")
            sides = []
            for part, fixed in zip(cuts(ints.shape[1], len(pivots)), pivots):
                both = exact(np.concatenate([ints[:, part], fixed.astype(object)]), ints[:, part].shape[1])
                sides.append(distances(both[: len(ints)], both[len(ints) :]))
            away = np.concatenate(sides, axis=1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(away.ravel()), away.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "away"])

    return stage(rows.mapInArrow(run, f"id long, label {kind}, ints array<long>, away array<double>"), "code-rows")


def _round(rows: DataFrame, book: Book, pivots: Book) -> Book:
    """The codebooks with each entry replaced by the floored mean of its parts; unused entries stay."""
    dims, entries = sum(b.shape[1] for b in book), len(book[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((entries, dims + len(book)), object)
        for batch in batches:
            if not batch.num_rows:
                continue
            for p, (part, own, code, _) in enumerate(assigned(batch, book, pivots)):
                total[:, dims + p] += np.bincount(code, minlength=entries)
                for entry in np.unique(code).tolist():
                    total[entry, part] += own[code == entry].astype(object).sum(axis=0)
        yield from totals_batch(total)

    total = summed(rows.mapInArrow(run, TOTALS), (entries, dims + len(book)))
    out = []
    for p, (part, old) in enumerate(zip(cuts(dims, len(book)), book)):
        new = old.astype(object)
        for entry in range(entries):
            if total[entry, dims + p]:
                new[entry] = total[entry, part] // total[entry, dims + p]
        out.append(new)
    return out


def _final(rows: DataFrame, book: Book, pivots: Book) -> DataFrame:
    kind = rows.schema["label"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, error = [], 0
            for _, _, code, away in assigned(batch, book, pivots):
                codes.append(code)
                error = error + away.astype(object)
            texts = [bytes(c).hex() for c in np.stack(codes, axis=1).astype(np.uint8)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(texts), as_longs(error)], ["id", "label", "code", "error"]
            )

    return stage(rows.mapInArrow(run, f"id long, label {kind}, code string, error long"), "codes")


def digest(book: Book) -> str:
    """SHA-256 of all entries' integers in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(str(int(v)) for entries in book for v in entries.ravel()).encode()).hexdigest()


def codebooks(vectors: DataFrame, *, parts: int, entries: int, rounds: int, scale: int, key: str, vector: str, label: str) -> tuple[DataFrame, Book, Book] | None:
    """Staged rows with pivot distances, the codebooks after all rounds, and the pivots; none for no rows."""
    if not 0 < entries <= 256:
        raise ValueError("a code of two hexadecimal digits names at most 256 entries")
    rows = stage(
        sound(vectors, key, vector, F.col(label).alias("label")).select("id", "label", integers(scale).alias("ints")), "code-ints"
    )
    first = rows.select("id", "ints").orderBy(F.asc_nulls_last("id"), "ints").limit(entries).collect()
    if not first:
        return None
    seed = np.array([r["ints"] for r in first], object)
    book = [seed[:, part] for part in cuts(seed.shape[1], parts)]
    pivots = [fixed_pivots(b, PIVOTS) for b in book]
    rows = _with_pivots(rows, pivots, label)
    for _ in range(rounds):
        book = _round(rows, book, pivots)
    return rows, book, pivots


def compress(vectors: DataFrame, *, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
             key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every sound row."""
    found = codebooks(vectors, parts=parts, entries=entries, rounds=rounds, scale=scale, key=key, vector=vector, label=label)
    if found is None:
        return vectors.sparkSession.createDataFrame(
            [], f"{key} long, code string, error long, label_error long, codebooks_sha256 string"
        )
    rows, book, pivots = found
    coded = _final(rows, book, pivots)
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.try_sum("error").alias("label_error"))
    return coded.join(totals, coded["label"].eqNullSafe(totals["of"]), "left").select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256")
    )
