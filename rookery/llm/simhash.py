"""Near-duplicates by SimHash: fingerprints in Arrow batches, then exact comparison of tiles of fingerprints.

Equal fingerprints are one before any comparison. Distinct ones are dealt into tiles by population count, since two
fingerprints whose counts differ by more than the radius cannot lie within it: only tiles of counts that near are paired,
by an equi join on the count. A tile pair is compared with numpy exclusive-or and bit counts, and gives a spanning forest
of its links, never all of them, so a large group of near copies stays linear. The work left is quadratic in the number
of distinct fingerprints (by a factor below one half); that is the method.

A null or wordless text has fingerprint zero and is linked like any other. A null doc_id never names a component; a
component of such rows alone has a null id. Repeated rows come back as often as they were given. An empty table gives an
empty result, and columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.batches import slices
from rookery.llm.components import components
from rookery.workspace import stage

SEED = 42
TILE = 4096
ROWS = 128


def fingerprint(text: bytes, shingle: int) -> int:
    """Majority of the bits of the hashes of all shingles, as a signed 64-bit integer."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    width = min(shingle, len(words))
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp): ASCII letters lower-cased, words between ASCII white space, all word shingles with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            raw = part.column("text").cast(pa.binary()).fill_null(b"").to_pylist()
            prints = pa.array([fingerprint(t, shingle) for t in raw], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), prints], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


class Forest:
    """Union-find over the values met in one tile pair."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def find(self, x: int) -> int:
        parent, root = self.parent, x
        while (up := parent.setdefault(root, root)) != root:
            root = up
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def edges(self) -> list[tuple[int, int]]:
        return [(x, self.find(x)) for x in self.parent if self.find(x) != x]


def linked(a: np.ndarray, b: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges that connect what the links between two tiles connect: at most one fewer than their fingerprints."""
    forest = Forest()
    left, right = a.view(np.uint64), b.view(np.uint64)
    for at in range(0, len(left), ROWS):
        near = np.bitwise_count(left[at : at + ROWS, None] ^ right) <= radius
        if not near.any():
            continue
        row, column = np.nonzero(near)
        # each column hangs on its first row; rows that share a column are joined through that first row
        columns, first = np.unique(column, return_index=True)
        parent = np.zeros(len(right), np.int64)
        parent[columns] = row[first]
        for c, r in zip(b[columns].tolist(), a[at + row[first]].tolist()):
            forest.union(c, r)
        shared = np.unique(row * ROWS + parent[column])
        for r, p in zip(a[at + shared // ROWS].tolist(), a[at + shared % ROWS].tolist()):
            forest.union(r, p)
    return forest.edges()


def tiles(distinct: DataFrame, size: int) -> tuple[DataFrame, int]:
    """(ones, slot, fps) of tiles of about ``size`` distinct fingerprints, and the largest number of tiles of a count.

    The slot is a hash of the fingerprint, so tiles are even whatever the values; the counts by population count are 65
    numbers at most, and that bound is what lets them pass through the driver into the plan.
    """
    counts = {r["ones"]: r["count"] for r in distinct.groupBy(F.bit_count("fp").alias("ones")).count().collect()}
    slots = {ones: -(-n // size) for ones, n in counts.items()}
    if not slots:
        return distinct.select(F.lit(0).alias("ones"), F.lit(0).alias("slot"), F.array("fp").alias("fps")), 1
    by_ones = F.create_map(*[F.lit(x) for pair in slots.items() for x in pair])
    dealt = distinct.select("fp", F.bit_count("fp").alias("ones")).select(
        "fp", "ones", F.pmod(F.xxhash64("fp"), by_ones[F.col("ones")]).cast("int").alias("slot")
    )
    return dealt.groupBy("ones", "slot").agg(F.collect_list("fp").alias("fps")), max(slots.values())


def near_edges(distinct: DataFrame, radius: int, size: int = TILE) -> DataFrame:
    """(u, v) edges whose components are those of all links within the radius between distinct fingerprints."""
    packed, most = tiles(distinct, size)
    packed = stage(packed, "tiles")
    salts = max(1, -(-most // 4))
    left = packed.withColumn("salt", F.pmod("slot", F.lit(salts)))
    right = packed.select(
        F.explode(F.sequence(F.greatest(F.lit(0), F.col("ones") - radius), F.col("ones"))).alias("near"),
        F.col("ones").alias("other_ones"),
        F.col("slot").alias("other_slot"),
        F.col("fps").alias("other"),
    ).withColumn("other_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    same = (F.col("ones") < F.col("other_ones")) | (F.col("slot") <= F.col("other_slot"))
    pairs = left.join(
        right, (F.col("ones") == F.col("near")) & (F.col("salt") == F.col("other_salt")) & same
    ).select("fps", "other")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                a, b = (batch.column(k)[i].values.to_numpy() for k in ("fps", "other"))
                found = np.array(linked(a, b, radius), np.int64).reshape(-1, 2)
                if len(found):
                    yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["u", "v"])

    return pairs.mapInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, *, shingle: int, radius: int, tile: int = TILE) -> DataFrame:
    """(doc_id, fp, component_id): one row for each row of docs, with the smallest doc_id that its links reach."""
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    distinct = stage(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    reached = components(near_edges(distinct, radius, tile))
    rooted = distinct.join(reached, distinct["fp"] == reached["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = stage(rooted.join(named, "root").select("fp", "component_id"), "classes")
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def labelled(docs: DataFrame, *, shingle: int, radius: int) -> DataFrame:
    """Contract form: the fingerprint as 16 hexadecimal digits."""
    return near_duplicates(docs, shingle=shingle, radius=radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, *, shingle: int, radius: int) -> DataFrame:
    """The documents that name their component; rows without a doc_id are left as they are.

    Rows that share a doc_id and a text are one document; different texts under one doc_id are documents of their own, all kept
    if the id names their component, so that no rerun picks another of them.
    """
    found = near_duplicates(docs, shingle=shingle, radius=radius)
    firsts = found.where("doc_id = component_id").select("doc_id").distinct()
    same = [f"keep_one {i}" for i in range(2)]  # two independent hashes of the text: 128 bits
    kept = docs.join(firsts, "doc_id", "left_semi").withColumns(
        {same[0]: F.xxhash64("text"), same[1]: F.xxhash64(F.lit("again"), "text")}
    ).dropDuplicates(["doc_id", *same]).drop(*same)
    return kept.unionByName(docs.where("doc_id is null"))
