"""Mixing sources to target weights with fixed-length blocks.

Every source's words, in a fixed order of its documents, are cut into blocks of ``block`` words. A mix is a row of slots,
each filled by one block, dealt over output shards of ``shard_slots`` slots. A shard's counts by source are one multinomial
draw from the sources' shares, seeded by the shard. All shards' draws are summed by source, and what a source was drawn beyond
its quota is repaired: those slots, spread by a pseudorandom permutation over all of the source's, are handed in order to the
sources drawn too rarely, so that every quota is met exactly and no block is taken too often. About the square root of the
number of slots change hands. Slots go through a pseudorandom permutation of the source's block indices (a new one each time
the source is used up), and the blocks drawn are joined to the blocks of the documents by index.

Sizes are words (maximal runs without ASCII white space). Null or wordless texts have size 0 and take nothing; the null
source is a source, last in order; repeated rows are separate documents; equal keys are ordered by a hash of the text, so
reruns agree; an empty table gives an empty result. The sources' totals pass through the driver: a mix has one weight for
each source, and more than ``MOST_SOURCES`` of them are refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rookery.workspace import literal_table, stage

WORD = r"[^\x20\x09-\x0D]+"
MOST_SOURCES = 100_000
CHUNK_ROWS = 2048
SPAN_CHUNKS = 4096
DRAW_SHARDS = 64
MOST_TASKS = 20_000


@dataclass(frozen=True)
class Source:
    """A source of the mix: its place in the order, its words, and the words wanted of it."""

    number: int
    name: str | None
    size: int
    target: Fraction
    blocks: int
    slots: int


def targets(sizes: Sequence[int], weights: Sequence[int], share: Fraction, most: int) -> list[Fraction]:
    """Targets by weight summing to ``share`` of all sizes, none above ``most`` times its size while others can take it."""
    wanted, capped = share * sum(sizes), set()
    while True:
        rest = wanted - sum(most * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        level = rest / weight if weight else Fraction(0)
        over = {i for i, w in enumerate(weights) if i not in capped and level * w > most * sizes[i]}
        if not over:
            return [Fraction(most * s) if i in capped else level * weights[i] for i, s in enumerate(sizes)]
        capped |= over


def plan_sources(
    totals: Sequence[tuple[str | None, int]], weights: Sequence[int], share: Fraction, most: int, block: int
) -> list[Source]:
    """Sources in code point order (null last) with weights in turn, targets, and whole slots nearest to them."""
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"{len(totals)} sources; a mix is planned for {MOST_SOURCES} at most")
    ordered = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    sizes = [size for _, size in ordered]
    goals = targets(sizes, [weights[i % len(weights)] for i in range(len(ordered))], share, most)
    found = []
    for i, ((name, size), goal) in enumerate(zip(ordered, goals)):
        blocks = -(-size // block)
        slots = min(most * blocks, round(goal * blocks / size)) if size else 0
        found.append(Source(i, name, size, goal, blocks, slots))
    return found


# --- draws -------------------------------------------------------------------------------------------------------------


def shard_counts(slots: np.ndarray, per_shard: int, shard: int, seed: int) -> np.ndarray:
    """A shard's slots by source: a multinomial draw by the sources' shares of all slots."""
    total = int(slots.sum())
    rng = np.random.default_rng([seed, shard])
    return rng.multinomial(min(per_shard, total - shard * per_shard), slots / total)


def permuted(index: np.ndarray, size: int, key: Sequence[int]) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 at the given places: four Feistel rounds, walked until inside."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = np.random.default_rng(list(key)).integers(0, 1 << 63, 4, np.uint64)
    found = index.astype(np.uint64)
    outside = np.arange(len(found))
    while len(outside):
        left, right = found[outside] >> np.uint64(half), found[outside] & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ mixed >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ (mixed >> np.uint64(32) & mask)
        found[outside] = left << np.uint64(half) | right
        outside = outside[found[outside] >= size]
    return found.astype(np.int64)


class Repair:
    """Brings the slots drawn to the quotas: the n-th surplus slot of all goes to the n-th place still open."""

    def __init__(self, quotas: np.ndarray, drawn: np.ndarray, seed: int):
        self.quotas, self.drawn, self.seed = quotas, drawn, seed
        surplus = np.maximum(0, drawn - quotas)
        self.first = np.cumsum(surplus) - surplus
        self.open = np.maximum(0, quotas - drawn)
        self.ends = np.cumsum(self.open)

    def settle(self, number: int, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sources, ranks below their quotas) of the slots of some ranks that were drawn for a source."""
        numbers = np.full(len(ranks), number)
        if self.drawn[number] <= self.quotas[number]:
            return numbers, ranks
        places = permuted(ranks, int(self.drawn[number]), (self.seed, number, 0, 1))
        over = places >= self.quotas[number]
        nth = self.first[number] + places[over] - self.quotas[number]
        to = np.searchsorted(self.ends, nth, side="right")
        numbers[over] = to
        places[over] = self.drawn[to] + nth - (self.ends[to] - self.open[to])
        return numbers, places


def chosen_blocks(numbers: np.ndarray, ranks: np.ndarray, blocks: Sequence[int], seed: int) -> np.ndarray:
    """The block of each slot: its rank through the permutation of its source's blocks that its turn has."""
    found = np.empty(len(ranks), np.int64)
    for i in np.unique(numbers).tolist():
        at = np.flatnonzero(numbers == i)
        turns = ranks[at] // blocks[i]
        for turn in np.unique(turns).tolist():
            own = at[turns == turn]
            found[own] = permuted(ranks[own] % blocks[i], blocks[i], (seed, i, turn))
    return found


def earlier(sums: DataFrame, value: str) -> DataFrame:
    """(number, chunk, base): the sum of a value over the chunks of the same number before each.

    Spans of chunks are added up first, so no task has all chunks of a number in hand.
    """
    spanned = sums.withColumn("span", F.floor(F.col("chunk") / SPAN_CHUNKS))
    spans = spanned.groupBy("number", "span").agg(F.sum(value).alias("in_span"))
    over_spans = Window.partitionBy("number").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("number", "span").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = spans.select("number", "span", F.coalesce(F.sum("in_span").over(over_spans), F.lit(0)).alias("span_base"))
    return spanned.join(starts, ["number", "span"]).select(
        "number", "chunk", (F.col("span_base") + F.coalesce(F.sum(value).over(inside), F.lit(0))).alias("base")
    )


def draws(spark, sources: Sequence[Source], per_shard: int, seed: int) -> DataFrame:
    """(shard, slot, number, block_no): the block of each slot of the mix.

    Shards are drawn twice, from the same seeds: once to add up the counts by chunk of shards, once to fill the slots.
    """
    slots = np.array([s.slots for s in sources], np.int64)
    blocks = [s.blocks for s in sources]
    shards = ceil(int(slots.sum()) / per_shard)

    def of_chunk(chunk: int) -> range:
        return range(chunk * DRAW_SHARDS, min(shards, (chunk + 1) * DRAW_SHARDS))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                total = sum(shard_counts(slots, per_shard, shard, seed) for shard in of_chunk(chunk))
                some = np.flatnonzero(total)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array(np.full(len(some), chunk)), "number": pa.array(some.astype(np.int32)), "n": pa.array(total[some])
                })

    chunks = ceil(shards / DRAW_SHARDS)
    sums = stage(spark.range(chunks).mapInArrow(count, "chunk long, number int, n long"), "draws")
    drawn = np.zeros(len(slots), np.int64)
    for r in sums.groupBy("number").agg(F.sum("n").alias("n")).collect():  # one row a source
        drawn[r["number"]] = r["n"]
    repair = Repair(slots, drawn, seed)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                before = np.zeros(len(slots), np.int64)
                before[[b["number"] for b in row["bases"]]] = [b["base"] for b in row["bases"]]
                for shard in of_chunk(row["chunk"]):
                    counts = shard_counts(slots, per_shard, shard, seed)
                    own = [repair.settle(i, np.arange(before[i], before[i] + counts[i])) for i in np.flatnonzero(counts).tolist()]
                    before += counts
                    numbers, ranks = (np.concatenate(column) for column in zip(*own))
                    order = np.random.default_rng([seed, shards, shard]).permutation(len(numbers))
                    yield pa.RecordBatch.from_pydict({
                        "shard": pa.array(np.full(len(numbers), shard)),
                        "slot": pa.array(np.arange(len(numbers))),
                        "number": pa.array(numbers[order].astype(np.int32)),
                        "block_no": pa.array(chosen_blocks(numbers, ranks, blocks, seed)[order]),
                    })

    # a chunk's list has a base for each source met in it; the rows are small and their work is not, so chunks get their own tasks
    bases = earlier(sums, "n").groupBy("chunk").agg(F.collect_list(F.struct("number", "base")).alias("bases"))
    spread = bases.repartitionByRange(max(1, min(chunks, MOST_TASKS)), "chunk")
    return spread.mapInArrow(fill, "shard long, slot long, number int, block_no long")


# --- documents ---------------------------------------------------------------------------------------------------------


def placed(sizes: DataFrame, sources: Sequence[Source]) -> DataFrame:
    """The rows with words, with their source's number and the place of their first word among the source's words.

    Two steps keep a hot source out of one task: sums of small hashed chunks, added up per source, then rows in a chunk.
    """
    spark = sizes.sparkSession
    names = literal_table(spark, [(s.name, s.number) for s in sources], "name string, number int")
    # as many rows as the mix has sources, MOST_SOURCES at most
    rows = sizes.where("size > 0").join(F.broadcast(names), F.col("source").eqNullSafe(F.col("name"))).drop("name")
    chunks = max(1, ceil(sizes.count() / CHUNK_ROWS))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "tag"), F.lit(chunks)).cast("int"))
    bases = earlier(rows.groupBy("number", "chunk").agg(F.sum("size").alias("words")), "words")
    inside = (
        Window.partitionBy("number", "chunk").orderBy("doc_id", "tag", "row").rowsBetween(Window.unboundedPreceding, -1)
    )
    return rows.join(bases.hint("merge"), ["number", "chunk"]).withColumn(
        "start", F.col("base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    )


def takes(sizes: DataFrame, sources: Sequence[Source], block: int, per_shard: int, seed: int) -> DataFrame:
    """(row, start_word, words, times): the stretches of each document that blocks of the mix cover, drawn ``times``."""
    spark = sizes.sparkSession
    drawn = draws(spark, sources, per_shard, seed).groupBy("number", "block_no").agg(F.count("*").alias("times"))
    last = (F.col("start") + F.col("size") - 1) / block
    cut = placed(sizes, sources).select(
        "row", "number", "start", "size",
        F.explode(F.sequence(F.floor(F.col("start") / block), F.floor(last))).alias("block_no"),
    )
    first = F.greatest(F.col("start"), F.col("block_no") * block)
    end = F.least(F.col("start") + F.col("size"), (F.col("block_no") + 1) * block)
    return cut.join(drawn.hint("merge"), ["number", "block_no"]).select(
        "row", (first - F.col("start")).alias("start_word"), (end - first).alias("words"), "times"
    )


@dataclass(frozen=True)
class Mix:
    """What to mix: weights in turn over the ordered sources, the share of all words, the most copies of a source."""

    weights: tuple[int, ...] = (5, 2, 1)
    share: Fraction = Fraction(3, 2)
    most: int = 2
    block: int = 64
    shard_slots: int = 4096
    seed: int = 20_24


def _measured(rows: DataFrame, mix: Mix) -> list[Source]:
    totals = rows.groupBy("source").agg(F.sum("size")).collect()  # one row a source
    return plan_sources([(r[0], r[1]) for r in totals], mix.weights, mix.share, mix.most, mix.block)


def _sized(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "row", "doc_id", "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("tag")
    )


def report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    rows = stage(_sized(docs.withColumn("row", F.monotonically_increasing_id())), "sizes")
    sources = _measured(rows, mix)
    found = takes(rows, sources, mix.block, mix.shard_slots, mix.seed)
    taken = found.groupBy("row").agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
    known = literal_table(
        rows.sparkSession,
        [(s.name, s.size, float(s.target)) for s in sources],
        "name string, source_size long, target double",
    )
    return (
        rows.join(F.broadcast(known), F.col("source").eqNullSafe(F.col("name")))
        .join(taken.hint("merge"), "row", "left")
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix as documents: one row for each copy of a document of which the mix takes words.

    A copy that is taken whole keeps its text; any other holds its taken words in order, joined by blanks. ``n_chars``
    is counted anew.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "source", "text")]
    # the other columns travel in one struct, so that none can clash with a name used inside
    kept = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)]).alias("kept")
    rows = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "source", "text", kept), "mix-input")
    sizes = stage(_sized(rows), "sizes")
    found = takes(sizes, _measured(sizes, mix), mix.block, mix.shard_slots, mix.seed)
    parts = found.groupBy("row").agg(F.collect_list(F.struct("start_word", "words", "times")).alias("parts"))
    copies = parts.select("row", "parts", F.explode(F.sequence(F.lit(1), F.array_max("parts.times").cast("int"))).alias("copy"))
    own = copies.select("row", F.array_sort(F.filter("parts", lambda p: p["times"] >= F.col("copy"))).alias("parts"))
    words = F.regexp_extract_all("text", F.lit(WORD), F.lit(0))
    cut = F.transform(
        "parts", lambda p: F.array_join(F.slice(F.col("all_words"), p["start_word"].cast("int") + 1, p["words"].cast("int")), " ")
    )
    length = F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["words"])
    text = F.when(length == F.size("all_words"), F.col("text")).otherwise(F.array_join(cut, " "))
    made = rows.join(own.hint("merge"), "row").withColumn("all_words", words).withColumn("text", text)
    columns = {c: F.col("kept")[f"c{i}"] for i, c in enumerate(others)} | {c: F.col(c) for c in ("doc_id", "source", "text")}
    if "n_chars" in others:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return made.select(*[columns[c].alias(c) for c in docs.columns])
