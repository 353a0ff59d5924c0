"""Table upkeep: insert-if-absent, change sets, lookups, clustered layout."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rookery.operators.relational import best_per_key
from rookery.workspace import fresh_folder, literal_table


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in a fixed order; rows with a NULL key part are left out."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    if not order:
        return df.dropDuplicates(list(keys))
    return best_per_key(df, keys, [F.asc_nulls_first(c) for c in order])


def insert_if_absent(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The rows to append: first per key, and only keys the target does not hold."""
    return first_per_key(incoming, keys, order).join(target.select(*keys), list(keys), "left_anti")


def insert_report(target: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(offered, inserted, repeated, present, refused) in one row: rows that come, those that insert-if-absent would append, those
    whose key came before in the load, those whose key the target holds, and those left out for a NULL in the key.

    Rows are counted by key before the join, so a key that comes often meets the target once.
    """
    held = target.select(*keys).distinct().withColumn("_held", F.lit(True))
    per_key = incoming.groupBy(*keys).agg(F.count("*").alias("_rows")).join(held, list(keys), "left")
    lost = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    new = ~lost & F.col("_held").isNull()
    counts = per_key.agg(
        F.sum("_rows").alias("offered"), F.count_if(new).alias("inserted"), F.sum(F.when(new, F.col("_rows") - 1)).alias("repeated"),
        F.sum(F.when(F.col("_held"), F.col("_rows"))).alias("present"), F.sum(F.when(lost, F.col("_rows"))).alias("refused"),
    )
    return counts.na.fill(0)


def append_rows(df: DataFrame, rows: Sequence[dict], moment=None) -> DataFrame:
    """Append literal rows; ``moment`` fills created_at (the current time when not given)."""
    names = list(rows[0])
    schema = StructType([df.schema[n] for n in names])
    literal = literal_table(df.sparkSession, [tuple(r[n] for n in names) for r in rows], schema)
    if "created_at" in df.columns and "created_at" not in names:
        when = F.current_timestamp() if moment is None else F.lit(moment)
        literal = literal.withColumn("created_at", when.cast(df.schema["created_at"].dataType))
    return df.unionByName(literal, allowMissingColumns=True)


def apply_changes(base: DataFrame, changes: DataFrame, key: str, fields: Sequence[str]) -> DataFrame:
    """Merge a batch of creates, partial updates and deletes, ordered by ``seq``.

    A create or delete resets the document, so only changes from the last reset on count. An update sets the fields
    it names (non-NULL). An update of a document that does not exist is ignored. ``version`` counts the changes.
    """
    reset = F.when(F.col("op").isin("create", "delete"), F.struct("seq", "op"))
    per_key = changes.groupBy(key).agg(
        F.max(reset).alias("_reset"), F.count("*").alias("version")
    )
    recent = changes.join(per_key.select(key, "_reset"), key).filter(
        F.col("_reset").isNull() | (F.col("seq") >= F.col("_reset.seq"))
    )
    latest = recent.groupBy(key).agg(
        *[
            F.max(F.when(F.col(f).isNotNull(), F.struct("seq", F.col(f).alias("value")))).alias(f"_new_{f}")
            for f in fields
        ]
    )
    delta = per_key.join(latest, key)
    marked = base.select(key, *fields, F.lit(True).alias("_base"))
    joined = marked.join(delta, key, "full_outer")
    kept = joined.filter(
        (F.col("_reset").isNull() & F.col("_base")) | (F.col("_reset.op") == "create")
    )
    values = [
        F.coalesce(
            F.col(f"_new_{f}.value"), F.when(F.col("_reset").isNull(), F.col(f))
        ).alias(f)
        for f in fields
    ]
    return kept.select(key, *values, F.coalesce("version", F.lit(0).cast("bigint")).alias("version"))


def write_clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Write range-clustered and sorted, so range filters skip row groups; read it back."""
    spread = (
        df.repartitionByRange(partitions, *columns) if partitions else df.repartitionByRange(*columns)
    )
    path = fresh_folder(df.sparkSession, "clustered")
    spread.sortWithinPartitions(*columns).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _spread_bits(value: Column) -> Column:
    """The 16 low bits of a number with a zero before each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask))
    return value


def interleaved(df: DataFrame, first: str, second: str) -> Column:
    """Place on a space-filling curve: the bits of both columns, scaled to 16 bits between their ends, in turn.

    Rows near in both columns are near on the curve, so a range on either column meets few stretches of it. Two numbers a column
    come from one aggregate. NULLs and a column of one value count as its least.
    """
    ends = df.agg(*[f(c).cast("double").alias(f"{n}_{c}") for c in (first, second) for n, f in (("low", F.min), ("high", F.max))]).first()

    def scaled(column: str) -> Column:
        low, high = ends[f"low_{column}"], ends[f"high_{column}"]
        if low is None or low == high:
            return F.lit(0).cast("bigint")
        part = (F.coalesce(F.col(column).cast("double"), F.lit(low)) - low) / (high - low)
        return F.floor(part * 65535).cast("bigint")

    return F.shiftleft(_spread_bits(scaled(first)), 1).bitwiseOR(_spread_bits(scaled(second)))


def write_interleaved(df: DataFrame, first: str, second: str, partitions: int | None = None) -> DataFrame:
    """Write along the space-filling curve of two columns, so that ranges on either skip files and row groups; read it back."""
    placed = df.withColumn("_curve", interleaved(df, first, second))
    spread = placed.repartitionByRange(partitions, "_curve") if partitions else placed.repartitionByRange("_curve")
    path = fresh_folder(df.sparkSession, "interleaved")
    spread.sortWithinPartitions("_curve").drop("_curve").write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_relations(relations: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write each relation as Parquet under one folder and read it back."""
    out = {}
    for name, df in relations.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        out[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")
    return out


def truncate_tables(spark, folder: str, schemas: dict) -> dict[str, DataFrame]:
    """Empty a set of stored tables, keeping their schemas."""
    out = {}
    for name, schema in schemas.items():
        literal_table(spark, [], schema).write.mode("overwrite").parquet(f"{folder}/{name}")
        out[name] = spark.read.schema(schema).parquet(f"{folder}/{name}")
    return out


def named_stage(df: DataFrame, name: str, *, persist: bool = True) -> DataFrame:
    """A named intermediate: a stored table behind a temporary view, or the view alone."""
    if persist:
        path = fresh_folder(df.sparkSession, name)
        df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
