"""Structured Streaming forms: growing relations, daily windows, counters and newest-N tables.

Every ``foreachBatch`` sink puts its rows into a ``KeyedTable``: a batch reads and writes the buckets of its own keys, and a replayed
batch overwrites itself, so nothing is counted twice.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, StructType

from rookery.operators import shred
from rookery.operators.relational import top_per_key
from rookery.sources.documents import LINES_PER_FILE, clean_lines, quarantined_lines, with_parse_error
from rookery.sources.relations import KEYS, RELATIONS
from rookery.streaming.tables import KeyedTable
from rookery.workspace import scratch, side_by_side, stage

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _drain(stream, checkpoint: str, mode: str = "append") -> None:
    query = stream.option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()


@contextmanager
def state_on_disk(spark: SparkSession):
    """Streams started inside keep their state in RocksDB: state that outgrows an executor's memory, such as all ids ever seen."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(STATE_STORE, before)


def described_first() -> Column:
    """A described user before a stub, then the earliest batch."""
    return F.struct(~F.col("stub"), -F.col("batch"))


def earliest() -> Column:
    return -F.col("batch")


def relation_tables(spark: SparkSession, folder: str) -> dict[str, KeyedTable]:
    """The eight relations as growing tables; users remember who is only a stub."""
    def table(name: str) -> KeyedTable:
        schema = StructType([*RELATIONS[name].fields])
        if name == "users":
            return KeyedTable(spark, f"{folder}/users", schema.add("stub", BooleanType()), KEYS[name], described_first)
        return KeyedTable(spark, f"{folder}/{name}", schema, KEYS[name], earliest)

    return {name: table(name) for name in RELATIONS}


def grow_relations(
    spark: SparkSession, source: str, pattern: str, target: str, checkpoint: str, files_per_batch: int | None = None
) -> dict[str, DataFrame]:
    """New line files arrive; the eight relations grow by insert-if-absent, and a user known from mentions only is replaced as
    soon as a document describes them. Returns the relations after the drain; refused lines and rows lie under ``refused``."""
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(source).select(F.col("_metadata.file_path").alias("file"), "value")
    tables = relation_tables(spark, target)

    def merge(batch: DataFrame, batch_id: int) -> None:
        with scratch(batch.sparkSession):
            merge_lines(batch, batch_id)

    def merge_lines(batch: DataFrame, batch_id: int) -> None:
        mine = {name: table.within(batch.sparkSession) for name, table in tables.items()}
        # stored as they are in small files, since a compressed file is read by one task
        arrived = clean_lines(stage(batch, "arrived", rows_per_file=LINES_PER_FILE))

        def stored(name: str, keys: DataFrame) -> DataFrame:
            columns = [*KEYS[name], *(["stub"] if name == "users" else [])]
            return mine[name].holding(keys, before=batch_id, columns=columns)

        fresh, refused = shred.build_relations(shred.unroll(arrived), stored)
        unread = quarantined_lines(with_parse_error(arrived)).select(F.lit("lines").alias("relation"), "reason", F.col("raw").alias("row"))

        def refuse() -> None:
            refused.unionByName(unread).write.mode("overwrite").parquet(f"{target}/refused/batch={batch_id}")

        with side_by_side(shred.JOBS_AT_ONCE + 1) as jobs:
            last = jobs.submit(refuse)
            list(jobs.map(lambda name: mine[name].put(fresh[name], batch_id), fresh))
            last.result()

    _drain(lines.writeStream.foreachBatch(merge), checkpoint)
    return {name: table.rows() for name, table in tables.items()}


def daily_windows(stream: DataFrame, time: str, value: str) -> DataFrame:
    """Count and average per day. There is no watermark: the state is one row a day, and a late row still counts."""
    return (
        stream.groupBy(F.to_date(time).alias("day")).agg(F.count("*").alias("doc_count"), F.avg(value).alias("average"))
    )


def maintain_rows(changing: DataFrame, keys: list[str], folder: str, checkpoint: str) -> DataFrame:
    """A table of an aggregation's newest rows: each batch writes the rows it changed, the last one of a key is valid."""
    table = KeyedTable(changing.sparkSession, folder, changing.schema, keys)

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.within(batch.sparkSession).put(batch, batch_id)

    _drain(changing.writeStream.foreachBatch(merge), checkpoint, "update")
    return table.rows()


def count_once(events: DataFrame, identity: str, keys: list[str]) -> DataFrame:
    """Events per key, each id counted once however late or often it comes.

    The ids seen stay in the state, since only a bound on lateness could release them; the state is spread over the
    shuffle partitions by id, and belongs on disk (``state_on_disk``).
    """
    return events.dropDuplicates([identity]).groupBy(*keys).agg(F.count("*").alias("total"))


def maintain_newest(events: DataFrame, key: str, identity: str, time: str, n: int, folder: str, checkpoint: str,
                    ) -> DataFrame:
    """(key, identity, time, rank): newest n events per key.

    A batch ranks its own events together with the stored lists of its keys, which it alone reads, and writes the complete list,
    of n entries at most, of every key it touched.
    """
    entry = StructType([events.schema[identity], events.schema[time]])
    table = KeyedTable(events.sparkSession, folder, StructType([events.schema[key]]).add("items", ArrayType(entry)), [key])
    order = [F.desc(time), F.desc(identity)]

    def listed(frame: DataFrame) -> DataFrame:
        return frame.select(key, F.inline("items")).select(key, identity, time)

    def merge(batch: DataFrame, batch_id: int) -> None:
        mine = table.within(batch.sparkSession)
        new = top_per_key(batch.select(key, identity, time), [key], order, n).drop("rank")
        both = new.unionByName(listed(mine.holding(new.select(key), before=batch_id)))
        kept = top_per_key(both.dropDuplicates([key, identity]), [key], order, n)
        mine.put(kept.groupBy(key).agg(F.collect_list(F.struct(identity, time)).alias("items")), batch_id)

    _drain(events.writeStream.foreachBatch(merge), checkpoint)
    return top_per_key(listed(table.rows()), [key], order, n)
