"""Token counts kept as delta-maintained rollups by source, language and tokenizer version.

A batch of changes is a set of signed rows: +1 for an inserted document, -1 for a deleted one, and both, old count and new,
for a revised one. A batch is summed by (source, lang, version) and written as one folder named by its id; writing is
the commit, since Spark marks a folder only when it is whole. A batch id that is committed already is not applied again,
so a replayed or retried batch changes nothing. Totals are the sums over committed batches; ``fold`` adds them up into
one base that remembers the ids it holds.

Null sources, languages and versions are groups of their own; null counts are zero; repeated rows count each; an empty
batch commits and adds nothing; groups whose documents and tokens cancel out are not listed. Sums are partial before the
shuffle, so a hot source costs one row a task.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm.batches import ENCODED_BYTES, slices, texts_of
from rookery.llm.chunks import library_encoder
from rookery.workspace import stage

KEYS = ("source", "lang", "version")
ROLLUP = "source string, lang string, version string, docs long, tokens long"


def signed(counts: DataFrame, sign: int) -> DataFrame:
    """Changes (keys, docs, tokens) from counts (keys, tokens): inserts for +1, deletes for -1."""
    tokens = F.coalesce(F.col("tokens"), F.lit(0)).cast("long") * sign
    return counts.select(*KEYS, F.lit(sign).cast("long").alias("docs"), tokens.alias("tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes of documents that were counted as ``old`` and now count as ``new``."""
    return signed(old, -1).unionByName(signed(new, 1))


def _summed(changes: DataFrame) -> DataFrame:
    return changes.groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))


class Rollup:
    """The rollup in one folder that all executors reach. One writer at a time commits batches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.disk, self.root = fs.FileSystem.from_uri(self.folder)
        self.disk.create_dir(f"{self.root}/batches", recursive=True)

    def _done(self, path: str) -> bool:
        return self.disk.get_file_info(f"{self.root}/{path}/_SUCCESS").type == fs.FileType.File

    def _base(self) -> dict:
        """The base in use: its folder, if there is one, and the ids folded into it."""
        path = f"{self.root}/base.json"
        if self.disk.get_file_info(path).type != fs.FileType.File:
            return {"folder": None, "batches": []}
        with self.disk.open_input_stream(path) as file:
            return json.loads(file.read())

    def committed(self) -> set[str]:
        """Ids of all batches that count."""
        found = self.disk.get_file_info(fs.FileSelector(f"{self.root}/batches"))
        return {f.base_name for f in found if self._done(f"batches/{f.base_name}")} | set(self._base()["batches"])

    def apply(self, batch: str, changes: DataFrame) -> bool:
        """Commit a batch; False, and nothing changes, if its id is committed already."""
        if batch in self.committed():
            return False
        _summed(changes).write.mode("overwrite").parquet(f"{self.folder}/batches/{batch}")
        return True

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) after all committed batches."""
        base = self._base()
        paths = [f"{self.folder}/batches/{b}" for b in sorted(self.committed() - set(base["batches"]))]
        paths += [f"{self.folder}/{base['folder']}"] if base["folder"] else []
        if not paths:
            return self.spark.createDataFrame([], ROLLUP)
        summed = _summed(self.spark.read.schema(ROLLUP).parquet(*paths))
        return summed.where("docs <> 0 or tokens <> 0")

    def fold(self) -> None:
        """Add the committed batches up into a new base; the switch is one rename, so a crash leaves the old base in use."""
        done, folder = sorted(self.committed()), f"base-{uuid.uuid4().hex}"
        self.totals().write.parquet(f"{self.folder}/{folder}")
        attempt = f"{self.root}/.{folder}.json"
        with self.disk.open_output_stream(attempt) as file:
            file.write(json.dumps({"folder": folder, "batches": done}).encode())
        self.disk.move(attempt, f"{self.root}/base.json")


# --- counts of documents -----------------------------------------------------------------------------------------------


def count_tokens(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The given columns but ``text``, with ``words`` and ``pieces``: runs without ASCII white space, and ids."""
    others = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        for part in slices(batches, "text", ENCODED_BYTES):
            _, starts = encoder.encode_column(part.column("text"))
            words = pa.array([len(t.encode().split()) for t in texts_of(part, "text")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[part.column(c) for c in others], words, pa.array(np.diff(starts))],
                [*others, "words", "pieces"],
            )

    schema = docs.select(*others).schema.add("words", "long").add("pieces", "long")
    return docs.mapInArrow(run, schema)


def by_version(counted: DataFrame, versions: dict[str, str]) -> DataFrame:
    """One row for each document and tokenizer version, from columns that hold the counts."""
    pairs = F.array(*[F.struct(F.lit(v).alias("version"), F.col(c).alias("tokens")) for v, c in versions.items()])
    return counted.withColumn("each", F.explode(pairs)).select(
        "doc_id", "digest", "source", "lang", "each.version", "each.tokens"
    )


def history(docs: DataFrame, folder: str, tokenizer: str) -> Rollup:
    """A corpus's rollup from its changes: load by an estimate, revise by real counts, delete exact copies, replay, fold.

    The load counts a word for every six characters and an id for every four; a copy is a row whose text equals that of a
    smaller doc_id. Copies go as a revision from all rows with an id to those of each text's smallest.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", "source", "lang", F.length(text).alias("n"), F.sha2(text, 256).alias("digest"), text.alias("text")
    )
    counted = stage(count_tokens(rows, tokenizer), "token-counts")
    estimate = counted.withColumn("words", F.floor(F.col("n") / 6)).withColumn("pieces", F.floor(F.col("n") / 4))
    versions = {"words-1": "words", "word_bpe_49k": "pieces"}
    before, after = by_version(estimate, versions), by_version(counted, versions)
    # joined by text and id together: a text's copies, however many, are dealt over all tasks
    named = counted.where("doc_id is not null")
    first = named.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    originals = by_version(named.join(first, ["digest", "doc_id"], "left_semi"), versions)
    rollup = Rollup(docs.sparkSession, folder)
    rollup.apply("load", signed(before, 1))
    rollup.apply("count", revised(before, after))
    rollup.fold()
    rollup.apply("copies", revised(after.where("doc_id is not null"), originals))
    rollup.apply("count", revised(before, after))
    return rollup
