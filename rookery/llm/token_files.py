"""Token ids as flat unsigned integer files with 64-bit document offsets, read back through memory maps.

A range partition of the documents becomes one pair of files in the target folder: ``part-00007.ids`` holds its ids end to
end (two bytes each where the vocabulary allows it, else four, little-endian), ``part-00007.idx`` holds, as int64,
``doc_id, doc_id is null, end`` for each document. Partition bases are the prefix sums of the parts' totals, one number
a part, so no pass over the documents is needed to place them.

Rows are ordered by (doc_id, hash of text); a null doc_id comes first and comes back as null. Null texts are empty, an
empty text holds the end id alone, repeated rows are written as often as they come, an empty table gives no files. Files
are written under a name of the attempt's own and renamed when whole, so a repeated task replaces its own output.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.llm.batches import ENCODED_BYTES, slices
from rookery.llm.chunks import library_encoder
from rookery.workspace import literal_table

MANIFEST = "parts.json"
READ_IDS, READ_ROWS = 4 << 20, 1 << 18


@dataclass(frozen=True)
class Part:
    """A pair of files: where its documents and ids start among all."""

    name: str
    documents: int
    tokens: int
    base: int
    width: int


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int) -> list[Part]:
    """Encode every text, add ``end_id``, and write the files in ascending doc_id order; returns the parts in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = library_encoder(tokenizer)
        end = np.array([end_id], encoder.dtype)
        if int(end[0]) != end_id:
            raise ValueError(f"end id {end_id} does not fit {encoder.dtype}")
        disk, root = fs.FileSystem.from_uri(folder)
        name = f"part-{TaskContext.get().partitionId():05d}"
        attempt = f"{root}/.{name}-{uuid.uuid4().hex}"
        keys, lengths = [], []
        with disk.open_output_stream(f"{attempt}.ids") as out:
            for part in slices(batches, "text", ENCODED_BYTES):
                ids, starts = encoder.encode_column(part.column("text"))
                out.write(np.insert(ids, starts[1:], end))
                keys.append(part.column("doc_id"))
                lengths.append(np.diff(starts) + 1)
        if not keys:
            disk.delete_file(f"{attempt}.ids")
            return
        counts = np.concatenate(lengths)
        column = pa.chunked_array(keys)
        index = np.stack([column.fill_null(0).to_numpy(), column.is_null().to_numpy(), np.cumsum(counts)], axis=1)
        with disk.open_output_stream(f"{attempt}.idx") as out:
            out.write(index.astype("<i8").tobytes())
        for kind in ("ids", "idx"):
            disk.move(f"{attempt}.{kind}", f"{root}/{name}.{kind}")
        yield pa.RecordBatch.from_pydict(
            {"name": [name], "documents": [len(counts)], "tokens": [int(counts.sum())], "width": [encoder.dtype.itemsize]}
        )

    disk, root = fs.FileSystem.from_uri(folder)
    disk.create_dir(root, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ordered = (
        rows.withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
        .select("doc_id", "text")
    )
    written = ordered.mapInArrow(run, "name string, documents long, tokens long, width long")
    parts, base = [], 0
    for row in sorted(written.collect()):  # one short row a part
        parts.append(Part(row.name, row.documents, row.tokens, base, row.width))
        base += row.tokens
    with disk.open_output_stream(f"{root}/{MANIFEST}") as out:
        out.write(json.dumps([vars(p) for p in parts]).encode())
    return parts


def read_parts(folder: str) -> list[Part]:
    """The parts of a folder, from its manifest."""
    disk, root = fs.FileSystem.from_uri(folder)
    with disk.open_input_stream(f"{root}/{MANIFEST}") as file:
        return [Part(**p) for p in json.loads(file.read())]


class _Values:
    """A file of integers: slices come from a memory map where it lies on a mounted file system, else from ranged reads."""

    def __init__(self, disk: fs.FileSystem, path: str, dtype: str):
        self.dtype, self.mapped, self.file = np.dtype(dtype), None, None
        if isinstance(disk, fs.LocalFileSystem):
            self.mapped = np.memmap(path, self.dtype, "r")
        else:
            self.file = disk.open_input_file(path)

    def between(self, start: int, end: int) -> np.ndarray:
        if self.mapped is not None:
            return self.mapped[start:end]
        width = self.dtype.itemsize
        return np.frombuffer(self.file.read_at((end - start) * width, start * width), self.dtype)


def _records(rows: np.ndarray, ids: _Values, at: int, base: int) -> Iterator[pa.RecordBatch]:
    """The documents of some rows of an index, the first of which starts at ``at``, in batches of about ``READ_IDS`` ids."""
    ends, first = np.concatenate([[at], rows[:, 2]]), 0
    while first < len(rows):
        last = max(first + 1, int(np.searchsorted(ends, ends[first] + READ_IDS, "right")) - 1)
        cut = ends[first : last + 1]
        wide = ids.between(int(cut[0]), int(cut[-1])).astype("<u4")
        offsets = pa.py_buffer(((cut - cut[0]) * 4).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows[first:last, 0], mask=rows[first:last, 1] != 0),
                pa.array(cut[:-1] + base),
                pa.array(np.diff(cut)),
                pa.BinaryArray.from_buffers(pa.binary(), last - first, [None, offsets, pa.py_buffer(wide)]),
            ],
            ["doc_id", "start", "n_tokens", "ids"],
        )
        first = last


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ids as little-endian unsigned 32-bit integers, start counts all earlier ids."""
    schema = "doc_id long, start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        disk, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for part in batch.to_pylist():
                index = _Values(disk, f"{root}/{part['name']}.idx", "<i8")
                ids = _Values(disk, f"{root}/{part['name']}.ids", f"<u{part['width']}")
                at = 0
                for first in range(0, part["documents"], READ_ROWS):
                    last = min(first + READ_ROWS, part["documents"])
                    rows = index.between(3 * first, 3 * last).reshape(-1, 3)
                    yield from _records(rows, ids, at, part["base"])
                    at = int(rows[-1, 2])

    parts = [(p.name, p.documents, p.tokens, p.base, p.width) for p in read_parts(folder)]
    names = "name string, documents long, tokens long, base long, width long"
    listed = literal_table(spark, parts, names)
    # dealt in turn from one partition of short rows: a task for each part, none with several
    return listed.coalesce(1).repartition(max(1, len(parts))).mapInArrow(run, schema)


def checksums(files: DataFrame) -> DataFrame:
    """Contract form: the ids of each document reduced to their CRC-32."""
    return files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
