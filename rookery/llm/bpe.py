"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of a word's tree hold ``rank << k | position`` of its adjacent pairs; the root is the leftmost pair of the
lowest rank. A merge changes three leaves and their paths to the root, and a word is done when its root holds no pair.
All new words of a batch are merged together: row i of every array is word i, so one numpy step does one merge in each.

Nulls encode as empty texts, empty texts as no ids; repeated rows give repeated results; long texts are encoded in parts
cut at blanks. A word longer than a group's width only widens its own group.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from rookery.llm.batches import ENCODED_BYTES, packed, slices
from rookery.llm.chunks import ChunkEncoder, byte_letters

NONE = np.iinfo(np.int64).max
CELLS = 1 << 18
DECODED_ROWS = 500


class Merges:
    """Pair ranks as sorted keys, and the merging of many words at once."""

    def __init__(self, pairs: list[tuple[int, int]], merged: list[int]):
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), np.array(merged, np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE for a pair that does not merge."""
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def apply(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Final ids of words laid end to end; words are grouped by width, so that padding at most doubles the work."""
        done = np.empty(len(lengths), object)
        starts = np.cumsum(lengths) - lengths
        bits = np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64)
        for k in np.unique(bits).tolist():
            rows = np.flatnonzero(bits == k)
            step = max(1, CELLS >> k)
            for at in range(0, len(rows), step):
                part = rows[at : at + step]
                merged, counts = self._merge(ids, starts[part], lengths[part], k)
                raw, ends = merged.astype("<u4").tobytes(), (4 * np.cumsum(counts)).tolist()
                done[part] = [raw[a:b] for a, b in zip([0, *ends], ends)]
        return done.tolist()

    def _merge(self, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray, bits: int):
        n, width = len(starts), 1 << bits
        columns = np.arange(width)
        alive = columns < lengths[:, None]
        ids = np.zeros((n, width + 1), np.int64)
        ids[:, :width] = words[np.minimum(starts[:, None] + columns, len(words) - 1)]
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        tree = np.full((n, 2 * width), NONE, np.int64)
        r, c = np.nonzero(columns < lengths[:, None] - 1)
        ranks = self.rank(ids[r, c], ids[r, c + 1])
        tree[r, c + width] = np.where(ranks == NONE, NONE, ranks << bits | c)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        row = np.flatnonzero(tree[:, 1] != NONE)
        while len(row):
            root = tree[row, 1]
            at = root & (width - 1)
            new = self.merged[root >> bits]
            gone = after[row, at]
            beyond = np.minimum(after[row, gone], width)
            ids[row, at] = new
            alive[row, gone] = False
            after[row, at] = beyond
            before[row, beyond] = at
            prior = before[row, at]
            self._set(tree, row, gone, None, bits)
            right = np.where(beyond >= lengths[row], NONE, self.rank(new, ids[row, beyond]))
            self._set(tree, row, at, right, bits)
            has = np.flatnonzero(prior >= 0)
            owner, prior = row[has], prior[has]
            self._set(tree, owner, prior, self.rank(ids[owner, prior], new[has]), bits)
            row = row[tree[row, 1] != NONE]
        return ids[:, :width][alive], alive.sum(axis=1)

    @staticmethod
    def _set(tree: np.ndarray, row: np.ndarray, at: np.ndarray, rank: np.ndarray | None, bits: int) -> None:
        """Point update: write the leaf, then the minimum of each pair of children up to the root."""
        node = at + (1 << bits)
        tree[row, node] = NONE if rank is None else np.where(rank == NONE, NONE, rank << bits | at)
        for _ in range(bits):
            node >>= 1
            tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])


class SegmentTreeEncoder(ChunkEncoder):
    """Words merged by segment tree."""

    def __init__(self, path: str):
        super().__init__(path)
        model = self.spec["model"]
        vocab: dict[str, int] = model["vocab"]
        end = model.get("end_of_word_suffix") or ""
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges([(vocab[a], vocab[b]) for a, b in pairs], [vocab[a + b] for a, b in pairs])
        self.inner = np.array([vocab[c] for c in byte_letters()], np.int64)
        self.final = np.array([vocab[c + end] for c in byte_letters()], np.int64)

    def encode_words(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        flat = np.frombuffer(b"".join(raw), np.uint8)
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        ids = self.inner[flat]
        last = np.cumsum(lengths) - 1
        ids[last] = self.final[flat[last]]
        merged = self.merges.apply(ids, lengths) if words else []
        if self.special.keys() & set(words):
            merged = [m if w not in self.special else np.array([self.special[w]], "<u4").tobytes() for w, m in zip(words, merged)]
        return merged


class TokenTable:
    """Ids back to text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec.get("decoder"):
            raise ValueError(f"{path}: files with a decoder of their own are not supported")
        known = {**spec["model"]["vocab"], **{t["content"]: t["id"] for t in spec.get("added_tokens", [])}}
        self.tokens: list[str | None] = [None] * (max(known.values()) + 1)
        for token, i in known.items():
            self.tokens[i] = token

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by blanks, as the library does for a file without a decoder; unknown ids are left out."""
        try:
            return " ".join(map(self.tokens.__getitem__, ids.tolist()))
        except (IndexError, TypeError):
            known = (self.tokens[i] if i < len(self.tokens) else None for i in ids.tolist())
            return " ".join(t for t in known if t is not None)


@lru_cache(maxsize=2)
def token_table(path: str) -> TokenTable:
    """One table a worker."""
    return TokenTable(path)


@lru_cache(maxsize=2)
def segment_tree_encoder(path: str) -> SegmentTreeEncoder:
    """One encoder a worker, shared by its tasks."""
    return SegmentTreeEncoder(path)


def encode(docs: DataFrame, tokenizer: str, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): ids as little-endian unsigned 32-bit integers. One row out for each row in, no shuffle."""

    def run(batches):
        encoder = segment_tree_encoder(tokenizer)
        for part in slices(batches, text, ENCODED_BYTES):
            ids, starts = encoder.encode_column(part.column(text))
            yield pa.RecordBatch.from_arrays([part.column(key), packed(ids, starts)], ["key", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"key {kind}, ids binary").withColumnRenamed("key", key)


def decode(encoded: DataFrame, tokenizer: str, *, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """The frame with the decoded text beside the id bytes (null ids decode to the empty text)."""

    def run(batches):
        table = token_table(tokenizer)
        for part in slices(batches, ids):
            raw = part.column(ids).fill_null(b"").to_pylist()
            decoded = pa.array([table.decode(np.frombuffer(r, "<u4")) for r in raw], pa.string())
            yield pa.RecordBatch.from_arrays([*part.columns, decoded], [*part.schema.names, out])

    schema = StructType([*encoded.schema.fields, StructField(out, StringType())])
    return encoded.mapInArrow(run, schema)


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, ids, decoded): ``encode`` and ``decode`` in one pass over the texts, so each task has one worker."""

    def run(batches):
        encoder, table = segment_tree_encoder(tokenizer), token_table(tokenizer)
        for part in slices(batches, "text", ENCODED_BYTES):
            ids, starts = encoder.encode_column(part.column("text"))
            for at in range(0, part.num_rows, DECODED_ROWS):
                cut = starts[at : at + DECODED_ROWS + 1]
                decoded = pa.array([table.decode(ids[a:b]) for a, b in zip(cut, cut[1:])], pa.string())
                raw = packed(ids[cut[0] : cut[-1]], cut - cut[0])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").slice(at, DECODED_ROWS), raw, decoded], ["doc_id", "ids", "decoded"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Contract form: encode every text, decode the ids again, and give counts and SHA-256 of both."""
    return round_trip(docs, tokenizer).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
