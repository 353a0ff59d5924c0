"""Encoding by white-space chunks: the text between two blanks is encoded once per worker and looked up afterwards.

Merges never cross white space in the vocabularies used here, so the ids of a text are the ids of its chunks in a row.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from tokenizers import Tokenizer

KEPT_CHUNKS = 500_000
LONG_CHUNK = 48
SEGMENT = 6 << 20
# Characters whose normal form, lower case and class follow from their code point alone; other chunks take the library's
# normaliser and splitter.
PLAIN_CHUNK = re.compile(r"[!-~À-ÿ]*\Z")
# fixed values: the splitting pattern of the word vocabulary, for plain lower-case text
WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-z0-9ß-öø-ÿ]+")


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """A long text in parts of about ``size`` characters, cut before a blank only, so that memory stays bounded."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def is_plain(texts: pa.Array) -> np.ndarray:
    """Which texts hold plain characters only: printable ASCII, tab, line ends and U+00C0 to U+00FF (lead byte C3)."""
    allowed = np.zeros(256, bool)
    allowed[[9, 10, 13, 0xC3, *range(0x20, 0x7F), *range(0x80, 0xC0)]] = True
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    odd = np.flatnonzero(~allowed[np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]]) if data else np.empty(0, int)
    counts = np.diff(np.searchsorted(odd + offsets[0], offsets))
    return counts == 0


def byte_letters() -> list[str]:
    """The visible character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(shown)))
    return [letters[b] for b in range(256)]


class ChunkEncoder:
    """Texts to little-endian id bytes. Chunks are cut into words, and ``encode_words`` of a subclass encodes new words.

    The memos hold short chunks and words only and are emptied when full, which changes speed and nothing else.
    """

    dtype = np.dtype("<u4")

    def __init__(self, path: str, kept: int = KEPT_CHUNKS):
        spec = white_space_free(path)
        self.spec, self.kept = spec, kept
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.chunks: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {}

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words as they stand after normalising and splitting; special tokens come as they are written."""
        raise NotImplementedError

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk, special tokens kept apart as they are written."""
        if PLAIN_CHUNK.match(chunk) and "<|" not in chunk:
            return WORDS.findall(chunk.lower())
        found: list[str] = []
        for i, part in enumerate(self.cut.split(chunk) if self.cut else [chunk]):
            if i % 2:
                found.append(part)
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                found += [normal[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        return found

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids start; the last entry is the total). Null is empty."""
        texts = texts.cast(pa.string()).fill_null("")
        sizes = pa.compute.binary_length(texts).to_numpy(zero_copy_only=False)
        if not len(sizes) or sizes.max() <= SEGMENT:
            return self._encode(texts)
        found, starts = [], [0]
        for text in texts:
            parts = [self._encode(pa.array([part], pa.string()))[0] for part in segments(text.as_py())]
            starts.append(starts[-1] + sum(map(len, parts)))
            found += parts
        return np.concatenate(found), np.array(starts, np.int64)

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Id bytes of each text of a list."""
        ids, starts = self.encode_column(pa.array(texts, pa.string()))
        raw, ends = ids.tobytes(), (starts * ids.itemsize).tolist()
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.empty(0, self.dtype), np.zeros(1, np.int64)
        if len(self.chunks) > self.kept:
            self.chunks = {"": b""}
        plain = is_plain(texts)
        lowered = pa.compute.utf8_lower(texts)
        if not plain.all():
            lowered = pa.compute.if_else(pa.array(plain), lowered, texts)
        rows = pa.compute.ascii_split_whitespace(lowered)
        chunks = rows.flatten().dictionary_encode()
        codes, distinct = chunks.indices.to_numpy(), chunks.dictionary.to_pylist()
        ids = list(map(self.chunks.get, distinct))
        new = [i for i, found in enumerate(ids) if found is None]
        words = [distinct[i] for i in new]
        for i, word, found in zip(new, words, self._encode_chunks(words)):
            ids[i] = found
            if len(word) <= LONG_CHUNK:
                self.chunks[word] = found
        # lay the ids of the distinct chunks end to end, then gather the stretch of each chunk in text order
        flat = np.frombuffer(b"".join(ids), self.dtype)
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // self.dtype.itemsize
        starts = (np.cumsum(lengths) - lengths)[codes]
        lengths = lengths[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        gathered = flat[np.repeat(starts - ends[:-1], lengths) + np.arange(ends[-1])]
        bounds = rows.offsets.to_numpy()
        return gathered, ends[bounds - bounds[0]]

    def _encode_chunks(self, chunks: list[str]) -> list[bytes]:
        if len(self.words) > self.kept:
            self.words = {}
        split, known = list(map(self.pieces, chunks)), self.words
        new = list(set().union(*split).difference(known))
        fresh = dict(zip(new, self.encode_words(new)))
        known.update((w, ids) for w, ids in fresh.items() if len(w) <= LONG_CHUNK)
        found = known | fresh if any(len(w) > LONG_CHUNK for w in fresh) else known
        return [b"".join(map(found.__getitem__, row)) for row in split]


class LibraryEncoder(ChunkEncoder):
    """Words encoded by the model of the tokenizers library."""

    def __init__(self, path: str):
        super().__init__(path)
        self.dtype = id_dtype(self.tokenizer.get_vocab_size(with_added_tokens=True))
        self.letters = byte_letters()

    def encode_words(self, words: list[str]) -> list[bytes]:
        tokenize, letters, special, dtype = self.tokenizer.model.tokenize, self.letters, self.special, self.dtype
        found = []
        for word in words:
            if word in special:
                ids = [special[word]]
            else:
                shown = word if word.isascii() and word.isprintable() else "".join([letters[b] for b in word.encode()])
                ids = [t.id for t in tokenize(shown)]
            found.append(np.array(ids, dtype).tobytes())
        return found


def id_dtype(size: int) -> np.dtype:
    """Two bytes an id where the vocabulary allows it, else four."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


@lru_cache(maxsize=2)
def library_encoder(path: str) -> LibraryEncoder:
    """One encoder a worker, shared by its tasks."""
    return LibraryEncoder(path)


def white_space_free(path: str) -> dict:
    """The tokenizer file, checked to split words off white space and map bytes to letters as ``pieces`` expects."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    split = steps[0] if steps else {}
    if not (split.get("type") == "Split" and split.get("behavior") == "Removed" and split.get("invert")):
        raise ValueError(f"{path}: chunks need a tokenizer that removes white space before merging")
    if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in spec.get("added_tokens", [])):
        raise ValueError(f"{path}: added tokens that look beyond their own characters are not supported")
    return spec
