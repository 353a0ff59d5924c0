"""Encoding, decoding and token files against the library."""

import hashlib
import zlib

import numpy as np
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

from rookery.llm import bpe, token_files
from rookery.llm.queries import END_ID, WORD_BPE
from rookery.workspace import fresh_folder


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(WORD_BPE)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def ids_of(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def expected(library, rows):
    found = []
    for (doc_id, _), ids in zip(rows, ids_of(library, [t for _, t in rows])):
        text = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        found.append((doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_digests_equal_the_library(which, library, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in bpe.digests(docs, WORD_BPE).collect()), key=str)
    assert got == expected(library, rows)


def test_encode_and_decode_apart(library, odd):
    both = bpe.decode(bpe.encode(odd, WORD_BPE), WORD_BPE)
    texts = {r.doc_id: r.text for r in odd.select("doc_id", "text").collect()}
    for row in both.collect():
        ids = np.frombuffer(row.ids, "<u4").tolist()
        assert ids == ids_of(library, [texts[row.doc_id]])[0]
        assert row.decoded == library.decode(ids, skip_special_tokens=False)


def test_one_long_word_and_segments(library, monkeypatch):
    from rookery.llm import chunks

    encoder = bpe.SegmentTreeEncoder(WORD_BPE)
    texts = ["ab" * 700 + "é" * 50, "z" * 33, "x", "!?" * 40]
    assert [np.frombuffer(b, "<u4").tolist() for b in encoder.encode_many(texts)] == ids_of(library, texts)
    monkeypatch.setattr(chunks, "SEGMENT", 50)
    monkeypatch.setattr(chunks.segments, "__defaults__", (50,))
    text = "many words in a row, cut before a blank only " * 20
    assert np.frombuffer(encoder.encode_many([text, None])[0], "<u4").tolist() == ids_of(library, [text])[0]


def test_empty_tables(documents, spark):
    none = documents.limit(0)
    assert bpe.digests(none, WORD_BPE).count() == 0
    folder = fresh_folder(spark, "token-files")
    assert token_files.write_token_files(none, folder, WORD_BPE, END_ID) == []
    assert token_files.read_token_files(spark, folder).count() == 0


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_files_round_trip(which, library, request, spark):
    docs = request.getfixturevalue(which)
    folder = fresh_folder(spark, "token-files")
    parts = token_files.write_token_files(docs, folder, WORD_BPE, END_ID)
    assert [p.base for p in parts] == [sum(q.tokens for q in parts[:i]) for i in range(len(parts))]
    got = sorted(token_files.checksums(token_files.read_token_files(spark, folder)).collect(), key=lambda r: r.start)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    keys = [r.doc_id for r in got]
    assert keys == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    assert [r.start for r in got] == [sum(r.n_tokens for r in got[:i]) for i in range(len(got))]
    whole = [(k, ids + [END_ID]) for (k, _), ids in zip(rows, ids_of(library, [t for _, t in rows]))]
    want = sorted(((k, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for k, i in whole), key=str)
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == want


def test_ranged_reads_equal_the_map(documents, spark):
    folder = fresh_folder(spark, "token-files")
    part = token_files.write_token_files(documents.coalesce(1), folder, WORD_BPE, END_ID)[0]
    disk, root = fs.FileSystem.from_uri(folder)
    elsewhere = fs.SubTreeFileSystem(root, disk)  # no mounted disk as far as the reader knows
    kinds = (("idx", "<i8"), ("ids", f"<u{part.width}"))
    near = [token_files._Values(disk, f"{root}/{part.name}.{kind}", dtype) for kind, dtype in kinds]
    far = [token_files._Values(elsewhere, f"{part.name}.{kind}", dtype) for kind, dtype in kinds]
    assert near[1].mapped is not None and far[1].mapped is None
    at, seen = 0, 0
    for first in range(0, part.documents, 7):
        last = min(first + 7, part.documents)
        tables = []
        for index, ids in (near, far):
            rows = index.between(3 * first, 3 * last).reshape(-1, 3)
            tables.append(list(token_files._records(rows, ids, at, part.base)))
        assert tables[0] == tables[1]
        at, seen = int(rows[-1, 2]), seen + sum(b.num_rows for b in tables[0])
    assert seen == part.documents and at == part.tokens
