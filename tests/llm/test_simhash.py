"""Fingerprints and components against brute force."""

import re

import numpy as np
import pytest
import xxhash

from rookery.llm import simhash as s
from rookery.llm.components import components


def plain_fingerprint(text, width=4):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(x.encode(), seed=42).intdigest() for x in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if (a ^ b).bit_count() <= radius:
                parent[find(i)] = find(j)
    best = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            best[find(i)] = min(best.get(find(i), doc_id), doc_id)
    return [best.get(find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_whole_tables(which, request):
    docs = request.getfixturevalue(which)
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.select("doc_id", "text").collect()]
    want = [(d, f"{fp:016x}", c) for (d, fp), c in zip(rows, plain_components(rows))]
    got = [tuple(r) for r in s.labelled(docs, shingle=4, radius=4).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_small_tiles_lose_no_link(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 62, 40, np.uint64)
    prints = sorted({int(x) ^ sum(1 << int(b) for b in set(rng.integers(0, 62, rng.integers(0, 7)))) for x in np.repeat(seeds, 30)})
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = s.near_edges(frame, 4, size=16)
    roots = {r.node: r.root for r in components(edges).collect()}
    rows = [(p, p) for p in prints]
    assert [roots.get(p, p) for p in prints] == plain_components(rows)
    assert edges.count() < 40 * len(prints)


def test_a_dense_tile_gives_a_forest():
    near = np.array([1 << i for i in range(60)], np.int64)  # all within two bits of each other
    assert len(s.linked(near, near, 4)) == len(near) - 1


def test_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (None, 5), (7, 7)], "u long, v long")
    assert {r.node: r.root for r in components(edges).collect()} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


def test_keep_one(odd, documents):
    kept = s.keep_one(odd, shingle=4, radius=4)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert kept.columns == odd.columns and ids == [1, 2, 5, 6, 8, 9] and kept.where("doc_id is null").count() == 1
    assert s.keep_one(documents.limit(0), shingle=4, radius=4).count() == 0


def test_different_texts_under_one_id_are_kept(spark):
    rows = [(1, "a b c d e f g"), (1, "quite another text stands here now"), (1, "a b c d e f g"), (2, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(tuple(r) for r in s.keep_one(docs, shingle=4, radius=4).collect())
    assert kept == [(1, "a b c d e f g"), (1, "quite another text stands here now")]
