"""Mixing: targets, draws, permutations, and the words the mix takes."""

import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from rookery.llm import mixing as m

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_share_the_excess():
    got = m.targets([100, 1000, 10, 0], [5, 2, 1, 5], Fraction(3, 2), 2)
    assert got[0] == 200 and got[2] == 20 and got[3] == 0 and sum(got) == Fraction(3 * 1110, 2)
    assert m.targets([], [], Fraction(3, 2), 2) == [] and m.targets([0], [5], Fraction(3, 2), 2) == [0]


def test_permutations():
    for n in (1, 2, 3, 64, 65, 1000):
        assert sorted(m.permuted(np.arange(n), n, (1, 2)).tolist()) == list(range(n))


def filled(slots, per_shard, seed):
    """All slots of all shards in plain order: drawn, then repaired."""
    shards = -(-int(slots.sum()) // per_shard)
    counts = [m.shard_counts(slots, per_shard, shard, seed) for shard in range(shards)]
    repair, before, got = m.Repair(slots, sum(counts), seed), np.zeros_like(slots), []
    for own in counts:
        for i in np.flatnonzero(own):
            got += zip(*(x.tolist() for x in repair.settle(int(i), np.arange(before[i], before[i] + own[i]))))
        before += own
    return counts, got


@pytest.mark.parametrize("seed", range(5))
def test_repaired_draws_fill_every_quota_once(seed):
    for slots, per_shard in (([5, 0, 100, 33], 10), ([1], 4), ([1, 1, 1], 4), ([4000, 3, 900], 64)):
        slots = np.array(slots)
        counts, got = filled(slots, per_shard, seed)
        assert all(c.sum() == per_shard for c in counts[:-1]) and sum(c.sum() for c in counts) == slots.sum()
        assert sorted(got) == [(i, rank) for i, n in enumerate(slots) for rank in range(n)]


def test_shard_counts_are_multinomial():
    slots = np.array([6000, 3000, 1000]) * 100
    counts = np.array([m.shard_counts(slots, 100, shard, 3) for shard in range(6000)])
    shares = slots / slots.sum()
    assert np.abs(counts.mean(0) - 100 * shares).max() < 0.4
    spread = 100 * (np.diag(shares) - np.outer(shares, shares))
    assert np.abs(np.cov(counts.T) - spread).max() < 2
    assert m.shard_counts(np.array([10**13, 3 * 10**13]), 4096, 10**9, 1).sum() == 4096


def test_draws_are_those_of_plain_order(spark, monkeypatch):
    monkeypatch.setattr(m, "DRAW_SHARDS", 3)
    monkeypatch.setattr(m, "SPAN_CHUNKS", 2)
    sources = [m.Source(i, str(i), 0, Fraction(0), blocks, slots) for i, (blocks, slots) in enumerate([(7, 5), (1, 0), (60, 100), (11, 22)])]
    rows = [tuple(r) for r in m.draws(spark, sources, 5, 9).collect()]
    assert sorted(r[:2] for r in rows) == sorted((i // 5, i % 5) for i in range(127))
    _, got = filled(np.array([s.slots for s in sources]), 5, 9)
    numbers, ranks = (np.array(x) for x in zip(*got))
    want = m.chosen_blocks(numbers, ranks, [s.blocks for s in sources], 9)
    assert Counter(r[2:] for r in rows) == Counter(zip(numbers.tolist(), want.tolist()))
    # each turn takes every block once
    taken = Counter(r[3] for r in rows if r[2] == 3)
    assert set(taken.values()) == {2} and len(taken) == 11
    assert m.draws(spark, [], 5, 9).count() == 0


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_report_and_texts_agree(which, request):
    docs = request.getfixturevalue(which)
    mix = m.Mix(block=16)
    rows = m.report(docs, mix).collect()
    assert rows and sorted(map(tuple, rows), key=str) == sorted(map(tuple, m.report(docs, mix).collect()), key=str)
    plain = [(r.doc_id, r.source, len(WORD.findall(r.text or ""))) for r in docs.collect()]
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((d, n) for d, _, n in plain)
    sizes = Counter()
    for _, source, n in plain:
        sizes[source] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    goals = m.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], Fraction(3, 2), 2)
    wanted = Counter((sizes[s], float(g)) for s, g in zip(order, goals))
    assert set(wanted) == {(r.source_size, r.target) for r in rows}
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    if len(set(wanted)) == len(order):
        for s, g in zip(order, goals):
            taken = sum(r.taken for r in rows if (r.source_size, r.target) == (sizes[s], float(g)))
            assert abs(taken - g) <= 16
    words = Counter()
    for r in m.mixed(docs, mix).collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    taken = Counter()
    for r in rows:
        taken[r.doc_id] += r.taken
    assert +words == +taken


def test_mixed_keeps_columns(odd, documents):
    assert m.mixed(odd).columns == odd.columns
    assert m.mixed(documents.limit(0)).count() == 0 and m.report(documents.limit(0)).count() == 0


def test_mixed_with_clashing_columns(spark, documents):
    names = ["row", "all_words", "parts", "copy", "Number", "kept", "size", "block_no", "a.b"]
    docs = documents.limit(40)
    for name in names:
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    got = m.mixed(docs)
    assert got.columns == docs.columns and got.count() > 0
    for r in got.collect():
        assert [r[name] for name in names] == [f"own {name}" for name in names]
