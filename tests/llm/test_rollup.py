"""Token rollups against counts of the final corpus, and commits that are applied once."""

import re

import pytest
from tokenizers import Tokenizer

from rookery.llm import token_rollup
from rookery.llm.queries import WORD_BPE
from rookery.workspace import fresh_folder


def expected(rows):
    library, first, totals = Tokenizer.from_file(WORD_BPE), {}, {}
    for r in rows:
        if r.doc_id is not None:
            first[r.text or ""] = min(first.get(r.text or "", r.doc_id), r.doc_id)
    for r in rows:
        text = r.text or ""
        if r.doc_id is not None and text in first and r.doc_id > first[text]:
            continue
        counts = {"words-1": len(re.findall(r"[^\x20\x09-\x0D]+", text)), "word_bpe_49k": len(library.encode(text, add_special_tokens=False).ids)}
        for version, n in counts.items():
            docs, tokens = totals.get((r.source, r.lang, version), (0, 0))
            totals[r.source, r.lang, version] = (docs + 1, tokens + n)
    return sorted(((*k, *v) for k, v in totals.items()), key=str)


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_history(which, request, spark):
    docs = request.getfixturevalue(which)
    rollup = token_rollup.history(docs, fresh_folder(spark, "rollup"), WORD_BPE)
    assert rollup.committed() == {"load", "count", "copies"}
    got = rollup.totals().select("source", "lang", "version", "docs", "tokens").collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(docs.collect())


def test_commits_once_and_cancels(spark):
    counts = spark.createDataFrame([("s", "en", "v", 5), (None, None, "v", None)], "source string, lang string, version string, tokens long")
    rollup = token_rollup.Rollup(spark, fresh_folder(spark, "rollup"))
    assert rollup.totals().count() == 0
    assert rollup.apply("a", token_rollup.signed(counts, 1)) and not rollup.apply("a", token_rollup.signed(counts, 1))
    rollup.fold()
    assert not rollup.apply("a", token_rollup.signed(counts, 1)) and rollup.totals().agg({"tokens": "sum"}).first()[0] == 5
    assert rollup.apply("none", token_rollup.signed(counts.limit(0), 1))
    assert rollup.apply("b", token_rollup.signed(counts, -1)) and rollup.totals().count() == 0


def test_a_half_written_batch_does_not_count(spark):
    counts = spark.createDataFrame([("s", "en", "v", 5)], "source string, lang string, version string, tokens long")
    rollup = token_rollup.Rollup(spark, fresh_folder(spark, "rollup"))
    rollup.apply("a", token_rollup.signed(counts, 1))
    rollup.disk.delete_file(f"{rollup.root}/batches/a/_SUCCESS")
    assert rollup.committed() == set() and rollup.totals().count() == 0
    assert rollup.apply("a", token_rollup.signed(counts, 1)) and rollup.totals().first().tokens == 5
