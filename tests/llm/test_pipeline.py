"""The pipeline against its stages' own results, and the registration of every query."""

import hashlib

import numpy as np
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from rookery.llm import secret_scan, simhash, site_quality
from rookery.llm.queries import WORD_BPE


def test_every_operator_is_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and "op1_secret_scan" in __spark_entry__.oracle_sql()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


def test_stages_take_effect(spark, sf, documents, labels):
    docs = documents
    seen = {}
    for name, step in corpus_pipeline.STAGES:
        before, docs = docs, step(spark, docs, sf)
        seen[name] = (before, docs)
        if name != "bpe_encoding":
            assert docs.columns == documents.columns
    before, kept = seen["quality_classifier"]
    good = {r.doc_id for r in site_quality.classify(before, labels).where("kept").collect()}
    assert {r.doc_id for r in kept.collect()} == good
    before, single = seen["simhash_dedup"]
    firsts = {r.component_id for r in simhash.near_duplicates(before, shingle=4, radius=4).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(firsts)
    before, masked = seen["secret_scan"]
    assert masked.count() == before.count() and secret_scan.report(masked).where("spans <> ''").count() == 0
    mixed, encoded = seen["bpe_encoding"]
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for r in mixed.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256) for r in encoded.collect()) == sorted(want)


def test_run(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert rows.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and rows.count() > 0
