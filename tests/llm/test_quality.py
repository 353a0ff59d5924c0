"""Base counts against plain code, held-out accuracy of the classifier, and the hierarchy."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rookery.llm import ngram_model, quality_rules, site_quality

BIG = "/root/testdata/sf0.1"


def plain_signals(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    again = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 5)}
    lines = text.split("\n")
    dups = sum(bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dups, len(again)


def test_signals(documents, odd):
    texts = [r.text for r in documents.select("text").collect() if len(r.text) < 6000]
    texts += [r.text for r in odd.select("text").collect() if len(r.text or "") < 6000]
    for text in texts:
        assert quality_rules.signals(text or "") == plain_signals(text)


def test_report_columns_and_odd_rows(odd, labels, documents):
    got = quality_rules.report(odd, labels)
    assert got.count() == odd.count() and got.where("kept is null or base_failed is null").count() == 0
    assert got.where("n_words = 0 and not base_failed").count() == 0
    assert quality_rules.report(documents.limit(0), labels.limit(0)).count() == 0


def test_batches_do_not_change_scores(documents, labels):
    bounds = ngram_model.FitBounds(rounds=20)
    model = ngram_model.fit(ngram_model.labelled_sample(documents, labels, "quality", bounds), bounds)
    texts = ["", None, "a", "ab", "Ünï cödé", "one two two three", "x\ny", "日本", *[r.text for r in documents.limit(30).collect()]]
    together = model.raw(pa.array(texts, pa.string()))
    assert np.allclose(together, [model.raw(pa.array([t], pa.string()))[0] for t in texts])


def test_long_texts_are_summed_in_pieces(documents, labels):
    bounds = ngram_model.FitBounds(rounds=20)
    model = ngram_model.fit(ngram_model.labelled_sample(documents, labels, "quality", bounds), bounds)
    texts = [r.text for r in documents.where("length(text) > 300").limit(20).collect()]
    texts += ["é日本 🙂 a  b\n\nword word " * 40, " " * 700 + "end", "a" * 100 + "\n" * 300 + "tail tail " * 30, None, "short"]
    whole = model.raw(pa.array(texts, pa.string()))
    for piece in (129, 200, 1000):
        assert np.allclose(model.raw(pa.array(texts, pa.string()), piece), whole, atol=1e-9)
    one_word = "x" * 5000 + " and more"
    for context, part in ngram_model.pieces(one_word.encode(), 100):
        assert len(context) <= 200 and len(part) <= 200
    assert "".join(p.decode() for _, p in ngram_model.pieces(one_word.encode(), 100)) == one_word


def test_sample_is_bounded_though_a_key_comes_often(spark):
    docs = spark.createDataFrame([(i // 500, f"text {i}") for i in range(3000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(6)], "doc_id long, quality int")
    sample = ngram_model.labelled_sample(docs, labels, "quality", ngram_model.FitBounds(per_class=2))
    assert sample.num_rows == 4 and sample.column("n").to_pylist() == [3] * 4
    assert all(t == f"text {k * 500}" or int(t[5:]) // 500 == k for k, t in zip(sample.column("doc_id").to_pylist(), sample.column("text").to_pylist()))


def test_sample_takes_the_smallest_hashes(spark):
    labels = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") % 9 == 0).cast("int").alias("quality"))
    docs = labels.select("doc_id", F.col("doc_id").cast("string").alias("text"))
    sample = ngram_model.labelled_sample(docs, labels, "quality", ngram_model.FitBounds(per_class=30))
    hashed = labels.withColumn("h", F.shiftrightunsigned(F.xxhash64("doc_id"), 11)).orderBy("h").collect()
    want = {r.doc_id for good in (0, 1) for r in [r for r in hashed if r.quality == good][:30]}
    assert set(sample.column("doc_id").to_pylist()) == want


@pytest.fixture(scope="module")
def halves(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    labels = spark.read.parquet(f"{BIG}/labels.parquet")
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(2))
    return docs, labels.where(fold == 0), labels.where(fold == 1)


def test_held_out_accuracy(halves):
    docs, train, held = halves
    for kept in (quality_rules.report(docs, train), site_quality.classify(docs, train)):
        rows = held.join(kept, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("kept")).collect()
        share = {r.quality: r.kept for r in rows}
        assert share[0] <= 0.1 and share[1] >= 0.97


def test_sites_pull_weak_evidence(spark):
    rows = [(i, "good" if i < 500 else "bad", f"p{i % 3}", 0.9 if i < 500 else 0.1) for i in range(1000)]
    rows += [(2000, "good", "p0", 0.5), (2001, "bad", "p0", 0.5), (2002, "rare", "p0", 0.5), (2003, None, None, 0.5)]
    scored = spark.createDataFrame(rows, "doc_id long, host string, path string, p double")
    found = {r.doc_id: r for r in site_quality.posteriors(scored).where("doc_id >= 2000").collect()}
    assert found[2000].posterior > 0.8 > 0.2 > found[2001].posterior
    assert abs(found[2002].posterior - 0.5) < 0.05 and abs(found[2003].posterior - 0.5) < 0.05
    assert site_quality.posteriors(scored.limit(0)).count() == 0


def test_keep_good(odd, labels, documents):
    kept = site_quality.keep_good(odd, labels)
    assert kept.columns == odd.columns and kept.where("doc_id is null").count() == 1
    assert site_quality.keep_good(documents.limit(0), labels).count() == 0
