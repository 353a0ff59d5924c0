import random

from pyspark.sql import functions as F

from rookery.functions import text as tx
from rookery.functions.stemming import porter_stem
from rookery.operators import search
from rookery.operators import tokens as tk


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_published_stems():
    pairs = {"caresses": "caress", "ponies": "poni", "agreed": "agre", "hopping": "hop", "filing": "file", "happy": "happi",
             "relational": "relat", "vietnamization": "vietnam", "hopefulness": "hope", "adoption": "adopt", "controll": "control"}
    assert {w: porter_stem(w) for w in pairs} == pairs


def test_tokens_keep_gaps_and_strip_html(spark):
    frame = docs(spark, "<p>The <b>na</b>tion's rise</p><script>x()</script>of 3.5 &amp; Café")
    rows = tk.english_tokens(frame, "doc_id", "text").orderBy("position").collect()
    assert [(r.term, r.position) for r in rows] == [("nation", 1), ("rise", 2), ("3.5", 4), ("café", 5)]
    assert docs(spark, "x").select(tx.folded(F.lit("Straße ÆØ É"))).first()[0] == "strasse aeo e"


def test_ngrams_and_shingles(spark):
    assert tk.ngram_tokens(docs(spark, "ab"), "doc_id", "text").count() == 0
    grams = {r.term for r in tk.ngram_tokens(docs(spark, "Émile"), "doc_id", "text").collect()}
    assert grams == {"emi", "mil", "ile", "emil", "mile", "emile"}
    terms = sorted(r.term for r in tk.shingle_tokens(docs(spark, "a B c"), "doc_id", "text").collect())
    assert terms == ["a", "ab", "abc", "b", "bc", "c"]


def test_phrases(spark):
    frame = docs(spark, "deaths were reported", "reported deaths", "deaths reported", "deaths", "rise of the nation", "rise nation")
    index = tk.store_index(tk.posting_rows(frame, "doc_id", "text"), 4)
    exact = search.phrase(index, tx.analyse_query("deaths reported")).collect()
    assert {r.doc_id for r in exact} == {2}
    gap = search.phrase(index, tx.analyse_query("rise of the nation")).collect()
    assert {r.doc_id for r in gap} == {4}
    sloppy = {r.doc_id: round(r.frequency, 6) for r in search.phrase(index, tx.analyse_query("deaths reported"), 5).collect()}
    # "were" is no stop word: one step apart; reversed order costs two
    assert sloppy == {0: 0.5, 1: round(1 / 3, 6), 2: 1.0}


def test_sloppy_against_brute_force(spark):
    """Neighbours in merged, offset-adjusted order, recounted in plain Python."""
    random.seed(3)
    texts = [" ".join(random.choice(["xa", "xb", "q"]) for _ in range(30)) for _ in range(40)]
    index = tk.store_index(tk.posting_rows(docs(spark, *texts), "doc_id", "text", "plain"), 4)
    got = {r.doc_id: r.frequency for r in search.sloppy_frequency(index.postings, [("xa", 0), ("xb", 1)], 3).collect()}
    for doc, text in enumerate(texts):
        marks = sorted((p - (w == "xb"), w) for p, w in enumerate(text.split()) if w != "q")
        want = sum(1 / (1 + b[0] - a[0]) for a, b in zip(marks, marks[1:]) if a[1] != b[1] and b[0] - a[0] <= 3)
        assert abs(got.get(doc, 0) - want) < 1e-9


def test_substring_search_equals_scan(spark, small):
    frame = small.documents.select("doc_id", "text")
    stored = search.stage_trigrams(frame, 8)
    for needle in ("WORTH", "in", "ion the", "%_"):
        found = {r.doc_id for r in search.substring_search(stored, frame, needle, 8).collect()}
        want = {r.doc_id for r in frame.filter(F.lower("text").contains(needle.lower())).collect()}
        assert found == want


def test_highlight(spark):
    frame = docs(spark, "Licensed under a license; relicensed.", "nothing here")
    hits = spark.createDataFrame([(0, 1.0), (1, 0.5)], "doc_id bigint, score double")
    rows = {r.doc_id: r.highlight for r in search.highlight(hits, frame, "doc_id", "text", ["licens"]).collect()}
    assert rows == {0: "<em>Licensed</em> under a <em>license</em>; relicensed.", 1: "nothing here"}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_read_the_buckets_of_their_terms_once(spark, small):
    index = tk.store_index(tk.posting_rows(small.documents, "doc_id", "text", "plain"), 16)
    for found in (search.phrase(index, [("worthless", 0), ("disgust", 1)]), search.match(index, ["worthless", "disgust"]),
                  search.phrase(index, [("worthless", 0), ("disgust", 1)], 5)):
        plan = plan_of(found)
        # postings, dictionary and totals; only the postings are pruned by bucket
        assert plan.count("FileScan parquet") == 3 and plan.count("PartitionFilters: [bucket") == 1
        assert plan.count("documents:bigint") == 1 and plan.count("doc_freq:bigint") == 1
        assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_index_rows_equal_grouped_tokens(spark, small):
    """Positions, lengths and statistics against the plain token table."""
    tokens = tk.english_tokens(small.documents, "doc_id", "text")
    index = tk.store_index(tk.posting_rows(small.documents, "doc_id", "text"), 8)
    got = {(r.doc_id, r.term): (r.frequency, r.positions, r.length) for r in index.postings.collect()}
    want, length = {}, {}
    for r in tokens.collect():
        want.setdefault((r.doc_id, r.term), []).append(r.position)
        length[r.doc_id] = length.get(r.doc_id, 0) + 1
    assert got == {k: (len(p), sorted(p), length[k[0]]) for k, p in want.items()}
    stats = {r.term: (r.doc_freq, r.term_freq) for r in tk.corpus_statistics(tokens).collect()}
    assert {r.term: (r.doc_freq, r.term_freq) for r in index.terms.collect()} == stats
    totals = index.totals.first()
    assert (totals.documents, round(totals.avg_length, 9)) == (len(length), round(sum(length.values()) / len(length), 9))


def test_index_of_odd_texts(spark):
    frame = spark.createDataFrame([("a", None), ("b", ""), ("c", "the of"), ("d", "x " * 9), (None, "lost y")], "key string, text string")
    index = tk.store_index(tk.posting_rows(frame, "key", "text"), 4)
    assert {(r.term, r.doc_id, r.frequency) for r in index.postings.collect()} == {("x", "d", 9), ("lost", None, 1), ("y", None, 1)}
    empty = tk.store_index(tk.posting_rows(frame.limit(0), "key", "text"), 4)
    assert search.match(empty, ["x"]).count() == 0 and search.phrase(empty, [("x", 0)]).count() == 0


def test_postings_are_written_where_they_are_made(spark):
    before = spark.conf.get(tk.WRITERS)
    frame = docs(spark, *[f"the zebra ate {i} apples" for i in range(6)]).repartitionByRange(3, "doc_id")
    index = tk.store_index(tk.posting_rows(frame, "doc_id", "text", "plain"), 4)
    folder = f"/bucket={tk.bucket_of('zebra', 4)}/"
    assert len([f for f in index.postings.inputFiles() if folder in f]) == 3  # one a task: no shuffle gathered them
    assert [r.doc_freq for r in index.terms.filter("term = 'zebra'").collect()] == [6]
    assert spark.conf.get(tk.WRITERS) == before
    rows = tk.posting_rows(frame.coalesce(1), "doc_id", "text", "plain").collect()
    assert [(r.term, r.doc_id) for r in rows] == sorted((r.term, r.doc_id) for r in rows) and sum(r.leads for r in rows) == 6


def test_repeated_terms_in_a_phrase(spark):
    index = tk.store_index(tk.posting_rows(docs(spark, "die die die", "die der die", "die"), "doc_id", "text", "plain"), 4)
    found = search.phrase(index, [("die", 0), ("die", 1)]).collect()
    assert {(r.doc_id, r.frequency) for r in found} == {(0, 2.0)}


def test_prefix_reads_a_range_of_the_dictionary(spark, small):
    index = tk.store_index(tk.posting_rows(small.documents, "doc_id", "text", "plain"), 16)
    rows = index.terms.collect()
    for prefix in ("wor", "a", "zzzz", "\U0010ffff"):
        want = {r.term for r in rows if r.term.startswith(prefix)}
        assert {r.term for r in tk.terms_with_prefix(index, prefix).collect()} == want
        held = {r.term for r in tk.prefix_postings(index, prefix).select("term").distinct().collect()}
        assert held == want
    plan = plan_of(tk.terms_with_prefix(index, "wor"))
    assert "GreaterThanOrEqual(term,wor)" in plan and "LessThan(term,wos)" in plan
    # sorted ranges: the terms of a prefix lie in one file or two
    files = index.terms.filter("term >= 'wor' and term < 'wos'").select(F.input_file_name()).distinct().count()
    assert files <= 2


def test_every_field_form_is_built(spark, small):
    from rookery.plans.texts import field_values

    for field, forms in tk.FIELD_ANALYZERS.items():
        if field.startswith("user.") or field == "place.name":
            for form in forms:
                assert tk.posting_rows(field_values(small, field), "id", "value", form).count() > 0
    tokens = tk.ngram_tokens(small.users, "id", "screen_name").groupBy("doc_id", "term").count()
    assert tk.posting_rows(small.users, "id", "screen_name", "ngram").count() == tokens.count()
    shingles = tk.shingle_tokens(small.places, "id", "full_name").groupBy("doc_id", "term").count()
    assert tk.posting_rows(small.places, "id", "full_name", "shingles").count() == shingles.count()


def test_slices_of_texts_give_the_terms_of_single_words(spark):
    texts = ["The dog's DOGS' Running & <b>runs</b> it's", "", None, "a an the", "ΑΣ:Β ΟΔΟΣ a‘b ÉTÉ Straße x’y", "q&amp;r <i>z"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = tk.base_tokens(frame, "doc_id", "text")
    plain = base.select("doc_id", "position", tx.plain_term(F.col("word")).alias("term")).filter(~F.col("term").isin(*tx.STOP_WORDS))
    want = sorted((r.doc_id, r.position, porter_stem(r.term)) for r in plain.collect())
    assert sorted(map(tuple, tk.english_tokens(frame, "doc_id", "text").collect())) == want
    rows = tk.posting_rows(frame, "doc_id", "text").collect()
    assert sorted((r.doc_id, p, r.term) for r in rows for p in r.positions) == want
    singles = sorted((r.doc_id, r.position, r.w) for r in base.select("doc_id", "position", tx.folded(F.col("word")).alias("w")).collect())
    assert sorted(map(tuple, tk.shingle_tokens(frame, "doc_id", "text", longest=1).collect())) == singles


def test_texts_without_markup_are_not_searched_for_it(spark):
    rows = spark.createDataFrame([("a < b &lt; <p>c</p>",), ("x &amp;lt; y",), ("plain",), (None,)], "text string")
    assert [r[0] for r in rows.select(tx.strip_html(F.col("text"))).collect()] == ["a < b < \nc\n", "x &lt; y", "plain", None]


def test_shingles_of_repeated_documents_are_not_shuffled(spark, tmp_path):
    from rookery.plans.registry import JOBS
    from rookery.views import Tables

    rows = [(1, "b a b a"), (1, "a b c"), (2, None), (None, "z z"), (3, "one")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = JOBS["t_05"].build(Tables(spark, str(tmp_path)))
    got = {r.doc_id: (r.shingles, r.distinct_shingles, r.first_term, r.last_term, r.characters) for r in out.collect()}
    assert got == {1: (15, 9, "a", "c", 26), None: (3, 2, "z", "zz", 4), 3: (1, 1, "one", "one", 3)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "term" not in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)
