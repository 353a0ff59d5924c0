"""Token tables, and the stored positional index that every search reads.

The index has one row a (term, document) with the term's frequency, its positions and the document's length, so that a query needs
neither a length table nor a grouping of tokens. A dictionary of terms with their document and term frequencies, sorted by
term, and one row of corpus totals are stored beside it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from rookery.functions import text as tx
from rookery.functions.stemming import stem, stem_batch
from rookery.workspace import fresh_folder, stage

# Which analysed forms each searchable field carries.
FIELD_ANALYZERS = {
    "text": ("english", "shingles", "raw"),
    "full_text": ("english", "shingles", "raw"),
    "in_reply_to_screen_name": ("english", "ngram", "shingles", "raw"),
    "user.name": ("english", "ngram", "shingles", "keyword"),
    "user.screen_name": ("english", "ngram", "keyword"),
    "user.location": ("english", "ngram", "keyword"),
    "user.description": ("english", "shingles", "keyword"),
    "place.name": ("english", "ngram", "shingles", "keyword"),
    "place.full_name": ("english", "ngram", "shingles", "keyword"),
    "place.country": ("english", "ngram", "shingles", "keyword"),
    "entities.user_mentions.name": ("english", "ngram", "shingles", "keyword"),
    "entities.user_mentions.screen_name": ("english", "ngram", "keyword"),
    "entities.hashtags.text": ("normalised",),
}


# ---- words of a slice of texts ------------------------------------------------------------------------------------------
SLICE_TOKENS = 1 << 18
RUN_TOKENS = 1 << 20  # of a slice that the index sorts by term
ROWS_OUT = 1 << 16


def _word_lists(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(doc_id, tokens): the words of every text that is there."""
    return docs.filter(F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("doc_id"), tx.words(tx.strip_html(F.col(text_column))).alias("tokens")
    )


def _slices(batches: Iterator[pa.RecordBatch], tokens: int = SLICE_TOKENS) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Ids and token lists of whole documents, at most ``tokens`` tokens at a time where a document has no more."""
    for batch in batches:
        ids, lists = batch.column("doc_id"), batch.column("tokens")
        ends, start = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + tokens, side="right")))
            yield ids.slice(start, stop - start), lists.slice(start, stop - start)
            start = stop


def _plain(word: str) -> str | None:
    """The possessive cut and lower case of ``plain_term`` for one word; None for a stop word."""
    term = (word[:-2] if word.endswith(tx.POSSESSIVE_TAILS) else word).lower()
    return None if term in tx.STOP_WORDS else term


def _analysed(lists: pa.Array, stemmed: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """(row, position, code, terms) of every token but the stop words; each distinct word of a slice is analysed once."""
    counts = lists.value_lengths().to_numpy(zero_copy_only=False)
    encoded = lists.flatten().dictionary_encode()
    plain = pa.array(list(map(_plain, encoded.dictionary.to_numpy(zero_copy_only=False).tolist())), pa.string())
    terms = (stem_batch(plain) if stemmed else plain).dictionary_encode()
    code = terms.indices.fill_null(-1).to_numpy(zero_copy_only=False)[encoded.indices.to_numpy(zero_copy_only=False)]
    row = np.repeat(np.arange(len(counts)), counts)
    position = (np.arange(len(code)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.int32)
    kept = code >= 0
    return row[kept], position[kept], code[kept], terms.dictionary


def base_tokens(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Words in order with their positions, HTML removed."""
    return docs.select(
        F.col(id_column).alias("doc_id"),
        F.posexplode(tx.words(tx.strip_html(F.col(text_column)))).alias("position", "word"),
    )


def plain_tokens(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Possessive cut, lower case, stop words removed; positions keep their gaps."""
    words = base_tokens(docs, id_column, text_column)
    terms = words.select("doc_id", "position", tx.plain_term(F.col("word")).alias("term"))
    return terms.filter(~F.col("term").isin(*tx.STOP_WORDS))


def stem_dictionary(terms: DataFrame) -> DataFrame:
    """Every distinct term with its stem."""
    return terms.select("term").distinct().withColumn("stem", stem(F.col("term")))


def english_tokens(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Stemmed tokens, in one pass and without a shuffle.

    Joining a stem dictionary back would read the texts twice and, once the vocabulary outgrows a broadcast, shuffle
    every token by term; analysing slices of whole texts does neither, and sees a word of many texts once a slice.
    """
    rows = _word_lists(docs, id_column, text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, lists in _slices(batches):
            row, position, code, terms = _analysed(lists, stemmed=True)
            for start in range(0, len(code), ROWS_OUT):
                part = slice(start, start + ROWS_OUT)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(row[part])), pa.array(position[part]), terms.take(pa.array(code[part]))],
                    ["doc_id", "position", "term"],
                )

    schema = StructType().add("doc_id", rows.schema["doc_id"].dataType).add("position", IntegerType()).add("term", StringType())
    return rows.mapInArrow(run, schema)


def ngram_tokens(docs: DataFrame, id_column: str, text_column: str, low: int = 3, high: int = 6) -> DataFrame:
    """Character n-grams of folded words; words shorter than the smallest size give none."""
    words = base_tokens(docs, id_column, text_column)
    word = tx.folded(F.col("word"))
    pieces = F.concat(*[tx.grams(word, size) for size in range(low, high + 1)])
    return words.select("doc_id", "position", F.explode(pieces).alias("term"))


def shingle_tokens(docs: DataFrame, id_column: str, text_column: str, longest: int = 3) -> DataFrame:
    """Single words and runs of 2..longest words joined without a separator, from each position."""
    text = tx.strip_html(F.col(text_column))
    words = docs.select(F.col(id_column).alias("doc_id"), tx.folded_words(text).alias("words"))
    runs = F.transform(
        "words",
        lambda _, i: F.array(*[
            F.concat(*[F.get("words", i + k) for k in range(n)]) for n in range(1, longest + 1)  # NULL beyond the end
        ]),
    )
    spread = words.select("doc_id", F.posexplode(runs).alias("position", "run"))
    return spread.select("doc_id", "position", F.explode("run").alias("term")).filter(F.col("term").isNotNull())


def keyword_keys(docs: DataFrame, column: str) -> DataFrame:
    """Lower-cased, folded keyword beside the original."""
    return docs.withColumn("keyword", tx.folded(F.col(column)))


def corpus_statistics(tokens: DataFrame) -> DataFrame:
    """Per term: document and term frequency; with document count and average length on each row.

    Two levels of partial aggregation: a term found in a third of all documents is one row per task after the first. The counts
    per document are stored, so the texts are analysed once for both the terms and the lengths.
    """
    per_doc = stage(tokens.groupBy("doc_id", "term").agg(F.count("*").alias("f")), "term-counts")
    terms = per_doc.groupBy("term").agg(F.count("*").alias("doc_freq"), F.sum("f").alias("term_freq"))
    lengths = per_doc.groupBy("doc_id").agg(F.sum("f").alias("length"))
    totals = lengths.agg(F.count("*").alias("documents"), F.avg("length").alias("avg_length"))
    return terms.crossJoin(totals)  # totals is an ungrouped aggregate: exactly one row


def document_lengths(tokens: DataFrame) -> DataFrame:
    return tokens.groupBy("doc_id").agg(F.count("*").alias("length"))


# ---- stored index ---------------------------------------------------------------------------------------------------
class TextIndex(NamedTuple):
    postings: DataFrame  # term, doc_id, frequency, positions, length, bucket
    terms: DataFrame  # term, doc_freq, term_freq, bucket; sorted by term
    totals: DataFrame  # documents, avg_length: one row
    buckets: int


WORDWISE = ("english", "plain")  # analysers of one term a word, which leave out stop words


def bucket_of(term: str, buckets: int) -> int:
    return zlib.crc32(term.encode()) % buckets


def _bucket(buckets: int) -> Column:
    return (F.crc32(F.encode("term", "utf-8")) % buckets).cast("int")


def _placed(words: Column, term) -> Column:
    """Structs of position and term, for a function from a word to its term."""
    return F.transform(words, lambda w, i: F.struct(i.cast("int").alias("position"), term(w).alias("term")))


def _many(words: Column, terms) -> Column:
    """As ``_placed`` where a word, or the words from a position on, give several terms."""
    return F.flatten(F.transform(words, lambda w, i: F.transform(
        terms(w, i), lambda one: F.struct(i.cast("int").alias("position"), one.alias("term"))
    )))


def _token_array(text: Column, analyser: str) -> Column:
    words = tx.words(tx.strip_html(text))
    if analyser == "raw":
        return _placed(words, lambda w: w)
    if analyser == "ngram":
        return _many(words, lambda w, i: F.concat(*[tx.grams(tx.folded(w), n) for n in (3, 4, 5, 6)]))
    if analyser == "shingles":
        folded = F.transform(words, tx.folded)
        return _many(folded, lambda w, i: F.transform(
            F.sequence(F.lit(1), F.least(F.lit(3), F.size(folded) - i)), lambda n: F.array_join(F.slice(folded, i + 1, n), "")
        ))
    if analyser in ("keyword", "normalised"):
        return F.array(F.struct(F.lit(0).alias("position"), tx.folded(text).alias("term")))
    raise ValueError(f"no analyser {analyser}")


def _inverted(ids: pa.Array, lists: pa.Array, analyser: str) -> pa.RecordBatch:
    """One row a (term, document) of a slice of documents, in that order, by one sort of all their tokens."""
    if analyser in WORDWISE:
        row, positions, code, terms = _analysed(lists, analyser == "english")
    else:
        tokens, lengths = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
        encoded, positions = tokens.field("term").dictionary_encode(), tokens.field("position").to_numpy(zero_copy_only=False)
        row, code, terms = np.repeat(np.arange(len(ids)), lengths), encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    counts = np.bincount(row, minlength=len(ids))
    # the tokens of a document come by position, and a stable sort keeps that
    rank = np.empty(len(terms), np.int64)
    rank[pc.sort_indices(terms).to_numpy()] = np.arange(len(terms))
    order = np.argsort(rank[code] * np.int64(len(ids)) + row, kind="stable")
    code, row, positions = code[order], row[order], positions[order]
    first = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (row[1:] != row[:-1])]) if len(code) else np.zeros(0, np.int64)
    ends = np.r_[first, len(code)].astype(np.int32)
    leads = np.zeros(len(first), bool)
    leads[np.unique(row[first], return_index=True)[1]] = True
    return pa.RecordBatch.from_arrays(
        [
            terms.take(pa.array(code[first])), ids.take(pa.array(row[first])),
            pa.array(np.diff(ends).astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(positions.astype(np.int32))),
            pa.array(counts[row[first]].astype(np.int32)), pa.array(leads),
        ],
        ["term", "doc_id", "frequency", "positions", "length", "leads"],
    )


def posting_rows(docs: DataFrame, id_column: str, text_column: str, analyser: str = "english") -> DataFrame:
    """(term, doc_id, frequency, positions, length, leads): each text inverted where it is read, without a shuffle.

    Ids are unique; NULL texts and texts without a term give no row. One row of each document ``leads``, so documents can be
    counted by counting it.
    """
    if analyser in WORDWISE:
        rows = _word_lists(docs, id_column, text_column)
    else:
        rows = docs.filter(F.col(text_column).isNotNull()).select(
            F.col(id_column).alias("doc_id"), _token_array(F.col(text_column), analyser).alias("tokens")
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, lists in _slices(batches, RUN_TOKENS):
            yield _inverted(ids, lists, analyser)

    schema = StructType().add("term", StringType()).add("doc_id", rows.schema["doc_id"].dataType).add("frequency", IntegerType())
    schema = schema.add("positions", ArrayType(IntegerType())).add("length", IntegerType()).add("leads", "boolean")
    return rows.mapInArrow(run, schema)


WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
BLOCK_BYTES = 8 << 20  # of a file that is open, one a bucket


@contextmanager
def writers_at_once(spark: SparkSession, number: int):
    """Writes started inside keep a file open for each of their folders, and need no sort, up to a number of folders."""
    before = spark.conf.get(WRITERS)
    spark.conf.set(WRITERS, number + 1)  # Spark sorts what is left once the bound itself is reached
    try:
        yield
    finally:
        spark.conf.set(WRITERS, before)


def store_index(rows: DataFrame, buckets: int = 64) -> TextIndex:
    """Write posting rows by term bucket, so that a query reads only the buckets of its terms, and the dictionary.

    Postings outweigh their texts, so they are neither shuffled nor sorted: each task writes a file a bucket, of runs that are
    sorted by term where they are made, and a term that a third of all documents hold is spread over the files. The dictionary is
    cut into ranges of terms and sorted, so a prefix lies in one file or two.
    """
    spark = rows.sparkSession
    folder = fresh_folder(spark, "index")
    keyed = rows.withColumn("bucket", _bucket(buckets))
    with writers_at_once(spark, buckets):
        keyed.write.partitionBy("bucket").options(compression="zstd", **{"parquet.block.size": BLOCK_BYTES}).parquet(
            f"{folder}/postings"
        )
    stored = spark.read.schema(keyed.schema).parquet(f"{folder}/postings")
    counted = stored.groupBy("term").agg(F.count("*").alias("doc_freq"), F.sum("frequency").alias("term_freq"))
    counted = counted.withColumn("bucket", _bucket(buckets))
    counted.repartitionByRange("term").sortWithinPartitions("term").write.parquet(f"{folder}/terms")
    totals = stored.agg(
        F.count_if("leads").alias("documents"), (F.sum("frequency") / F.count_if("leads")).alias("avg_length")
    )
    totals.write.parquet(f"{folder}/totals")
    return TextIndex(
        stored.drop("leads"), spark.read.schema(counted.schema).parquet(f"{folder}/terms"),
        spark.read.schema(totals.schema).parquet(f"{folder}/totals"), buckets,
    )


def postings(index: TextIndex, terms: list[str]) -> DataFrame:
    """Rows of the given terms only: partition pruning by bucket, then row-group pruning by term."""
    wanted = sorted({bucket_of(term, index.buckets) for term in terms})
    rows = index.postings.filter(F.col("bucket").isin(*wanted) & F.col("term").isin(*terms))
    return rows.select("doc_id", "term", "frequency", "positions", "length")


def _after_prefix(prefix: str) -> str | None:
    """The least string greater than all that begin with the prefix."""
    head = prefix.rstrip(chr(0x10FFFF))
    if not head:
        return None
    code = ord(head[-1]) + 1
    return head[:-1] + chr(0xE000 if code == 0xD800 else code)


def terms_with_prefix(index: TextIndex, prefix: str) -> DataFrame:
    """Dictionary rows of the terms that begin with a prefix; a range of the sorted term, so only its files are opened."""
    rows = index.terms.filter(F.col("term") >= prefix)
    after = _after_prefix(prefix)
    return rows if after is None else rows.filter(F.col("term") < after)


def prefix_postings(index: TextIndex, prefix: str) -> DataFrame:
    """Postings of all terms that begin with a prefix; the buckets of those terms alone are read (dynamic pruning)."""
    found = terms_with_prefix(index, prefix).select("bucket", "term")
    return index.postings.join(found, ["bucket", "term"], "left_semi").select("doc_id", "term", "frequency", "positions", "length")
