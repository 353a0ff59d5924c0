"""Ranked and boolean search over the stored positional index, and substring search over trigram postings.

Scores are BM25 with k1 = 1.2 and b = 0.75, exact lengths and corpus-wide statistics. A query scans the buckets of its terms once;
phrases are found by intersecting the position arrays of one document inside its row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.functions import text as tx
from rookery.operators import tokens as tk
from rookery.operators.tokens import TextIndex, postings
from rookery.workspace import fresh_folder, literal_table, stage

K1, B = 1.2, 0.75
Terms = Sequence[tuple[str, int]]


# ---- scoring --------------------------------------------------------------------------------------------------------
def _idf(documents: Column, frequency: Column) -> Column:
    return F.log(1 + (documents - frequency + 0.5) / (frequency + 0.5))


def _saturate(frequency: Column, length: Column, average: Column) -> Column:
    return frequency * (K1 + 1) / (frequency + K1 * (1 - B + B * length / average))


def term_weights(index: TextIndex, terms: Sequence[str]) -> DataFrame:
    """Inverse document frequency per query term, with the corpus totals (as many rows as the query has terms)."""
    wanted = index.terms.filter(F.col("term").isin(*terms))
    return wanted.crossJoin(index.totals).select(  # totals is one stored row
        "term", _idf(F.col("documents"), F.col("doc_freq")).alias("idf"), "avg_length"
    )


def match(index: TextIndex, terms: Sequence[str]) -> DataFrame:
    """BM25 of documents holding any of the terms."""
    weighted = postings(index, list(terms)).join(F.broadcast(term_weights(index, terms)), "term")  # one row per query term
    part = F.col("idf") * _saturate(F.col("frequency"), F.col("length"), F.col("avg_length"))
    return weighted.groupBy("doc_id").agg(F.sum(part).alias("score"))


def match_all(docs: DataFrame, id_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("doc_id"), F.lit(1.0).alias("score"))


def term_query(index: TextIndex, term: str) -> DataFrame:
    """Documents holding an exact analysed term, with its frequency."""
    return postings(index, [term]).select("doc_id", F.col("frequency").cast("bigint").alias("frequency"))


def any_of(index: TextIndex, clauses: Sequence[Sequence[str]], minimum: int = 1) -> DataFrame:
    """Documents meeting at least ``minimum`` clauses; a clause is met by any of its terms."""
    names = [(term, i) for i, clause in enumerate(clauses) for term in clause]
    lookup = literal_table(index.postings.sparkSession, names, "term string, clause int")
    hits = postings(index, sorted({t for t, _ in names})).select("doc_id", "term")
    met = hits.join(F.broadcast(lookup), "term").groupBy("doc_id").agg(F.countDistinct("clause").alias("clauses"))
    return met.filter(F.col("clauses") >= minimum)


# ---- phrases --------------------------------------------------------------------------------------------------------
def _by_document(rows: DataFrame, terms: Terms) -> DataFrame:
    """(doc_id, length, at): documents with all terms; ``at`` maps each term to its positions, sorted."""
    wanted = sorted({term for term, _ in terms})
    held = rows.filter(F.col("term").isin(*wanted)).groupBy("doc_id").agg(
        F.max("length").alias("length"), F.map_from_entries(F.collect_list(F.struct("term", "positions"))).alias("at")
    )
    return held.filter(F.size("at") == len(wanted))


def _shifted(term: str, offset: int) -> Column:
    return F.transform(F.col("at")[F.lit(term)], lambda p: p - offset)


def _mark(ordinal: int):
    return lambda p: F.struct(p.alias("at"), F.lit(ordinal).alias("ordinal"))


def phrase_frequency(rows: DataFrame, terms: Terms) -> DataFrame:
    """(doc_id, length, frequency): exact occurrences, by intersecting the positions shifted by their place in the phrase."""
    starts = None
    for term, offset in terms:
        here = _shifted(term, offset)
        starts = here if starts is None else F.array_intersect(starts, here)
    found = _by_document(rows, terms).select("doc_id", "length", F.size(starts).cast("double").alias("frequency"))
    return found.filter(F.col("frequency") > 0)


def sloppy_frequency(rows: DataFrame, terms: Terms, slop: int) -> DataFrame:
    """(doc_id, length, frequency): each match of total displacement d adds 1/(1+d), in either order.

    Positions are shifted by their offset in the phrase, so an exact match has all of them equal. A match starts at a
    term whose next query term is another one (ties in phrase order); its displacement is the distance to the farthest
    of the nearest later other terms. Terms must differ. One walk backwards over a document's merged positions remembers
    the nearest later position of every term.
    """
    if len({term for term, _ in terms}) != len(terms):
        raise ValueError("sloppy phrases need distinct terms")
    marks = F.array_sort(F.concat(*[
        F.transform(_shifted(term, offset), _mark(i))
        for i, (term, offset) in enumerate(terms)
    ]))
    nothing = F.struct(
        F.array_repeat(F.lit(None).cast("int"), len(terms)).alias("nearest"), F.lit(-1).alias("following"),
        F.lit(0.0).alias("total"),
    )

    def step(seen: Column, mark: Column) -> Column:
        others = F.filter(seen["nearest"], lambda p, j: (j != mark["ordinal"]) & p.isNotNull())
        distance = F.array_max(others) - mark["at"]
        matched = (F.size(others) == len(terms) - 1) & (seen["following"] != mark["ordinal"]) & (distance <= slop)
        return F.struct(
            F.transform(seen["nearest"], lambda p, j: F.when(j == mark["ordinal"], mark["at"]).otherwise(p)).alias("nearest"),
            mark["ordinal"].alias("following"),
            (seen["total"] + F.when(matched, 1 / (1 + distance)).otherwise(0.0)).alias("total"),
        )

    walked = F.aggregate(F.reverse(marks), nothing, step, lambda seen: seen["total"])
    found = _by_document(rows, terms).select("doc_id", "length", walked.alias("frequency"))
    return found.filter(F.col("frequency") > 0)


def phrase(index: TextIndex, terms: Terms, slop: int = 0) -> DataFrame:
    """Documents with the phrase, its frequency and its BM25 score (weights of its terms summed, a repeated term again)."""
    rows = postings(index, sorted({t for t, _ in terms}))
    frequency = sloppy_frequency(rows, terms, slop) if slop else phrase_frequency(rows, terms)
    times = F.create_map(*[F.lit(x) for term in {t for t, _ in terms} for x in (term, sum(t == term for t, _ in terms))])
    weight = term_weights(index, sorted({t for t, _ in terms})).agg(
        F.sum(F.col("idf") * times[F.col("term")]).alias("_weight"), F.max("avg_length").alias("_avg")
    )
    scored = frequency.crossJoin(weight)  # one row
    return scored.select(
        "doc_id", "frequency",
        (F.col("_weight") * _saturate(F.col("frequency"), F.col("length"), F.col("_avg"))).alias("score"),
    )


def values_with_phrase(df: DataFrame, column: str, phrases: Sequence[str]) -> DataFrame:
    """Distinct values of a column in which any phrase occurs; every value is analysed once."""
    values = df.select(F.col(column)).filter(F.col(column).isNotNull()).distinct()
    queries = [tx.analyse_query(text) for text in phrases]
    wanted = sorted({term for terms in queries for term, _ in terms})
    rows = stage(tk.posting_rows(values, column, column).filter(F.col("term").isin(*wanted)), "phrase-values")
    found = [phrase_frequency(rows, terms).select(F.col("doc_id").alias(column)) for terms in queries]
    out = found[0]
    for frame in found[1:]:
        out = out.unionByName(frame)
    return out.distinct()


# ---- compound queries -----------------------------------------------------------------------------------------------
def boolean_query(
    must: DataFrame, must_not: DataFrame | None = None, allowed: DataFrame | None = None
) -> DataFrame:
    """Scored ``must`` hits without the forbidden documents and inside the unscored filter."""
    out = must
    if must_not is not None:
        out = out.join(must_not.select("doc_id"), "doc_id", "left_anti")
    if allowed is not None:
        out = out.join(allowed.select("doc_id"), "doc_id", "left_semi")
    return out


def best_fields(fields: Sequence[tuple[DataFrame, float]]) -> DataFrame:
    """Score of the best field after boosting."""
    boosted = None
    for scored, boost in fields:
        part = scored.select("doc_id", (F.col("score") * boost).alias("score"))
        boosted = part if boosted is None else boosted.unionByName(part)
    return boosted.groupBy("doc_id").agg(F.max("score").alias("score"))


def gauss_decay(moment: Column, origin: Column, scale_days: float, offset_days: float, decay: float) -> Column:
    away = F.abs(F.unix_timestamp(moment.cast("timestamp")) - F.unix_timestamp(origin.cast("timestamp"))) / 86400.0
    beyond = F.greatest(F.lit(0.0), away - offset_days)
    return F.exp(F.log(F.lit(decay)) * beyond * beyond / (scale_days * scale_days))


def function_score(
    scored: DataFrame, attributes: DataFrame, origin, *, scale_days: float, offset_days: float, decay: float,
    verified_weight: float,
) -> DataFrame:
    """Text score plus popularity x recency x verified weight. ``attributes`` is keyed by doc_id."""
    joined = scored.join(attributes, "doc_id")
    factor = (
        F.log10(1 + F.coalesce(F.col("retweet_count"), F.lit(0)))
        * gauss_decay(F.col("created_at"), F.lit(origin), scale_days, offset_days, decay)
        * F.when(F.col("verified"), verified_weight).otherwise(1.0)
    )
    return joined.withColumn("score", F.col("score") + factor)


def top_hits(scored: DataFrame, limit: int = 10) -> DataFrame:
    """Best hits by score, ties by id, each with the exact total number of hits. The scores are stored, so the search runs once."""
    scored = stage(scored, "scored")
    total = scored.agg(F.count("*").alias("total_hits"))
    best = scored.withColumn("score", F.round("score", 6)).orderBy(F.desc("score"), "doc_id").limit(limit)
    return best.crossJoin(total)  # one-row side


def highlight(
    hits: DataFrame, docs: DataFrame, id_column: str, text_column: str, stems: Sequence[str],
    before: str = "<em>", after: str = "</em>",
) -> DataFrame:
    """Mark the matched words in the whole text of the hits (a top-k frame, so only its texts are stored and analysed)."""
    hits = stage(hits, "hits")
    texts = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    chosen = stage(texts.join(hits, "doc_id", "left_semi"), "hit-texts")
    words = tk.base_tokens(chosen, "doc_id", "text").withColumn("term", tx.plain_term(F.col("word")))
    known = tk.stem_dictionary(words).filter(F.col("stem").isin(*stems))
    forms = words.join(known, "term", "left_semi").groupBy("doc_id").agg(F.sort_array(F.collect_set("word"), asc=False).alias("forms"))
    edge = r"[\p{L}\p{M}\p{N}_]"
    quoted = F.array_join(F.transform("forms", lambda w: F.concat(F.lit("\\Q"), w, F.lit("\\E"))), "|")
    pattern = F.concat(F.lit(f"(?<!{edge})("), quoted, F.lit(f")(?!{edge})"))
    marked = chosen.join(forms, "doc_id", "left")
    return hits.join(
        marked.select(
            "doc_id",
            F.when(F.col("forms").isNull(), F.col("text"))
            .otherwise(F.regexp_replace("text", pattern, F.lit(f"{before}$1{after}"))).alias("highlight"),
        ),
        "doc_id",
    )


# ---- nested arrays --------------------------------------------------------------------------------------------------
def nested_documents(tweets: DataFrame, tags: DataFrame, mentions: DataFrame) -> DataFrame:
    """Tweets with their tag and mention arrays (both bounded by the document)."""
    tag_arrays = tags.groupBy("tweet_id").agg(F.array_sort(F.collect_set(F.struct(F.col("tag").alias("text")))).alias("hashtags"))
    mention_arrays = mentions.groupBy("tweet_id").agg(
        F.array_sort(F.collect_set(F.struct(
            F.col("mentioned_user_id").alias("id"), F.col("mentioned_screen_name").alias("screen_name")
        ))).alias("user_mentions")
    )
    keyed = tweets.withColumnRenamed("id", "tweet_id")
    return keyed.join(tag_arrays, "tweet_id", "left").join(mention_arrays, "tweet_id", "left")


def _element_in(name: str, values: Sequence[str]):
    return lambda e: tx.folded(e[name]).isin(*[v.lower() for v in values])


def nested_match(docs: DataFrame, tags: Sequence[str], mentions: Sequence[str]) -> DataFrame:
    """Documents with one matching tag element and one matching mention element."""
    return docs.filter(
        F.exists("hashtags", _element_in("text", tags)) & F.exists("user_mentions", _element_in("screen_name", mentions))
    )


def inner_hits(docs: DataFrame, tags: Sequence[str], mentions: Sequence[str], size: int = 5) -> DataFrame:
    """The matched elements of each hit, at most ``size`` per array."""
    hits = nested_match(docs, tags, mentions)
    return hits.withColumn("matched_hashtags", F.slice(F.filter("hashtags", _element_in("text", tags)), 1, size)).withColumn(
        "matched_mentions", F.slice(F.filter("user_mentions", _element_in("screen_name", mentions)), 1, size)
    )


# ---- partial names --------------------------------------------------------------------------------------------------
def rank_by_shared_terms(index: TextIndex, query_terms: Sequence[str], limit: int = 10) -> DataFrame:
    """Documents by the number of distinct query grams or shingles they hold, from the stored index of those."""
    hits = postings(index, list(query_terms))
    return hits.groupBy("doc_id").agg(F.count("*").alias("matches")).orderBy(F.desc("matches"), "doc_id").limit(limit)


def autocomplete(index: TextIndex, prefix: str, limit: int = 10) -> DataFrame:
    """Documents with a term that begins with a prefix, those with most such terms first."""
    hits = tk.prefix_postings(index, prefix)
    return hits.groupBy("doc_id").agg(F.count("*").alias("matches")).orderBy(F.desc("matches"), "doc_id").limit(limit)


def query_grams(text: str, low: int = 3, high: int = 6) -> list[str]:
    import regex

    words = [w.lower() for w in regex.findall(tx.WORD, text)]
    return sorted({w[i : i + n] for w in words for n in range(low, high + 1) for i in range(len(w) - n + 1)})


def query_shingles(text: str, longest: int = 3) -> list[str]:
    import regex

    words = [w.lower() for w in regex.findall(tx.WORD, text)]
    return sorted({"".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)})


# ---- substrings -----------------------------------------------------------------------------------------------------
def trigram_postings(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", buckets: int = 64) -> DataFrame:
    """Distinct lower-cased trigrams per document, deduplicated inside the row."""
    pieces = F.array_distinct(tx.grams(F.lower(text_column), 3))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.explode(pieces).alias("trigram"))
    return rows.withColumn("bucket", (F.crc32(F.encode("trigram", "utf-8")) % buckets).cast("int"))


def stage_trigrams(docs: DataFrame, buckets: int = 64, **columns) -> DataFrame:
    """Store the postings by trigram bucket; oversized buckets are split by AQE."""
    rows = trigram_postings(docs, buckets=buckets, **columns)
    folder = fresh_folder(docs.sparkSession, "trigrams")
    (
        rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", "trigram")
        .write.partitionBy("bucket").parquet(folder)
    )
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def substring_search(
    stored: DataFrame, docs: DataFrame, needle: str, buckets: int = 64, id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Documents containing the needle in any case: trigram candidates, then an exact recheck."""
    recheck = F.lower(text_column).contains(needle.lower())
    lowered = needle.lower()
    parts = sorted({lowered[i : i + 3] for i in range(len(lowered) - 2)})
    if not parts:
        return docs.filter(recheck)
    wanted = sorted({tk.bucket_of(p, buckets) for p in parts})
    candidates = (
        stored.filter(F.col("bucket").isin(*wanted) & F.col("trigram").isin(*parts))
        .groupBy("doc_id").agg(F.count("*").alias("_n")).filter(F.col("_n") == len(parts))
        .select(F.col("doc_id").alias(id_column))
    )
    return docs.join(candidates, id_column, "left_semi").filter(recheck)
