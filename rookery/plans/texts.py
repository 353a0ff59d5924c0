"""Registered text analysis and ranked search (T-*).

Search jobs read a stored index, as they would in use; it is built once per application and data folder.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.functions import stemming
from rookery.functions import text as tx
from rookery.operators import search
from rookery.operators import tokens as tk
from rookery.plans.registry import job
from rookery.views import Tables

PART_CHARACTERS = 4_000_000  # of texts in one task that holds their shingles

_indexes: dict[tuple, tk.TextIndex] = {}


def index_of(t: Tables, corpus: str) -> tk.TextIndex:
    """The stored index of a corpus: documents, tweets, the descriptions of tweet authors, or ``field:analyser``."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir, corpus)
    if key not in _indexes:
        _indexes[key] = build_index(t, corpus)
    return _indexes[key]


def build_index(t: Tables, corpus: str) -> tk.TextIndex:
    if corpus == "documents":
        rows = tk.posting_rows(t.spread().documents, "doc_id", "text")
    elif corpus == "tweets":
        rows = tk.posting_rows(t.spread().tweets, "id", "full_text")
    elif corpus == "descriptions":
        # a description is analysed once per user and then handed to the user's tweets
        per_user = tk.posting_rows(t.users, "id", "description").withColumnRenamed("doc_id", "user_id")
        rows = t.tweets.select(F.col("id").alias("doc_id"), "user_id").join(per_user, "user_id").drop("user_id")
    else:
        field, analyser = corpus.rsplit(":", 1)
        if analyser not in tk.FIELD_ANALYZERS[field]:
            raise ValueError(f"{field} has no form {analyser}")
        rows = tk.posting_rows(field_values(t, field), "id", "value", analyser)
    return tk.store_index(rows, buckets=16)


def field_values(t: Tables, field: str) -> DataFrame:
    """(id, value) of a searchable field."""
    if field.startswith("user."):
        return t.users.select("id", F.col(field[5:]).alias("value"))
    if field.startswith("place."):
        return t.places.select("id", F.col({"name": "id"}.get(field[6:], field[6:])).alias("value"))
    if field.startswith("entities.user_mentions."):
        named = t.tweet_user_mentions.select(F.col("mentioned_user_id").alias("id"), F.col("mentioned_screen_name").alias("value"))
        return named.distinct()
    if field == "entities.hashtags.text":
        return t.tweet_hashtag.select(F.col("tag").alias("id"), F.col("tag").alias("value")).distinct()
    return t.tweets.select("id", F.col("full_text").alias("value"))


# ---- oracle text ----------------------------------------------------------------------------------------------------
def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _strip_sql(column: str) -> str:
    out = f"regexp_replace({column}, {_quoted(tx.HTML_HIDDEN)}, chr(10), 'g')"
    out = f"regexp_replace({out}, {_quoted(tx.HTML_INLINE)}, '', 'g')"
    out = f"regexp_replace({out}, {_quoted(tx.HTML_TAG)}, chr(10), 'g')"
    for name, char in tx.ENTITIES:
        out = f"replace({out}, {_quoted(name)}, {_quoted(char)})"
    return out


def _words_sql(name: str, source: str, id_column: str, text_column: str) -> str:
    return (
        f"{name} as (select doc_id, unnest(l) as word, unnest(range(len(l))) as position from (select {id_column} as doc_id, "
        f"regexp_extract_all({_strip_sql(text_column)}, {_quoted(tx.WORD)}) as l from {source}) z)"
    )


def _terms_sql(name: str, words: str, families: dict[str, str]) -> str:
    """Analysed tokens; the stems a query needs are given by the pattern of their word family."""
    stop = ", ".join(_quoted(w) for w in tx.STOP_WORDS)
    cases = " ".join(f"when regexp_full_match(t, {_quoted(p)}) then {_quoted(s)}" for s, p in families.items())
    term = f"case {cases} else t end" if cases else "t"
    return (
        f"{name} as (select doc_id, position, {term} as term from (select doc_id, position, "
        f"lower(regexp_replace(word, {_quoted(tx.POSSESSIVE)}, '')) as t from {words}) z where t not in ({stop}))"
    )


def _corpus_sql(corpus: str, families: dict[str, str], prefix: str = "") -> str:
    source = {
        "documents": ("documents", "doc_id", "text"),
        "tweets": ("tweets", "id", "full_text"),
        "descriptions": ("(select t.id, u.description from tweets t join users u on u.id = t.user_id) d", "id", "description"),
    }[corpus]
    return (
        _words_sql(f"{prefix}w", *source) + ", " + _terms_sql(f"{prefix}k", f"{prefix}w", families) + ", "
        f"{prefix}len as (select doc_id, count(*) as length from {prefix}k group by 1), "
        f"{prefix}tot as (select count(*) as docs, avg(length) as av from {prefix}len)"
    )


def _match_sql(name: str, terms: list[str], prefix: str = "") -> str:
    listed = ", ".join(_quoted(t) for t in terms)
    p = prefix
    return (
        f"{name}_f as (select doc_id, term, count(*) as f from {p}k where term in ({listed}) group by 1, 2), "
        f"{name}_n as (select term, count(*) as n from {name}_f group by 1), "
        f"{name} as (select doc_id, sum(ln(1 + (docs - n + 0.5e0) / (n + 0.5e0)) * f * 2.2e0 / "
        f"(f + 1.2e0 * (0.25e0 + 0.75e0 * length / av))) as score from {name}_f join {name}_n using (term) "
        f"join {p}len using (doc_id) cross join {p}tot group by doc_id)"
    )


def _phrase_sql(name: str, first: str, second: str, slop: int | None, prefix: str = "") -> str:
    """Two-term phrase; exact by a self join, sloppy by neighbours in merged order."""
    p = prefix
    if slop is None:
        frequency = (
            f"select a.doc_id, count(*)::double as frequency from {p}k a join {p}k b on b.doc_id = a.doc_id "
            f"and b.position = a.position + 1 where a.term = {_quoted(first)} and b.term = {_quoted(second)} group by 1"
        )
    else:
        frequency = (
            "select doc_id, sum(1e0 / (1 + d)) as frequency from (select doc_id, term, "
            "lead(term) over s as other, lead(adj) over s - adj as d from (select doc_id, term, "
            f"case when term = {_quoted(second)} then position - 1 else position end as adj, "
            f"case when term = {_quoted(second)} then 1 else 0 end as o from {p}k where term in "
            f"({_quoted(first)}, {_quoted(second)})) m window s as (partition by doc_id order by adj, o)) z "
            f"where other <> term and d <= {slop} group by 1"
        )
    names = ", ".join(_quoted(x) for x in (first, second))
    return (
        f"{name}_f as ({frequency}), "
        f"{name}_t as (select term, count(distinct doc_id) as n from {p}k where term in ({names}) group by 1), "
        f"{name}_w as (select sum(ln(1 + (docs - n + 0.5e0) / (n + 0.5e0)) * "
        f"{2 if first == second else 1}) as weight from {name}_t cross join {p}tot), "
        f"{name} as (select doc_id, frequency, weight * frequency * 2.2e0 / "
        f"(frequency + 1.2e0 * (0.25e0 + 0.75e0 * length / av)) as score from {name}_f join {p}len using (doc_id) "
        f"cross join {p}tot cross join {name}_w)"
    )


# Surface families of the query stems in the supplied texts.
FAMILIES = {s: s + "(e|s|es|ed|ing)?" for s in ("anea", "thanea", "thanedbl", "worthless", "licens", "disgust")}
FAMILIES |= {"erin": "erin(es|ou|ed|ing|er|ator|ant|ered|ering|ation|able|ates|oued|ouing|eation|eant|eable)?"}
FAMILIES |= {"der": "ders?", "die": "die"}
HITS = ["doc_id", "score"]


def _top(scored):
    return scored.withColumn("score", F.round("score", 6))


def _shape_sql(x: str) -> str:
    """Letters as C and V; y is a vowel after a consonant. Runs of y alternate, so the two rules are applied in turn."""
    out = f"regexp_replace(regexp_replace(regexp_replace({x}, '[^aeiouy]', 'C', 'g'), '[aeiou]', 'V', 'g'), '^y', 'C')"
    for _ in range(6):
        out = f"replace(replace({out}, 'Cy', 'CV'), 'Vy', 'VC')"
    return out


def _measure_sql(x: str) -> str:
    return f"len(regexp_extract_all({_shape_sql(x)}, 'V+C+'))"


def _short_sql(x: str) -> str:
    return f"(length({x}) >= 3 and {_shape_sql(x)} like '%CVC' and right({x}, 1) not in ('w', 'x', 'y'))"


def _suffix_sql(name: str, source: str, suffixes, fits: str) -> str:
    """One step: the longest suffix that a word ends in goes, if what is left of the word fits."""
    longest = sorted(suffixes, key=lambda p: -len(p[0]))
    cut = " ".join(f"when w like '%{old}' then {len(old)}" for old, _ in longest)
    put = " ".join(f"when w like '%{old}' then '{new}'" for old, new in longest)
    return (
        f"{name}a as (select t, w, case {cut} end as k, case {put} end as put from {source}), "
        f"{name}b as (select t, w, put, left(w, length(w) - k) as h, right(w, k) as gone from {name}a), "
        f"{name} as (select t, case when h is not null and {fits} then h || put else w end as w from {name}b)"
    )


def _stems_sql(name: str, terms: str) -> str:
    """(t, w): every distinct term with its stem, by the published rules as a chain of steps."""
    whole = "case when w like '%e' and (m > 1 or (m = 1 and not short)) then h else w end"
    return ", ".join([
        f"z0 as (select distinct term as t from {terms})",
        "z1 as (select t, case when t like '%sses' or t like '%ies' then left(t, length(t) - 2) "
        "when t like '%s' and t not like '%ss' then left(t, length(t) - 1) else t end as w from z0 where length(t) > 2)",
        "z2 as (select t, w, case when w like '%eed' then null "
        f"when w like '%ed' and {_shape_sql('left(w, length(w) - 2)')} like '%V%' then left(w, length(w) - 2) "
        f"when w like '%ing' and {_shape_sql('left(w, length(w) - 3)')} like '%V%' then left(w, length(w) - 3) end as h from z1)",
        f"z3 as (select t, case when w like '%eed' and {_measure_sql('left(w, length(w) - 3)')} > 0 then left(w, length(w) - 1) "
        "when h is null then w when h like '%at' or h like '%bl' or h like '%iz' then h || 'e' "
        f"when length(h) > 1 and right(h, 1) = left(right(h, 2), 1) and {_shape_sql('h')} like '%C' "
        "and right(h, 1) not in ('l', 's', 'z') then left(h, length(h) - 1) "
        f"when {_measure_sql('h')} = 1 and {_short_sql('h')} then h || 'e' else h end as w from z2)",
        f"z4 as (select t, case when w like '%y' and {_shape_sql('left(w, length(w) - 1)')} like '%V%' "
        "then left(w, length(w) - 1) || 'i' else w end as w from z3)",
        _suffix_sql("z5", "z4", stemming.STEP2, f"{_measure_sql('h')} > 0"),
        _suffix_sql("z6", "z5", stemming.STEP3, f"{_measure_sql('h')} > 0"),
        _suffix_sql("z7", "z6", [(x, "") for x in stemming.STEP4],
                    f"{_measure_sql('h')} > 1 and (gone <> 'ion' or right(h, 1) in ('s', 't'))"),
        f"z8 as (select t, w, h, {_measure_sql('h')} as m, {_short_sql('h')} as short from "
        "(select t, w, left(w, length(w) - 1) as h from z7))",
        f"z9 as (select t, {whole} as w from z8)",
        f"{name} as (select t, case when w like '%ll' and {_measure_sql('left(w, length(w) - 1)')} > 1 "
        "then left(w, length(w) - 1) else w end as w from z9 union all select t, t from z0 where length(t) <= 2)",
    ])


STEMS_SQL = "with " + _words_sql("a", "documents", "doc_id", "text") + ", " + _terms_sql("k", "a", {}) + ", " + _stems_sql("st", "k")


# ---- token tables ---------------------------------------------------------------------------------------------------
@job("t_01", "with " + _words_sql("a", "documents", "doc_id", "text") + ", " + _words_sql("b", "pages", "page_id", "html")
     + " select 'document' as kind, * from a union all select 'page', * from b")
def _(t: Tables):
    docs = tk.base_tokens(t.spread().documents, "doc_id", "text").withColumn("kind", F.lit("document"))
    return docs.unionByName(tk.base_tokens(t.spread().pages, "page_id", "html").withColumn("kind", F.lit("page")))


@job("t_02", STEMS_SQL + " select doc_id, position, w as term from k join st on st.t = k.term")
def _(t: Tables):
    return tk.english_tokens(t.spread().documents, "doc_id", "text")


@job("t_03", STEMS_SQL + " select t as term, w as stem from st")
def _(t: Tables):
    return tk.stem_dictionary(tk.plain_tokens(t.spread().documents, "doc_id", "text"))


FOLD_SQL = f"translate(lower({{}}), {_quoted(tx.FOLD_FROM)}, {_quoted(tx.FOLD_TO)})"
for _letter, _plain in tx.FOLD_WIDE:
    FOLD_SQL = f"replace({FOLD_SQL}, {_quoted(_letter)}, {_quoted(_plain)})"


@job("t_04", "with " + _words_sql("w", "users", "id", "screen_name") + f""",
f as (select doc_id, position, {FOLD_SQL.format('word')} as word from w),
g as (select doc_id, position, word, n, unnest(range(1, len(word) - n + 2)) as i from f, (values (3),(4),(5),(6)) s(n))
select doc_id, position, substr(word, i, n) as term from g""")
def _(t: Tables):
    return tk.ngram_tokens(t.users, "id", "screen_name")


@job("t_05", "with " + _words_sql("w", "documents", "doc_id", "text") + f""",
f as (select doc_id, position, {FOLD_SQL.format('word')} as a from w),
s as (select doc_id, a, lead(a, 1) over o as b, lead(a, 2) over o as c from f window o as (partition by doc_id order by position)),
r as (select doc_id, a as term from s union all select doc_id, a || b from s where b is not null
  union all select doc_id, a || b || c from s where c is not null)
select doc_id, count(*) as shingles, count(distinct term) as distinct_shingles, min(term) as first_term,
  max(term) as last_term, cast(sum(length(term)) as bigint) as characters from r group by doc_id""")
def _(t: Tables):
    # the texts are shuffled, not their many times larger shingles: rows of one document then stay together. The number of parts
    # goes by the characters, since AQE would merge parts by the size of the texts
    characters = t.documents.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(characters / PART_CHARACTERS))
    rows = tk.shingle_tokens(t.documents.repartition(parts, "doc_id"), "doc_id", "text")
    # one row per (document, shingle) first: the distinct count then needs no second shuffle of raw rows
    per_term = rows.groupBy("doc_id", "term").agg(F.count("*").alias("n"))
    return per_term.groupBy("doc_id").agg(
        F.sum("n").alias("shingles"), F.count("*").alias("distinct_shingles"), F.min("term").alias("first_term"),
        F.max("term").alias("last_term"), F.sum(F.length("term") * F.col("n")).alias("characters"),
    )


@job("t_06", "with " + _words_sql("w", "documents", "doc_id", "text") + f"""
select {FOLD_SQL.format('word')} as keyword, count(distinct word) as spellings, count(*) as uses from w group by 1""")
def _(t: Tables):
    keyed = tk.keyword_keys(tk.base_tokens(t.spread().documents, "doc_id", "text"), "word")
    per_word = keyed.groupBy("keyword", "word").agg(F.count("*").alias("n"))
    return per_word.groupBy("keyword").agg(F.count("*").alias("spellings"), F.sum("n").alias("uses"))


@job("t_07", "with " + _words_sql("w", "documents", "doc_id", "text") + ", " + _terms_sql("k", "w", {}) + """,
tot as (select count(*) as documents, avg(n) as avg_length from (select count(*) as n from k group by doc_id) z)
select term, count(distinct doc_id) as doc_freq, count(*) as term_freq, documents, round(avg_length, 6) as avg_length
from k cross join tot group by term, documents, avg_length""")
def _(t: Tables):
    stats = tk.corpus_statistics(tk.plain_tokens(t.spread().documents, "doc_id", "text"))
    return stats.withColumn("avg_length", F.round("avg_length", 6))


# ---- searches -------------------------------------------------------------------------------------------------------
@job("t_08", "with " + _corpus_sql("documents", FAMILIES) + ", " + _phrase_sql("p", "anea", "erin", None)
     + " select doc_id, frequency, round(score, 6) as score from p")
def _(t: Tables):
    return _top(search.phrase(index_of(t, "documents"), tx.analyse_query("anea eriner")))


@job("t_09", "with " + _corpus_sql("documents", FAMILIES) + ", " + _phrase_sql("p", "die", "der", 5)
     + " select doc_id, round(frequency, 6) as frequency, round(score, 6) as score from p")
def _(t: Tables):
    hits = search.phrase(index_of(t, "documents"), tx.analyse_query("die der"), slop=5)
    return _top(hits).withColumn("frequency", F.round("frequency", 6))


@job("t_10", "with " + _corpus_sql("tweets", FAMILIES) + ", " + _phrase_sql("p", "die", "der", 5) + ", "
     + _phrase_sql("bad", "die", "die", None) + """
select doc_id, round(score, 6) as score from p where doc_id not in (select doc_id from bad)
and doc_id in (select t.id from tweets t join users u on u.id = t.user_id where u.followers_count > 10)""")
def _(t: Tables):
    index = index_of(t, "tweets")
    followed = t.tweets.select(F.col("id").alias("doc_id"), "user_id").join(
        t.users.filter(F.col("followers_count") > 10).select(F.col("id").alias("user_id")), "user_id"
    )
    hits = search.boolean_query(
        search.phrase(index, tx.analyse_query("die der"), slop=5),
        search.phrase(index, tx.analyse_query("die die")),
        followed,
    )
    return _top(hits).select(*HITS)


@job("t_11", "with " + _corpus_sql("documents", FAMILIES) + """
select doc_id, count(distinct case when term in ('worthless', 'disgust') then 0 when term = 'licens' then 1 else 2 end)
  as clauses from k where term in ('worthless', 'disgust', 'licens', 'thanedbl') group by doc_id having clauses >= 2""")
def _(t: Tables):
    clauses = [["worthless", "disgust"], ["licens"], ["thanedbl"]]
    return search.any_of(index_of(t, "documents"), clauses, minimum=2)


T_12_SQL = "with " + _corpus_sql("documents", FAMILIES) + ", " + _match_sql("m", ["worthless", "licens", "thanedbl"])


@job("t_12", T_12_SQL + " select doc_id, round(score, 6) as score from m")
def _(t: Tables):
    terms = [term for term, _ in tx.analyse_query("worthless licensed thanedble")]
    return _top(search.match(index_of(t, "documents"), terms))


@job("t_13", "select doc_id, 1e0 as score from documents")
def _(t: Tables):
    return search.match_all(t.documents, "doc_id")


@job("t_14", "with " + _corpus_sql("documents", FAMILIES)
     + " select doc_id, count(*) as frequency from k where term = 'disgust' group by 1")
def _(t: Tables):
    return search.term_query(index_of(t, "documents"), "disgust")


BEST_SQL = (
    "with " + _corpus_sql("tweets", FAMILIES) + ", "
    + _corpus_sql("descriptions", {"machineri": "machinery|machineries"}, "d_") + ", "
    + _match_sql("m", ["thanedbl", "machineri"]) + ", " + _match_sql("n", ["thanedbl", "machineri"], "d_") + """,
best as (select doc_id, max(score) as score from (select doc_id, score * 2e0 as score from m
  union all select doc_id, score from n) z group by 1)"""
)


def _best_fields(t: Tables):
    terms = [term for term, _ in tx.analyse_query("thanedble machinery")]
    return search.best_fields([
        (search.match(index_of(t, "tweets"), terms), 2.0),
        (search.match(index_of(t, "descriptions"), terms), 1.0),
    ])


@job("t_15", BEST_SQL + " select doc_id, round(score, 6) as score from best")
def _(t: Tables):
    return _top(_best_fields(t))


@job("t_16", BEST_SQL + """
select doc_id, round(score + log10(1 + coalesce(retweet_count, 0))
  * exp(ln(0.01e0) * power(greatest(0e0, abs(epoch(created_at) - epoch(timestamp '2000-06-01')) / 86400e0 - 7e0), 2)
    / power(23e0, 2)) * case when u.verified then 2e0 else 1e0 end, 6) as score
from best join tweets t on t.id = doc_id join users u on u.id = t.user_id""")
def _(t: Tables):
    authors = t.users.select(F.col("id").alias("user_id"), "verified")
    attributes = t.tweets.select(F.col("id").alias("doc_id"), "user_id", "retweet_count", "created_at").join(authors, "user_id")
    scored = search.function_score(
        _best_fields(t), attributes, dt.datetime(2000, 6, 1), scale_days=23.0, offset_days=7.0, decay=0.01, verified_weight=2.0
    )
    return _top(scored).select(*HITS)


@job("t_17")
def _(t: Tables):
    terms = [term for term, _ in tx.analyse_query("worthless licensed thanedble")]
    hits = search.top_hits(search.match(index_of(t, "documents"), terms))
    return search.highlight(hits, t.documents, "doc_id", "text", terms)


NESTED_SQL = """
with h as (select tweet_id, string_agg(tag, '|' order by tag) as matched_hashtags from tweet_hashtag
  where lower(tag) in ('brand#7', 'brand#12', 'brand#3') group by 1),
m as (select tweet_id, string_agg(mentioned_screen_name, '|' order by mentioned_user_id) as matched_mentions
  from tweet_user_mentions where mentioned_user_id % 10 = 4 and mentioned_user_id < 1000 group by 1)
select tweet_id{} from h join m using (tweet_id)"""
NESTED_TAGS = ["brand#7", "BRAND#12", "brand#3"]
NESTED_MENTIONS = [f"M{i}" for i in range(4, 1000, 10)]


def _nested(t: Tables):
    return search.nested_documents(t.tweets.select("id"), t.tweet_hashtag, t.tweet_user_mentions)


@job("t_18", NESTED_SQL.format(""))
def _(t: Tables):
    return search.nested_match(_nested(t), NESTED_TAGS, NESTED_MENTIONS).select("tweet_id")


@job("t_19", NESTED_SQL.format(", matched_hashtags, matched_mentions"))
def _(t: Tables):
    hits = search.inner_hits(_nested(t), NESTED_TAGS, NESTED_MENTIONS)
    return hits.select(
        "tweet_id",
        F.array_join(F.transform("matched_hashtags", lambda h: h["text"]), "|").alias("matched_hashtags"),
        F.array_join(F.transform("matched_mentions", lambda m: m["screen_name"]), "|").alias("matched_mentions"),
    )


@job("t_20", """
select * from (select 'partial' as form, cast(id as varchar) as doc_id, cast((case when screen_name like '%001%' then 1 else 0 end)
  + (case when screen_name like '%012%' then 1 else 0 end) + (case when screen_name like '%0012%' then 1 else 0 end)
  as bigint) as matches from users where screen_name like '%001%' or screen_name like '%012%' order by 3 desc, id limit 10) a
union all select * from (select 'words', id, cast((case when id = 'NATION_3' then 1 else 0 end)
  + (case when country = 'EUROPE' then 1 else 0 end)
  + (case when id = 'NATION_3' and country = 'EUROPE' then 1 else 0 end) as bigint) as matches from places
  where id = 'NATION_3' or country = 'EUROPE' order by 3 desc, 2 limit 10) b
union all select * from (select 'begin', id, cast(least(3, 2 + length(country) - length(replace(country, ' ', ''))) as bigint)
  as matches from places where id like 'NATION_1%' order by 3 desc, 2 limit 10) c""")
def _(t: Tables):
    partial = search.rank_by_shared_terms(index_of(t, "user.screen_name:ngram"), search.query_grams("0012"))
    names = index_of(t, "place.full_name:shingles")
    words = search.rank_by_shared_terms(names, search.query_shingles("Nation_3 Europe"))
    begin = search.autocomplete(names, "nation_1")  # the word and the shingles from it begin so
    forms = {"partial": partial, "words": words, "begin": begin}
    frames = [f.select(F.lit(form).alias("form"), F.col("doc_id").cast("string").alias("doc_id"), "matches") for form, f in forms.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@job("a_15", T_12_SQL + """
select doc_id, round(score, 6) as score, (select count(*) from m) as total_hits from m
order by round(score, 6) desc, doc_id limit 10""")
def _(t: Tables):
    terms = [term for term, _ in tx.analyse_query("worthless licensed thanedble")]
    return search.top_hits(search.match(index_of(t, "documents"), terms))
