"""Registered ingest and normalisation (I-*, N-*): the views written as documents, read back, checked and shredded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.functions.scalar import clean_text, parse_timestamp
from rookery.operators import graph, integrity, shred
from rookery.plans import corpus
from rookery.plans.registry import job
from rookery.plans.relational import STAMP, stamped
from rookery.plans.upkeep import TAG_ID_SQL
from rookery.sources import documents as docs
from rookery.sources import geometry, relations as rels
from rookery.views import Tables
from rookery.workspace import fresh_folder

_lines: dict[tuple, DataFrame] = {}
_statuses: dict[tuple, DataFrame] = {}


def lines(t: Tables) -> DataFrame:
    """All lines for work that is heavy by the line, those of files that do not split stored once per application and data folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _lines:
        _lines[key] = corpus.corpus_lines(t, stored=True)
    return _lines[key]


def checked(t: Tables) -> DataFrame:
    return docs.with_parse_error(docs.clean_lines(lines(t)))


def good(t: Tables) -> DataFrame:
    return docs.good_lines(checked(t))


def statuses(t: Tables) -> DataFrame:
    """The unrolled statuses, stored once per application and data folder."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _statuses:
        _statuses[key] = shred.unroll(docs.clean_lines(lines(t)))
    return _statuses[key]


def document_id():
    text = F.coalesce(F.get_json_object("value", "$.id"), F.get_json_object("value", "$.id_str"))
    return text.try_cast("bigint").alias("id")


# ---- sources --------------------------------------------------------------------------------------------------------


@job("i_01", "select cast(id % 8 as int) as shard, count(*) as lines from tweets where id % 8 between 2 and 5 group by 1")
def _(t: Tables):
    lines = corpus.corpus_lines(t, limit=6, skip=2)
    return lines.groupBy(corpus.shard_of("file").alias("shard")).agg(F.count("*").alias("lines"))


@job("i_02", """
select cast(id % 8 as int) as shard, case when id % 97 = 0 then 'not valid JSON' else 'good' end as reason, count(*) as n
from tweets group by 1, 2""")
def _(t: Tables):
    lines = checked(t)
    refused = docs.quarantined_lines(lines).select("file", "reason")
    kept = docs.good_lines(lines).select("file", F.lit("good").alias("reason"))
    return (
        kept.unionByName(refused).groupBy(corpus.shard_of("file").alias("shard"), "reason").agg(F.count("*").alias("n"))
    )


def _unknown_sql(alias: str, path: str) -> str:
    return (
        f"case when {alias}.id % 13 = 3 and {alias}.id % 73 <> 0 then '{path}.extended_tweet' end, "
        f"case when {alias}.id % 83 = 0 then '{path}.surprise' end"
    )


# one status in fifty quotes itself, its retweet included, which an embedded status may not hold
STRICT_SQL = f"""
strict as (select g.id, concat_ws(',', {_unknown_sql('g', '$')}, {_unknown_sql('r', '$.retweeted_status')},
  {_unknown_sql('q', '$.quoted_status')},
  case when g.id % 50 = 0 and r.id is not null then '$.quoted_status.retweeted_status' end) as unknown_fields
  from tweets g left join tweets r on r.id = g.retweeted_status_id
  left join tweets q on q.id = case when g.id % 50 = 0 then g.id else g.quoted_status_id end where g.id % 97 <> 0)"""


@job("i_03", f"with {STRICT_SQL} select id, unknown_fields from strict where unknown_fields <> ''")
def _(t: Tables):
    flagged = docs.with_unknown_fields(good(t)).filter(F.size("unknown_fields") > 0)
    return flagged.select(document_id(), F.array_join("unknown_fields", ",").alias("unknown_fields"))


@job("i_04", """
select id, case when id % 6 = 0 then '{"url":"https://t.example/' || id || '"}' end as permalink,
  case when id % 6 = 0 then 'https://t.example/' || id end as permalink_url from tweets where id % 97 <> 0""")
def _(t: Tables):
    kept = docs.kept_objects(good(t), {"permalink": "$.quoted_status_permalink"})
    variant = F.try_variant_get(F.parse_json("permalink"), "$.url", "string")
    return kept.select(document_id(), "permalink", variant.alias("permalink_url"))


@job("i_05", "select id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at from tweets where id % 97 <> 0")
def _(t: Tables):
    return good(t).select(
        document_id(), F.date_format(parse_timestamp(F.get_json_object("value", "$.created_at")), STAMP).alias("created_at")
    )


@job("i_06", """
select g.id, case when g.place_id is not null then 4 end as ring_size, case when r.place_id is not null then 4 end as
  retweeted_ring_size, case when g.place_id is not null then true end as closed
from tweets g left join tweets r on r.id = g.retweeted_status_id where g.id % 97 <> 0""")
def _(t: Tables):
    fixed = docs.normalised_geometry(good(t))
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c))
    closed = F.element_at("ring", 1) == F.element_at("ring", -1)
    return fixed.select(
        document_id(), size("ring").alias("ring_size"), size("retweeted_status_ring").alias("retweeted_ring_size"), closed.alias("closed")
    )


@job("i_07", """
select id, 17e0 + id % 5 as lon, 48e0 + id % 2 as lat from tweets where id % 97 <> 0 and id % 4 = 0""")
def _(t: Tables):
    fixed = docs.normalised_geometry(good(t), order="lat_lon").filter(F.col("point").isNotNull())
    return fixed.select(document_id(), F.col("point")[0].alias("lon"), F.col("point")[1].alias("lat"))


@job("i_08", f"""
with {STRICT_SQL}
select cast(t.id % 8 as int) as shard, count(*) filter (where unknown_fields = '') as succeeded,
  count(*) filter (where unknown_fields is null or unknown_fields <> '') as failed
from tweets t left join strict s on s.id = t.id group by 1""")
def _(t: Tables):
    counts, _ = docs.bulk_write(corpus.corpus_lines(t))
    return counts.groupBy(corpus.shard_of("file").alias("shard")).agg(
        F.sum("succeeded").alias("succeeded"), F.sum("failed").alias("failed")
    )


@job("i_09", "select cast(id % 8 as int) as shard, count(*) as lines from tweets group by 1")
def _(t: Tables):
    per_file = docs.lines_per_file(corpus.corpus_lines(t))
    return per_file.select(corpus.shard_of("file").alias("shard"), "lines")


@job("i_10", """
select id, screen_name, verified, case when id % 19 <> 0 then followers_count end as followers_count, location from users""")
def _(t: Tables):
    text = t.users.select(
        F.col("id").cast("string").alias("id"), "screen_name", F.col("verified").cast("string").alias("verified"),
        F.when(F.col("id") % 19 == 0, "n/a").otherwise(F.col("followers_count").cast("string")).alias("followers_count"),
        "location",
    )
    typed = rels.typed_rows(text, rels.RELATIONS["users"])
    path = fresh_folder(t.spark, "typed")
    typed.write.parquet(path)
    stored = rels.read_relation(t.spark, "users", path)
    return stored.select("id", "screen_name", "verified", "followers_count", "location")


@job("i_11", "select doc_id, nullif(lang, 'en') as lang, text, n_chars from documents")
def _(t: Tables):
    rows = t.documents.select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"), "text", "n_chars")
    path = fresh_folder(t.spark, "delimited")
    rels.write_delimited(rows, path)
    return rels.read_delimited(t.spark, path, rows.schema)


@job("i_12", """
select a.screen_name, count(distinct r.user_id) as retweeting_accounts
from tweets r join tweets o on o.id = r.retweeted_status_id join users a on a.id = o.user_id
where o.user_id <> r.user_id group by a.id, a.screen_name order by retweeting_accounts desc, a.screen_name limit 10""")
def _(t: Tables):
    path = fresh_folder(t.spark, "result")
    rels.write_result(graph.most_retweeted_authors(t.tweets, t.users), path)
    return rels.read_result(t.spark, path, "screen_name string, retweeting_accounts bigint")


def _wkt_rows(t: Tables) -> DataFrame:
    """District polygons, some with a hole and an island in it, and customer points as text; every ninth point is cut short."""
    pair = F.concat_ws(" ", *[(F.floor(F.col(c) * 1e6) / 1e6).cast("string") for c in "xy"])
    rings = t.district_ring.groupBy("poly_id", "ring").agg(F.array_sort(F.collect_list(F.struct("seq", pair.alias("p")))).alias("v"))
    texts = rings.withColumn("t", F.concat(F.lit("("), F.array_join(F.transform("v", lambda e: e["p"]), ", "), F.lit(")")))
    whole = texts.groupBy("poly_id").agg(F.array_sort(F.collect_list(F.struct("ring", "t"))).alias("r"))
    body = F.array_join(F.transform(F.slice("r", 1, 2), lambda e: e["t"]), ", ")
    island = F.when(F.size("r") > 2, F.get("r", F.lit(2))["t"])
    polygons = whole.select(
        F.col("poly_id").cast("bigint").alias("osm_id"),
        F.coalesce(
            F.concat(F.lit("MULTIPOLYGON(("), body, F.lit("), ("), island, F.lit("))")), F.concat(F.lit("POLYGON("), body, F.lit(")"))
        ).alias("wkt"),
    )
    point = F.concat(F.lit("POINT("), pair, F.lit(")"))
    points = t.geo_points.select(
        (F.col("id") + 1000).alias("osm_id"),
        F.when(F.col("id") % 9 == 0, F.expr("'POINT(17.5'")).otherwise(point).alias("wkt"),
    )
    return polygons.unionByName(points)



@job("i_13", """
select cast(poly_id as bigint) as osm_id, case when max(ring) = 2 then 'MULTIPOLYGON' else 'POLYGON' end as kind, 4326 as srid, count(*) as vertices, round(sum(floor(x * 1e6) / 1e6), 5) as sx
from district_ring group by poly_id
union all select id + 1000, case when id % 9 <> 0 then 'POINT' else 'refused' end, case when id % 9 <> 0 then 4326 end,
  case when id % 9 <> 0 then 1 end, case when id % 9 <> 0 then round(floor(x * 1e6) / 1e6, 5) end from geo_points""")
def _(t: Tables):
    table, refused = geometry.load_geometries(_wkt_rows(t), "wkt", 4326)
    good_rows = geometry.vertex_table(table, "osm_id", "kind", "srid").groupBy("osm_id", "kind", "srid").agg(
        F.count("*").alias("vertices"), F.round(F.sum("x"), 5).alias("sx")
    )
    return good_rows.unionByName(refused.select("osm_id", F.lit("refused").alias("kind")), allowMissingColumns=True)


@job("i_14", """
select cast(poly_id as bigint) as osm_id, case when max(ring) = 2 then 'MULTIPOLYGON((' else 'POLYGON(' end
  || string_agg(case when ring = 2 then '),(' when ring = 1 then ',' else '' end || r, '' order by ring)
  || case when max(ring) = 2 then '))' else ')' end as wkt, 4326 as srid from (select poly_id, ring, '('
  || string_agg(floor(x * 1e6) / 1e6 || ' ' || floor(y * 1e6) / 1e6, ',' order by seq) || ')' as r from district_ring group by 1, 2) z group by poly_id
union all select id + 1000, 'POINT(' || floor(x * 1e6) / 1e6 || ' ' || floor(y * 1e6) / 1e6 || ')', 4326 from geo_points where id % 9 <> 0""")
def _(t: Tables):
    table, _ = geometry.load_geometries(_wkt_rows(t), "wkt", 4326)
    return table.select("osm_id", geometry.as_text(F.col("kind"), F.col("rings")).alias("wkt"), "srid")


# ---- normalisation --------------------------------------------------------------------------------------------------
SEEN_SQL = """
good as (select * from tweets where id % 97 <> 0),
wraps as (select g.*, k.k from good g, range(6) k(k) where k.k = 0 or g.id % 50 = 0),
seen as (select id, id % 8 as shard, k as depth from wraps
  union all select retweeted_status_id, id % 8, 1 + k from wraps where retweeted_status_id is not null
  union all select g.quoted_status_id, g.id % 8, case when g.id % 50 = 0 then 6 else 1 end from good g
    join tweets q on q.id = g.quoted_status_id
  union all select r.quoted_status_id, g.id % 8, 2 + k from wraps g join tweets r on r.id = g.retweeted_status_id
    join tweets q on q.id = r.quoted_status_id),
kept as (select distinct id from seen)"""


@job("n_01", f"with {SEEN_SQL} select id as status_id, depth, count(*) as n from seen group by 1, 2")
def _(t: Tables):
    return statuses(t).groupBy("status_id", "depth").agg(F.count("*").alias("n"))


@job("n_02", f"""
with {SEEN_SQL}
select id, screen_name, name, description, verified, protected, followers_count, friends_count, statuses_count, location
from users where id in (select user_id from tweets where id in (select id from kept))""")
def _(t: Tables):
    return shred.relation(statuses(t), "users").drop("created_at", "url")


@job("n_03", f"""
with {SEEN_SQL} select * from places where id in (select place_id from tweets where id in (select id from kept))""")
def _(t: Tables):
    return shred.relation(statuses(t), "places")


@job("n_04", f"""
with {SEEN_SQL},
first as (select id, arg_min(depth, shard * 10 + depth) as depth from seen group by 1)
select t.id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at, case when t.id % 73 <> 0 then full_text end as full_text,
  case when t.id % 4 <> 0 then 0 end as display_from, case when t.id % 4 <> 0 then length(full_text) end as display_to,
  lang, user_id, source, nullif(in_reply_to_status_id, 0) as in_reply_to_status_id,
  nullif(quoted_status_id, 0) as quoted_status_id,
  case when f.depth = 0 and retweeted_status_id % 79 <> 0 then retweeted_status_id end as retweeted_status_id,
  place_id, retweet_count, favorite_count, possibly_sensitive from tweets t join first f on f.id = t.id""")
def _(t: Tables):
    return stamped(shred.relation(statuses(t), "tweets"))


TAGS_SQL = f"k as (select tweet_id, tag, {TAG_ID_SQL} as hid from tweet_hashtag where tweet_id in (select id from kept))"


@job("n_05", f"with {SEEN_SQL}, {TAGS_SQL} select distinct hid as id, tag from k")
def _(t: Tables):
    return shred.relation(statuses(t), "hashtags")


@job("n_06", f"with {SEEN_SQL}, {TAGS_SQL} select tweet_id, hid as hashtag_id from k")
def _(t: Tables):
    return shred.relation(statuses(t), "tweet_hashtag")


@job("n_07", f"""
with {SEEN_SQL} select tweet_id, url, url || '#full' as expanded_url,
  case when tweet_id % 3 = 0 then url || '#end' else url || '#full' end as unwound_url
from tweet_urls where tweet_id in (select id from kept)""")
def _(t: Tables):
    return shred.relation(statuses(t), "tweet_urls").drop("display_url")


@job("n_08", f"""
with {SEEN_SQL} select tweet_id, mentioned_user_id, mentioned_screen_name, 'Name ' || mentioned_user_id as mentioned_name
from tweet_user_mentions where tweet_id in (select id from kept)""")
def _(t: Tables):
    return shred.relation(statuses(t), "tweet_user_mentions")


@job("n_09", f"""
with {SEEN_SQL} select tweet_id, media_id, type, 'http://m/' || media_id as media_url
from tweet_media where tweet_id in (select id from kept) and media_id <> 0""")
def _(t: Tables):
    media = shred.relation(statuses(t), "tweet_media")
    return media.select("tweet_id", "media_id", "type", "media_url")


@job("n_10", """
select id, case when id % 73 <> 0 and id % 13 <> 3 and id % 2 = 0 then full_text end as full_text,
  case when id % 6 = 0 then '{"url":"https://t.example/' || id || '"}' end as permalink from tweets where id % 97 <> 0""")
def _(t: Tables):
    at = lambda path: clean_text(F.get_json_object("value", path))
    return good(t).select(document_id(), at("$.full_text").alias("full_text"), at("$.quoted_status_permalink").alias("permalink"))


@job("n_11", f"""
with {SEEN_SQL}, m as (select distinct mentioned_user_id as id from tweet_user_mentions where tweet_id in (select id from kept)),
u as (select id, screen_name, name from users where id in (select user_id from tweets where id in (select id from kept)))
select id, screen_name, name, false as stub from u
union all select id, 'M' || id, 'Name ' || id, true from m where id not in (select id from u)""")
def _(t: Tables):
    users = shred.relation(statuses(t), "users")
    stubs = shred.mentioned_stubs(shred.mention_rows(statuses(t)), users)
    return users.select("id", "screen_name", "name", F.lit(False).alias("stub")).unionByName(
        stubs.select("id", "screen_name", "name", F.lit(True).alias("stub"))
    )


BUILD_SQL = f"""
with {SEEN_SQL}, u as (select user_id as id from tweets where id in (select id from kept)
  union select mentioned_user_id from tweet_user_mentions where tweet_id in (select id from kept))
select 'users' as relation, count(*) as rows from u
union all select 'places', count(distinct place_id) from tweets where id in (select id from kept)
union all select 'tweets', count(*) from kept
union all select 'hashtags', count(distinct tag) from tweet_hashtag where tweet_id in (select id from kept)
union all select 'tweet_hashtag', count(*) from tweet_hashtag where tweet_id in (select id from kept)
union all select 'tweet_urls', count(*) from tweet_urls where tweet_id in (select id from kept)
union all select 'tweet_user_mentions', count(*) from tweet_user_mentions where tweet_id in (select id from kept)
union all select 'tweet_media', count(*) from tweet_media where tweet_id in (select id from kept) and media_id <> 0"""


@job("n_12", BUILD_SQL + """
union all select 'refused', count(*) from seen s join tweet_media m on m.tweet_id = s.id where media_id = 0""")
def _(t: Tables):
    built, refused = shred.build_relations(statuses(t))
    return integrity.row_counts({**built, "refused": refused})
