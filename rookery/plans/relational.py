"""Registered predicates, joins and aggregates (P-*, J-*, A-*)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.operators import feed, relational as rel, search
from rookery.plans.registry import job
from rookery.views import Tables

STAMP = "yyyy-MM-dd HH:mm:ss"


def stamped(df, *columns):
    for name in columns or ("created_at",):
        df = df.withColumn(name, F.date_format(name, STAMP))
    return df


TWEET_SQL = "t.* replace (strftime(t.created_at, '%Y-%m-%d %H:%M:%S') as created_at)"
BRIEF = ["id", "user_id", "retweet_count", "full_text"]


@job("p_01", "select * from users where screen_name = 'Customer#000000042'")
def _(t: Tables):
    return rel.text_equals(t.users, "screen_name", "Customer#000000042")


@job("p_02", """
select 'narrow' as width, id, followers_count from users where followers_count >= 100 and followers_count <= 200
union all select 'wide', id, followers_count from users where followers_count >= 100 and followers_count <= 1000""")
def _(t: Tables):
    parts = [
        rel.in_range(t.users, "followers_count", 100, high).select(F.lit(width).alias("width"), "id", "followers_count")
        for width, high in (("narrow", 200), ("wide", 1000))
    ]
    return parts[0].unionByName(parts[1])


@job("p_03", f"select {TWEET_SQL} from tweets t where full_text like '%thanedble%'")
def _(t: Tables):
    return stamped(rel.contains(t.tweets, "full_text", "thanedble"))


@job("p_04", "select id, full_text from tweets where full_text like 'Anat with%'")
def _(t: Tables):
    return rel.has_prefix(t.tweets, "full_text", "Anat with").select("id", "full_text")


@job("p_05", """
select id, 'suffix' as form from tweets where full_text ilike '%ERIN.'
union all select id, 'inside' from tweets where full_text ilike '%WORTHLESS%'""")
def _(t: Tables):
    ends = rel.ends_with_ignoring_case(t.tweets, "full_text", "ERIN.").select("id", F.lit("suffix").alias("form"))
    inside = rel.contains_ignoring_case(t.tweets, "full_text", "WORTHLESS").select("id", F.lit("inside").alias("form"))
    return ends.unionByName(inside)


@job("p_06", "select id, retweet_count from tweets where retweet_count <= 10 or retweet_count > 50")
def _(t: Tables):
    return rel.outside_range(t.tweets, "retweet_count", 10, 50).select("id", "retweet_count")


@job("p_07", """
select * from places where id in ('NATION_1','NATION_3','NATION_8','NATION_14') and id is not null
and place_type = 'country' and country_code = 'EU'""")
def _(t: Tables):
    names = ["NATION_1", "NATION_3", "NATION_8", "NATION_14"]
    return rel.one_of(t.places, "id", names, place_type="country", country_code="EU")


@job("p_08", """
select 'selective' as form, * from users where followers_count < 10 and friends_count > 1000
union all select 'unselective', * from users where followers_count < 1000 and friends_count > 1000""")
def _(t: Tables):
    tight = rel.few_followers_many_friends(t.users, 10, 1000).withColumn("form", F.lit("selective"))
    loose = rel.few_followers_many_friends(t.users, 1000, 1000).withColumn("form", F.lit("unselective"))
    return tight.unionByName(loose)


@job("p_09", """
(select 'user' as kind, screen_name as name from users where lower(screen_name) like 'customer#00000001%'
 order by screen_name limit 10)
union all (select 'tag', tag from (select distinct tag from tweet_hashtag) where lower(tag) like 'brand#1%'
 order by tag limit 10)""")
def _(t: Tables):
    users = rel.autocomplete(t.users, "screen_name", "CUSTOMER#00000001").select(
        F.lit("user").alias("kind"), F.col("screen_name").alias("name")
    )
    tags = rel.autocomplete(t.tweet_hashtag.select("tag").distinct(), "tag", "bRand#1").select(
        F.lit("tag").alias("kind"), F.col("tag").alias("name")
    )
    return users.unionByName(tags)


@job("p_10", """
select t.id, strftime(t.created_at, '%Y-%m-%d %H:%M:%S') as created_at from tweets t
where exists (select 1 from tweet_hashtag h where h.tweet_id = t.id and h.tag = 'Brand#7')
order by t.created_at desc, t.id desc limit 20""")
def _(t: Tables):
    posts = rel.tagged_posts(t.tweets.select("id", "created_at"), t.tweet_hashtag)
    return stamped(rel.newest_with_tag(posts, "Brand#7")).select("id", "created_at")


@job("p_11", """
select 'include' as form, id, screen_name, description, null as location from users
union all select 'exclude', id, screen_name, description, location from users""")
def _(t: Tables):
    card = rel.project(t.users, include=["id", "screen_name", "description"])
    rest = rel.project(
        t.users,
        exclude=["name", "verified", "protected", "followers_count", "friends_count", "statuses_count"],
    )
    return card.withColumn("form", F.lit("include")).unionByName(
        rest.withColumn("form", F.lit("exclude")), allowMissingColumns=True
    )


@job("p_12", "select id, case when favorite_count > 250 then 1 else 0 end as popular from tweets")
def _(t: Tables):
    return rel.flag(t.tweets.select("id", "favorite_count"), "popular", F.col("favorite_count") > 250).drop(
        "favorite_count"
    )


_trigrams: dict[tuple, DataFrame] = {}


def trigrams_of(t: Tables) -> DataFrame:
    """The stored trigram postings of the documents, built once per application and data folder as an index would be."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _trigrams:
        _trigrams[key] = search.stage_trigrams(t.spread().documents.select("doc_id", "text"))
    return _trigrams[key]


@job("p_13", "select doc_id, text from documents where text ilike '%gusting%'")
def _(t: Tables):
    docs = t.documents.select("doc_id", "text")
    return search.substring_search(trigrams_of(t), docs, "gusting")


@job("j_01", """
select t.id, t.full_text, u.screen_name, u.followers_count from tweets t join users u on t.user_id = u.id
where u.followers_count > 500 and t.full_text ilike '%disgusting%'""")
def _(t: Tables):
    tweets = rel.contains_ignoring_case(t.tweets, "full_text", "disgusting")
    users = t.users.filter(F.col("followers_count") > 500)
    return rel.tweets_with_authors(tweets, users).select("t.id", "t.full_text", "u.screen_name", "u.followers_count")


@job("j_02", """
select t.id, t.user_id from tweets t left join tweet_hashtag h on h.tweet_id = t.id where h.tweet_id is null""")
def _(t: Tables):
    tagged = t.tweet_hashtag.select(F.col("tweet_id").alias("id"))
    return rel.without_match(t.tweets.select("id", "user_id"), tagged, "id")


@job("j_03", f"""
select distinct on (t.id) {TWEET_SQL} from tweets t join users u on t.user_id = u.id
left join tweet_hashtag th on th.tweet_id = t.id
where u.description ilike '%mach%' and th.tweet_id is null and t.full_text ilike '%worthless%'
and (t.retweet_count <= 10 or t.retweet_count > 50) order by t.id, u.followers_count desc""")
def _(t: Tables):
    return stamped(rel.sceptical_tweets(t.tweets, t.users, t.tweet_hashtag, "mach", "worthless", 10, 50))


@job("j_04", """
select t.id, t.place_id, case when p.id is not null then 1 else 0 end as in_place
from tweets t left join places p on p.id = t.place_id and p.full_name ilike 'nation_3,%'""")
def _(t: Tables):
    place = t.places.filter(F.col("full_name").ilike("nation\\_3,%"))
    return rel.left_join_flag(t.tweets.select("id", "place_id"), place, "place_id", "id", "in_place")


@job("j_05", """
select a.name as left_name, b.name as right_name, a.x as ax, a.y as ay, b.x as bx, b.y as by_
from geo_points a cross join geo_points b
where (a.name = 'Customer#000000007' and b.name = 'Customer#000000070')
or (a.name = 'Customer#000000008' and b.name = 'Customer#000000003')""")
def _(t: Tables):
    pairs = [("Customer#000000007", "Customer#000000070"), ("Customer#000000008", "Customer#000000003")]
    return rel.named_pairs(t.geo_points, t.geo_points, pairs).select(
        "left_name", "right_name", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"),
        F.col("b.x").alias("bx"), F.col("b.y").alias("by_"),
    )


@job("j_07", """
select id, screen_name from users where id in (select follower_id from follows where followee_id in
(select id from users where screen_name in ('Customer#000000000', 'Customer#000000010')))""")
def _(t: Tables):
    stars = rel.one_of(t.users, "screen_name", ["Customer#000000000", "Customer#000000010"])
    followed = rel.with_match(t.follows, stars, "followee_id", "id")
    return rel.with_match(t.users.select("id", "screen_name"), followed, "id", "follower_id")


@job("j_08", """
with c as (select id, text, post_id % 997 as post_id, row_number() over (
  partition by post_id % 997 order by created_at desc, id desc) as rank from comments)
select t.id as post_id, u.screen_name as author, c.rank, c.id as comment_id, c.text as comment_text
from tweets t join users u on u.id = t.user_id left join c on c.post_id = t.id and c.rank <= 3""")
def _(t: Tables):
    comments = t.comments.withColumn("post_id", F.col("post_id") % 997)
    newest = rel.top_per_key(comments, ["post_id"], [F.desc("created_at"), F.desc("id")], 3).select(
        "post_id", "rank", F.col("id").alias("comment_id"), F.col("text").alias("comment_text")
    )
    posts = rel.tweets_with_authors(t.tweets.select("id", "user_id"), t.users).select(
        F.col("t.id").alias("post_id"), F.col("u.screen_name").alias("author")
    )
    return posts.join(newest, "post_id", "left")


@job("a_01", "select count(*) as n from tweets")
def _(t: Tables):
    return t.tweets.agg(F.count("*").alias("n"))


@job("a_02", """
select t.user_id, count(distinct m.mentioned_user_id) as mentioned from tweets t
join tweet_user_mentions m on m.tweet_id = t.id group by t.user_id order by mentioned desc, t.user_id limit 10""")
def _(t: Tables):
    mentions = t.tweet_user_mentions.withColumnRenamed("tweet_id", "id")
    joined = t.tweets.select("id", "user_id").join(mentions, "id")
    return rel.count_distinct_top(joined, "user_id", "mentioned_user_id", "mentioned")


@job("a_03", """
select followee_id, count(distinct follower_id) as followers from follows group by followee_id
having count(distinct follower_id) >= 20""")
def _(t: Tables):
    return rel.groups_with_at_least(t.follows, "followee_id", "follower_id", "followers", 20)


@job("a_04", """
select user_id, max(favorite_count + retweet_count) as best from tweets group by user_id
order by best desc, user_id limit 1""")
def _(t: Tables):
    scored = t.tweets.select("user_id", (F.col("favorite_count") + F.col("retweet_count")).alias("score"))
    return rel.group_with_largest(scored, "user_id", "score", "best")


@job("a_05", "select cast(sum(retweet_count) as bigint) as retweets from tweets")
def _(t: Tables):
    return t.tweets.agg(F.sum("retweet_count").alias("retweets"))


HISTOGRAM_SQL = """
, d as (select date_trunc('day', created_at) as day, count(*) as n, avg(retweet_count) as a from hits group by 1),
g as (select unnest(generate_series(min(day), max(day), interval 1 day)) as day from d)
select strftime(g.day, '%Y-%m-%d') as day, coalesce(n, 0) as doc_count, round(a, 6) as avg_retweets
from g left join d on d.day = g.day"""


def day_rows(df, *averages):
    for name in averages:
        df = df.withColumn(name, F.round(name, 6))
    return df.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@job("a_06", "with hits as (select * from tweets)" + HISTOGRAM_SQL)
def _(t: Tables):
    return day_rows(rel.daily_histogram(t.tweets, "created_at", "retweet_count", "avg_retweets"), "avg_retweets")


@job("a_07", "with hits as (select t.* from tweets t join users u on u.id = t.user_id where "
     "u.location in ('NATION_3', 'NATION_17'))" + HISTOGRAM_SQL)
def _(t: Tables):
    located = search.values_with_phrase(t.users, "location", ["nation_3", "Nation_17"])
    authors = t.users.join(located, "location", "left_semi").select(F.col("id").alias("user_id"))
    hits = t.tweets.join(authors, "user_id", "left_semi")
    return day_rows(rel.daily_histogram(hits, "created_at", "retweet_count", "avg_retweets"), "avg_retweets")


@job("a_08", """
with h as (select t.*, u.location in ('NATION_3', 'NATION_17') as hit from tweets t join users u on u.id = t.user_id),
d as (select date_trunc('day', created_at) as day, count(*) as n, avg(retweet_count) as a,
  count(*) filter (where hit) as sn, avg(retweet_count) filter (where hit) as sa from h group by 1),
g as (select unnest(generate_series(min(day), max(day), interval 1 day)) as day from d)
select strftime(g.day, '%Y-%m-%d') as day, coalesce(n, 0) as global_count, round(a, 6) as global_avg,
  coalesce(sn, 0) as subset_count, round(sa, 6) as subset_avg from g left join d on d.day = g.day""")
def _(t: Tables):
    located = search.values_with_phrase(t.users, "location", ["nation_3", "Nation_17"])
    authors = rel.left_join_flag(t.users, located, "location", "location", "in_subset").select(
        F.col("id").alias("user_id"), "in_subset"
    )
    flagged = t.tweets.select("user_id", "created_at", "retweet_count").join(authors, "user_id")
    days = rel.daily_subset_against_all(flagged, "created_at", "retweet_count", F.col("in_subset") == 1)
    return day_rows(days, "global_avg", "subset_avg")


@job("a_09", "select tag, count(*) as posts from tweet_hashtag group by tag")
def _(t: Tables):
    return rel.posts_per_tag(t.tweet_hashtag)


A_10_USERS = """
select 'user' as entity, u.id, coalesce(p.n, 0) as posts_count, coalesce(f.n, 0) as followers_count,
  coalesce(g.n, 0) as following_count, cast(null as bigint) as comments_count, cast(null as bigint) as likes_count
from users u left join (select user_id, count(*) as n from tweets group by 1) p on p.user_id = u.id
left join (select followee_id, count(*) as n from follows group by 1) f on f.followee_id = u.id
left join (select follower_id, count(*) as n from follows group by 1) g on g.follower_id = u.id"""
A_10_POSTS = """
select 'post' as entity, t.id, cast(null as bigint) as posts_count, cast(null as bigint) as followers_count,
  cast(null as bigint) as following_count, coalesce(c.n, 0) as comments_count, coalesce(r.n, 0) as likes_count
from tweets t left join (select post_id, count(*) as n from comments group by 1) c on c.post_id = t.id
left join (select target_id, count(*) as n from reactions where type = 'like' group by 1) r on r.target_id = t.id"""


@job("a_10", f"{A_10_USERS} union all {A_10_POSTS}")
def _(t: Tables):
    users = feed.user_counters(t.users.select("id"), t.tweets, t.follows).withColumn("entity", F.lit("user"))
    posts = feed.post_counters(t.tweets.select("id"), t.comments, t.reactions).withColumn("entity", F.lit("post"))
    return users.unionByName(posts, allowMissingColumns=True)


@job("a_11", """
select id, round(retweet_count / 7e0 + favorite_count / 3e0, 2) as popularity from tweets""")
def _(t: Tables):
    score = F.col("retweet_count") / F.lit(7.0) + F.col("favorite_count") / F.lit(3.0)
    return rel.ranked_by(t.tweets, "popularity", score, 2, "id").select("id", "popularity")


@job("a_12", """
select id, name from geo_points order by (x - 19e0)*(x - 19e0) + (y - 48e0)*(y - 48e0), id limit 1""")
def _(t: Tables):
    dx, dy = F.col("x") - 19.0, F.col("y") - 48.0
    return rel.smallest_by(t.geo_points, dx * dx + dy * dy, "id").select("id", "name")


@job("a_13", """
select user_id, rank, id as post_id from (select id, user_id,
  row_number() over (partition by user_id order by created_at desc, id desc) as rank from tweets) z where rank <= 10""")
def _(t: Tables):
    arrays = rel.newest_arrays(t.tweets, "user_id", 10, ["id"], "posts")
    return arrays.select("user_id", F.inline("posts")).withColumnRenamed("id", "post_id")


@job("a_14", """
select id, post_id, text, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at from (
select * from comments where created_at > timestamp '2024-01-11 06:00:00' order by created_at, id limit 10) z""")
def _(t: Tables):
    page = rel.page_after(t.comments, "2024-01-11 06:00:00")
    return stamped(page.select("id", "post_id", "text", "created_at"))


@job("a_16", f"""
with u as ({A_10_USERS}), p as ({A_10_POSTS})
select * from (select 'post' as kind, id, likes_count as score from p order by 3 desc, 2 limit 10) a
union all select * from (select 'user', id, followers_count from u order by 3 desc, 2 limit 10) b""")
def _(t: Tables):
    posts = feed.post_counters(t.tweets.select("id"), t.comments, t.reactions)
    users = feed.user_counters(t.users.select("id"), t.tweets, t.follows)
    return feed.most_popular(posts, "likes_count", "post", 10).unionByName(
        feed.most_popular(users, "followers_count", "user", 10)
    )
