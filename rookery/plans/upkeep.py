"""Registered table upkeep, integrity reports and graph patterns (K-*, Q-*, R-*)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from rookery.functions.scalar import hashtag_id
from rookery.operators import feed, graph, integrity, merge
from rookery.operators import relational as rel
from rookery.plans.registry import job
from rookery.plans.relational import STAMP, stamped
from rookery.views import Tables
from rookery.workspace import fresh_folder

TAG_ID_SQL = "cast(cast('0x' || substr(sha256(tag), 49, 16) as ubigint) % 9223372036854775808 as bigint)"


def relations(t: Tables) -> dict:
    tags = t.tweet_hashtag.select("tag").distinct()
    return {
        "users": t.users,
        "places": t.places,
        "tweets": t.tweets,
        "hashtags": tags.select(hashtag_id(F.col("tag")).alias("id"), "tag"),
        "tweet_hashtag": t.tweet_hashtag.select("tweet_id", hashtag_id(F.col("tag")).alias("hashtag_id")),
        "tweet_urls": t.tweet_urls,
        "tweet_user_mentions": t.tweet_user_mentions,
        "tweet_media": t.tweet_media,
    }


NAMES = ["users", "places", "tweets", "tweet_hashtag", "tweet_urls", "tweet_user_mentions", "tweet_media"]
COUNTS_SQL = " union all ".join(
    [f"select '{n}' as relation, count(*) as rows from {n}" for n in NAMES]
    + ["select 'hashtags', count(distinct tag) from tweet_hashtag"]
)


@job("k_01", COUNTS_SQL)
def _(t: Tables):
    stored = merge.write_relations(relations(t), fresh_folder(t.spark, "relations"))
    return integrity.row_counts(stored)


@job("k_02", """
select id, screen_name, id % 3 <> 0 as inserted from users""")
def _(t: Tables):
    target = t.users.filter(F.col("id") % 3 == 0).select("id", "screen_name")
    first = t.users.select("id", "screen_name", F.lit(0).alias("load"))
    again = first.select("id", F.lit("later name").alias("screen_name"), F.lit(1).alias("load"))
    fresh = merge.insert_if_absent(target, first.unionByName(again), ["id"], ["load"])
    return target.withColumn("inserted", F.lit(False)).unionByName(
        fresh.select("id", "screen_name", F.lit(True).alias("inserted"))
    )


@job("k_02_report", """
select count(*) * 2 as offered, count(case when id % 3 <> 0 then 1 end) as inserted,
  count(case when id % 3 <> 0 then 1 end) as repeated, count(case when id % 3 = 0 then 1 end) * 2 as present,
  cast(0 as bigint) as refused from users""")
def _(t: Tables):
    target = t.users.filter(F.col("id") % 3 == 0).select("id")
    return merge.insert_report(target, t.users.select("id").unionByName(t.users.select("id")), ["id"])


@job("k_03", """
select relation, rows, phase from (select 'users' as relation, count(*) as rows, 'before' as phase from users
union all select 'places', count(*), 'before' from places
union all select 'users', 0, 'after' union all select 'places', 0, 'after') z""")
def _(t: Tables):
    folder = fresh_folder(t.spark, "truncate")
    stored = merge.write_relations({"users": t.users, "places": t.places}, folder)
    counts = {n: df.count() for n, df in stored.items()}
    empty = merge.truncate_tables(t.spark, folder, {n: df.schema for n, df in stored.items()})
    before = [t.spark.range(1).select(F.lit(n).alias("relation"), F.lit(c).cast("bigint").alias("rows")) for n, c in counts.items()]
    return before[0].unionByName(before[1]).withColumn("phase", F.lit("before")).unionByName(
        integrity.row_counts(empty).withColumn("phase", F.lit("after"))
    )


@job("k_04", """
select id, post_id, text, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at from comments
union all select -2, 7, 'first', '2024-02-01 00:00:00' union all select -10, 8, 'second', '2024-02-01 00:00:00'""")
def _(t: Tables):
    comments = t.comments.select("id", "post_id", "text", "created_at")
    rows = [{"id": -2, "post_id": 7, "text": "first"}, {"id": -10, "post_id": 8, "text": "second"}]
    return stamped(merge.append_rows(comments, rows, dt.datetime(2024, 2, 1)))


@job("k_05", """
select u.description, count(*) as tweets from users u join tweets t on t.user_id = u.id where u.verified
group by u.description""")
def _(t: Tables):
    verified = merge.named_stage(t.users.filter("verified").select("id", "description"), "verified_users")
    joined = t.tweets.select(F.col("user_id").alias("id")).join(verified, "id")
    per_kind = merge.named_stage(joined, "verified_posts", persist=False)
    return per_kind.groupBy("description").agg(F.count("*").alias("tweets"))


CHANGES_SQL = """
select (event_id*7) % 1500 as id, event_id as seq,
  case event_type when 'error' then 'delete' when 'purchase' then 'create' else 'update' end as op,
  case when event_type in ('click','purchase','signup') then event_id % 100 end as retweet_count,
  case when event_type in ('view','purchase','signup') then (event_id*3) % 50 end as favorite_count from events"""


@job("k_06", f"""
with ch as ({CHANGES_SQL}),
r as (select id, max(seq) filter (where op <> 'update') as rs, arg_max(op, seq) filter (where op <> 'update') as ro,
  count(*) as v from ch group by id),
l as (select ch.id, arg_max(ch.retweet_count, ch.seq) filter (where ch.retweet_count is not null) as rt,
  arg_max(ch.favorite_count, ch.seq) filter (where ch.favorite_count is not null) as fv
  from ch join r on r.id = ch.id where r.rs is null or ch.seq >= r.rs group by 1),
b as (select id, retweet_count, favorite_count from tweets)
select coalesce(b.id, r.id) as id, coalesce(rt, case when ro is null then retweet_count end) as retweet_count,
  coalesce(fv, case when ro is null then favorite_count end) as favorite_count, coalesce(v, 0) as version
from b full outer join r on r.id = b.id left join l on l.id = r.id
where (ro is null and b.id is not null) or ro = 'create'""")
def _(t: Tables):
    changes = t.spark.sql(CHANGES_SQL.replace("from events", "from {events}"), events=t.events)
    base = t.tweets.select("id", "retweet_count", "favorite_count")
    return merge.apply_changes(base, changes, "id", ["retweet_count", "favorite_count"])


@job("k_07", """
select v.id, screen_name, followers_count from (values (3::bigint), (42::bigint), (-5::bigint), (77::bigint)) v(id)
left join users u on u.id = v.id""")
def _(t: Tables):
    return feed.lookup(t.users.select("id", "screen_name", "followers_count"), [3, 42, -5, 77])


@job("k_08", "select id, followers_count, friends_count, statuses_count from users "
     "where followers_count < 10 and friends_count > 1000")
def _(t: Tables):
    columns = ["followers_count", "friends_count", "statuses_count"]
    stored = merge.write_interleaved(t.users.select("id", *columns), *columns[:2])
    return rel.few_followers_many_friends(stored, 10, 1000)


# ---- integrity ------------------------------------------------------------------------------------------------------
@job("q_01", COUNTS_SQL)
def _(t: Tables):
    return integrity.row_counts(relations(t))


def _missing_sql(name, source, column, target, key="id"):
    return (
        f"select '{name}' as reference, count(*) as missing from {source} s left join {target} g on g.{key} = s.{column} "
        f"where s.{column} is not null and g.{key} is null"
    )


@job("q_02", "with ht as (select distinct tag from tweet_hashtag where tag <> 'Brand#7') " + " union all ".join([
    _missing_sql("reply", "tweets", "in_reply_to_status_id", "tweets"),
    _missing_sql("quote", "tweets", "quoted_status_id", "tweets"),
    _missing_sql("retweet", "tweets", "retweeted_status_id", "tweets"),
    _missing_sql("tweet_user", "tweets", "user_id", "users"),
    _missing_sql("mention_tweet", "tweet_user_mentions", "tweet_id", "tweets"),
    _missing_sql("url_tweet", "tweet_urls", "tweet_id", "tweets"),
    _missing_sql("media_tweet", "tweet_media", "tweet_id", "tweets"),
    _missing_sql("tag_tweet", "tweet_hashtag", "tweet_id", "tweets"),
    _missing_sql("tag_hashtag", "tweet_hashtag", "tag", "ht", "tag"),
]))
def _(t: Tables):
    stored = relations(t)
    return integrity.missing_references({**stored, "hashtags": stored["hashtags"].filter(F.col("tag") != "Brand#7")})


Q_03_COLUMNS = ["user_id", "place_id", "in_reply_to_status_id", "quoted_status_id", "retweeted_status_id"]


@job("q_03", " union all ".join(
    f"select '{c}' as column_name, count(*) - count({c}) as nulls from tweets" for c in Q_03_COLUMNS
))
def _(t: Tables):
    return integrity.null_counts(t.tweets, Q_03_COLUMNS)


def _keys_sql(relation, columns):
    listed = ", ".join(columns)
    return (
        f"select '{relation}' as relation, '{'+'.join(columns)}' as key_columns, count(*) as repeated_keys, "
        f"cast(coalesce(sum(n), 0) as bigint) as rows_involved from (select count(*) as n from {relation} "
        f"group by {listed} having count(*) > 1) z"
    )


KEYS = {
    "users": ["id"], "tweets": ["id"], "tweet_user_mentions": ["tweet_id", "mentioned_user_id"],
    "tweet_urls": ["tweet_id"], "tweet_media": ["media_id"], "follows": ["follower_id", "followee_id"],
}


@job("q_04", " union all ".join(_keys_sql(n, c) for n, c in KEYS.items()))
def _(t: Tables):
    return integrity.key_report({n: getattr(t, n) for n in KEYS}, KEYS)


TYPED_SQL = """
typed as (select t.id, t.user_id as author_id, t.created_at,
  case t.id % 3 when 0 then 'image' when 1 then 'text' else 'video' end as type,
  case when t.id % 3 = 1 then full_text end as text, case when t.id % 3 = 0 then link end as image_url,
  case when t.id % 3 = 0 then tag end as caption, case when t.id % 3 = 2 then link end as video_url,
  case when t.id % 3 = 2 then favorite_count end as duration
  from tweets t left join (select tweet_id, min(url) as link from tweet_urls group by 1) l on l.tweet_id = t.id
  left join (select tweet_id, min(tag) as tag from tweet_hashtag group by 1) h on h.tweet_id = t.id)"""


@job("q_05", f"""
with {TYPED_SQL}
select 'Reactions' as collection, 'type: allowed values' as rule, count(*) filter (where type <> 'like') as violations
from reactions
union all select 'Reactions', 'user_id: required', count(*) - count(user_id) from reactions
union all select 'Comments', 'post_id: required', count(*) - count(post_id) from comments
union all select 'Comments', 'text: allowed values', count(*) filter (where text <> 'click') from comments
union all select 'Posts', 'created_at: required', count(*) - count(created_at) from typed
union all select 'Posts', 'type: allowed values', count(*) filter (where type not in ('text', 'image')) from typed
union all select 'Posts', 'image_url: required for image', count(*) filter (where type = 'image' and image_url is null) from typed
union all select 'Posts', 'text: required for text', count(*) filter (where type = 'text' and text is null) from typed
union all select 'Posts', 'text: string', 0 from (select 1) a
union all select 'Users', 'location: array', count(*) from users""")
def _(t: Tables):
    posts = feed.typed_posts(t.tweets, t.tweet_urls, t.tweet_hashtag)
    return integrity.rule_report({
        "Reactions": (t.reactions, [integrity.allowed("type", ["like"]), *integrity.required("user_id")]),
        "Comments": (t.comments, [*integrity.required("post_id"), integrity.allowed("text", ["click"])]),
        "Posts": (posts, [
            *integrity.required("created_at"), integrity.allowed("type", ["text", "image"]),
            integrity.required_for("image", "image_url"), integrity.required_for("text", "text"),
            *integrity.typed(posts.schema, {"text": "string"}),
        ]),
        "Users": (t.users, integrity.typed(t.users.schema, {"location": "array"})),
    })


# ---- graph ----------------------------------------------------------------------------------------------------------
@job("r_01", """
select 'account' as kind, id from users where screen_name = 'Customer#000000007'
union all select 'tweet', id from tweets where id = 1234""")
def _(t: Tables):
    accounts = graph.find_accounts(t.users, "Customer#000000007").select(F.lit("account").alias("kind"), "id")
    return accounts.unionByName(t.tweets.filter(F.col("id") == 1234).select(F.lit("tweet").alias("kind"), "id"))


@job("r_02", """
select 'total' as part, 'FOLLOWS' as type, null as src, null as dst, count(*) + 1 as n from follows
union all select 'total', 'POSTS', null, null, count(*) + 1 from tweets
union all select 'total', 'RETWEETS', null, null, count(*) + 1 from tweets where retweeted_status_id is not null
union all select 'subgraph', 'FOLLOWS', 'account:test', 'account:7', 1
union all select 'subgraph', 'POSTS', 'account:test', 'tweet:rt_1234', 1
union all select 'subgraph', 'RETWEETS', 'tweet:rt_1234', 'tweet:1234', 1""")
def _(t: Tables):
    vertices, edges = graph.graph_frames(t.users, t.tweets, t.follows)
    added = graph.literal_graph(
        t.spark,
        vertices=[("Account", "account:test", "visitor"), ("Tweet", "tweet:rt_1234", None)],
        edges=[
            ("account:test", "FOLLOWS", "account:7"), ("account:test", "POSTS", "tweet:rt_1234"),
            ("tweet:rt_1234", "RETWEETS", "tweet:1234"), ("account:test", "FOLLOWS", "account:nobody"),
        ],
    )
    once = graph.merge_graph(vertices, edges, *added)
    _, twice = graph.merge_graph(*once, *added)
    totals = twice.groupBy("type").agg(F.count("*").alias("n")).withColumn("part", F.lit("total"))
    around = graph.neighbourhood(twice, "account:test", "tweet:rt_1234").withColumn("part", F.lit("subgraph"))
    return totals.unionByName(around.withColumn("n", F.lit(1).cast("bigint")), allowMissingColumns=True)


@job("r_03", """
select a.screen_name, count(distinct r.user_id) as retweeting_accounts
from tweets r join tweets o on o.id = r.retweeted_status_id join users a on a.id = o.user_id
where o.user_id <> r.user_id group by a.id, a.screen_name order by retweeting_accounts desc, a.screen_name limit 10""")
def _(t: Tables):
    return graph.most_retweeted_authors(t.tweets, t.users)


@job("r_04", """
with f as (select followee_id, count(distinct follower_id) as followers from follows group by 1 having followers >= 20)
select u.screen_name, count(*) as non_retweeted_tweets, f.followers
from f join users u on u.id = f.followee_id join tweets t on t.user_id = u.id
where not exists (select 1 from tweets r where r.retweeted_status_id = t.id)
group by u.screen_name, f.followers order by non_retweeted_tweets desc, u.screen_name limit 20""")
def _(t: Tables):
    return graph.popular_without_retweets(t.tweets, t.users, t.follows)
