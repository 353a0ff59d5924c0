"""Registered feed jobs (F-*)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.operators import feed
from rookery.plans.registry import job
from rookery.plans.relational import stamped
from rookery.plans.upkeep import TYPED_SQL
from rookery.views import Tables
from rookery.workspace import stage


def busy_comments(t: Tables):
    """The comments gathered on fewer posts, so that newest-N has something to cut."""
    return t.comments.withColumn("post_id", F.col("post_id") % 997)


BUSY_SQL = "busy as (select id, post_id % 997 as post_id, author_id, text, created_at from comments)"
RANK = "row_number() over (partition by user_id order by created_at desc, post_id desc) as rank"
ITEMS_SQL = """items as (select f.follower_id as user_id, t.id as post_id, t.created_at, u.screen_name as username,
  t.user_id as author_id from follows f join tweets t on t.user_id = f.followee_id join users u on u.id = t.user_id)"""


def cards(t: Tables):
    return feed.post_cards(t.tweets, t.users)


@job("f_01", f"""
with {ITEMS_SQL}, ranked as (select *, {RANK} from items)
select user_id, rank, post_id, username, coalesce(l.n, 0) as likes_count, coalesce(c.n, 0) as comments_count
from ranked left join (select target_id, count(*) as n from reactions group by 1) l on l.target_id = post_id
left join (select post_id as p, count(*) as n from comments group by 1) c on c.p = post_id where rank <= 50""")
def _(t: Tables):
    # the feeds are cut from ids and times; names and counters join what is left
    thin = t.tweets.select(F.col("id").alias("post_id"), F.col("user_id").alias("author_id"), "created_at")
    thin = thin.join(t.users.select(F.col("id").alias("author_id")), "author_id", "left_semi")
    entries = feed.attach_cards(feed.build_feeds(thin, t.follows), t.users, t.comments, t.reactions)
    return entries.select("user_id", "rank", "post_id", "username", "likes_count", "comments_count")


@job("f_02", """
select user_id, rank, post_id from (select user_id, id as post_id,
  row_number() over (partition by user_id order by created_at desc, id desc) as rank from tweets) z where rank <= 10""")
def _(t: Tables):
    return feed.own_posts(cards(t)).select("user_id", "rank", "post_id")


@job("f_03", f"""
with {BUSY_SQL}, z as (select *, row_number() over (partition by post_id order by created_at desc, id desc) as rank
from busy) select post_id, rank, z.id, text, u.screen_name as username from z left join users u on u.id = z.author_id
where rank <= 3""")
def _(t: Tables):
    return feed.newest_comments(busy_comments(t), t.users).select("post_id", "rank", "id", "text", "username")


SPLIT = "2024-01-20 00:00:00"


@job("f_04", f"""
with {BUSY_SQL}, {ITEMS_SQL}, ranked as (select *, {RANK} from items),
z as (select *, row_number() over (partition by post_id order by created_at desc, id desc) as crank from busy),
c as (select post_id as p, count(*) as n, string_agg(cast(id as varchar), '|' order by crank) filter (where crank <= 3)
  as newest from z group by 1)
select user_id, rank, post_id, coalesce(n, 0) as comments_count, newest as newest_comments
from ranked left join c on c.p = post_id where rank <= 50""")
def _(t: Tables):
    comments = busy_comments(t)
    old = comments.filter(F.col("created_at") < F.lit(SPLIT))
    new = comments.filter(F.col("created_at") >= F.lit(SPLIT))
    entries = feed.attach_comments(feed.build_feeds(cards(t), t.follows), feed.comment_summary(old))
    after = feed.apply_comments(entries, new)
    ids = F.array_join(F.transform("newest_comments", lambda c: c["id"].cast("string")), "|")
    return after.select("user_id", "rank", "post_id", "comments_count", ids.alias("newest_comments"))


@job("f_05", f"""
with {ITEMS_SQL}, ranked as (select *, {RANK} from items),
own as (select user_id, id as post_id, created_at from tweets), oranked as (select *, {RANK} from own)
select 'feed' as kind, user_id, rank, post_id from ranked where rank <= 50
union all select 'own', user_id, rank, post_id from oranked where rank <= 10
union all select 'count', u.id, 0, count(t.id) from users u left join tweets t on t.user_id = u.id group by u.id""")
def _(t: Tables):
    fresh = F.col("id") % 4 == 1
    old, new = t.tweets.filter(~fresh), t.tweets.filter(fresh)
    old_cards, new_cards = feed.post_cards(old, t.users), feed.post_cards(new, t.users)
    columns = ["kind", "user_id", "rank", "post_id"]
    feeds = feed.apply_posts(feed.build_feeds(old_cards, t.follows), new_cards, t.follows)
    own = feed.apply_own_posts(feed.own_posts(old_cards), new_cards)
    counts = feed.add_counts(
        feed.user_counters(t.users.select("id"), old, t.follows), new, "user_id", "posts_count"
    ).select(F.col("id").alias("user_id"), F.lit(0).alias("rank"), F.col("posts_count").alias("post_id"))
    return (
        feeds.withColumn("kind", F.lit("feed")).select(*columns)
        .unionByName(own.withColumn("kind", F.lit("own")).select(*columns))
        .unionByName(counts.withColumn("kind", F.lit("count")).select(*columns))
    )


@job("f_06", f"""
with old as (select * from follows where (follower_id + followee_id) % 11 <> 0),
added as (select * from follows where (follower_id + followee_id) % 11 = 0),
gone as (select * from old where (follower_id + 2*followee_id) % 13 = 0),
rest as (select * from old where (follower_id + 2*followee_id) % 13 <> 0),
posts as (select id as post_id, user_id as author_id, created_at,
  row_number() over (partition by user_id order by created_at desc, id desc) as prank from tweets),
base as (select follower_id as user_id, post_id, created_at from rest join posts on author_id = followee_id),
cut as (select * from (select *, {RANK} from base) z where rank <= 50),
everything as (select user_id, post_id, created_at from cut union all
  select follower_id, post_id, created_at from added join posts on author_id = followee_id where prank <= 10),
net as (select * from rest union all select * from added)
select 'feed' as kind, user_id, rank, post_id from (select *, {RANK} from everything) z where rank <= 50
union all select 'followers', u.id, 0, count(n.followee_id) from users u left join net n on n.followee_id = u.id group by u.id
union all select 'following', u.id, 0, count(n.followee_id) from users u left join net n on n.follower_id = u.id group by u.id
""")
def _(t: Tables):
    mix = F.col("follower_id") + F.col("followee_id")
    old, added = t.follows.filter(mix % 11 != 0), t.follows.filter(mix % 11 == 0)
    removed = old.filter((mix + F.col("followee_id")) % 13 == 0)
    entries = feed.build_feeds(cards(t), old)
    # the log: every change, some of them repeated, and unfollows that are taken back or come after a follow that is not kept
    def logged(pairs: DataFrame, op: str, seq: int) -> DataFrame:
        return pairs.select("follower_id", "followee_id", F.lit(op).alias("op"), F.lit(seq).alias("seq"))

    wavering = old.filter((mix % 7 == 0) & ((mix + F.col("followee_id")) % 13 != 0))
    never = added.select(F.col("followee_id").alias("follower_id"), F.col("follower_id").alias("followee_id")).join(
        t.follows.select("follower_id", "followee_id"), ["follower_id", "followee_id"], "left_anti"
    )
    log = [(added, "follow", 1), (added, "follow", 5), (removed, "unfollow", 2), (wavering, "unfollow", 3), (wavering, "follow", 4),
           (never, "follow", 6), (never, "unfollow", 7)]
    added, removed = feed.net_changes(reduce(DataFrame.unionByName, [logged(*entry) for entry in log]), old)
    after = feed.apply_follow_changes(entries, cards(t), old, added, removed)
    counted = feed.apply_follow_counts(
        feed.user_counters(t.users.select("id"), t.tweets, old), old, added, removed
    )
    out = after.select(F.lit("feed").alias("kind"), "user_id", "rank", "post_id")
    for kind in ("followers", "following"):
        out = out.unionByName(counted.select(
            F.lit(kind).alias("kind"), F.col("id").alias("user_id"), F.lit(0).alias("rank"),
            F.col(f"{kind}_count").alias("post_id"),
        ))
    return out


@job("f_07", """
with r as (select *, case when id % 4 = 0 then 'comment' else 'post' end as kind from reactions),
n as (select kind, target_id, count(*) as n from r where type = 'like' group by 1, 2),
e as (select 'post' as kind, id from tweets union all select 'comment', id from comments)
select e.kind, e.id, coalesce(n.n, 0) as likes_count from e left join n on n.kind = e.kind and n.target_id = e.id""")
def _(t: Tables):
    kinded = t.reactions.withColumn("target_kind", F.when(F.col("id") % 4 == 0, "comment").otherwise("post"))
    entities = t.tweets.select(F.lit("post").alias("kind"), "id").unionByName(
        t.comments.select(F.lit("comment").alias("kind"), "id")
    ).withColumn("likes_count", F.lit(0).cast("bigint"))
    early = F.col("created_at") < F.lit(SPLIT)
    return feed.apply_reactions(feed.apply_reactions(entities, kinded.filter(early)), kinded.filter(~early))


@job("f_08", f"""
with {ITEMS_SQL}, ranked as (select *, {RANK} from items)
select v.user_id, rank, post_id, username from (values (3::bigint), (18::bigint), (-1::bigint), (700::bigint)) v(user_id)
left join ranked r on r.user_id = v.user_id and rank <= 50""")
def _(t: Tables):
    ids = [3, 18, -1, 700]
    # a set of users needs only their own follow edges
    edges = t.follows.filter(F.col("follower_id").isin(*ids))
    entries = feed.build_feeds(cards(t), edges).select("user_id", "rank", "post_id", "username")
    return feed.lookup(entries, ids, "user_id")


@job("f_09", f"""
with {BUSY_SQL}, page as (select *, row_number() over (partition by post_id order by created_at, id) as rank from busy
  where created_at > timestamp '2024-01-05 00:00:00')
select v.id, u.screen_name, u.description, u.followers_count, p.rank, p.id as comment_id, p.text as comment_text
from (values (5::bigint), (12::bigint), (600::bigint), (-4::bigint)) v(id) left join tweets t on t.id = v.id
left join users u on u.id = t.user_id left join page p on p.post_id = v.id and p.rank <= 10""")
def _(t: Tables):
    page = feed.post_pages(t.tweets, t.users, busy_comments(t), [5, 12, 600, -4], "2024-01-05 00:00:00")
    return page.select("id", "screen_name", "description", "followers_count", "rank", "comment_id", "comment_text")


@job("f_10", """
with p as (select *, row_number() over (partition by user_id order by created_at desc, id desc) as rank from tweets)
select v.id, u.screen_name, u.description,
  (select count(*) from tweets t where t.user_id = v.id) as posts_count,
  (select count(*) from follows f where f.followee_id = v.id) as followers_count,
  (select count(*) from follows f where f.follower_id = v.id) as following_count, p.rank, p.id as post_id
from (values (4::bigint), (90::bigint), (-9::bigint)) v(id) left join users u on u.id = v.id
left join p on p.user_id = v.id and p.rank <= 10""")
def _(t: Tables):
    out = feed.profiles(t.users, t.tweets, t.follows, [4, 90, -9])
    return out.drop("created_at")


@job("f_11", f"""
with {TYPED_SQL}
select id, author_id, strftime(created_at, '%Y-%m-%d %H:%M:%S') as created_at, type, text, image_url, caption,
  video_url, duration from typed""")
def _(t: Tables):
    # the tweets carry the number of their text through all joins
    texts = stage(t.documents.select("doc_id", "lang", F.monotonically_increasing_id().alias("text_id"), F.col("text").alias("body")), "texts")
    thin = t.replacing("documents", texts.select("doc_id", "lang", F.when(F.col("body").isNotNull(), F.col("text_id")).alias("text")))
    posts = feed.typed_posts(thin.tweets, t.tweet_urls, t.tweet_hashtag)
    return stamped(feed.with_texts(posts, texts.select("text_id", "body")))
