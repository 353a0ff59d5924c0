"""Denormalised feeds: counters, own and followed newest posts, and their incremental upkeep.

A feed is kept as one row per (user, rank) so that no task ever holds more than a bounded array. Posts are cut to the
newest N per author before the follow join, which bounds the fan-out of each follow edge; the per-follower cut is a
``row_number`` filter that Spark also applies before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.operators.relational import best_per_key, top_per_key
from rookery.workspace import literal_table

FEED_SIZE = 50
OWN_SIZE = 10
COMMENTS_SIZE = 3
EDGES_PER_TASK = 25_000  # of follows, each of which brings at most the feed's size of posts
POSTS_PER_TASK = 500_000


def _newest(*columns: str):
    return [F.desc(c) for c in columns]


def counts_by(df: DataFrame, key: str, identity: str, name: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(identity)).agg(F.count("*").alias(name))


def _with_counts(entities: DataFrame, counts: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    for frame, name in counts:
        entities = entities.join(frame, "id", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return entities


def user_counters(users: DataFrame, posts: DataFrame, follows: DataFrame) -> DataFrame:
    """Posts, followers and following per user, recomputed in full."""
    return _with_counts(users, [
        (counts_by(posts, "user_id", "id", "posts_count"), "posts_count"),
        (counts_by(follows, "followee_id", "id", "followers_count"), "followers_count"),
        (counts_by(follows, "follower_id", "id", "following_count"), "following_count"),
    ])


def post_counters(posts: DataFrame, comments: DataFrame, reactions: DataFrame) -> DataFrame:
    """Comments and likes per post, recomputed in full."""
    likes = reactions.filter(F.col("type") == "like")
    return _with_counts(posts, [
        (counts_by(comments, "post_id", "id", "comments_count"), "comments_count"),
        (counts_by(likes, "target_id", "id", "likes_count"), "likes_count"),
    ])


def most_popular(entities: DataFrame, counter: str, kind: str, limit: int) -> DataFrame:
    return (
        entities.orderBy(F.desc(counter), "id").limit(limit)
        .select(F.lit(kind).alias("kind"), "id", F.col(counter).alias("score"))
    )


def post_cards(posts: DataFrame, users: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """What a feed entry shows of a post: author card, time and any counters it carries."""
    authors = users.select(F.col("id").alias("author_id"), F.col("screen_name").alias("username"))
    cards = posts.select(F.col("id").alias("post_id"), F.col("user_id").alias("author_id"), "created_at", *extra)
    return cards.join(authors, "author_id")


def newest_per_author(cards: DataFrame, n: int) -> DataFrame:
    return top_per_key(cards, ["author_id"], _newest("created_at", "post_id"), n).drop("rank")


def own_posts(cards: DataFrame, n: int = OWN_SIZE) -> DataFrame:
    """Every author's newest posts, ranked."""
    return top_per_key(cards, ["author_id"], _newest("created_at", "post_id"), n).withColumnRenamed(
        "author_id", "user_id"
    )


def _rank_feed(entries: DataFrame, n: int) -> DataFrame:
    return top_per_key(entries, ["user_id"], _newest("created_at", "post_id"), n)


def deliver(cards: DataFrame, follows: DataFrame) -> DataFrame:
    """One candidate entry per (follower, post); both sides of the pair are unique, so no entry repeats."""
    edges = follows.select(F.col("follower_id").alias("user_id"), F.col("followee_id").alias("author_id"))
    return edges.join(cards, "author_id")


def build_feeds(cards: DataFrame, follows: DataFrame, n: int = FEED_SIZE) -> DataFrame:
    """Every user's feed from scratch."""
    return _rank_feed(deliver(newest_per_author(cards, n), follows), n)


def attach_cards(entries: DataFrame, users: DataFrame, comments: DataFrame, reactions: DataFrame) -> DataFrame:
    """Entries with their author's name and their post's counters; entries of unknown authors are left out."""
    authors = users.select(F.col("id").alias("author_id"), F.col("screen_name").alias("username"))
    likes = counts_by(reactions.filter(F.col("type") == "like"), "target_id", "post_id", "likes_count")
    named = entries.join(authors, "author_id")
    for counts, name in ((likes, "likes_count"), (counts_by(comments, "post_id", "post_id", "comments_count"), "comments_count")):
        named = named.join(counts, "post_id", "left").withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return named


def pack_feeds(entries: DataFrame, columns: Sequence[str], name: str = "latest_posts_followed") -> DataFrame:
    """The document form: one row per user with a bounded array."""
    packed = F.array_sort(F.collect_list(F.struct("rank", *columns)))
    return entries.groupBy("user_id").agg(packed.alias(name))


def newest_comments(comments: DataFrame, users: DataFrame, n: int = COMMENTS_SIZE) -> DataFrame:
    """Newest comments per post with the commenter's name; unknown commenters keep a NULL name."""
    kept = top_per_key(comments, ["post_id"], _newest("created_at", "id"), n)
    names = users.select(F.col("id").alias("author_id"), F.col("screen_name").alias("username"))
    return kept.join(names, "author_id", "left")


def comment_summary(comments: DataFrame, n: int = COMMENTS_SIZE) -> DataFrame:
    """Per post: comment count and the newest comments as a bounded array, newest first."""
    counts = comments.groupBy("post_id").agg(F.count("*").alias("comments_count"))
    kept = top_per_key(comments, ["post_id"], _newest("created_at", "id"), n)
    item = F.struct("created_at", "id", "text", "author_id")
    arrays = kept.groupBy("post_id").agg(F.sort_array(F.collect_list(item), asc=False).alias("newest_comments"))
    return counts.join(arrays, "post_id")


def attach_comments(entries: DataFrame, summary: DataFrame) -> DataFrame:
    return entries.join(summary, "post_id", "left").withColumn(
        "comments_count", F.coalesce("comments_count", F.lit(0).cast("bigint"))
    )


def apply_comments(entries: DataFrame, new_comments: DataFrame, n: int = COMMENTS_SIZE) -> DataFrame:
    """Add a batch of comments to every feed entry of the commented posts.

    The batch is reduced to one row per post first; a post in a third of all feeds then joins a single summary row.
    """
    delta = comment_summary(new_comments, n).select(
        "post_id", F.col("comments_count").alias("_more"), F.col("newest_comments").alias("_new")
    )
    merged = F.concat(F.coalesce("newest_comments", F.array()), F.coalesce("_new", F.array()))
    return (
        entries.join(delta, "post_id", "left")
        .withColumn("comments_count", F.col("comments_count") + F.coalesce("_more", F.lit(0)))
        .withColumn(
            "newest_comments",
            F.when(F.col("_new").isNull(), F.col("newest_comments")).otherwise(
                F.slice(F.sort_array(merged, asc=False), 1, n)
            ),
        )
        .drop("_more", "_new")
    )


def _once_per_user(old: DataFrame, fresh: DataFrame, tasks: int) -> DataFrame:
    """Old and fresh rows, each post of a user once.

    They are dealt out by user, for this step and the ranking after it. The number of tasks is a bound that grows with the input:
    left to the size of a shuffle, whose short rows compress well, one task held the posts of all users.
    """
    return old.drop("rank").unionByName(fresh).repartition(tasks, "user_id").dropDuplicates(["user_id", "post_id"])


def apply_posts(entries: DataFrame, new_cards: DataFrame, follows: DataFrame, n: int = FEED_SIZE) -> DataFrame:
    """Feeds after a batch of new posts: old entries and delivered new ones, ranked again; a replayed batch changes nothing."""
    fresh = deliver(newest_per_author(new_cards, n), follows)
    return _rank_feed(_once_per_user(entries, fresh, 1 + follows.count() // EDGES_PER_TASK), n)


def apply_own_posts(own: DataFrame, new_cards: DataFrame, n: int = OWN_SIZE) -> DataFrame:
    fresh = newest_per_author(new_cards, n).withColumnRenamed("author_id", "user_id")
    both = _once_per_user(own, fresh, 1 + (own.count() + new_cards.count()) // POSTS_PER_TASK)
    return top_per_key(both, ["user_id"], _newest("created_at", "post_id"), n)


def add_counts(counters: DataFrame, events: DataFrame, key: str, name: str, sign: int = 1) -> DataFrame:
    """A counter column after a batch of events; rows without events keep their value."""
    delta = counts_by(events, key, "id", "_delta")
    return (
        counters.join(delta, "id", "left")
        .withColumn(name, F.col(name) + sign * F.coalesce("_delta", F.lit(0)))
        .drop("_delta")
    )


def net_changes(changes: DataFrame, follows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(added, removed) pairs of a log (follower_id, followee_id, op, seq) against the edges there are.

    Only the last change of a pair counts, so an unfollow that is taken back in the same batch changes nothing; of two changes
    with one number the follow wins. Follows of edges that are there, unfollows of edges that are not, and so a batch applied
    before, give nothing. A pair's changes are reduced before they are joined, however often it changed.
    """
    pair = ["follower_id", "followee_id"]
    last = changes.groupBy(*pair).agg(F.max(F.struct("seq", (F.col("op") == "follow").alias("follows"))).alias("last"))
    known = follows.select(*pair)
    added = last.filter("last.follows").select(*pair).join(known, pair, "left_anti")
    removed = last.filter("not last.follows").select(*pair).join(known, pair, "left_semi")
    return added, removed


def apply_changes_to_follows(follows: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    pair = ["follower_id", "followee_id"]
    return follows.select(*pair).join(removed, pair, "left_anti").unionByName(added)


def apply_follow_changes(
    entries: DataFrame, cards: DataFrame, follows: DataFrame, added: DataFrame, removed: DataFrame,
    n: int = FEED_SIZE, seed: int = OWN_SIZE,
) -> DataFrame:
    """Feeds after follows and unfollows.

    A new follow brings the followee's newest ``seed`` posts. Whoever unfollows gets the feed rebuilt from the
    remaining edges, because entries cut off earlier may come back. A pair in both sets stays; ``net_changes`` orders them.
    """
    pair = ["follower_id", "followee_id"]
    gone = removed.select(*pair).distinct().join(added.select(*pair), pair, "left_anti")
    leavers = gone.select(F.col("follower_id").alias("user_id")).distinct()
    new_edges = added.select(*pair).distinct().join(follows.select(*pair), pair, "left_anti")
    remaining = follows.select(*pair).join(gone, pair, "left_anti").join(
        leavers.withColumnRenamed("user_id", "follower_id"), "follower_id", "left_semi"
    )
    rebuilt = deliver(newest_per_author(cards, n), remaining)
    untouched = entries.drop("rank").join(leavers, "user_id", "left_anti")
    # deliver() may hand a rebuilt user more than n rows; the old feed must be cut before seeds are ranked in
    rebuilt = _rank_feed(rebuilt, n).drop("rank")
    seeds = deliver(newest_per_author(cards, seed), new_edges)
    return _rank_feed(untouched.unionByName(rebuilt).unionByName(seeds), n)


def apply_follow_counts(counters: DataFrame, follows: DataFrame, added: DataFrame, removed: DataFrame) -> DataFrame:
    """Counters after follows and unfollows; repeats, edges that are there already and edges that never were count nothing."""
    pair = ["follower_id", "followee_id"]
    known = follows.select(*pair)
    new = added.select(*pair).distinct().join(known, pair, "left_anti")
    gone = removed.select(*pair).distinct().join(known, pair, "left_semi").join(added.select(*pair), pair, "left_anti")
    for events, sign in ((new, 1), (gone, -1)):
        counters = add_counts(counters, events, "followee_id", "followers_count", sign)
        counters = add_counts(counters, events, "follower_id", "following_count", sign)
    return counters


def apply_reactions(counters: DataFrame, reactions: DataFrame) -> DataFrame:
    """Like counters of posts and comments, keyed by (kind, id), after a batch."""
    delta = (
        reactions.filter(F.col("type") == "like")
        .groupBy(F.col("target_kind").alias("kind"), F.col("target_id").alias("id"))
        .agg(F.count("*").alias("_delta"))
    )
    return (
        counters.join(delta, ["kind", "id"], "left")
        .withColumn("likes_count", F.col("likes_count") + F.coalesce("_delta", F.lit(0)))
        .drop("_delta")
    )


def lookup(df: DataFrame, ids: Sequence[int], key: str = "id") -> DataFrame:
    """Rows for a list of ids; ids without a row stay, with NULLs. The list is a query parameter, not data.

    The semi-filter runs first so the scan is cut to the wanted keys before the outer join.
    """
    wanted = literal_table(df.sparkSession, [(i,) for i in ids], f"{key} bigint")
    return wanted.join(df.filter(F.col(key).isin(*ids)), key, "left")


def post_pages(
    posts: DataFrame, users: DataFrame, comments: DataFrame, ids: Sequence[int], last_seen, limit: int = 10
) -> DataFrame:
    """Post, author card and the next page of comments for a set of posts."""
    chosen = lookup(posts.select("id", "user_id", "created_at"), ids)
    authors = users.select(
        F.col("id").alias("user_id"), "screen_name", "description", "followers_count", "statuses_count"
    )
    later = comments.filter(F.col("post_id").isin(*ids) & (F.col("created_at") > F.lit(last_seen)))
    page = top_per_key(later, ["post_id"], [F.asc("created_at"), F.asc("id")], limit).select(
        F.col("post_id").alias("id"), "rank", F.col("id").alias("comment_id"), F.col("text").alias("comment_text")
    )
    return chosen.join(authors, "user_id", "left").join(page, "id", "left")


def profiles(
    users: DataFrame, posts: DataFrame, follows: DataFrame, ids: Sequence[int], n: int = OWN_SIZE
) -> DataFrame:
    """User card, counters and newest posts for a set of users; counting reads only rows of those users."""
    chosen = lookup(users.select("id", "screen_name", "description"), ids)
    their_posts = posts.filter(F.col("user_id").isin(*ids))
    their_edges = follows.filter(F.col("followee_id").isin(*ids) | F.col("follower_id").isin(*ids))
    cards = user_counters(chosen, their_posts, their_edges)
    newest = top_per_key(
        their_posts.select(F.col("user_id").alias("id"), F.col("id").alias("post_id"), "created_at"),
        ["id"], _newest("created_at", "post_id"), n,
    )
    return cards.join(newest, "id", "left")


def with_texts(posts: DataFrame, texts: DataFrame) -> DataFrame:
    """Posts whose ``text`` is a number, with the text of that number in ``texts`` (text_id, body) instead.

    A text moves once, however many posts show it; posts without one are spread over all tasks.
    """
    home = F.coalesce("text", -1 - F.monotonically_increasing_id())
    found = posts.withColumn("_home", home).join(texts, F.col("_home") == F.col("text_id"), "left")
    return found.select(*[F.col("body").alias("text") if c == "text" else F.col(c) for c in posts.columns])


def typed_posts(tweets: DataFrame, urls: DataFrame, tags: DataFrame) -> DataFrame:
    """One wide table for text, image and video posts; each kind fills its own columns."""
    links = urls.groupBy(F.col("tweet_id").alias("id")).agg(F.min("url").alias("_link"))
    labels = best_per_key(tags.withColumnRenamed("tweet_id", "id"), ["id"], [F.asc("tag")]).withColumnRenamed(
        "tag", "_tag"
    )
    kind = F.when(F.col("id") % 3 == 0, "image").when(F.col("id") % 3 == 1, "text").otherwise("video")
    # only the texts that are shown go through the joins
    posts = tweets.withColumn("type", kind).select(
        "id", "user_id", "created_at", "type", "favorite_count",
        F.when(F.col("type") == "text", F.col("full_text")).alias("text"),
    )
    wide = posts.join(links, "id", "left").join(labels, "id", "left")
    return wide.select(
        "id", F.col("user_id").alias("author_id"), "created_at", "type", "text",
        F.when(F.col("type") == "image", F.col("_link")).alias("image_url"),
        F.when(F.col("type") == "image", F.col("_tag")).alias("caption"),
        F.when(F.col("type") == "video", F.col("_link")).alias("video_url"),
        F.when(F.col("type") == "video", F.col("favorite_count")).alias("duration"),
    )
