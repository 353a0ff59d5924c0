"""Predicates, joins, distinct, top-k and histograms over relations.

Everything here is a declarative plan: simple comparisons reach the Parquet scan, join strategies are left to the
optimizer's size statistics and AQE, and per-key rankings filter on ``row_number`` so that Spark's window group limit
trims every key on the map side before the shuffle (a hot key never arrives whole in one task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.workspace import literal_table


# ---- predicates -----------------------------------------------------------------------------------------------------
def text_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(F.col(column) == value)


def in_range(df: DataFrame, column: str, low, high) -> DataFrame:
    return df.filter(F.col(column).between(low, high))


def contains(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.filter(F.col(column).contains(needle))


def has_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.filter(F.col(column).startswith(prefix))


def _like_escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")


def ends_with_ignoring_case(df: DataFrame, column: str, suffix: str) -> DataFrame:
    return df.filter(F.col(column).ilike("%" + _like_escaped(suffix)))


def contains_ignoring_case(df: DataFrame, column: str, needle: str) -> DataFrame:
    return df.filter(F.col(column).ilike("%" + _like_escaped(needle) + "%"))


def outside_range(df: DataFrame, column: str, low, high) -> DataFrame:
    """Rows at or below ``low`` or above ``high``."""
    return df.filter((F.col(column) <= low) | (F.col(column) > high))


def one_of(df: DataFrame, column: str, values: Sequence, **equal) -> DataFrame:
    """Non-null membership in a list, with further equality conditions."""
    condition = F.col(column).isNotNull() & F.col(column).isin(*values)
    for name, value in equal.items():
        condition = condition & (F.col(name) == value)
    return df.filter(condition)


def few_followers_many_friends(users: DataFrame, followers_below: int, friends_above: int) -> DataFrame:
    return users.filter(
        (F.col("followers_count") < followers_below) & (F.col("friends_count") > friends_above)
    ).orderBy("statuses_count", "id")


def autocomplete(df: DataFrame, column: str, prefix: str, limit: int = 10) -> DataFrame:
    """First names, in order, that start with the prefix in any case."""
    return df.filter(F.lower(column).startswith(prefix.lower())).orderBy(column).limit(limit)


def newest_with_tag(posts: DataFrame, tag: str, limit: int = 20) -> DataFrame:
    return (
        posts.filter(F.array_contains("tags", tag)).orderBy(F.desc("created_at"), F.desc("id")).limit(limit)
    )


def project(df: DataFrame, include: Sequence[str] | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    return df.select(*(include or [c for c in df.columns if c not in set(exclude)]))


def flag(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """1 where the condition holds, 0 where it is false or unknown."""
    return df.withColumn(name, F.when(condition, 1).otherwise(0))


# ---- joins ----------------------------------------------------------------------------------------------------------
def tweets_with_authors(tweets: DataFrame, users: DataFrame) -> DataFrame:
    return tweets.alias("t").join(users.alias("u"), F.col("t.user_id") == F.col("u.id"))


def without_match(df: DataFrame, other: DataFrame, column: str, other_column: str | None = None) -> DataFrame:
    """Rows with no partner; the other side is reduced to distinct keys first, so its hot keys cost one row."""
    keys = other.select(F.col(other_column or column).alias(column)).distinct()
    return df.join(keys, column, "left_anti")


def with_match(df: DataFrame, other: DataFrame, column: str, other_column: str | None = None) -> DataFrame:
    keys = other.select(F.col(other_column or column).alias(column)).distinct()
    return df.join(keys, column, "left_semi")


def sceptical_tweets(
    tweets: DataFrame, users: DataFrame, tweet_hashtag: DataFrame, description: str, text: str, low: int, high: int
) -> DataFrame:
    """Untagged tweets by matching authors, one row per tweet id, the author with most followers winning."""
    wanted = outside_range(contains_ignoring_case(tweets, "full_text", text), "retweet_count", low, high)
    authors = contains_ignoring_case(users, "description", description).select(
        F.col("id").alias("user_id"), F.col("followers_count").alias("_followers")
    )
    tagged = tweet_hashtag.select(F.col("tweet_id").alias("id"))
    joined = without_match(wanted.join(authors, "user_id"), tagged, "id")
    return best_per_key(joined, ["id"], [F.desc("_followers"), F.asc("user_id")]).drop("_followers").orderBy("id")


def left_join_flag(df: DataFrame, other: DataFrame, column: str, other_column: str, name: str) -> DataFrame:
    """Keep every row and mark those with a partner."""
    keys = other.select(F.col(other_column).alias(column), F.lit(True).alias("_hit")).distinct()
    return flag(df.join(keys, column, "left"), name, F.col("_hit")).drop("_hit")


def named_pairs(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Every (left, right) row pair for listed name pairs: two equi joins instead of a product."""
    wanted = literal_table(left.sparkSession, pairs, "left_name string, right_name string")
    a = left.select(F.col("name").alias("left_name"), F.struct(*left.columns).alias("a"))
    b = right.select(F.col("name").alias("right_name"), F.struct(*right.columns).alias("b"))
    return wanted.join(a, "left_name").join(b, "right_name")


# ---- aggregation and ranking ----------------------------------------------------------------------------------------
def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    return top_per_key(df, keys, order, 1).drop("rank")


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key with their 1-based rank."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= n)


def newest_arrays(
    df: DataFrame, key: str, n: int, columns: Sequence[str], name: str = "items", time: str = "created_at",
    identity: str = "id",
) -> DataFrame:
    """Newest ``n`` rows per key as one array, newest first; rows are trimmed before they are collected."""
    kept = top_per_key(df, [key], [F.desc(time), F.desc(identity)], n)
    packed = F.array_sort(F.collect_list(F.struct("rank", *columns)))
    return kept.groupBy(key).agg(packed.alias(name))


def count_distinct_top(df: DataFrame, key: str, counted: str, name: str, limit: int = 10) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(counted).alias(name)).orderBy(F.desc(name), key).limit(limit)


def groups_with_at_least(df: DataFrame, key: str, counted: str, name: str, minimum: int) -> DataFrame:
    return df.groupBy(key).agg(F.countDistinct(counted).alias(name)).filter(F.col(name) >= minimum)


def group_with_largest(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.max(value).alias(name)).orderBy(F.desc(name), key).limit(1)


def ranked_by(df: DataFrame, name: str, expression: Column, digits: int, tie: str) -> DataFrame:
    return df.withColumn(name, F.round(expression, digits)).orderBy(F.desc(name), tie)


def smallest_by(df: DataFrame, expression: Column, tie: str) -> DataFrame:
    return df.orderBy(expression.asc(), F.asc(tie)).limit(1)


def page_after(df: DataFrame, last_seen, limit: int = 10) -> DataFrame:
    """Keyset page: rows later than the last seen timestamp, oldest first."""
    return df.filter(F.col("created_at") > F.lit(last_seen)).orderBy("created_at", "id").limit(limit)


def with_empty_days(per_day: DataFrame) -> DataFrame:
    """Add the days missing between the first and last.

    Works on one row per calendar day, so the unpartitioned window holds days, not documents, and the input is
    scanned once.
    """
    following = F.lead("day").over(Window.orderBy("day"))
    spread = per_day.withColumn("_to", F.coalesce(F.date_sub(following, 1), F.col("day"))).withColumn(
        "_day", F.explode(F.sequence("day", "_to"))
    )
    real = F.col("_day") == F.col("day")
    kept = [c for c in per_day.columns if c != "day"]
    return spread.select(F.col("_day").alias("day"), *[F.when(real, F.col(c)).alias(c) for c in kept])


def daily_histogram(df: DataFrame, time: str, value: str, average: str) -> DataFrame:
    """Documents and average per UTC day; days without documents show 0 and NULL."""
    per_day = df.groupBy(F.to_date(time).alias("day")).agg(
        F.count("*").alias("doc_count"), F.avg(value).alias(average)
    )
    filled = with_empty_days(per_day)
    return filled.withColumn("doc_count", F.coalesce("doc_count", F.lit(0).cast("bigint")))


def daily_subset_against_all(df: DataFrame, time: str, value: str, in_subset: Column) -> DataFrame:
    """Both histograms in one pass over the documents."""
    per_day = df.groupBy(F.to_date(time).alias("day")).agg(
        F.count("*").alias("global_count"),
        F.avg(value).alias("global_avg"),
        F.count_if(in_subset).alias("subset_count"),
        F.avg(F.when(in_subset, F.col(value))).alias("subset_avg"),
    )
    filled = with_empty_days(per_day)
    for name in ("global_count", "subset_count"):
        filled = filled.withColumn(name, F.coalesce(name, F.lit(0).cast("bigint")))
    return filled


def posts_per_tag(tweet_hashtag: DataFrame, limit: int | None = None) -> DataFrame:
    ranked = tweet_hashtag.groupBy("tag").agg(F.count("*").alias("posts")).orderBy(F.desc("posts"), "tag")
    return ranked.limit(limit) if limit else ranked


def tagged_posts(tweets: DataFrame, tweet_hashtag: DataFrame) -> DataFrame:
    """Posts with their (bounded, per-document) tag array."""
    tags = tweet_hashtag.groupBy(F.col("tweet_id").alias("id")).agg(F.array_sort(F.collect_set("tag")).alias("tags"))
    return tweets.join(tags, "id", "left")
