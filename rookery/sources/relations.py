"""Declared schemas of the eight relations, and delimited files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

_TYPES = {
    "bigint": LongType(),
    "int": IntegerType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "timestamp_ntz": TimestampNTZType(),
}


def _schema(text: str) -> StructType:
    out = StructType()
    for column in text.split(", "):
        name, kind = column.split(" ")
        out.add(name, _TYPES[kind])
    return out


# The relational model.
RELATIONS: dict[str, StructType] = {
    name: _schema(ddl)
    for name, ddl in {
        "users": "id bigint, screen_name string, name string, description string, verified boolean, protected boolean, "
                 "followers_count int, friends_count int, statuses_count int, created_at timestamp_ntz, "
                 "location string, url string",
        "places": "id string, full_name string, country string, country_code string, place_type string",
        "tweets": "id bigint, created_at timestamp_ntz, full_text string, display_from int, display_to int, lang string, "
                  "user_id bigint, source string, in_reply_to_status_id bigint, quoted_status_id bigint, "
                  "retweeted_status_id bigint, place_id string, retweet_count int, favorite_count int, "
                  "possibly_sensitive boolean",
        "hashtags": "id bigint, tag string",
        "tweet_hashtag": "tweet_id bigint, hashtag_id bigint",
        "tweet_urls": "tweet_id bigint, url string, expanded_url string, display_url string, unwound_url string",
        "tweet_user_mentions": "tweet_id bigint, mentioned_user_id bigint, mentioned_screen_name string, "
                               "mentioned_name string",
        "tweet_media": "tweet_id bigint, media_id bigint, type string, media_url string, media_url_https string, "
                       "display_url string, expanded_url string",
    }.items()
}

# Primary keys.
KEYS: dict[str, list[str]] = {
    "users": ["id"],
    "places": ["id"],
    "tweets": ["id"],
    "hashtags": ["id"],
    "tweet_hashtag": ["tweet_id", "hashtag_id"],
    "tweet_urls": ["tweet_id", "url"],
    "tweet_user_mentions": ["tweet_id", "mentioned_user_id"],
    "tweet_media": ["tweet_id", "media_id"],
}


def typed_rows(df: DataFrame, schema: StructType) -> DataFrame:
    """Text columns cast to the declared types; what does not fit becomes NULL, absent columns too."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema
    ])


def read_relation(spark: SparkSession, name: str, path: str) -> DataFrame:
    return spark.read.schema(RELATIONS[name]).parquet(path)


def write_delimited(df: DataFrame, path: str) -> None:
    """Tab-separated staging file, quoted; NULL is the empty field."""
    df.write.option("sep", "\t").option("nullValue", "").option("emptyValue", "").option("quote", '"').option(
        "escape", '"'
    ).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Staging file with a doubled quote as escape and '' as NULL; quoted fields may span lines."""
    return (
        spark.read.schema(schema).option("sep", "\t").option("nullValue", "").option("emptyValue", "")
        .option("quote", '"').option("escape", '"').option("multiLine", True).csv(path)
    )


def write_result(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def read_result(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
