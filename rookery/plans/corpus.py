"""The views as nested status documents, written to files for the ingest jobs.

Variants by id: % 97 a broken line, % 89 a NUL inside the text, % 83 an unknown field, % 13 = 3 an ``extended_tweet``,
% 79 only ``id_str``, % 73 no text, % 71 an open ring, % 50 nested to depth 6 and more. Times take three formats by id % 3.

Lines are built with a mark in place of each text, so that no join of the statuses moves texts. The texts come last: a line goes to
the first text it names, and only its other texts are sent to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.sources.documents import list_files, read_lines, stored_lines
from rookery.views import Tables
from rookery.workspace import (
    file_paths, folder_names, fresh_folder, join_files, recorded, remove_folder, scratch, shuffles_removed, stage,
)

PATTERNS = ("*.txt", "*.txt.gz")
SHARDS = 8
LINES_PER_TASK = 20_000
_folders: dict[tuple, str] = {}


def _entity_arrays(t: Tables) -> DataFrame:
    def arrays(df, name, *fields):
        return df.groupBy("tweet_id").agg(F.array_sort(F.collect_set(F.struct(*fields))).alias(name))

    tag = F.when(F.col("tweet_id") % 2 == 0, F.concat(F.lit(" "), "tag")).otherwise(F.col("tag")).alias("text")
    link = F.col("url")
    mention = F.col("mentioned_user_id")
    media = F.col("media_id")
    frames = [
        arrays(t.tweet_hashtag, "hashtags", tag),
        arrays(t.tweet_urls, "urls", "url", F.concat(link, F.lit("#full")).alias("expanded_url"),
               F.when(F.col("tweet_id") % 3 == 0, F.concat(link, F.lit("#end"))).alias("unwound_url")),
        arrays(t.tweet_user_mentions, "user_mentions",
               F.when(mention % 5 != 0, mention).alias("id"), mention.cast("string").alias("id_str"),
               F.col("mentioned_screen_name").alias("screen_name"), F.concat(F.lit("Name "), mention).alias("name")),
        arrays(t.tweet_media, "media", media.alias("id"), "type", F.concat(F.lit("http://m/"), media).alias("media_url")),
    ]
    out = t.tweets.select(F.col("id").alias("tweet_id"))
    for frame in frames:
        out = out.join(frame, "tweet_id", "left")
    return out


def numbered_texts(t: Tables) -> DataFrame:
    """Stored: the documents with a number for each text, its length, and the text as it stands between quotes in JSON."""
    inside = F.to_json(F.struct("text"))
    head, tail = len('{"text":"'), len('"}')
    body = F.when(F.col("text").isNotNull(), F.substring(inside, F.lit(head + 1), F.length(inside) - (head + tail)))
    numbered = t.documents.select(
        "doc_id", "lang", F.monotonically_increasing_id().alias("text_id"), F.length("text").alias("size"), body.alias("body")
    )
    return stage(numbered, "numbered-texts")


def status_documents(t: Tables, mark: str) -> DataFrame:
    """(id, quoted_status_id, retweeted_status_id, doc) without embedded statuses.

    Each ``full_text`` is (text_id, size); the documents hold the number of their text between two marks instead of the text.
    """
    tweets = t.tweets.withColumnRenamed("id", "tweet_id").join(_entity_arrays(t), "tweet_id")
    users = t.users.select(F.col("id").alias("user_id"), F.struct(
        "id", F.col("id").cast("string").alias("id_str"), "screen_name", "name", "description", "verified", "protected",
        "followers_count", "friends_count", "statuses_count", "location",
    ).alias("user"))
    box = F.array(F.array(*[F.array(F.lit(x), F.lit(y)) for x, y in ((17.0, 48.0), (18.0, 48.0), (18.0, 49.0), (17.0, 48.0))]))
    places = t.places.select(F.col("id").alias("place_id"), F.struct(
        "id", "full_name", "country", "country_code", "place_type", F.struct(box.alias("coordinates")).alias("bounding_box")
    ).alias("place"))
    n = F.col("tweet_id")
    joined = tweets.join(users, "user_id").join(places, "place_id", "left")
    opened = F.col("place").withField("bounding_box.coordinates", F.transform(
        "place.bounding_box.coordinates", lambda ring: F.when(n % 71 == 0, F.slice(ring, 1, 3)).otherwise(ring)
    ))
    marked = F.concat(F.lit(mark), F.col("full_text.text_id"), F.lit(mark))
    text = F.when(n % 89 == 0, F.concat(F.lit("\x00"), marked)).otherwise(marked)
    status = F.date_format("created_at", "EEE MMM dd HH:mm:ss")
    time = (
        F.when(n % 3 == 0, F.concat(status, F.lit(" +0000 "), F.date_format("created_at", "yyyy")))
        .when(n % 3 == 1, F.concat(F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+0000")))
        .otherwise((F.unix_timestamp(F.col("created_at").cast("timestamp")) * 1000).cast("string"))
    )
    doc = F.struct(
        F.when(n % 79 != 0, n).alias("id"),
        n.cast("string").alias("id_str"),
        time.alias("created_at"),
        F.when((n % 73 != 0) & (n % 13 != 3) & (n % 2 == 0), text).alias("full_text"),
        F.when((n % 73 != 0) & (n % 13 != 3) & (n % 2 == 1), text).alias("text"),
        F.when((n % 73 != 0) & (n % 13 == 3), F.struct(text.alias("full_text"))).alias("extended_tweet"),
        F.when(n % 4 != 0, F.array(F.lit(0), F.col("full_text.size"))).otherwise(F.array(F.lit(7))).alias("display_text_range"),
        "lang", "source", "in_reply_to_status_id", "quoted_status_id", "retweet_count", "favorite_count",
        "possibly_sensitive", "user",
        F.when(F.col("place").isNotNull(), opened).alias("place"),
        F.when(n % 4 == 0, F.struct(F.array(F.lit(48.0) + n % 2, F.lit(17.0) + n % 5).alias("coordinates"))).alias("coordinates"),
        F.struct("hashtags", "urls", "user_mentions", F.when(n % 2 == 1, F.col("media")).alias("media")).alias("entities"),
        F.when(n % 2 == 0, F.struct("media")).alias("extended_entities"),
        F.when(n % 6 == 0, F.struct(F.concat(F.lit("https://t.example/"), n).alias("url"))).alias("quoted_status_permalink"),
        F.when(n % 83 == 0, F.lit("x")).alias("surprise"),
    )
    return joined.select(n.alias("id"), F.col("quoted_status_id").alias("quoted"), F.col("retweeted_status_id").alias("retweeted"), doc.alias("doc"))


def marked_lines(t: Tables, mark: str) -> DataFrame:
    """(id, value): each status with its retweet target (and that one's quote) and its quote embedded, texts by number."""
    numbered = status_documents(t, mark).withColumn("row", F.monotonically_increasing_id())
    flat = stage(numbered, "flat-statuses")
    # which rows a line embeds is told by narrow joins, so that a document travels only to lines that embed it
    own = flat.select("id", "quoted", "retweeted", "row")
    quotes = own.select(F.col("id").alias("quoted"), F.col("row").alias("quote"))
    with_quote = own.join(quotes, "quoted", "left").select("id", "retweeted", "row", "quote")
    originals = with_quote.select(F.col("id").alias("retweeted"), F.col("row").alias("original"), F.col("quote").alias("its_quote"))
    found = with_quote.join(originals, "retweeted", "left").drop("retweeted")
    rows = stage(found.withColumn("line", F.monotonically_increasing_id()), "embedded-rows")
    docs = flat.select("row", "doc")
    slots = F.array(*[F.struct(F.lit(c).alias("slot"), F.col(c).alias("row")) for c in ("quote", "original", "its_quote")])
    asked = rows.select(F.col("row").alias("home"), "line", F.inline(F.filter(slots, lambda s: s["row"].isNotNull())))
    sent = asked.join(docs, "row").select("home", F.col("line").alias("at"), F.struct("slot", "doc").alias("one")).repartition("home")
    sent = sent.groupBy("home", "at").agg(F.map_from_entries(F.collect_list("one")).alias("embedded"))
    # the lines of a row are told apart by a condition that is no join key: the documents lie by row already
    nested = rows.select("id", "row", "line").join(docs, "row").join(
        sent, (F.col("row") == F.col("home")) & (F.col("line") - F.col("at") == 0), "left"
    )
    inside = lambda slot: F.col("embedded")[slot]
    shared = F.col("doc").withField("quoted_status", inside("quote")).withField(
        "retweeted_status", inside("original").withField("quoted_status", inside("its_quote"))
    )
    # exploding one struct keeps Spark from copying the JSON writers into every later use of their columns
    forms = F.struct(F.to_json(shared).alias("whole"), F.to_json(shared.dropFields("quoted_status")).alias("alone"))
    written = nested.select("id", F.inline(F.array(forms)))
    # one in fifty quotes itself five times over before its true quote, so that some statuses are found at depth 6 only
    head = F.concat(F.expr("left(alone, length(alone) - 1)"), F.lit(',"quoted_status":'))
    deep = F.concat(F.repeat(head, F.lit(5)), "whole", F.repeat(F.lit("}"), F.lit(5)))
    value = F.when(F.col("id") % 50 == 0, deep).otherwise(F.col("whole"))
    broken = F.expr("left(whole, length(whole) - 5)")
    return written.select("id", F.when(F.col("id") % 97 == 0, broken).otherwise(value).alias("value"))


def with_texts(
    lines: DataFrame, texts: DataFrame, mark: str, per_task: int = LINES_PER_TASK, made_of: Sequence[str] = ()
) -> DataFrame:
    """(id, value) with the texts (text_id, body) in place of their marked numbers; folders ``made_of`` go once the lines are read.

    A line is at home with the first text it names, and goes there without a text; its other texts are joined and sent to its home.
    """
    spark = lines.sparkSession
    parts = F.split("value", mark)  # every second part is a number
    numbers = F.transform(F.array_distinct(F.filter(parts, lambda _, i: i % 2 == 1)), lambda x: x.cast("bigint"))
    cut = lines.select("id", F.monotonically_increasing_id().alias("line"), parts.alias("parts"), numbers.alias("numbers"))
    home = F.coalesce(F.get("numbers", F.lit(0)), -1 - F.col("line"))  # lines without a text have a home each
    placed = stage(cut.select(home.alias("home"), "line", F.struct("id", "parts").alias("it"), "numbers"), "marked-lines")
    for folder in made_of:
        remove_folder(spark, folder)
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), placed.count() // per_task)
    named = placed.select("home", "line", F.explode(F.slice("numbers", F.lit(2), F.size("numbers"))).alias("text_id"))
    dealt = texts.select("text_id", "body").repartition(tasks, "text_id")  # both joins read the one exchange
    others = named.join(dealt, "text_id").select("home", "line", F.struct("text_id", "body").alias("other"))
    gathered = placed.drop("numbers").unionByName(others, allowMissingColumns=True).repartition(tasks, "home")
    whole = gathered.groupBy("home", "line").agg(
        F.first("it", ignorenulls=True).alias("it"), F.map_from_entries(F.collect_list("other")).alias("others")
    ).join(dealt, F.col("home") == F.col("text_id"), "left")

    def filled(part, i):
        number = part.try_cast("bigint")
        return F.when(i % 2 == 0, part).when(number == F.col("home"), F.col("body")).otherwise(F.col("others")[number])

    return whole.select("it.id", F.array_join(F.transform("it.parts", filled), "").alias("value"))


def documents_with_embedded(t: Tables) -> DataFrame:
    """(id, value): the nested documents as lines, texts and all."""
    texts, mark = numbered_texts(t), f"text{uuid.uuid4().hex}"
    known = F.when(F.col("size").isNotNull(), F.struct("text_id", "size"))
    thin = t.replacing("documents", texts.select("doc_id", "lang", known.alias("text")))
    with recorded() as made_of:
        marked = marked_lines(thin, mark)
    lines = with_texts(marked, texts, mark, made_of=made_of)
    # to_json escapes the NUL; the reader must cope with the raw byte as well
    raw = (F.col("id") % 89 == 0) & (F.col("id") % 97 != 0)
    return lines.withColumn("value", F.when(raw, F.replace("value", F.lit("\\u0000"), F.lit("\x00"))).otherwise(F.col("value")))


def write_parts(lines: DataFrame) -> str:
    """Folder of lines (shard, value), gzipped by the task that has them, in a folder a shard."""
    parts = fresh_folder(lines.sparkSession, "corpus-parts")
    with shuffles_removed(lines.sparkSession):
        lines.write.partitionBy("shard").option("compression", "gzip").text(parts)
    return parts


def join_parts(spark: SparkSession, parts: str, folder: str) -> None:
    """One file a shard: 0 plain and the others gzipped, of which 0 to 3 are complete before 4 to 7 begin.

    A gzipped file may have several members, so the parts of a shard are put one after another as they are; only the plain shard is
    read again, in one task.
    """
    found = [(int(name.removeprefix("shard=")), f"{parts}/{name}") for name in folder_names(spark, parts) if name.startswith("shard=")]

    def write(one: tuple[int, str]) -> None:
        shard, path = one
        if shard < 1:
            spark.read.text(path).coalesce(1).write.text(f"{folder}/plain/shard={shard}")
            remove_folder(spark, path)
        else:
            join_files(spark, file_paths(spark, path, "*.gz"), f"{folder}/zipped/shard={shard}/part-0.txt.gz")

    with ThreadPoolExecutor(SHARDS) as jobs:
        for group in ([one for one in found if one[0] < 4], [one for one in found if one[0] >= 4]):
            list(jobs.map(write, group))
    remove_folder(spark, parts)


def corpus_folder(t: Tables) -> str:
    """Folder of line files, shard 0 plain and the others gzipped, one file per shard; written once per application.

    Shards 0 to 3 are complete before 4 to 7 begin, so a stream meets them first.
    """
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key not in _folders:
        folder = fresh_folder(t.spark, "corpus")
        with scratch(t.spark):
            parts = write_parts(documents_with_embedded(t).select((F.col("id") % SHARDS).cast("int").alias("shard"), "value"))
        join_parts(t.spark, parts, folder)
        _folders[key] = folder
    return _folders[key]


def corpus_lines(t: Tables, limit: int = 0, skip: int = 0, stored: bool = False) -> DataFrame:
    paths = list_files(t.spark, corpus_folder(t), PATTERNS, limit, skip)
    return stored_lines(t.spark, paths) if stored else read_lines(t.spark, paths)


def shard_of(file):
    return F.regexp_extract(file, r"shard=(\d+)", 1).cast("int")
