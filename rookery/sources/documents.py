"""Reading JSON-lines documents: file choice, parsing with quarantine, strict field checks, load counts.

Every step is an expression over the line, so reading, checking and unrolling stay in one stage after the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rookery.functions.scalar import NUL, close_ring, lon_lat
from rookery.workspace import fresh_folder, stage

PATTERNS = ("*.jsonl", "*.jsonl.gz", "*.json")


def list_files(
    spark: SparkSession, folder: str, patterns: Sequence[str] = PATTERNS, limit: int = 0, skip: int = 0
) -> list[str]:
    """Input paths, sorted within each pattern; the first ``limit`` are taken, then the first ``skip`` left out."""
    found: list[str] = []
    for pattern in patterns:
        reader = spark.read.format("text").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        found.extend(sorted(reader.load(folder).inputFiles()))
    if limit:
        found = found[:limit]
    return found[skip:]


UNSPLIT = (".gz", ".deflate", ".snappy", ".zst")
BLOCK = 64
LINES_PER_FILE = 5_000


def read_lines(spark: SparkSession, paths: Sequence[str], spread: int | None = None) -> DataFrame:
    """(file, value) per line. Compressed files do not split, so their lines alone are dealt out to ``spread`` tasks.

    They are dealt in blocks by their place in the file: dealing rows round sorts them first, which spills a large file, and lines
    that lie together compress better.
    """
    def lines(some: list[str]) -> DataFrame:
        if not some:
            return spark.createDataFrame([], "file string, value string")
        return spark.read.text(some).select(F.col("_metadata.file_path").alias("file"), "value")

    whole = [p for p in paths if p.endswith(UNSPLIT)]
    if not spread or not whole:
        return lines(list(paths))
    block = F.floor(F.monotonically_increasing_id() / BLOCK)
    dealt = lines(whole).withColumn("_block", block).repartition(spread, "_block").drop("_block")
    plain = [p for p in paths if p not in set(whole)]
    return lines(plain).unionByName(dealt) if plain else dealt


def stored_lines(spark: SparkSession, paths: Sequence[str], per_file: int = LINES_PER_FILE) -> DataFrame:
    """(file, value) per line, for work that is heavy by the line. Lines of files that do not split are stored once in small files,
    which take less room than a shuffle of the lines; the others are read where they lie."""
    whole = [p for p in paths if p.endswith(UNSPLIT)]
    plain = [p for p in paths if not p.endswith(UNSPLIT)]
    if not whole:
        return read_lines(spark, plain)
    kept = stage(read_lines(spark, whole), "lines", rows_per_file=per_file)
    return read_lines(spark, plain).unionByName(kept) if plain else kept


def lines_per_file(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file").agg(F.count("*").alias("lines"))


def clean_lines(lines: DataFrame) -> DataFrame:
    """Trimmed lines without NUL; blank lines are dropped."""
    value = F.trim(F.replace("value", F.lit(NUL), F.lit("")))
    return lines.withColumn("value", value).filter(F.length("value") > 0)


def with_parse_error(lines: DataFrame) -> DataFrame:
    """Adds ``error``: NULL for a JSON object, else why the line is refused. A key given twice in an object is not valid."""
    reason = (
        F.when(~F.col("value").startswith("{"), "not an object")
        .when(F.try_parse_json("value").isNull(), "not valid JSON")
    )
    return lines.withColumn("error", reason)


def good_lines(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("error").isNull()).drop("error")


def quarantined_lines(checked: DataFrame) -> DataFrame:
    """Refused lines with file, reason and raw text."""
    return checked.filter(F.col("error").isNotNull()).select("file", F.col("error").alias("reason"), F.col("value").alias("raw"))


# ---- strict documents -----------------------------------------------------------------------------------------------
# The fields each level of a search document may hold.
STATUS_FIELDS = (
    "is_quote_status quoted_status_id quoted_status_id_str withheld_in_countries quoted_status_permalink created_at id "
    "id_str text full_text truncated display_text_range source in_reply_to_status_id in_reply_to_status_id_str "
    "in_reply_to_user_id in_reply_to_user_id_str in_reply_to_screen_name user geo coordinates place contributors "
    "entities extended_entities favorited retweeted possibly_sensitive retweet_count favorite_count lang "
    "retweeted_status quoted_status"
).split()
EMBEDDED_FIELDS = [f for f in STATUS_FIELDS if f != "retweeted_status"] + ["scopes"]
USER_FIELDS = (
    "withheld_in_countries id id_str name screen_name location description url entities protected verified "
    "followers_count friends_count listed_count favourites_count statuses_count created_at utc_offset time_zone "
    "profile_image_url profile_image_url_https profile_banner_url profile_background_color geo_enabled lang "
    "contributors_enabled is_translator is_translation_enabled profile_background_image_url "
    "profile_background_image_url_https profile_link_color profile_background_tile profile_image_extensions_alt_text "
    "profile_banner_extensions_alt_text profile_sidebar_border_color profile_sidebar_fill_color profile_text_color "
    "profile_use_background_image default_profile has_extended_profile translator_type default_profile_image following "
    "follow_request_sent notifications other_info"
).split()
PLACE_FIELDS = "id url place_type contained_within name full_name country country_code bounding_box attributes".split()
ENTITY_FIELDS = "hashtags symbols user_mentions urls media".split()

STRICT_LEVELS = {
    "$": STATUS_FIELDS,
    "$.user": USER_FIELDS,
    "$.place": PLACE_FIELDS,
    "$.entities": ENTITY_FIELDS,
    "$.retweeted_status": EMBEDDED_FIELDS,
    "$.retweeted_status.user": USER_FIELDS,
    "$.retweeted_status.place": PLACE_FIELDS,
    "$.quoted_status": EMBEDDED_FIELDS,
    "$.quoted_status.user": USER_FIELDS,
    "$.quoted_status.place": PLACE_FIELDS,
}


def _prefixed(prefix: str):
    return lambda name: F.concat(F.lit(prefix), name)


def with_unknown_fields(lines: DataFrame, levels: dict[str, Sequence[str]] = STRICT_LEVELS) -> DataFrame:
    """Adds ``unknown_fields``: paths of fields outside the allowed set, an empty array for a sound document."""
    parts = []
    for path, allowed in levels.items():
        node = F.col("value") if path == "$" else F.get_json_object("value", path)
        extra = F.array_except(F.json_object_keys(node), F.array(*[F.lit(f) for f in allowed]))
        named = F.transform(extra, _prefixed(path + "."))
        parts.append(F.coalesce(named, F.array().cast("array<string>")))
    return lines.withColumn("unknown_fields", F.concat(*parts))


def kept_objects(lines: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Sub-objects that are stored but not searched, as JSON text."""
    return lines.select("file", "value", *[F.get_json_object("value", path).alias(name) for name, path in paths.items()])


def validated(lines: DataFrame) -> DataFrame:
    """Every line with its outcome: parse error, unknown fields, or accepted."""
    checked = with_unknown_fields(with_parse_error(clean_lines(lines)))
    reason = F.coalesce(
        F.col("error"),
        F.when(F.size("unknown_fields") > 0, F.concat(F.lit("unknown: "), F.array_join("unknown_fields", ","))),
    )
    return checked.select("file", "value", reason.alias("reason"))


def bulk_write(lines: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write accepted and rejected documents; per file, how many went where. Returns (counts, stored)."""
    spark = lines.sparkSession
    folder = folder or fresh_folder(spark, "bulk")
    flagged = validated(lines).withColumn("accepted", F.col("reason").isNull())
    flagged.write.partitionBy("accepted").parquet(folder)
    stored = spark.read.schema(flagged.schema).parquet(folder)
    counts = stored.groupBy("file").agg(
        F.count_if(F.col("accepted")).alias("succeeded"), F.count_if(~F.col("accepted")).alias("failed")
    )
    return counts, stored


# ---- geometry inside documents --------------------------------------------------------------------------------------
RING = "struct<coordinates:array<array<array<double>>>>"
POINT = "struct<coordinates:array<double>>"
HOLDERS = ("", "quoted_status.", "retweeted_status.")


def normalised_geometry(lines: DataFrame, order: str = "lat_lon") -> DataFrame:
    """Closed place rings and [lon, lat] points of a document and its two embedded statuses."""
    out = ["file", "value"]
    for holder in HOLDERS:
        name = holder.replace(".", "_")
        box = F.from_json(F.get_json_object("value", f"$.{holder}place.bounding_box"), RING)
        point = F.from_json(F.get_json_object("value", f"$.{holder}coordinates"), POINT)
        out.append(close_ring(box["coordinates"][0]).alias(f"{name}ring"))
        out.append(lon_lat(point["coordinates"], order).alias(f"{name}point"))
    return lines.select(*out)
