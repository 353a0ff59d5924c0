"""Small column expressions shared by ingest and shredding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUL = "\x00"


def clean_text(column: Column) -> Column:
    """NUL removed; empty and missing are both NULL."""
    return F.nullif(F.replace(column, F.lit(NUL), F.lit("")), F.lit(""))


def filled(column: Column) -> Column:
    """NULL for empty text, so ``coalesce`` moves on to the next candidate."""
    return F.nullif(column, F.lit(""))


def hashtag_id(tag: Column) -> Column:
    """sha-256 of the tag modulo 2^63: only the last 16 hex digits matter."""
    tail = F.conv(F.substring(F.sha2(tag, 256), 49, 16), 16, 10).cast("decimal(20,0)")
    return (tail % F.lit("9223372036854775808").cast("decimal(20,0)")).cast("bigint")


EPOCH_MILLIS = (-62_135_596_800_000, 253_402_300_799_999)  # first and last millisecond of the years 1 to 9999


def parse_timestamp(value: Column) -> Column:
    """Status form, ISO with milliseconds and zone, or epoch milliseconds.

    The weekday is cut off: it carries no information and Spark refuses it when parsing. Numbers outside the years 1 to
    9999 are no times and give NULL.
    """
    millis = value.try_cast("bigint")
    return F.coalesce(
        F.try_to_timestamp(F.regexp_replace(value, r"^[A-Za-z]{3} ", ""), F.lit("MMM dd HH:mm:ss Z yyyy")),
        F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXX")),
        F.try_to_timestamp(value, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSSXXX")),
        F.when(millis.between(*EPOCH_MILLIS), F.timestamp_millis(millis)),
    )


def close_ring(ring: Column) -> Column:
    """Repeat the first vertex at the end of an open ring."""
    open_ring = (F.size(ring) > 0) & (F.element_at(ring, 1) != F.element_at(ring, -1))
    return F.when(open_ring, F.concat(ring, F.slice(ring, 1, 1))).otherwise(ring)


def lon_lat(point: Column, order: str) -> Column:
    """[lon, lat] from a coordinate pair given as ``lat_lon`` or ``lon_lat``; impossible values become NULL."""
    if order not in ("lat_lon", "lon_lat"):
        raise ValueError(order)
    lat, lon = (point[0], point[1]) if order == "lat_lon" else (point[1], point[0])
    valid = (F.size(point) == 2) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180)
    return F.when(valid, F.array(lon, lat))
