"""Hand cases and equivalences of the relational, upkeep, feed, graph, spatial and streaming jobs."""

import datetime as dt
import json
import math

import numpy as np
from pyspark.sql import functions as F

from rookery.functions import geo
from rookery.operators import feed, graph, merge, relational as rel, spatial
from rookery.streaming import jobs
from rookery.streaming.tables import KeyedTable
from rookery import workspace


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_histogram_fills_days(spark):
    frame = spark.createDataFrame([(dt.datetime(2020, 1, 1, 5), 2), (dt.datetime(2020, 1, 3), 4)], "created_at timestamp, v int")
    got = rel.daily_histogram(frame, "created_at", "v", "a").orderBy("day").collect()
    assert [(r.day.day, r.doc_count, r.a) for r in got] == [(1, 1, 2.0), (2, 0, None), (3, 1, 4.0)]


def test_insert_report_counts_what_is_inserted(spark):
    target = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "id int, v string")
    load = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (2, "c"), (3, "a"), (None, "n"), (None, "m")], "id int, v string")
    assert rows(merge.insert_report(target, load, ["id"])) == {(7, 2, 2, 1, 2)}
    assert merge.insert_if_absent(target, load, ["id"], ["v"]).count() == 2
    assert rows(merge.insert_report(target, load.limit(0), ["id"])) == {(0, 0, 0, 0, 0)}


def test_top_per_key_trims_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), "id").repartition(4)
    plan = rel.top_per_key(frame, ["k"], [F.desc("id")], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_insert_if_absent_first_wins(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    new = spark.createDataFrame([(1, "x", 0), (2, "b", 2), (2, "a", 1), (None, "n", 0)], "id int, v string, o int")
    assert rows(merge.insert_if_absent(target, new, ["id"], ["o"]).select("id", "v")) == {(2, "a")}


def test_change_set(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "id int, t string, n int")
    changes = spark.createDataFrame(
        [(1, 1, "update", None, 9), (1, 2, "update", "z", None), (2, 3, "delete", None, None), (2, 4, "update", "no", None),
         (4, 5, "update", "no", None), (3, 6, "delete", None, None), (3, 7, "create", "new", None)],
        "id int, seq int, op string, t string, n int",
    )
    assert rows(merge.apply_changes(base, changes, "id", ["t", "n"])) == {(1, "z", 9, 2), (3, "new", None, 2)}


def test_self_retweets_do_not_count(spark):
    users = spark.createDataFrame([(1, "a"), (2, "b")], "id int, screen_name string")
    tweets = spark.createDataFrame([(1, 1, None), (2, 1, 1), (3, 2, 1), (4, 2, 1)], "id int, user_id int, retweeted_status_id int")
    assert rows(graph.most_retweeted_authors(tweets, users)) == {("a", 1)}
    follows = spark.createDataFrame([(2, 1)], "follower_id int, followee_id int")
    assert rows(graph.popular_without_retweets(tweets, users, follows, 1)) == {("a", 1, 1)}


def test_incremental_feed_equals_rebuild(small):
    cards = feed.post_cards(small.tweets, small.users)
    whole = feed.build_feeds(cards, small.follows, 5)
    new = F.col("post_id") % 3 == 0
    step = feed.apply_posts(feed.build_feeds(cards.filter(~new), small.follows, 5), cards.filter(new), small.follows, 5)
    columns = ["user_id", "rank", "post_id"]
    assert rows(step.select(columns)) == rows(whole.select(columns))
    packed = feed.pack_feeds(whole, ["post_id"])
    assert packed.count() == whole.select("user_id").distinct().count()


def test_feed_updates_are_dealt_out_by_the_input(spark, monkeypatch):
    monkeypatch.setattr(feed, "EDGES_PER_TASK", 10)
    monkeypatch.setattr(feed, "POSTS_PER_TASK", 20)
    at = F.timestamp_seconds(F.col("id") * 60)
    posts = spark.range(200).select((F.col("id") % 40).alias("author_id"), F.col("id").alias("post_id"), at.alias("created_at"))
    follows = spark.range(160).select((F.col("id") % 40).alias("follower_id"), ((F.col("id") * 7 + 1) % 40).alias("followee_id")).distinct()
    old, new = posts.filter("post_id < 150"), posts.filter("post_id >= 100")  # fifty come twice
    feeds = feed.apply_posts(feed.build_feeds(old, follows, 3), new, follows, 3)
    own = feed.apply_own_posts(feed.own_posts(old, 3), new, 3)
    assert feeds.rdd.getNumPartitions() == 1 + follows.count() // 10
    assert own.rdd.getNumPartitions() == 1 + (120 + 100) // 20
    columns = ["user_id", "rank", "post_id"]
    assert rows(feeds.select(columns)) == rows(feed.build_feeds(posts, follows, 3).select(columns))
    assert rows(own.select(columns)) == rows(feed.own_posts(posts, 3).select(columns))


def test_projection_round_trip_and_known_point(spark):
    # a published check value of the projection lies in the west and south: both axes negative
    frame = spark.createDataFrame([(14.42, 50.09), (17.1, 48.15), (22.5, 49.0)], "x double, y double")
    grid = geo.to_grid(frame)
    first = grid.first()
    assert abs(first.x + 742_900) < 2_000 and abs(first.y + 1_042_800) < 2_500
    back = geo.to_degrees(grid)
    for a, b in zip(frame.collect(), back.collect()):
        assert abs(a.x - b.x) < 1e-7 and abs(a.y - b.y) < 1e-7


SQUARE = [(0, 0.0, 0.0), (1, 2.0, 0.0), (2, 2.0, 2.0), (3, 0.0, 2.0), (4, 0.0, 0.0)]


def ring(spark, poly, corners):
    return spark.createDataFrame([(poly, f"p{poly}", s, x, y) for s, x, y in corners], "poly_id int, name string, seq int, x double, y double")


def test_border_points_are_outside_but_touch(spark):
    square = ring(spark, 1, SQUARE)
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 1.0), (3, 3.0, 1.0), (4, 0.0, 0.0)], "id int, x double, y double")
    assert rows(spatial.within_flag(points, square, 0.7, "f").select("id", "f")) == {(1, 1), (2, 0), (3, 0), (4, 0)}
    road = spark.createDataFrame([(7, 0, 2.0, 1.0), (7, 1, 3.0, 1.0), (8, 0, 2.1, 1.0), (8, 1, 3.0, 1.0)], "road_id int, seq int, x double, y double")
    edges = spatial.segments(square, "poly_id")
    assert rows(spatial.roads_touching(road, edges, 0.5)) == {(7,)}
    centre = spatial.centroids(square).first()
    assert (centre.x, centre.y, centre.signed_area) == (1.0, 1.0, 4.0)


def test_polygon_within_concave(spark):
    u_shape = ring(spark, 9, list(enumerate_pairs([(0, 0), (6, 0), (6, 6), (4, 6), (4, 2), (2, 2), (2, 6), (0, 6), (0, 0)])))
    spans = ring(spark, 1, list(enumerate_pairs([(1, 3), (5, 3), (5, 4), (1, 4), (1, 3)])))
    foot = ring(spark, 2, list(enumerate_pairs([(0, 0), (6, 0), (6, 1), (0, 1), (0, 0)])))
    got = rows(spatial.polygons_within(spans.unionByName(foot), u_shape, 1.0))
    assert got == {(2, 9)}


def enumerate_pairs(pairs):
    return [(i, float(x), float(y)) for i, (x, y) in enumerate(pairs)]


def test_zone_cells_equal_a_raster_and_are_few(spark):
    city = ring(spark, 1, [(s, x * 1000, y * 1000) for s, x, y in SQUARE])
    land = ring(spark, 2, list(enumerate_pairs([(-9e3, -9e3), (9e3, -9e3), (9e3, 2.2e3), (-9e3, 2.2e3), (-9e3, -9e3)])))
    finest = 12.5

    def raster(step):
        at = (np.arange(-1200 // step, 3200 // step + 1) + 0.5) * step
        x, y = np.meshgrid(at, at)
        away = np.hypot(np.maximum(0, np.maximum(-x, x - 2000)), np.maximum(0, np.maximum(-y, y - 2000)))
        return int(((away > 0) & (away <= 1000) & (y < 2200)).sum()), x.size

    cells = spatial.zone_cells(city, land, 1000.0, finest, 5, 1000.0).collect()
    assert len({(c.i, c.j, c.width) for c in cells}) == len(cells)
    assert sum(c.width**2 for c in cells) == raster(finest)[0] * finest**2
    assert len(cells) < raster(finest)[1] / 20  # as many as the outlines are long, not as the zone is wide


def test_interval_cover_against_sampling(spark, monkeypatch):
    """Every road that a fine sampling finds near, and no other; the border has gaps, corners and a point."""
    monkeypatch.setattr(spatial, "on_grid", lambda df, x="x", y="y": df)
    rng = np.random.default_rng(7)
    borders = [(0.0, 0.0, 50.0, 0.0), (50.0, 0.0, 50.0, 40.0), (80.0, 40.0, 80.0, 40.0), (0.0, 33.0, 25.0, 33.0)]
    starts = rng.uniform(-12, 95, (200, 2))
    roads = {r: [tuple((starts[r] + rng.normal(0, 8, 2)).round(2)) for _ in range(2 + r % 2)] for r in range(200)}
    roads |= {300: [(5.0, 9.0), (45.0, 9.0)], 301: [(5.0, 10.0), (40.0, 10.0)], 302: [(5.0, 10.1), (6.0, 10.1)], 303: [(80.0, 45.0)] * 2, 304: [(9.0, 16.5), (10.0, 16.5)]}

    def near(x, y):
        out = np.full(len(x), np.inf)
        for x1, y1, x2, y2 in borders:
            dx, dy = x2 - x1, y2 - y1
            t = np.clip(((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy), 0, 1) if dx or dy else 0
            out = np.minimum(out, np.hypot(x - x1 - t * dx, y - y1 - t * dy))
        return out

    want = set()
    for r, v in roads.items():
        t = np.linspace(0, 1, 20001)
        if all((near(a[0] + t * (b[0] - a[0]), a[1] + t * (b[1] - a[1])) <= 10 + 1e-9).all() for a, b in zip(v, v[1:])):
            want.add(r)
    vertices = spark.createDataFrame([(r, i, float(x), float(y)) for r, v in roads.items() for i, (x, y) in enumerate(v)], "road_id int, seq int, x double, y double")
    edges = spark.createDataFrame(borders, "x1 double, y1 double, x2 double, y2 double")
    assert {300, 301, 303} < want and 302 not in want and len(want) > 5
    assert {r.road_id for r in spatial.roads_within(vertices, edges, 10.0).collect()} == want


def haversine(x1, y1, x2, y2):
    x1, y1, x2, y2 = map(np.radians, (x1, y1, x2, y2))
    a = np.sin((y2 - y1) / 2) ** 2 + np.cos(y1) * np.cos(y2) * np.sin((x2 - x1) / 2) ** 2
    return 2 * geo.EARTH_RADIUS * np.arcsin(np.sqrt(a))


def test_points_near_and_nearest_anywhere_on_the_globe(spark):
    rng = np.random.default_rng(8)
    x, y = rng.uniform(-180, 180, 400), np.degrees(np.arcsin(rng.uniform(-1, 1, 400)))
    x, y = np.r_[x, rng.uniform(-180, 180, 200), np.full(50, 180.0), rng.normal(20, 0.01, 150)], np.r_[y, rng.uniform(88, 90, 200), rng.uniform(-1, 1, 50), rng.normal(48, 0.01, 150)]
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))], "id int, x double, y double")
    qx, qy = np.r_[x[::9], -180.0, 179.999, 0.0, 20.0, 20.3], np.r_[y[::9], 0.5, -0.5, 90.0, 48.0, 48.2]
    queries = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(qx, qy))], "query_id int, qx double, qy double")
    away = haversine(qx[:, None], qy[:, None], x, y)
    for metres in (2_000.0, 90_000.0, 3_000_000.0, 15_000_000.0):
        got = {(r.query_id, r.id) for r in spatial.points_near(points, queries, metres).collect()}
        sure, may = set(zip(*np.nonzero(away <= metres - 1e-3))), set(zip(*np.nonzero(away <= metres + 1e-3)))
        assert sure <= got <= may
    got = {r.query_id: r.metres for r in spatial.nearest_points(points, queries).collect()}
    assert len(got) == len(qx) and np.allclose([got[i] for i in range(len(qx))], away.min(axis=1), atol=1e-3)
    assert spatial.nearest_points(points.limit(0), queries).count() == 0


def test_polygon_within_looks_between_touching_vertices(spark):
    # the outer border leaves the inner edge at (7, 3), dips below it and comes back at (8, 3)
    notched = ring(spark, 9, list(enumerate_pairs([(0, 0), (10, 0), (10, 6), (8.5, 6), (8, 3), (7.5, 2), (7, 3), (6.5, 6), (0, 6), (0, 0)])))
    across = ring(spark, 1, list(enumerate_pairs([(1, 1), (9, 1), (9, 3), (1, 3), (1, 1)])))
    below = ring(spark, 2, list(enumerate_pairs([(1, 1), (9, 1), (9, 2), (1, 2), (1, 1)])))
    inside = ring(spark, 3, list(enumerate_pairs([(0, 0), (7, 0), (7, 3), (0, 3), (0, 0)])))
    inner = across.unionByName(below).unionByName(inside)
    assert rows(spatial.polygons_within(inner, notched, 1.0)) == {(2, 9), (3, 9)}


def test_replayed_posts_and_repeated_follows_change_nothing(spark):
    at = dt.datetime(2020, 1, 1)
    cards = spark.createDataFrame([(2, 10, at, "a"), (2, 11, at, "a")], "author_id int, post_id int, created_at timestamp, username string")
    follows = spark.createDataFrame([(1, 2)], "follower_id int, followee_id int")
    once = feed.apply_posts(feed.build_feeds(cards.filter("post_id = 10"), follows), cards, follows)
    twice = feed.apply_posts(once, cards, follows)
    assert rows(twice.select("user_id", "rank", "post_id")) == rows(once.select("user_id", "rank", "post_id")) == {(1, 1, 11), (1, 2, 10)}
    counters = spark.createDataFrame([(1, 0, 1), (2, 1, 0), (3, 0, 0)], "id int, followers_count int, following_count int")
    added = spark.createDataFrame([(1, 2), (3, 2), (3, 2)], follows.schema)
    never = spark.createDataFrame([(2, 3)], follows.schema)
    assert rows(feed.apply_follow_counts(counters, follows, added, never)) == {(1, 0, 1), (2, 2, 0), (3, 0, 1)}


def test_follow_log_keeps_the_last_change_of_a_pair(spark):
    follows = spark.createDataFrame([(1, 2), (3, 2), (5, 2)], "follower_id int, followee_id int")
    log = spark.createDataFrame(
        [(1, 2, "unfollow", 1), (1, 2, "follow", 2), (3, 2, "follow", 3), (3, 2, "unfollow", 4), (4, 2, "follow", 5), (4, 2, "follow", 6),
         (6, 2, "follow", 7), (6, 2, "unfollow", 8), (5, 2, "follow", 9), (7, 2, "unfollow", 9)],
        "follower_id int, followee_id int, op string, seq int",
    )
    added, removed = feed.net_changes(log, follows)
    assert rows(added) == {(4, 2)} and rows(removed) == {(3, 2)}
    counters = spark.createDataFrame([(i, 3 if i == 2 else 0, 1 if i in (1, 3, 5) else 0) for i in range(1, 8)], "id int, followers_count int, following_count int")
    after = feed.apply_follow_counts(counters, follows, added, removed)
    assert {r.id: (r.followers_count, r.following_count) for r in after.collect()} == {1: (0, 1), 2: (3, 0), 3: (0, 0), 4: (0, 1), 5: (0, 1), 6: (0, 0), 7: (0, 0)}
    # the same batch again finds nothing to do
    again = feed.net_changes(log, feed.apply_changes_to_follows(follows, added, removed))
    assert [df.count() for df in again] == [0, 0]
    # without an order, a pair that is in both sets stays
    both = spark.createDataFrame([(1, 2)], follows.schema)
    kept = feed.apply_follow_counts(counters, follows, both, both)
    assert {r.id: r.followers_count for r in kept.collect()}[2] == 3
    cards = spark.createDataFrame([(2, 10, dt.datetime(2020, 1, 1), "a")], "author_id int, post_id int, created_at timestamp, username string")
    feeds = feed.apply_follow_changes(feed.build_feeds(cards, follows), cards, follows, both, both)
    assert rows(feeds.select("user_id", "post_id")) == {(1, 10), (3, 10), (5, 10)}


def test_late_and_repeated_events_count_once(spark, tmp_path):
    schema = "event_id int, user_id int, ts timestamp"
    source = f"{tmp_path}/in"
    for batch in ([(1, 7, dt.datetime(2020, 1, 20))], [(2, 7, dt.datetime(2020, 1, 1)), (1, 7, dt.datetime(2020, 1, 20))]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    for _ in range(2):  # a second call finds nothing new
        got = jobs.maintain_rows(jobs.count_once(stream, "event_id", ["user_id"]), ["user_id"], f"{tmp_path}/out", f"{tmp_path}/at")
        assert rows(got) == {(7, 2)}


def keyed(spark, tmp_path, **more):
    schema = spark.createDataFrame([], "k long, v string").schema
    return KeyedTable(spark, f"{tmp_path}/table", schema, ["k"], **more)


def test_keyed_table_newest_row_wins_and_replay_changes_nothing(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=4, fanout=3)
    put = lambda rows, batch: table.put(spark.createDataFrame(rows, "k long, v string"), batch)
    want = {}
    assert table.rows().count() == 0 and table.holding(spark.range(3).toDF("k")).count() == 0
    for batch in range(10 + 1):
        new = [(k, f"{batch}") for k in range(batch, 20, 1 + batch % 3)]
        put([(99, "crashed")], batch)  # a first attempt that is replayed
        put(new, batch)
        want |= dict(new)
    assert rows(table.rows()) == set(want.items())
    asked = spark.createDataFrame([(3,), (7,), (None,), (55,)], "k long")
    assert rows(table.holding(asked)) == {(k, v) for k, v in want.items() if k in (3, 7)}
    assert "10" not in {v for _, v in rows(table.rows(before=10))}
    # merged in tiers: fewer than ``fanout`` segments in each, and no more folders than two manifests name
    segments = table._segments()
    tiers = [t for _, t in segments]
    assert all(tiers.count(t) < 3 for t in tiers) and max(tiers) >= 1
    assert len(list((tmp_path / "table" / "manifest").iterdir())) <= 2
    assert len(list((tmp_path / "table" / "segments").glob("segment=*"))) <= len(segments) + 6


def test_ten_batches_read_less_than_three_times_what_one_does(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=64)
    table.put(spark.range(20000).select(F.col("id").alias("k"), F.lit("old").alias("v")), 0)
    one = table.opened(spark.range(20000).toDF("k"), before=1).count()
    read = 0
    for batch in range(1, 11):
        keys = spark.range(batch * 7, batch * 7 + 7).toDF("k")
        opened = table.opened(keys, before=batch)
        assert "PartitionFilters: [bucket" in opened._jdf.queryExecution().executedPlan().toString().replace("isnotnull(bucket", "bucket")
        read += opened.count()
        table.put(keys.withColumn("v", F.lit(f"{batch}")), batch)
    assert one == 20000 and read < 3 * one
    assert table.rows().filter("v <> 'old'").count() == 70


def test_stubs_become_users_when_described_later(spark, tmp_path):
    def lines(name, *documents):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / name).write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))

    user = lambda n: {"id": n, "screen_name": f"u{n}"}
    mention = {"user_mentions": [{"id": 2, "screen_name": "m2"}, {"id": 3, "screen_name": "m3"}]}
    grow = lambda: jobs.grow_relations(spark, f"{tmp_path}/in", "*.txt", f"{tmp_path}/out", f"{tmp_path}/at", 1)
    lines("a.txt", {"id": 10, "text": "first", "user": user(1), "entities": mention}, "{broken")
    grown = grow()
    assert {(r.id, r.screen_name, r.stub) for r in grown["users"].collect()} == {(1, "u1", False), (2, "m2", True), (3, "m3", True)}
    lines("b.txt", {"id": 11, "text": "t", "user": user(2), "entities": mention}, {"id": 10, "text": "later", "user": {"id": 1, "screen_name": "new"}})
    grown = grow()
    assert {(r.id, r.screen_name, r.stub) for r in grown["users"].collect()} == {(1, "u1", False), (2, "u2", False), (3, "m3", True)}
    assert {(r.id, r.full_text) for r in grown["tweets"].collect()} == {(10, "first"), (11, "t")}
    assert grown["tweet_user_mentions"].count() == 4
    refused = spark.read.parquet(f"{tmp_path}/out/refused")
    assert {(r.relation, r.reason) for r in refused.collect()} == {("lines", "not valid JSON")}


def test_state_goes_to_disk_and_the_setting_comes_back(spark, tmp_path):
    before = spark.conf.get(jobs.STATE_STORE)
    spark.createDataFrame([(1, 7), (1, 7), (2, 7)], "event_id int, user_id int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("event_id int, user_id int").parquet(f"{tmp_path}/in")
    with jobs.state_on_disk(spark):
        counted = jobs.count_once(stream, "event_id", ["user_id"])
        assert rows(jobs.maintain_rows(counted, ["user_id"], f"{tmp_path}/out", f"{tmp_path}/at")) == {(7, 2)}
    assert spark.conf.get(jobs.STATE_STORE) == before
    assert list((tmp_path / "at" / "state").rglob("*.zip"))


def test_interleaved_layout_skips_row_groups_on_either_column(spark, tmp_path):
    import pyarrow.parquet as pq

    frame = spark.range(40000).select(
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("int").alias("a"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5000)).alias("b")
    )
    stored = {
        "curve": merge.write_interleaved(frame, "a", "b", 64), "sorted": merge.write_clustered(frame, ["a", "b"], 64),
    }

    def opened(table, column, low, high):
        """Row groups whose statistics leave the range possible."""
        count = 0
        for path in table.inputFiles():
            meta = pq.ParquetFile(path.removeprefix("file://").removeprefix("file:")).metadata
            at = meta.schema.names.index(column)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                count += stats.min <= high and stats.max >= low
        return count

    for table in stored.values():
        assert table.filter("a between 100 and 150 and b between 1000 and 1200").count() == frame.filter("a between 100 and 150 and b between 1000 and 1200").count()
        assert table.count() == 40000
    assert opened(stored["sorted"], "b", 1000, 1200) >= 60  # a plain order helps its first column only
    for column, low, high in (("a", 100, 150), ("b", 1000, 1200)):
        assert opened(stored["curve"], column, low, high) <= 24
    odd = spark.createDataFrame([(None, 1), (2, None), (2, 2)], "a int, b int")
    assert merge.write_interleaved(odd, "a", "b").count() == 3 and merge.write_interleaved(odd.limit(0), "a", "b").count() == 0


def rings_of(spark, poly, *outlines):
    """Rings given as (hole, corners), numbered in order."""
    table = [
        (poly, f"p{poly}", number, hole, seq, float(x), float(y))
        for number, (hole, corners) in enumerate(outlines) for seq, (x, y) in enumerate([*corners, corners[0]])
    ]
    return spark.createDataFrame(table, "poly_id int, name string, ring int, hole boolean, seq int, x double, y double")


def box(x1, y1, x2, y2):
    return [(x1, y1), (x2, y1), (x2, y2), (x1, y2)]


def test_holes_and_islands_by_even_odd(spark):
    # the hole is wound like the outline, the island the other way: neither matters
    lake = rings_of(spark, 1, (False, box(0, 0, 10, 10)), (True, box(2, 2, 8, 8)), (False, box(4, 4, 5, 5)[::-1]))
    points = spark.createDataFrame([(1, 1.0, 1.0), (2, 3.0, 3.0), (3, 4.5, 4.5), (4, 2.0, 3.0), (5, 4.0, 4.5), (6, 11.0, 3.0)], "id int, x double, y double")
    for size in (0.7, 3.0, 50.0):
        assert rows(spatial.points_within(points, lake, size)) == {(1, 1), (3, 1)}
    got = spatial.centroids(lake).first()
    assert got.signed_area == 100 - 36 + 1
    assert math.isclose(got.x, (100 * 5 - 36 * 5 + 4.5) / 65) and math.isclose(got.y, got.x)
    assert rows(spatial.names(lake)) == {(1, "p1")}


def test_polygons_within_those_with_holes(spark):
    lake = rings_of(spark, 9, (False, box(0, 0, 10, 10)), (True, box(2, 2, 8, 8)), (False, box(4, 4, 6, 6)))
    gap = rings_of(spark, 8, (False, box(20, 0, 24, 4)), (False, box(24, 4, 28, 8)), (False, box(20, 4, 24, 8)), (False, box(24, 0, 28, 4)))
    inner = [
        rings_of(spark, 1, (False, box(1, 1, 9, 9))),  # goes round the hole
        rings_of(spark, 2, (False, box(1, 1, 9, 9)), (True, box(2, 2, 8, 8))),  # has the same hole
        rings_of(spark, 3, (False, box(4, 4, 5, 5))),  # on the island
        rings_of(spark, 4, (False, box(3, 3, 7, 7))),  # island and water
        rings_of(spark, 5, (False, box(1, 1, 9, 9)), (True, box(3, 3, 7, 7))),  # a smaller hole
        rings_of(spark, 6, (False, box(0, 0, 2, 2))),  # touches the hole in a corner
        rings_of(spark, 7, (False, box(1, 1, 9, 9)), (True, box(2, 2, 8, 8)), (False, box(4, 4, 6, 6))),
        rings_of(spark, 10, (False, box(21, 1, 23, 3))),  # in one part of several
    ]
    outer = lake.unionByName(gap)
    some = inner[0]
    for one in inner[1:]:
        some = some.unionByName(one)
    assert rows(spatial.polygons_within(some, outer, 2.5)) == {(2, 9), (3, 9), (6, 9), (7, 9), (10, 8)}


def test_texts_of_several_rings(spark):
    from rookery.sources import geometry

    long = ", ".join(f"{i} {i % 7}" for i in range(100_000))
    texts = {
        1: "POLYGON((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 1))",
        2: " multipolygon ( ((0 0,4 0,4 4,0 0)) , ((5 5,6 5,6 6,5 5),(5.1 5.1,5.2 5.1,5.2 5.2,5.1 5.1)) ) ",
        3: f"POLYGON(({long}, 0 0))",
        4: "LINESTRING(0 0, 1 1)",
        5: "POINT(1 -2.5e1)",
        -1: "POLYGON((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 2 2, 1 9))",  # the hole is open
        -2: "MULTIPOLYGON((0 0, 4 0, 4 4, 0 0))",
        -3: "POLYGON((0 0, 4 0, 4 4, 0 0)",
        -4: "POLYGON EMPTY",
        -5: "LINESTRING(0 0)",
        -6: None,
        -7: "",
    }
    table, refused = geometry.load_geometries(spark.createDataFrame(list(texts.items()), "osm_id int, wkt string"), "wkt", 4326)
    assert {r.osm_id for r in refused.collect()} == {k for k in texts if k < 0}
    found = {r.osm_id: r.t for r in table.select("osm_id", geometry.as_text(table.kind, table.rings).alias("t")).collect()}
    assert found[1] == "POLYGON((0.0 0.0,4.0 0.0,4.0 4.0,0.0 0.0),(1.0 1.0,2.0 1.0,2.0 2.0,1.0 1.0))"
    assert found[2] == (
        "MULTIPOLYGON(((0.0 0.0,4.0 0.0,4.0 4.0,0.0 0.0)),((5.0 5.0,6.0 5.0,6.0 6.0,5.0 5.0),(5.1 5.1,5.2 5.1,5.2 5.2,5.1 5.1)))"
    )
    assert found[4] == "LINESTRING(0.0 0.0,1.0 1.0)" and found[5] == "POINT(1.0 -25.0)"
    counts = {tuple(r) for r in geometry.vertex_table(table, "osm_id").groupBy("osm_id", "ring", "hole").count().collect()}
    assert counts == {(1, 0, False, 4), (1, 1, True, 4), (2, 0, False, 4), (2, 1, False, 4), (2, 2, True, 4),
                      (3, 0, False, 100_001), (4, 0, False, 2), (5, 0, False, 1)}


def test_texts_join_the_tweets_last(small):
    plan = small.tweets._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join Inner" in line]
    assert "doc_id" in joins[0] and "c_custkey" in "".join(joins[1:])


def test_only_shown_texts_go_through_the_joins_of_posts(spark):
    from rookery.operators import feed

    tweets = spark.createDataFrame([(i, 7, "2024-01-01", f"t{i}", i) for i in range(6)], "id long, user_id long, created_at string, full_text string, favorite_count long")
    urls = spark.createDataFrame([(0, "u0"), (2, "u2"), (2, "u1")], "tweet_id long, url string")
    tags = spark.createDataFrame([(0, "b"), (0, "a")], "tweet_id long, tag string")
    posts = feed.typed_posts(tweets, urls, tags)
    assert {r.id: tuple(r)[3:] for r in posts.collect()} == {
        0: ("image", None, "u0", "a", None, None), 3: ("image", None, None, None, None, None),
        1: ("text", "t1", None, None, None, None), 4: ("text", "t4", None, None, None, None),
        2: ("video", None, None, None, "u1", 2), 5: ("video", None, None, None, None, 5),
    }
    lines = posts._jdf.queryExecution().optimizedPlan().toString().splitlines()
    cut = next(i for i, line in enumerate(lines) if " AS text" in line)
    assert cut > max(i for i, line in enumerate(lines) if "Join LeftOuter" in line)


def test_nearest_points_measure_few_pairs_in_a_crowd(spark, monkeypatch):
    placed = [(n, 10.0 + n * 1e-6, 80.0) for n in range(400)] + [(n, 10.0, 85.0) for n in range(1000, 1300)]
    points = spark.createDataFrame(placed, "id int, x double, y double")
    asked = spark.createDataFrame([(q, 10.0 + (q * 10 + 0.3) * 1e-6, 80.0) for q in range(40)] + [(99, 10.0, 85.01)], "query_id int, qx double, qy double")
    pairs, best = [], spatial.best_per_key
    monkeypatch.setattr(spatial, "best_per_key", lambda df, *a: pairs.append(df.count()) or best(df, *a))
    got = {(r.query_id, r.id) for r in spatial.nearest_points(points, asked).collect()}
    assert got == {(q, q * 10) for q in range(40)} | {(99, 1000)}
    assert sum(pairs) < 4_000  # 40 queries times 400 points, and 300 in one place, were 16,300


def test_latitudes_beyond_a_pole_lie_on_the_other_side(spark):
    points = spark.createDataFrame([(1, -170.0, 88.0), (2, 10.0, 92.0), (3, 10.0, 88.0), (4, 10.0, -92.0), (5, -170.0, -88.0)], "id int, x double, y double")
    asked = spark.createDataFrame([(1, 10.0, 92.001), (2, -170.0, 88.001), (3, 10.0, -92.001)], "query_id int, qx double, qy double")
    got = {(r.query_id, r.id) for r in spatial.points_near(points, asked, 1_000.0).collect()}
    assert got == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 4), (3, 5)}


def test_a_batch_of_lines_leaves_no_staged_tables(spark, tmp_path, monkeypatch):
    import gzip

    (tmp_path / "in").mkdir()
    with gzip.open(tmp_path / "in" / "a.txt.gz", "wt") as out:
        out.writelines(json.dumps({"id": n, "text": f"t{n}", "user": {"id": n % 7, "screen_name": "u"}}) + "\n" for n in range(1, 50))
        out.write("{broken\n")
    monkeypatch.setattr(workspace, "shared_root", lambda _: f"{tmp_path}/shared")
    grown = jobs.grow_relations(spark, f"{tmp_path}/in", "*.txt*", f"{tmp_path}/out", f"{tmp_path}/at")
    assert list((tmp_path / "shared" / "rookery").iterdir()) == []
    assert {r.full_text for r in grown["tweets"].collect()} == {f"t{n}" for n in range(1, 50)} and grown["users"].count() == 7
    assert [r.reason for r in spark.read.parquet(f"{tmp_path}/out/refused").collect()] == ["not valid JSON"]


def test_typed_posts_carry_numbers_until_their_texts_join(spark, capsys):
    numbers = [(1, 7), (4, 7), (7, None), (10, 9), (2, 7), (4, 8)]
    posts = spark.createDataFrame([(i, "text" if i % 3 == 1 else "video", n if i % 3 == 1 else None) for i, n in numbers], "id bigint, type string, text bigint")
    texts = spark.createDataFrame([(7, "seven"), (8, "eight"), (9, None)], "text_id bigint, body string")
    shown = feed.with_texts(posts, texts)
    assert shown.columns == posts.columns
    assert sorted((r.id, r.text) for r in shown.collect() if r.text) == [(1, "seven"), (4, "eight"), (4, "seven")]
    assert sorted(r.id for r in shown.collect()) == [1, 2, 4, 4, 7, 10]


def test_wide_posts_shuffle_each_text_once(spark, small, capsys):
    from rookery.plans import JOBS

    moved = JOBS["f_11"].build(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        capsys.readouterr()
        JOBS["f_11"].build(small).explain("formatted")
        plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [e for e in plan.split("\n\n") if "Exchange" in e.split("\n")[0]]
    assert exchanges and sum("body" in e or "full_text" in e for e in exchanges) == 1
    want = {(r.id, r.full_text) for r in small.tweets.collect() if r.id % 3 == 1}
    assert {(r.id, r.text) for r in moved.collect() if r.type == "text"} == want
