"""Views over the supplied tables, as one SQL text for both engines (see FIXTURES.md)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    "users": """
select c_custkey as id, c_name as screen_name, c_name as name, c_mktsegment as description,
  c_custkey % 10 = 0 as verified, c_custkey % 17 = 0 as protected,
  cast(floor(abs(c_acctbal)) as bigint) % 1000 as followers_count,
  (c_custkey*37) % 2000 as friends_count, (c_custkey*13) % 5000 as statuses_count, n_name as location
from customer join nation on n_nationkey = c_nationkey""",
    "places": """
select n_name as id, concat(n_name, ', ', r_name) as full_name, r_name as country,
  substr(r_name,1,2) as country_code, 'country' as place_type
from nation join region on r_regionkey = n_regionkey""",
    "tweets": """
select o_orderkey as id, o_orderdate as created_at, d.text as full_text, d.lang as lang, o_custkey as user_id,
  o_orderpriority as source,
  case when o_orderkey % 5 = 0 then (o_orderkey*104729+7) % (n_o*2) end as in_reply_to_status_id,
  case when o_orderkey % 7 = 0 then (o_orderkey*31+5) % (n_o+n_o) end as quoted_status_id,
  case when o_orderkey % 2 = 0 then (o_orderkey*7919+13) % n_o end as retweeted_status_id,
  case when o_orderkey % 3 = 0 then n_name end as place_id,
  cast(floor(o_totalprice) as bigint) % 100 as retweet_count, (o_orderkey*11) % 500 as favorite_count,
  o_orderstatus = 'P' as possibly_sensitive
from orders cross join (select count(*) as n_o from orders) co cross join (select count(*) as n_d from documents) cd
  join documents d on d.doc_id = o_orderkey % n_d join customer on c_custkey = o_custkey
  join nation on n_nationkey = c_nationkey""",
    "tweet_hashtag": """
select distinct l_orderkey as tweet_id, p_brand as tag from lineitem join part on p_partkey = l_partkey
where l_orderkey % 3 = 0""",
    "tweet_user_mentions": """
select distinct l_orderkey as tweet_id, (l_suppkey*97+l_partkey) % (n_c*2) as mentioned_user_id,
  concat('M', cast((l_suppkey*97+l_partkey) % (n_c*2) as varchar(20))) as mentioned_screen_name
from lineitem cross join (select count(*) as n_c from customer) cc where l_linenumber <= 2""",
    "tweet_urls": """
select distinct l_orderkey as tweet_id, p.url as url
from lineitem cross join (select count(*) as n_p from pages) cp
  join pages p on p.page_id = l_partkey % n_p where l_linenumber = 1""",
    "tweet_media": """
select distinct l_orderkey as tweet_id, l_partkey as media_id, p_type as type
from lineitem join part on p_partkey = l_partkey where l_returnflag = 'R'""",
    "follows": """
select distinct follower_id, followee_id from (select c_custkey as follower_id,
  cast(floor(((c_custkey*31+i*17)%100)*((c_custkey*31+i*17)%100)*((c_custkey*7+i*11)%1000)*n_c / 1e7) as bigint)
    as followee_id
  from customer cross join (select count(*) as n_c from customer) cc
  cross join (values (1),(2),(3),(4),(5),(6),(7),(8)) e(i)) z where follower_id <> followee_id""",
    "comments": """
select event_id as id, (event_id*31) % n_o as post_id, user_id as author_id, event_type as text, ts as created_at
from events cross join (select count(*) as n_o from orders) co where event_type in ('click','error')""",
    "reactions": """
select event_id as id, user_id, (event_id*17) % n_o as target_id, 'like' as type, ts as created_at
from events cross join (select count(*) as n_o from orders) co where event_type in ('purchase','view')""",
    "district_ring": """
select n_nationkey as poly_id, n_name as name, 0 as ring, false as hole, seq, 16.9e0 + gi*1.1e0 + ((gi*7+gj*3)%5)/5e1 as x,
  47.7e0 + gj*3.8e-1 + ((gi*3+gj*11)%4)/8e1 as y
from (select n_nationkey, n_name, seq, n_nationkey%5+di as gi, cast(floor(n_nationkey/5e0) as int)+dj as gj
  from nation cross join (values (0,0,0),(1,1,0),(2,1,1),(3,0,1),(4,0,0)) c(seq,di,dj)) g
union all select n_nationkey, n_name, ring, ring = 1, seq, 16.9e0 + n_nationkey%5*1.1e0 + dx, 47.7e0 + floor(n_nationkey/5e0)*3.8e-1 + dy
from nation cross join (values (1,0,3e-1,1.2e-1),(1,1,7e-1,1.2e-1),(1,2,7e-1,2.6e-1),(1,3,3e-1,2.6e-1),(1,4,3e-1,1.2e-1),
  (2,0,4e-1,1.6e-1),(2,1,4e-1,2.2e-1),(2,2,6e-1,2.2e-1),(2,3,6e-1,1.6e-1),(2,4,4e-1,1.6e-1)) h(ring,seq,dx,dy)
where n_nationkey % 3 = 0 and (ring = 1 or n_nationkey % 2 = 0)""",
    "region_ring": """
select r_regionkey as poly_id, r_name as name, 0 as ring, false as hole, seq, 16.9e0 + gi*1.1e0 + ((gi*7+gj*3)%5)/5e1 as x,
  47.7e0 + gj*3.8e-1 + ((gi*3+gj*11)%4)/8e1 as y
from (select r_regionkey, r_name, seq, gi, r_regionkey+dj as gj from region cross join
  (values (0,0,0),(1,1,0),(2,2,0),(3,3,0),(4,4,0),(5,5,0),(6,5,1),(7,4,1),(8,3,1),(9,2,1),(10,1,1),(11,0,1),(12,0,0))
    c(seq,gi,dj)) g
union all select r_regionkey, r_name, ring, true, seq, 16.9e0 + gi*1.1e0 + 5e-1 + m*sx, 47.7e0 + r_regionkey*3.8e-1 + 1.9e-1 + (m-1.3e-1)*sy
from region cross join (values (0,1,3,2e-1),(0,2,1,2e-1),(1,1,4,2.2e-1),(2,1,2,2e-1)) h(r,ring,gi,m)
  cross join (values (0,-1,-1),(1,-1,1),(2,1,1),(3,1,-1),(4,-1,-1)) c(seq,sx,sy) where r_regionkey = r""",
    "geo_points": """
select c_custkey as id, c_name as name, 17e0 + ((c_custkey*7919)%100000)/1e5*5.2e0 as x,
  47.75e0 + ((c_custkey*104729+17)%100000)/1e5*1.75e0 as y from customer""",
    "road_vertex": """
select o_orderkey as road_id, k as seq,
  17e0 + ((o_orderkey*7919)%100000)/1e5*5e0 + k*(((o_orderkey*13)%41)-20)/1e3 as x,
  47.8e0 + ((o_orderkey*104729)%100000)/1e5*1.6e0 + k*(((o_orderkey*29)%31)-15)/1e3 as y
from orders cross join (values (0),(1),(2),(3)) e(k)""",
}

# The order in which Spark joins: inner joins commute, and wide texts are joined last so that no other join shuffles them.
_TEXT_JOIN = "join documents d on d.doc_id = o_orderkey % n_d"
_OTHER_JOINS = "join customer on c_custkey = o_custkey\n  join nation on n_nationkey = c_nationkey"
SPARK_VIEWS = {"tweets": VIEWS["tweets"].replace(f"{_TEXT_JOIN} {_OTHER_JOINS}", f"{_OTHER_JOINS} {_TEXT_JOIN}")}

_ANY_BASE = re.compile(r"\b(" + "|".join(BASE_TABLES) + r")\b")
_ANY_VIEW = re.compile(r"\b(" + "|".join(VIEWS) + r")\b")


class Tables:
    """Attribute access to the supplied tables and the views over them."""

    def __init__(self, spark: SparkSession, sf_dir: str, spread_scans: bool = False):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        self._spread_scans = spread_scans

    def spread(self) -> Tables:
        """The same tables for CPU-heavy row work: a scan with fewer splits than cores is dealt out over all of them.

        A table of many files keeps its own splits, so at scale this adds no shuffle.
        """
        return self if self._spread_scans else Tables(self.spark, self.sf_dir, True)

    def replacing(self, name: str, frame: DataFrame) -> Tables:
        """The same tables but for a supplied one; the views read the given frame in its place."""
        other = Tables(self.spark, self.sf_dir, self._spread_scans)
        other._frames = {n: f for n, f in self._frames.items() if n in BASE_TABLES} | {name: frame}
        return other

    def _scan(self, name: str) -> DataFrame:
        scan = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        cores = self.spark.sparkContext.defaultParallelism
        if self._spread_scans and scan.rdd.getNumPartitions() < cores:
            return scan.repartition(cores)
        return scan

    def __getattr__(self, name: str) -> DataFrame:
        frames = self.__dict__["_frames"]
        if name not in frames:
            if name in BASE_TABLES:
                frames[name] = self._scan(name)
            elif name in VIEWS:
                text = SPARK_VIEWS.get(name, VIEWS[name])
                used = set(_ANY_BASE.findall(text))
                frames[name] = self.spark.sql(
                    _ANY_BASE.sub(r"{\1}", text), **{base: getattr(self, base) for base in used}
                )
            else:
                raise AttributeError(name)
        return frames[name]


def with_views(body: str) -> str:
    """Oracle text: the views a query names, inlined in front of it."""
    used = [name for name in VIEWS if name in set(_ANY_VIEW.findall(body))]
    heads = [f"{name} as ({VIEWS[name].strip()})" for name in used]
    body = body.strip()
    if body[:5].lower() == "with ":
        heads.append(body[5:])
        return "with " + ",\n".join(heads)
    return ("with " + ",\n".join(heads) + "\n" if heads else "") + body
