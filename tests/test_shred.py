import datetime as dt
import gzip
import json
import re
import time

from pyspark.sql import functions as F

from rookery.functions.scalar import parse_timestamp
from rookery.operators import shred
from rookery.plans import corpus, ingest
from rookery.sources import documents as docs
from rookery.views import Tables
from rookery import workspace
from rookery.workspace import fresh_folder, stage


def status(n, **more):
    return {"id": n, "text": f"t{n}", "user": {"id": n * 10, "screen_name": f"u{n}"}, **more}


def write(folder, name, lines):
    folder.mkdir(exist_ok=True)
    body = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n"
    opener = gzip.open if name.endswith(".gz") else open
    with opener(folder / name, "wt") as out:
        out.write(body)


def test_files_parse_and_quarantine(spark, tmp_path):
    write(tmp_path, "b.jsonl", [status(1), "", "{broken", "[1]"])
    write(tmp_path, "a.jsonl.gz", [status(2)])
    write(tmp_path, "a.jsonl", [status(3)])
    paths = docs.list_files(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a.jsonl", "b.jsonl", "a.jsonl.gz"]
    assert [p.rsplit("/", 1)[1] for p in docs.list_files(spark, str(tmp_path), limit=2, skip=1)] == ["b.jsonl"]
    checked = docs.with_parse_error(docs.clean_lines(docs.read_lines(spark, paths)))
    assert docs.good_lines(checked).count() == 3
    assert {r.reason for r in docs.quarantined_lines(checked).collect()} == {"not valid JSON", "not an object"}
    strict = docs.with_unknown_fields(spark.createDataFrame([("f", json.dumps(status(1, odd=1, place={"x": 2})))], "file string, value string"))
    assert strict.first().unknown_fields == ["$.odd", "$.place.x"]


def test_embedded_first_wins_and_violations(spark):
    deep = None
    for n in range(14, 4, -1):  # ten levels
        deep = status(n, **({"quoted_status" if n % 2 else "retweeted_status": deep} if deep else {}))
    rows = [
        ("f1", status(1, full_text="", entities={"hashtags": [{"text": " Covid "}, {"tag": "x"}, {"text": ""}, {"text": "  "}],
                                                 "urls": [{"expanded_url": "e"}, {"url": "u", "expanded_url": "e"}],
                                                 "user_mentions": [{"id_str": "77", "screen_name": "m"}, {"name": "none"}]})),
        ("f2", {**status(1), "text": "later"}),
        ("f1", {"text": "no id"}),
        ("f1", deep),
    ]
    lines = spark.createDataFrame([(f, json.dumps(d)) for f, d in rows], "file string, value string")
    assert shred.unroll(lines).filter("depth = 9").select("status_id").first()[0] == 14
    built, refused = shred.build_relations(shred.unroll(lines))
    tweets = {r.id: r.full_text for r in built["tweets"].collect()}
    assert tweets == {1: "t1", **{n: f"t{n}" for n in range(5, 15)}}
    assert {r.tag for r in built["hashtags"].collect()} == {"Covid", "x"}
    assert {(r.id, r.screen_name) for r in built["users"].collect()} == {(n * 10, f"u{n}") for n in (1, *range(5, 15))} | {(77, "m")}
    assert [(r.url, r.unwound_url) for r in built["tweet_urls"].collect()] == [("u", "e")]
    assert [(r.relation, r.reason) for r in refused.collect()] == [("tweet_urls", "url is NULL")]
    assert {r.id for r in built["users"].filter("stub").collect()} == {77}
    again, _ = shred.build_relations(shred.unroll(lines), built)
    assert all(df.count() == 0 for df in again.values())


def test_odd_types_cost_a_column_not_the_line(spark):
    rows = [
        {"id": 1, "text": {"x": 1}, "user": "nobody", "entities": {"hashtags": "none", "urls": [{"url": "u"}]}, "place": None},
        {"id": "2", "text": "t", "user": {"id": 20, "name": ["a"]}, "quoted_status": "gone", "retweeted_status": {"id": 3.0, "text": None}},
        {"id": {"no": 1}, "id_str": "4", "quoted_status": {"text": "no id", "quoted_status": {"id_str": "5"}}},
    ]
    values = [json.dumps(r) for r in rows] + ["", "null", "[]", '"text"', "{}", '{"id": 9', None]
    found = shred.unroll(spark.createDataFrame([("f", v) for v in values], "file string, value string"))
    got = {(r.status_id, r.depth): r.doc for r in found.collect()}
    assert got.keys() == {(1, 0), (2, 0), (3, 1), (4, 0), (5, 2)}
    assert got[1, 0].text == '{"x":1}' and got[1, 0].user is None and got[1, 0].entities.hashtags is None
    assert got[1, 0].entities.urls[0].url == "u" and got[2, 0].user.name == '["a"]'


def test_lines_of_unsplit_files_are_dealt_out(spark, tmp_path):
    write(tmp_path, "a.jsonl.gz", [status(n) for n in range(40)])
    write(tmp_path, "b.jsonl", [status(n) for n in range(40, 50)])
    lines = docs.read_lines(spark, docs.list_files(spark, str(tmp_path)), spread=4)
    assert lines.count() == 50 and lines.rdd.getNumPartitions() >= 5
    assert docs.lines_per_file(lines).count() == 2


def test_timestamps(spark):
    values = ["Mon Mar 09 01:02:03 +0100 2020", "2020-03-09T00:02:03.000Z", "1583712123000", "junk", "9999999999999999999", "999999999999999999"]
    frame = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in frame.select(F.date_format(parse_timestamp(F.col("v")), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2020-03-09 00:02:03"] * 3 + [None] * 3


def test_staged_paths_are_fresh(spark):
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")


def test_compressed_lines_are_dealt_by_place_without_a_sort(spark, tmp_path):
    write(tmp_path, "a.jsonl.gz", [status(n) for n in range(500)])
    lines = docs.read_lines(spark, docs.list_files(spark, str(tmp_path)), spread=6)
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and lines.rdd.getNumPartitions() == 6
    assert sorted(json.loads(r.value)["id"] for r in lines.collect()) == list(range(500))


def nested_tables(spark):
    """Six statuses, two of which quote or repeat others; two documents with one id, one without a text."""
    t = Tables(spark, "/nowhere")
    frames = {
        "region": ([(0, "R")], "r_regionkey int, r_name string"),
        "nation": ([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(1, "c", "m", 5.0, 0)], "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double, c_nationkey int"),
        "orders": ([(n, dt.date(2024, 1, 1), 1, "p", 3.0, "F") for n in (1, 2, 3, 5, 49, 50)],
                   "o_orderkey bigint, o_orderdate date, o_custkey bigint, o_orderpriority string, o_totalprice double, o_orderstatus string"),
        "documents": ([(0, 'zero "quoted"\n\u00e9', "en"), (1, "one", "en"), (1, "one again", "de"), (2, None, "en"), (3, "", "en")],
                      "doc_id bigint, text string, lang string"),
        "lineitem": ([], "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_returnflag string"),
        "part": ([], "p_partkey bigint, p_brand string, p_type string"),
        "pages": ([], "page_id bigint, url string"),
    }
    for name, (rows, schema) in frames.items():
        t = t.replacing(name, spark.createDataFrame(rows, schema))
    return t


def test_texts_join_the_lines_last(spark):
    t = nested_tables(spark)
    texts = corpus.numbered_texts(t)
    thin = t.replacing("documents", texts.select("doc_id", "lang", F.when(F.col("size").isNotNull(), F.struct("text_id", "size")).alias("text")))
    marked = [r.value for r in corpus.marked_lines(thin, "MARK").collect()]
    assert not any("zero" in line or "again" in line for line in marked)

    want = sorted((r.id, r.full_text) for r in t.tweets.select("id", "full_text").collect())
    lines = corpus.documents_with_embedded(t).collect()

    def text(doc):
        return doc.get("full_text", doc.get("text", doc.get("extended_tweet", {}).get("full_text")))

    whole = [(r.id, json.loads(r.value)) for r in lines]
    by_id = {}
    for n, body in want:
        by_id.setdefault(n, set()).add(body)
    assert {(n, text(d)) for n, d in whole} == set(want) and len({n for n, _ in whole}) == len(by_id)

    def walk(doc):
        yield doc
        for name in ("quoted_status", "retweeted_status"):
            if name in doc:
                yield from walk(doc[name])

    for _, top in whole:
        for doc in walk(top):
            assert text(doc) in by_id[int(doc["id_str"])]
    assert any("retweeted_status" in d for _, d in whole) and any("quoted_status" in d for _, d in whole)


def moved(frame, capsys):
    """The columns that each exchange of a plan moves."""
    capsys.readouterr()
    frame.explain("formatted")
    return re.findall(r"Exchange\nInput \[\d+\]: \[(.*)\]", capsys.readouterr().out)


def test_first_statuses_move_no_text(spark, capsys):
    # 50 lines of two files, each with one of ten ids and a copy of the next one inside; three passes deep for id 3
    deep = status(3, text="deep")
    for _ in range(9):
        deep = {"quoted_status": deep}
    rows = [(f"f{n % 2}", status(n % 10 + 1, text=f"{n}", quoted_status=status((n + 1) % 10 + 1, text=f"in {n}"))) for n in range(50)] + [("e", deep)]
    lines = spark.createDataFrame([(f, json.dumps(d)) for f, d in rows], "file string, value string").repartition(5)
    statuses = shred.unroll(lines)
    assert statuses.select("row").distinct().count() == statuses.count() == 101
    first = shred.first_statuses(statuses)
    got = {r.status_id: (r.file, r.depth) for r in first.collect()}
    assert first.count() == 10 and got[3] == ("e", 9) and got[1] == ("f0", 0) and got[2] == ("f0", 1)
    tweets = shred.relation(statuses, "tweets")
    columns = moved(tweets, capsys)
    assert columns and not any("doc" in c or "text" in c for c in columns)
    texts = {r.id: r.full_text for r in tweets.collect()}
    assert len(texts) == 10 and texts[3] == "deep" and texts[2].startswith("in ") and not texts[1].startswith("in ")
    built, _ = shred.build_relations(statuses)
    assert sorted(built["tweets"].select("id").collect()) == [(n,) for n in range(1, 11)]


def test_statuses_are_written_without_a_sort(spark, capsys):
    statuses = shred.unroll(spark.createDataFrame([("f", json.dumps(status(1)))], "file string, value string"))
    [folder] = {f.rsplit("/", 1)[0] for f in statuses.inputFiles()}
    assert "deeper=" not in folder


def test_stored_lines_are_the_lines(spark, tmp_path, capsys):
    write(tmp_path, "a.jsonl.gz", [status(n) for n in range(40)])
    write(tmp_path, "b.jsonl", [status(n) for n in range(40, 50)])
    paths = docs.list_files(spark, str(tmp_path))
    lines = docs.stored_lines(spark, paths, per_file=10)
    assert moved(lines, capsys) == [] and len(lines.inputFiles()) == 5
    assert sorted(lines.collect()) == sorted(docs.read_lines(spark, paths).collect())
    assert docs.stored_lines(spark, [p for p in paths if p.endswith("l")]).count() == 10


def test_documents_go_only_to_lines_that_embed_them(spark, capsys):
    t = nested_tables(spark)
    thin = t.replacing("documents", t.documents.select("doc_id", "lang", F.struct(F.col("doc_id").alias("text_id"), F.length("text").alias("size")).alias("text")))
    lines = corpus.marked_lines(thin, "MARK")
    capsys.readouterr()
    lines.explain("formatted")
    assert capsys.readouterr().out.count("doc:struct") == 2  # once for the lines, once for what they embed
    tops = [json.loads(r.value) for r in lines.filter("id <> 50").collect()]
    # the first row and its quote come twice, since two texts go by one number
    by_id = {r.id: r for r in t.tweets.collect()}
    for top in tops:
        target = by_id[int(top["id_str"])].retweeted_status_id
        assert ("retweeted_status" in top) == (target in by_id)
        assert "retweeted_status" not in top or int(top["retweeted_status"]["id_str"]) == target
        target = by_id[int(top["id_str"])].quoted_status_id
        assert ("quoted_status" in top) == (target in by_id)


def test_lines_that_are_parsed_lie_in_files_that_split(small):
    lines = ingest.checked(small)
    assert not [f for f in lines.inputFiles() if f.endswith(".gz")]
    names = lambda df: sorted((r.file, r.value) for r in df.select("file", "value").collect())
    assert names(lines) == names(docs.clean_lines(corpus.corpus_lines(small)))
    assert ingest.lines(small) is ingest.lines(small)


def test_shards_are_joined_from_compressed_parts(spark, tmp_path):
    lines = spark.range(3000).select((F.col("id") % 8).cast("int").alias("shard"), F.concat(F.lit("line "), "id").alias("value"))
    parts = corpus.write_parts(lines.repartition(3, "value"))
    corpus.join_parts(spark, parts, f"{tmp_path}/made")
    paths = docs.list_files(spark, f"{tmp_path}/made", corpus.PATTERNS)
    assert len(paths) == 8 and [p.endswith(".gz") for p in paths] == [False] + [True] * 7
    read = docs.read_lines(spark, paths).select(corpus.shard_of("file"), "value").collect()
    assert sorted(read) == sorted(lines.collect())
    second = paths[2].removeprefix("file:")
    assert open(second, "rb").read().count(b"\x1f\x8b\x08") >= 3  # a member a task
    assert len(gzip.open(second, "rt").read().splitlines()) == 375
    assert not workspace.folder_names(spark, parts)


def test_a_corpus_leaves_only_its_lines(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workspace, "shared_root", lambda _: str(tmp_path))
    t = nested_tables(spark)
    t.sf_dir = str(tmp_path)
    folder = corpus.corpus_folder(t)
    assert [p.name for p in (tmp_path / "rookery").iterdir()] == [folder.rsplit("/", 1)[1]]
    assert {r[0] for r in corpus.corpus_lines(t).select(corpus.shard_of("file")).collect()} == {n % 8 for n in (1, 2, 3, 5, 49, 50)}


def test_shuffle_files_go_with_the_write_that_made_them(spark):
    shuffles = lambda: {r for r in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("|").split("|") if "shuffle_" in r}
    before, setting = shuffles(), spark.conf.get(workspace.SHUFFLE_CLEANUP)
    kept = stage(spark.range(1000).repartition(5, "id").groupBy("id").count(), "dealt")
    for _ in range(40):  # they are removed by another thread
        if not (made := shuffles() - before):
            break
        time.sleep(0.25)
    assert not made and spark.conf.get(workspace.SHUFFLE_CLEANUP) == setting
    assert kept.count() == 1000
