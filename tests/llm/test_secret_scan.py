"""Secret spans against the re module and DuckDB, and the trigram queries behind the index."""

import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from rookery.llm import secret_scan as s


def spans(text, rules=s.RULES):
    found = []
    for n, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.least:
                found.append((m.start(), n, f"{rule.kind}:{m.start()}:{m.end()}"))
    return [label for *_, label in sorted(found)]


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_report_equals_plain_matching(which, request):
    docs = request.getfixturevalue(which)
    want = []
    for r in docs.select("doc_id", "text").collect():
        base = spans(r.text, s.BASE_RULES)
        counts = [sum(x.startswith(k + ":") for x in base) for k in ("assign", "access", "hex")]
        want.append((r.doc_id, *counts, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(spans(r.text))))
    got = [tuple(r) for r in s.report(docs).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_a_dropped_match_still_consumes(spark):
    docs = spark.createDataFrame([(1, "secret: token: abcdefgh TOKEN='abc' token=abcdef")], "doc_id long, text string")
    assert s.report(docs).first().spans == ",".join(spans("secret: token: abcdefgh TOKEN='abc' token=abcdef"))


def test_trigram_queries():
    assert s.trigram_query("[0-9a-f]+") == [] and s.trigram_query("ab") == [] and s.trigram_query("(abc|x)") == []
    assert s.trigram_query("AKIA[A-Z0-9]+") == [frozenset({frozenset({"aki", "kia"})})]
    assert s.trigram_query("(abc|de[fg])") == [frozenset(map(frozenset, ({"abc"}, {"def"}, {"deg"})))]
    assert s.trigram_query("abc.*(xyz)?") == [frozenset({frozenset({"abc"})})]
    assert s.trigram_query("(?:abc.d|xyz)") == [frozenset(map(frozenset, ({"abc"}, {"xyz"})))]
    assert s.trigram_query("(abc)+") == [frozenset({frozenset({"abc"})})]


def spelled(rng, nodes):
    """A random text that the parsed pattern matches."""
    out = []
    for name, value in nodes:
        kind = str(name)
        if kind == "LITERAL":
            out.append(chr(value))
        elif kind == "ANY":
            out.append(rng.choice("qz7 "))
        elif kind == "IN":
            first, what = rng.choice(value)
            out.append(chr(what if str(first) == "LITERAL" else rng.randint(*what)))
        elif kind == "SUBPATTERN":
            out.append(spelled(rng, value[-1]))
        elif kind == "BRANCH":
            out.append(spelled(rng, rng.choice(value[1])))
        else:
            least, most, inner = value
            out += [spelled(rng, inner) for _ in range(rng.randint(least, min(int(most), least + 2)))]
    return "".join(out)


def random_pattern(rng, depth=0):
    pieces = []
    for _ in range(rng.randint(1, 3)):
        kind = rng.randint(0, 5 if depth < 2 else 3)
        piece = "".join(rng.choice("abcD-") for _ in range(rng.randint(1, 4)))
        if kind == 1:
            piece = rng.choice(["[0-9]", "[ab]", "[A-Z]", ".", "[abx0-9]"])
        elif kind >= 4:
            piece = "(?:" + "|".join(random_pattern(rng, depth + 1) for _ in range(rng.randint(1, 3))) + ")"
        if kind in (1, 5):
            piece += rng.choice(["", "?", "+", "*", "{2}", "{0,2}", "{3,}"])
        pieces.append(piece)
    return "".join(pieces)


def satisfied(text, pattern):
    folded = text.lower()
    return all(any(all(t in folded for t in some) for some in clause) for clause in s.trigram_query(pattern))


def test_every_match_satisfies_its_trigram_query():
    rng = random.Random(5)
    asked = 0
    for _ in range(1500):
        pattern = random_pattern(rng)
        asked += bool(s.trigram_query(pattern))
        for _ in range(4):
            text = spelled(rng, re._parser.parse(pattern))
            assert satisfied(text, pattern), (pattern, text)  # no regex engine here: nested repeats would take it for ever
    assert asked > 300


def test_unknown_characters_inside_a_pattern(spark):
    patterns = {"abc[0-9]{4}def": "abc1234def", "foo([A-Z]b)ar": "fooXbar", "xoxb-[0-9]{12}-[0-9]{12}-[a-z]+": "xoxb-123456789012-123456789012-abc"}
    rules = tuple(s.Rule(f"k{n}", pattern) for n, pattern in enumerate(patterns))
    docs = spark.createDataFrame([(n, f"see {text} here") for n, text in enumerate(patterns.values())], "doc_id long, text string")
    assert {r.doc_id: [x.kind for x in r.found] for r in s.scan(docs, rules).collect()} == {n: [f"k{n}"] for n in range(3)}


def test_redaction_with_clashing_columns(spark):
    names = ["doc_id", "text", "kinds", "found", "candidate", "kept", "trigram", "n_chars"]
    docs = spark.createDataFrame([(1, "token=abcdefgh", "a", "b", "c", "d", "e", 3)], names)
    row = s.redact(docs).first()
    assert row.asDict() == dict(zip(names, (1, "<secret>", "a", "b", "c", "d", "e", 8)))


def test_index_names_every_holder(documents):
    rules = tuple(r for r in s.RULES if s.trigram_query(r.pattern))
    vocabulary = sorted({t for r in rules for c in s.trigram_query(r.pattern) for a in c for t in a})
    index = s.build_index(documents, vocabulary)
    named = {(r.doc_id, k) for r in s.candidates(index, rules).collect() for k in r.kinds}
    for r in documents.select("doc_id", "text").collect():
        for label in spans(r.text, rules):
            assert (r.doc_id, label.split(":")[0]) in named
    assert len(named) < documents.count()


def test_redaction_leaves_no_span(odd, documents):
    for docs in (odd, documents):
        masked = s.redact(docs)
        assert masked.columns == docs.columns and masked.count() == docs.count()
        assert s.report(masked).where("spans <> ''").count() == 0
    kept = s.redact(documents).join(s.report(documents).where("spans = ''"), "doc_id").select("doc_id", "text")
    assert kept.exceptAll(documents.select("doc_id", "text")).count() == 0
    assert s.redact(documents).where(F.length("text") != F.col("n_chars")).count() == 0


def test_rules_without_trigrams_only_and_empty_tables(documents, spark):
    assert s.report(documents.limit(0)).count() == 0
    only = s.scan(documents, (s.BASE_RULES[2],))
    assert only.count() == documents.count()


def test_no_python_in_the_plan(documents):
    plan = s.report(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow(Eval|Map)|MapIn", plan)


def test_sql_form(documents, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf}/documents.parquet'")
    want = sorted(con.execute(s.oracle()).fetchall())
    assert sorted(tuple(r) for r in s.report(documents).collect()) == want
