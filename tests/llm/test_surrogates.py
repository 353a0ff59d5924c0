"""Surrogates: nothing personal left, formats kept, one surrogate a value and one value a surrogate."""

import re

from rookery.llm import surrogates as s

KEY = b"test"
SAMPLE = (
    "Mr. John Smith and Frau MÜLLER: Foo.Bar7@mail2.Example.com, +1 (017) 555-7713, 4111 1111 1111 1111, 10.0.0.1, 999.1.1.1,"
    " Госпожа Анна Белова, DE89 3704 0044 0532 0130 00, 123-45-6789, version 1.2.3.4.5"
)


def test_found_kinds():
    kinds = [e[2] for e in s.find(SAMPLE)]
    assert kinds == ["name_m", "name_family", "name_family", "email", "phone", "account", "ip", "name_f", "name_family", "iban", "ssn"]


def test_names_without_titles_and_said_again():
    marked = [
        ("[John] [Smith] and [Mary] [Jones] met.", "m family f family"),
        ("Mr. [John] [Smith] called. [Smith] said no, and SMITHS or smith or Smithson stayed; [SMITH]!", "m family family family"),
        ("Frau [Ünal] wrote; later [Ünal] came with [Peter] [O'Neil].", "family family m family"),
        ("[Анна] Белова: [Анна]".replace("Белова", "[Белова]"), "f family f"),
        ("The Apache License. Of Of General Public, John met no one; Paul and Rosa", ""),
    ]
    for text, kinds in marked:
        plain = text.replace("[", "").replace("]", "")
        want, shift = [], 0
        for m in re.finditer(r"\[([^\]]+)\]", text):
            want.append((m.start() - shift, m[1].lower()))
            shift += 2
        got = s.find(plain)
        assert [(e[0], e[3]) for e in got] == want and [e[2][5:] for e in got] == kinds.split()
        assert all(plain[e[0] : e[1]].lower() == e[3] for e in got)


def test_one_person_reads_the_same_everywhere(spark):
    text = "Mr. John Smith called. Smith said no. Mary Smith agreed with JOHN."
    docs = spark.createDataFrame([(1, text), (2, "Frau Smith met Adam Keller")], "doc_id long, text string")
    one, two = (r.text for r in sorted(s.replace(docs, KEY).collect(), key=lambda r: r.doc_id))
    m = re.fullmatch(r"Mr\. (\w+) (\w+) called\. (\w+) said no\. (\w+) (\w+) agreed with (\w+)\.", one)
    assert m and m[2] == m[3] == m[5] and m[1].upper() == m[6] and m[4] != m[1]
    assert "Smith" not in one + two and "John" not in one and two.split()[1] == m[2]


def test_documents(documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    forward = {}
    for row in s.replace(documents, KEY).collect():
        before, after = s.find(texts[row.doc_id]), s.find(row.text)
        assert row.n_entities == len(before) and [e[2] for e in before] == [e[2] for e in after]
        if not before:
            assert row.text == texts[row.doc_id]
        for a, b in zip(before, after):
            assert forward.setdefault(a[2:], b[2:]) == b[2:]
    assert len(set(forward.values())) == len(forward) and not set(forward) & set(forward.values())


def test_formats(spark):
    docs = spark.createDataFrame([(1, SAMPLE), (2, SAMPLE.upper())], "doc_id long, text string")
    rows = {r.doc_id: r.text for r in s.replace(docs, KEY).collect()}
    text = rows[1]
    assert text[:4] == "Mr. " and len(text.split(", ")) == len(SAMPLE.split(", "))
    entities = {e[2]: (text[e[0] : e[1]], e[3]) for e in s.find(text)}
    assert s.luhn(entities["account"][1]) == 0 and entities["account"][0].count(" ") == 3
    assert entities["ip"][0].startswith("10.") and entities["phone"][0].startswith("+1 (")
    assert entities["email"][0].endswith(".com") and s.script_of(entities["name_f"][0]) == "cyrillic"
    assert entities["name_f"][1] in [n.lower() for n in s.NAMES["cyrillic"]["f"]] and "999.1.1.1" in text and "1.2.3.4.5" in text


def test_more_names_than_the_list_holds(spark):
    values = spark.createDataFrame([("name_m", f"n{i}") for i in range(60)] + [("name_m", "adam")], "kind string, value string")
    rows = s.mapping(values, KEY).collect()
    assert len({r.chosen for r in rows}) == len(rows) == 61 and not {r.chosen for r in rows} & {r.value for r in rows}


def test_odd_rows(odd, documents):
    got = s.replace(odd, KEY)
    assert got.count() == odd.count() and got.where("text is null").count() == 1
    assert s.replace(documents.limit(0), KEY).count() == 0


def test_full_spaces_settle_in_a_fixed_number_of_draws(spark):
    emails = [("email", f"{a}@{b}.co") for a in map(chr, range(97, 123)) for b in map(chr, range(97, 123))]
    private = [("ip", f"192.168.{a}.{b}") for a in range(1, 255) for b in range(1, 255, 8)] + [("ip", "192.168.9.3")]
    names = [("name_m", f"name{i}") for i in range(3000)]
    full = [("ip", f"192.168.{a}.{b}") for a in range(1, 255) for b in range(1, 255)]
    for values in (emails + private + names, full):
        rows = s.mapping(spark.createDataFrame(values, "kind string, value string"), KEY).collect()
        assert {(r.kind, r.value) for r in rows} == set(values)
        assert len({(r.kind, r.chosen) for r in rows}) == len(rows) == len(set(values))
        assert all(r.chosen != r.value for r in rows)
        assert all(r.chosen.startswith("192.168.") for r in rows if r.kind == "ip")
