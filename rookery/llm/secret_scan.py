"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's pattern gives a Boolean trigram query: clauses that must all hold, each a choice of trigram sets of which one
must be present whole. The index holds, for every document, the postings of the trigrams that some rule can ask for; a
posting no rule asks for would never be read, so it is not stored, and the index grows with the documents and the rules
but not with the vocabulary. Postings are intersected by grouping on (document, alternative) with the trigrams as bits,
candidates are verified with the pattern itself, and rules whose pattern demands no trigram scan every text.

Matches are leftmost, non-overlapping per rule; a match whose checked group is too short is dropped but still consumes its
characters. Offsets are code points, ends exclusive. Null texts are empty; rows with a null or repeated doc_id are verified
on their own text (the index may only name them as candidates too often); an empty table gives an empty result; columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.workspace import literal_table, stage

MOST_STRINGS = 96
SMALL_CLASS = 6
MOST_BITS = 62
Alternatives = frozenset[frozenset[str]]


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the group that must have ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


def any_case(word: str) -> str:
    """ASCII letters in either case, spelled out so that no engine folds other letters in."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# fixed values: the base rules of the contract, in its order
BASE_RULES = (
    Rule(
        "assign",
        "(" + "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key")) + ")"
        r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 6, True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", "[0-9a-f]+", 0, 24, True),
)
# Further kinds, reported beside the base ones.
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("hosting_token", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)
RULES = BASE_RULES + MORE_RULES


# --- from a pattern to a trigram query -------------------------------------------------------------------------------


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _choice(strings: set[str]) -> list[Alternatives]:
    """The clause that one of the strings stands in the text; no clause if one of them has no trigram."""
    sets = {_trigrams(s) for s in strings}
    if frozenset() in sets:
        return []
    return [frozenset(s for s in sets if not any(o < s for o in sets))]


class _Walk:
    """Strings that a pattern can spell so far, and the clauses of what stood before the last gap."""

    def __init__(self) -> None:
        self.strings: set[str] = {""}
        self.clauses: list[Alternatives] = []

    def gap(self) -> None:
        """Something unknown may stand here, so the strings on both sides of it are no longer the whole spelling."""
        self.clauses += _choice(self.strings)
        self.strings = {""}
        self.exact = False

    def follow(self, strings: set[str]) -> None:
        if len(self.strings) * len(strings) > MOST_STRINGS:
            self.gap()
        self.strings = {a + b for a, b in product(self.strings, strings)}

    def walk(self, nodes) -> _Walk:
        for name, value in nodes:
            kind = str(name)
            if kind == "LITERAL" and value < 128:  # engines fold some other letters by their neighbours
                self.follow({chr(value).lower()})
            elif kind == "IN" and (letters := _letters(value)):
                self.follow(letters)
            elif kind == "SUBPATTERN":
                self._inner([value[-1]])
            elif kind == "BRANCH":
                self._inner(value[1])
            elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                self._repeat(*value)
            elif kind not in ("AT", "ASSERT", "ASSERT_NOT"):
                self.gap()
        return self

    def _inner(self, branches) -> None:
        walks = [_Walk().walk(b) for b in branches]
        if all(not w.clauses and w.exact for w in walks):
            self.follow(set().union(*[w.strings for w in walks]))
            return
        self.gap()
        for w in walks:
            w.gap()
        if all(w.clauses for w in walks):  # one clause of each branch is enough for a sound choice
            best = [max(w.clauses, key=lambda c: min(map(len, c))) for w in walks]
            self.clauses.append(frozenset().union(*best))

    def _repeat(self, least: int, most, nodes) -> None:
        inner = _Walk().walk(nodes)
        exact = inner.exact and not inner.clauses
        if exact and (least, most) == (0, 1):
            self.follow(inner.strings | {""})
        elif exact and least == most and len(inner.strings) ** least <= MOST_STRINGS:
            for _ in range(least):
                self.follow(inner.strings)
        elif least:
            self._inner([nodes])
            self.gap()
        else:
            self.gap()

    exact = True


def _letters(items) -> set[str]:
    """The characters of a small class without ranges or negation, folded to lower case; empty for any other."""
    if any(str(name) != "LITERAL" or value >= 128 for name, value in items):
        return set()
    letters = {chr(v).lower() for _, v in items}
    return letters if len(letters) <= SMALL_CLASS else set()


def trigram_query(pattern: str) -> list[Alternatives]:
    """Clauses over the trigrams of the lower-cased text that every match must meet; empty if there are none."""
    walk = _Walk().walk(re._parser.parse(pattern))
    walk.gap()
    return list(dict.fromkeys(walk.clauses))


# --- the index ---------------------------------------------------------------------------------------------------------


def build_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """Postings (trigram, doc_id) of the given trigrams over lower-cased texts, found in one pass without a shuffle."""
    folded = docs.select("doc_id", F.lower("text").alias("folded"))
    present = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in vocabulary]))
    return folded.select("doc_id", F.explode(present).alias("trigram")).select("trigram", "doc_id")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds): the documents whose postings satisfy a rule's trigram query, with the kinds of those rules."""
    rows, clauses = [], []
    for rule in rules:
        query = trigram_query(rule.pattern)
        if query:
            clauses.append((rule.kind, len(query)))
        for c, clause in enumerate(query):
            for a, needed in enumerate(sorted(map(sorted, clause))):
                needed = needed[:MOST_BITS]  # fewer trigrams ask for less, which is sound
                rows += [(t, rule.kind, c, a, 1 << bit, (1 << len(needed)) - 1) for bit, t in enumerate(needed)]
    spark = index.sparkSession
    asked = literal_table(spark, rows, "trigram string, kind string, clause int, alternative int, bit long, whole long")
    sizes = literal_table(spark, clauses, "kind string, clauses int")
    met = (
        index.join(F.broadcast(asked), "trigram")  # as many rows as the rules have trigrams
        .groupBy("doc_id", "kind", "clause", "alternative", "whole")
        .agg(F.bit_or("bit").alias("bits"))
        .where("bits = whole")
    )
    passed = met.groupBy("doc_id", "kind").agg(F.count_distinct("clause").alias("held"))
    return (
        passed.join(F.broadcast(sizes), "kind")
        .where("held = clauses")
        .groupBy("doc_id")
        .agg(F.collect_set("kind").alias("kinds"))
    )


# --- verification ------------------------------------------------------------------------------------------------------


def _spans(rule: Rule, order: int, text: str) -> Column:
    """Spans (start, kind number, kind, end) of a rule in a text column.

    The parts between matches and the matches alternate, so the start of a match is the length of all before it.
    """
    pattern = F.lit(rule.pattern)
    parts = F.transform(F.split(text, rule.pattern, -1), F.length)
    whole = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    checked = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    item = "struct<start:int,n:int,kind:string,end:int>"
    first = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{item}>").alias("found"))

    def step(state: Column, match: Column) -> Column:
        start = state["at"] + match["part"]
        end = start + match["whole"]
        span = F.struct(start.alias("start"), F.lit(order).alias("n"), F.lit(rule.kind).alias("kind"), end.alias("end"))
        kept = F.when(match["checked"] >= rule.least, F.array_append(state["found"], span)).otherwise(state["found"])
        return F.struct(end.alias("at"), kept.alias("found"))

    zipped = F.arrays_zip(
        F.slice(parts, F.lit(1), F.size(whole)).alias("part"), whole.alias("whole"), checked.alias("checked")
    )
    return F.aggregate(zipped, first, step, lambda state: state["found"])


def narrowed(rule: Rule) -> Rule:
    """A rule that is one repeated class needs no group check: only runs long enough are matched at all."""
    if rule.group == 0 and re.fullmatch(r"\[[^\]]+\]\+", rule.pattern):
        return Rule(rule.kind, f"{rule.pattern[:-1]}{{{rule.least},}}", 0, rule.least, rule.base)
    return rule


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, found): every span of every rule, by start and then by the rules' order."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *[k for k in keep if k != "text"])
    indexed = [r for r in rules if trigram_query(r.pattern)]
    vocabulary = sorted({t for r in indexed for clause in trigram_query(r.pattern) for some in clause for t in some})
    if indexed:
        found = candidates(stage(build_index(rows, vocabulary), "trigram-index"), tuple(indexed))
        found = found.withColumnRenamed("doc_id", "candidate")
        rows = rows.join(found, F.col("doc_id").eqNullSafe(F.col("candidate")), "left").drop("candidate")
    else:
        rows = rows.withColumn("kinds", F.array().cast("array<string>"))
    every = []
    for order, rule in enumerate(rules):
        spans = _spans(narrowed(rule), order, "text")
        if rule in indexed:
            spans = F.when(F.array_contains("kinds", F.lit(rule.kind)), spans)
        else:
            # most texts hold no such run; the bare test costs one pass and saves the three of the spans
            spans = F.when(F.col("text").rlike(narrowed(rule).pattern), spans)
        every.append(F.coalesce(spans, F.array().cast("array<struct<start:int,n:int,kind:string,end:int>>")))
    return rows.select("doc_id", *keep, F.array_sort(F.concat(*every)).alias("found"))


def _listed(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def _of_kinds(kinds: list[str]):
    return lambda span: span["kind"].isin(kinds)


def report(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Contract form: counts of the base kinds, the digest of the base spans, and all spans."""
    base = [r.kind for r in rules if r.base]
    spans = scan(docs, rules)
    counts = [F.size(F.filter("found", _of_kinds([kind]))).cast("long").alias(f"n_{kind}") for kind in base]
    held = F.filter("found", _of_kinds(base))
    return spans.select(
        "doc_id", *counts, F.sha2(_listed(held), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans")
    )


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, *, mask: str = "<secret>") -> DataFrame:
    """The documents with every span replaced by a mask (overlapping spans by one), and ``n_chars`` counted anew."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    # the other columns travel in one struct, so that none can clash with a name used inside
    packed = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others]).alias("kept"))
    spans = scan(packed, rules, keep=("text", "kept"))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(state: Column, span: Column) -> Column:
        clear = F.substring(F.col("text"), state["at"] + 1, span["start"] - state["at"])
        done = F.when(span["start"] >= state["at"], F.concat(state["done"], clear, F.lit(mask)))
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), done.otherwise(state["done"]).alias("done"))

    def finish(state: Column) -> Column:
        return F.concat(state["done"], F.substring(F.col("text"), state["at"] + 1, F.length("text")))

    text = F.when(F.size("found") > 0, F.aggregate("found", first, step, finish)).otherwise(F.col("text"))
    masked = spans.withColumn("text", text)
    columns = {c: F.col("kept")[c] for c in others} | {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.select(*[columns[c].alias(c) for c in docs.columns])


# --- the same in SQL ---------------------------------------------------------------------------------------------------


def oracle(rules: tuple[Rule, ...] = RULES) -> str:
    """DuckDB SQL for ``report``: parts and matches of each rule as lists, summed up to each match."""
    lists, spans = [], []
    for n, rule in enumerate(rules):
        p = rule.pattern.replace("'", "''")
        lists.append(
            f"list_transform(string_split_regex(text, '{p}'), lambda x: length(x)) as p{n},"
            f" list_transform(regexp_extract_all(text, '{p}'), lambda x: length(x)) as w{n},"
            f" list_transform(regexp_extract_all(text, '{p}', {rule.group}), lambda x: length(x)) as c{n}"
        )
        spans.append(
            f"select r, {n} as n, '{rule.kind}' as kind, coalesce(list_sum(p{n}[1:i]), 0) + coalesce(list_sum(w{n}[1:i-1]), 0)"
            f" as s, w{n}[i] as w from (select r, p{n}, w{n}, c{n}, unnest(range(1, len(w{n}) + 1)) as i from l)"
            f" where c{n}[i] >= {rule.least}"
        )
    base = [r.kind for r in rules if r.base]
    one = "concat(kind, ':', cast(s as bigint), ':', cast(s + w as bigint))"
    return (
        "with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),\n"
        f"l as (select r, {', '.join(lists)} from d),\n"
        f"s as ({' union all '.join(spans)}),\n"
        f"g as (select r, {', '.join(f'''count(*) filter (kind = '{k}') as n_{k}''' for k in base)},"
        f" string_agg({one}, ',' order by s, n) filter (n < {len(base)}) as b, string_agg({one}, ',' order by s, n) as a"
        " from s group by r)\n"
        f"select doc_id, {', '.join(f'cast(coalesce(n_{k}, 0) as bigint) as n_{k}' for k in base)},"
        " sha256(coalesce(b, '')) as base_sha256, coalesce(a, '') as spans from d left join g using (r)"
    )
