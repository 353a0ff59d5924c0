"""Personal data replaced by keyed surrogates of the same type, format, script and gender.

Entities are found in whole texts and reduced to a normal value (an address in lower case, the digits of a number, the
parts of a name). Each distinct value of a type gets one surrogate, drawn by a keyed hash of (type, value, attempt), so
the same person or number reads the same everywhere (coreference), and without the key nothing leads back. Before use the
surrogates are checked against each other and against all values found in the corpus: of values that drew the same
surrogate the first keeps it, the others and those that drew a real value draw again (distinctness). Names and addresses grow with
the attempts, so they soon settle; where real values fill a space that cannot grow, such as that of private IP addresses, what is
left after a fixed number of draws exchanges its real values in keyed order, which is as distinct. An occurrence is then
written in its own format: separators, brackets, length and letter case stay.

Names are found after titles and, without one, where a given name of the lists stands before a capitalised word; a name found once
in a text is replaced at every other place where the text has it capitalised. Given names that are not listed stay unless a title
or another place gives them away.

Numbers keep their length, a phone number its country code, a card number its validity, an address its top-level domain,
an IP address its private or public kind; a given name keeps gender and script, a family name its script.

Null texts stay null and hold nothing; repeated rows are rewritten alike; an empty table gives an empty result. Texts
without entities are not shuffled; of the others only positions and values are, and the texts once.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rookery.llm.batches import slices
from rookery.workspace import stage

EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
NUMBER = re.compile(
    r"(?P<ip>(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\.?\d))"
    r"|(?P<phone>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\d))"
    r"|(?P<phone2>(?<![\d)])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d))"
    r"|(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))"
    r"|(?P<account>(?<!\d)\d{4}(?:[ -]\d{4}){3}(?!\d)|(?<!\d)\d{12,19}(?!\d))"
)
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
NAME = re.compile(
    r"(?P<title>Mr|Mrs|Ms|Miss|Herr|Frau|Señor|Señora|Monsieur|Madame|Господин|Госпожа)\.? "
    r"(?P<first>[^\W\d_a-z][\w'’-]+)(?: (?P<last>[^\W\d_a-z][\w'’-]+))?"
)
# a full name without a title: a given name that the lists hold before a capitalised word
FULL_NAME = re.compile(
    r"(?<![\w'’-])(?P<first>[^\W\d_a-z][^\W\d_A-Z]+) "
    r"(?P<last>[^\W\d_a-z](?:['’][^\W\d_a-z])?[^\W\d_A-Z][\w'’-]*)"
)
CAPITALISED = re.compile(r"(?<![\w'’-])[^\W\d_a-z][\w'’-]+")
# fixed values: titles of women; all others are of men
FEMALE = {"Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа"}
# fixed values: names to choose from, by script and part
NAMES = {
    "latin": {
        "m": (
            "Adam Albert Andrew Anthony Boris Brian Carl Charles Daniel David Edward Emil Eric Felix Georg George Henry Hugo "
            "Ivan Jacob James John Jonas Joseph Karel Kevin Leon Louis Martin Michael Noel Oscar Patrick Paul Peter Richard "
            "Robert Simon Stephen Steven Thomas Timothy Walter William"
        ).split(),
        "f": (
            "Alice Amanda Anna Barbara Bella Carol Clara Diana Dorothy Elena Elizabeth Emily Emma Flora Greta Helen Irene "
            "Jennifer Jessica Julia Karen Karin Laura Linda Lisa Margaret Maria Martha Mary Michelle Nancy Nora Olga Patricia "
            "Petra Rebecca Rosa Sandra Sarah Sonja Susan Teresa Ursula Victoria"
        ).split(),
        "family": "Adler Becker Costa Dahl Ebner Fischer Garcia Haas Jensen Keller Lopez Marin Novak Olsen Perez Roth".split(),
    },
    "cyrillic": {
        "m": "Андрей Борис Виктор Денис Егор Иван Кирилл Максим Олег Павел".split(),
        "f": "Анна Вера Галина Елена Зоя Ирина Мария Нина Ольга Софья".split(),
        "family": "Белов Волков Громов Жуков Зайцев Козлов Лебедев Морозов Орлов Соколов".split(),
    },
}
SYLLABLES = {
    "latin": "ba be di do fa fe ga go ka ke la le mi mo na ne ra ro sa so ta ti va ve".split(),
    "cyrillic": "ба бо да де ка ко ла ле ма мо на но ра ро са со та то ва ве".split(),
}
GIVEN = {name: f"name_{g}" for names in NAMES.values() for g in "mf" for name in names[g]}
LISTED = 2  # draws from the lists of names; later ones are made of syllables
DRAWS = 12
KINDS = ("email", "phone", "ip", "ssn", "account", "iban", "name_m", "name_f", "name_family")


def script_of(word: str) -> str:
    return "cyrillic" if any("Ѐ" <= c <= "ӿ" for c in word) else "latin"


def digits_of(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the entities, left to right without overlap; where two meet, the earlier starts stay.

    A name is known by a title before it, or by a listed given name before a capitalised word. A name known in a text is found
    wherever else the text has it as a capitalised word, of the kind it had first.
    """
    found: list[tuple[int, int, str, str]] = []
    if "@" in text:
        found += [(*m.span(), "email", m[0].lower()) for m in EMAIL.finditer(text)]
    for m in NUMBER.finditer(text):
        kind = m.lastgroup.rstrip("2")
        if kind == "ip":
            if all(int(part) < 256 for part in m[0].split(".")):
                found.append((*m.span(), "ip", m[0]))
            continue
        country = re.match(r"\+\d{1,3}(?=[ .(-])", m[0])
        digits = digits_of(m[0])
        value = f"{country[0]}|{digits[len(country[0]) - 1:]}" if country else digits
        found.append((*m.span(), kind, value))
    found += [(*m.span(), "iban", m[0].replace(" ", "")) for m in IBAN.finditer(text) if len(digits_of(m[0])) >= 8]
    people = _names(text)
    if people:
        known: dict[str, str] = {}
        for _, _, kind, value in people:
            known.setdefault(value, kind)
        placed = {p[0] for p in people}
        words = (m for m in CAPITALISED.finditer(text) if m.start() not in placed)
        people += [(*m.span(), known[m[0].lower()], m[0].lower()) for m in words if m[0][0].isupper() and m[0].lower() in known]
    found += people
    kept, end = [], 0
    for entity in sorted(found, key=lambda e: (e[0], -e[1])):
        if entity[0] >= end:
            kept.append(entity)
            end = entity[1]
    return kept


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Names that a title or a listed given name gives away."""
    found = []
    for m in NAME.finditer(text):
        parts = [("first", "f" if m["title"] in FEMALE else "m"), ("last", "family")] if m["last"] else [("first", "family")]
        found += [(*m.span(part), f"name_{kind}", m[part].lower()) for part, kind in parts]
    placed = {f[0] for f in found}
    for m in FULL_NAME.finditer(text):
        kind = GIVEN.get(m["first"])
        if kind and m["last"][0].isupper() and m.start("first") not in placed and m.start("last") not in placed:
            found += [(*m.span("first"), kind, m["first"].lower()), (*m.span("last"), "name_family", m["last"].lower())]
    return sorted(found)


class Draw:
    """A stream of numbers below given bounds, keyed by (key, kind, value, attempt)."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.seed = hmac.new(key, f"{kind}\0{value}\0{attempt}".encode(), hashlib.sha256).digest()
        self.state = int.from_bytes(self.seed * 4, "little")

    def below(self, n: int) -> int:
        if self.state < 1 << 64:
            self.seed = hashlib.sha256(self.seed).digest()
            self.state = int.from_bytes(self.seed * 4, "little")
        self.state, chosen = divmod(self.state, n)
        return chosen

    def like(self, text: str) -> str:
        """Digits for digits and letters for letters, everything else as it is."""
        return "".join(
            str(self.below(10)) if c.isdigit() else chr(97 + self.below(26)) if c.isalpha() else c for c in text
        )


def luhn(digits: str) -> int:
    """The check sum of a digit string: 0 for a valid card number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10


def surrogate(key: bytes, kind: str, value: str, attempt: int) -> str:
    """The replacement of a normal value, in normal form; other attempts give other ones."""
    draw = Draw(key, kind, value, attempt)
    if kind == "email":
        local, domain = value.split("@", 1)
        host, top = domain.rsplit(".", 1)
        more = "".join(chr(97 + draw.below(26)) for _ in range(attempt // 2))
        return f"{draw.like(local)}{more}@{draw.like(host)}.{top}"
    if kind == "ip":
        parts = value.split(".")
        private = re.match(r"10\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.", value)
        kept = 0 if not private else 1 if parts[0] == "10" else 2
        while True:
            fresh = parts[:kept] + [str(1 + draw.below(254)) for _ in parts[kept:]]
            if private or not (fresh[0] in ("10", "127") or ".".join(fresh[:2]) in ("192.168", "169.254")):
                return ".".join(fresh)
    if kind == "iban":
        return value[:2] + "".join(
            str(draw.below(10)) if c.isdigit() else chr(65 + draw.below(26)) for c in value[2:]
        )
    if kind.startswith("name_"):
        script = script_of(value)
        names = NAMES[script][kind[5:]]
        if attempt < LISTED:
            return names[draw.below(len(names))].lower()
        syllables = SYLLABLES[script]
        return "".join(syllables[draw.below(len(syllables))] for _ in range(2 + attempt // 2))
    country, bar, digits = value.rpartition("|")
    fresh = str(1 + draw.below(9)) + draw.like(digits[1:])
    if kind == "account" and luhn(digits) == 0:
        fresh = fresh[:-1] + next(d for d in "0123456789" if luhn(fresh[:-1] + d) == 0)
    return country + bar + fresh


def written(occurrence: str, kind: str, chosen: str) -> str:
    """The surrogate in the format of one occurrence."""
    if kind in ("phone", "ssn", "account"):
        country, bar, digits = chosen.rpartition("|")
        rest, left = occurrence[len(country):] if bar else occurrence, iter(digits)
        return (country if bar else "") + "".join(next(left, "") if c.isdigit() else c for c in rest)
    if kind == "iban":
        left = iter(chosen)
        return "".join(c if c == " " else next(left, "") for c in occurrence)
    if occurrence.isupper():
        return chosen.upper()
    return chosen.title() if occurrence[:1].isupper() and kind.startswith("name_") else chosen


# --- Spark -------------------------------------------------------------------------------------------------------------

ENTITY = "array<struct<start:int,end:int,kind:string,value:string>>"


def entities(docs: DataFrame) -> DataFrame:
    """The frame's doc_id and text with a column ``found`` of all entities."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("value", pa.string())]))
        for part in slices(batches, "text"):
            rows = [
                [dict(zip(("start", "end", "kind", "value"), e)) for e in find(t)] if t else []
                for t in part.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text"), pa.array(rows, kind)], ["doc_id", "text", "found"]
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, f"doc_id long, text string, found {ENTITY}")


def _drawn(values: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, attempt, chosen)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            chosen = [surrogate(key, r["kind"], r["value"], r["attempt"]) for r in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(chosen, pa.string())], [*batch.schema.names, "chosen"])

    return values.select("kind", "value", "attempt").mapInArrow(
        run, "kind string, value string, attempt int, chosen string"
    )


def mapping(values: DataFrame, key: bytes) -> DataFrame:
    """(kind, value, chosen): a surrogate for each distinct (kind, value), distinct in its kind and no value of it."""
    real = stage(values.select("kind", "value").distinct(), "entity-values")
    current = stage(_drawn(real.withColumn("attempt", F.lit(0)), key), "surrogates")
    order = Window.partitionBy("kind", "chosen").orderBy("attempt", "value")
    taken = real.select(F.col("kind").alias("k"), F.col("value").alias("v"))
    for attempt in range(1, DRAWS + 1):
        ranked = current.withColumn("place", F.row_number().over(order))
        marked = ranked.join(taken, (F.col("kind") == F.col("k")) & (F.col("chosen") == F.col("v")), "left")
        marked = stage(marked.withColumn("again", (F.col("place") > 1) | F.col("v").isNotNull()).drop("k", "v", "place"), "marked")
        settled, left = marked.where("not again").drop("again"), marked.where("again").drop("again")
        if left.isEmpty():
            return settled.select("kind", "value", "chosen")
        if attempt < DRAWS:
            fresh = _drawn(left.withColumn("attempt", F.lit(attempt)), key)
            current = stage(settled.unionByName(fresh), "surrogates")
    return settled.select("kind", "value", "chosen").unionByName(_exchanged(left, key))


def _format(value: Column) -> Column:
    """What a surrogate must keep of a value: country, network or top-level domain, and the length."""
    kept = F.regexp_extract(value, r"^(\+\d+\||10\.|192\.168\.|172\.\d+\.)|(\.\w+)$", 0)
    return F.concat_ws("|", kept, F.when(~value.rlike(r"^(\d+\.){3}\d+$"), F.length(value)))


def _exchanged(left: DataFrame, key: bytes) -> DataFrame:
    """Values that found no free surrogate take one another's place, each that of the next in keyed order.

    No surrogate drawn is a real value, so these are distinct from all of them. A value that is alone in its format is doubled.
    """
    turn = Window.partitionBy("kind", "format").orderBy(F.sha2(F.concat(F.lit(key.hex()), "value"), 256), "value")
    kept = left.withColumn("format", _format(F.col("value")))
    after = F.coalesce(F.lead("value").over(turn), F.first("value").over(turn))
    placed = kept.withColumn("after", after)
    alone = F.concat("value", F.lit("0"), F.translate("value", "@|.", ""))
    return placed.select("kind", "value", F.when(F.col("after") == F.col("value"), alone).otherwise(F.col("after")).alias("chosen"))


def replace(docs: DataFrame, key: bytes) -> DataFrame:
    """(doc_id, text, n_entities): every row, its entities replaced by surrogates."""
    # detected once: positions and values are written beside the texts, and both branches read them
    every = stage(entities(docs).withColumn("row", F.monotonically_increasing_id()), "entity-texts")
    clean = every.where(F.size("found") == 0).select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"))
    holding = every.where(F.size("found") > 0)
    listed = holding.select("row", F.explode("found").alias("e")).select("row", "e.*")
    chosen = mapping(listed, key)
    swaps = listed.join(chosen, ["kind", "value"]).groupBy("row").agg(
        F.collect_list(F.struct("start", "end", "kind", "chosen")).alias("swaps")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            texts = []
            for text, made in zip(part.column("text").to_pylist(), part.column("swaps").to_pylist()):
                pieces, at = [], 0
                for s in sorted(made, key=lambda s: s["start"]):
                    pieces += [text[at : s["start"]], written(text[s["start"] : s["end"]], s["kind"], s["chosen"])]
                    at = s["end"]
                texts.append("".join([*pieces, text[at:]]))
            counts = pa.compute.list_value_length(part.column("swaps")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(texts, pa.string()), counts], ["doc_id", "text", "n_entities"]
            )

    rewritten = holding.join(swaps, "row").select("doc_id", "text", "swaps")
    return clean.unionByName(rewritten.mapInArrow(run, "doc_id long, text string, n_entities long"))
