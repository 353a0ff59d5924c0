"""Column expressions for text analysis; all of it stays inside the JVM.

Tokens approximate Unicode word boundaries: runs of letters, marks, digits and ``_``, joined by an inner apostrophe or
dot. There is no segmentation of scripts written without spaces.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from rookery.functions.stemming import porter_stem

# The English stop list of the published analyser.
STOP_WORDS = (
    "a an and are as at be but by for if in into is it no not of on or such that the their then there these they this "
    "to was will with"
).split()

WORD = r"[\p{L}\p{M}\p{N}_]+(?:['’.][\p{L}\p{M}\p{N}_]+)*"
POSSESSIVE_TAILS = tuple(mark + s for mark in "'’＇" for s in "sS")
POSSESSIVE = r"['’＇][sS]$"

# Elements that sit inside a line of text; every other tag ends the line.
INLINE_TAGS = "a abbr b bdo big cite code dfn em font i kbd q s samp small span strike strong sub sup tt u var".split()
# The named entities that occur in ordinary text.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))

HTML_HIDDEN = r"(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<!--.*?-->"
HTML_INLINE = r"(?i)</?(?:" + "|".join(INLINE_TAGS) + r")(?:\s[^>]*)?/?>"
HTML_TAG = r"</?[A-Za-z!?][^>]*>"


def _fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """ASCII folding of Latin letters, from Unicode decompositions."""
    # Letters without a decomposition.
    plain = {"ø": "o", "đ": "d", "ł": "l", "ð": "d", "ı": "i", "’": "'", "‘": "'"}
    wide = (("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"))
    for code in [*range(0xE0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)
        if letter.islower() and len(base) > 1 and base[0].isascii():
            plain[letter] = base[0]
    return "".join(plain), "".join(plain.values()), wide


FOLD_FROM, FOLD_TO, FOLD_WIDE = _fold_tables()


def strip_html(text: Column) -> Column:
    """Drop scripts, styles, comments and tags; inline tags join their neighbours, others break the line.

    A text without ``<`` has no markup and one without ``&`` no entity, so such texts are not searched for them.
    """
    tagless = F.regexp_replace(text, HTML_HIDDEN, "\n")
    tagless = F.regexp_replace(tagless, HTML_INLINE, "")
    tagless = F.regexp_replace(tagless, HTML_TAG, "\n")

    def decoded(out: Column) -> Column:
        for name, char in ENTITIES:
            out = F.replace(out, F.lit(name), F.lit(char))
        return out

    return (
        F.when(F.contains(text, F.lit("<")), decoded(tagless)).when(F.contains(text, F.lit("&")), decoded(text)).otherwise(text)
    )


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def plain_term(word: Column) -> Column:
    """Possessive cut and lower case."""
    owner = F.substring(word, -2, 2).isin(*POSSESSIVE_TAILS)
    return F.lower(F.when(owner, F.left(word, F.length(word) - 2)).otherwise(word))


def folded(text: Column) -> Column:
    """Lower case and ASCII fold, usable as a join key."""
    out = F.translate(F.lower(text), FOLD_FROM, FOLD_TO)
    for letter, plain in FOLD_WIDE:
        out = F.replace(out, F.lit(letter), F.lit(plain))
    return out


def folded_words(text: Column) -> Column:
    """The folded words of a text, folded as a whole before it is cut.

    Folding turns no other character into part of a word, save the opening quote, which is left out here as no word has it. The
    lower case of a capital sigma depends on what follows, so texts with one are cut first.
    """
    quote = FOLD_FROM.index("‘")
    whole = F.translate(F.lower(text), FOLD_FROM[:quote] + FOLD_FROM[quote + 1 :], FOLD_TO[:quote] + FOLD_TO[quote + 1 :])
    for letter, plain in FOLD_WIDE:
        whole = F.replace(whole, F.lit(letter), F.lit(plain))
    return F.when(F.contains(text, F.lit("Σ")), F.transform(words(text), folded)).otherwise(words(whole))


def grams(text: Column, size: int) -> Column:
    """All overlapping character n-grams, in linear time; none when the text is shorter."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def analyse_query(text: str, stem: bool = True) -> list[tuple[str, int]]:
    """Terms of a query string with their positions, analysed like the documents."""
    import regex

    out = []
    for position, word in enumerate(regex.findall(WORD, text)):
        term = re.sub(POSSESSIVE, "", word).lower()
        if term not in STOP_WORDS:
            out.append((porter_stem(term) if stem else term, position))
    return out
