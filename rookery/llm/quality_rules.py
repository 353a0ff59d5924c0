"""Quality rules: counted base rules, and a calibrated n-gram classifier against a fixed threshold.

Words are maximal runs without ASCII white space, lines are cut at line feeds. Null texts have no words and fail the base
rule, as do texts of fewer words than ``fewest``; repeated rows are judged alike; an empty table gives an empty result.
All counts are exact and over whole texts; one Arrow pass, no shuffle.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rookery.llm.batches import slices, texts_of
from rookery.llm.ngram_model import FitBounds, NgramModel, fit, labelled_sample

SYMBOLS, BLANKS = "#*$%&|<>", " \t\n\r\x0b\x0c"
WINDOW = 5
SIGNALS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Limits:
    """Fixed thresholds: fewest words, largest percentage of repeated words, least probability of good quality."""

    fewest: int = 10
    repeated: int = 20
    probability: float = 0.5


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of five that stand twice or more in the text, the first ones included."""
    windows = list(zip(*[words[i:] for i in range(WINDOW)]))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    cover = np.zeros(len(words) + 1, np.int64)
    again = np.flatnonzero(np.fromiter((seen[w] > 1 for w in windows), bool, len(windows)))
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    return int((np.cumsum(cover[:-1]) > 0).sum())


def repeated_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def signals(text: str) -> tuple[int, int, int, int, int]:
    """The counts of ``SIGNALS`` of one text."""
    words = text.encode().split()
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        repeated_lines(text),
        repeated_words(words),
    )


def judge(docs: DataFrame, model: NgramModel, limits: Limits = Limits()) -> DataFrame:
    """(doc_id, signals, probability, base_failed, kept) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = [signals(t) for t in texts_of(part, "text")]
            counted = [pa.array(column, pa.int64()) for column in zip(*rows)]
            good = pa.array(model.probability(part.column("text")), pa.float64())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *counted, good], ["doc_id", *SIGNALS, "probability"])

    schema = "doc_id long, " + ", ".join(f"{s} long" for s in SIGNALS) + ", probability double"
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)
    failed = (F.col("n_words") < limits.fewest) | (100 * F.col("n_repeat_words") > limits.repeated * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("probability") >= limits.probability)
    )


def report(docs: DataFrame, labels: DataFrame, bounds: FitBounds = FitBounds(), limits: Limits = Limits()) -> DataFrame:
    """Contract form: train on the labelled quality rows, then judge every document."""
    model = fit(labelled_sample(docs, labels, "quality", bounds), bounds)
    return judge(docs, model, limits)
