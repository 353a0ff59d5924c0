"""Quality by hierarchical empirical Bayes: a document's own evidence, weighed against its path, host and the corpus.

The document classifier gives a calibrated probability p under the global prior g, so its evidence is odds(p) / odds(g).
Grouped sums of p give each path and host a mean; a host's mean is shrunk towards g and a path's towards its host's, by
strengths that the method of moments takes from the spread of the means: sites that differ little, or have few documents,
follow the level above. A document's prior is its path's shrunk mean without the document itself, and the posterior odds
are evidence times prior odds.

Null hosts and paths are groups of their own; a null or empty text has only its site's evidence; repeated rows count
and are judged each; an empty table gives an empty result; one host alone gives no spread and follows the corpus. Sums per
site are partial before the shuffle, so a host with a third of all rows sends one row a task and level.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.llm.batches import slices
from rookery.llm.ngram_model import FitBounds, NgramModel, fit, labelled_sample
from rookery.workspace import stage

THRESHOLD = 0.5
EDGE = 1e-4
STRENGTHS = (1.0, 1e5)


def evidence(docs: DataFrame, model: NgramModel, host: Column, path: Column) -> DataFrame:
    """(doc_id, host, path, p): the classifier's probability of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            p = pa.array(model.probability(part.column("text")), pa.float64())
            kept = [part.column(c) for c in ("doc_id", "host", "path")]
            yield pa.RecordBatch.from_arrays([*kept, p], ["doc_id", "host", "path", "p"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), host.alias("host"), path.alias("path"), "text")
    return rows.mapInArrow(run, "doc_id long, host string, path string, p double")


def strength(groups: DataFrame, n: str, total: str, mean: Column) -> float:
    """Prior strength for shrinking group means towards ``mean``: p(1-p) / variance between groups - 1, within bounds."""
    own = F.col(total) / F.col(n)
    row = groups.select(
        F.col(n).alias("n"), (F.col(n) * (own - mean) * (own - mean)).alias("spread"), (mean * (1 - mean)).alias("unit")
    ).agg(
        F.count("*").alias("groups"), F.sum("n").alias("n"), F.sum("spread").alias("spread"), F.avg("unit").alias("unit")
    ).first()
    if not row.groups or row.groups < 2 or not row.n:
        return STRENGTHS[1]
    between = (row.spread - (row.groups - 1) * row.unit) / row.n
    return min(max(row.unit / between - 1, STRENGTHS[0]), STRENGTHS[1]) if between > 0 else STRENGTHS[1]


def _logit(p: Column) -> Column:
    sure = F.greatest(F.lit(EDGE), F.least(F.lit(1 - EDGE), p))
    return F.log(sure / (1 - sure))


def posteriors(scored: DataFrame) -> DataFrame:
    """(doc_id, host, path, document_p, host_p, path_p, posterior) from (doc_id, host, path, p)."""
    paths = stage(scored.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("total")), "path-sums")
    hosts = stage(paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("total").alias("host_total")), "host-sums")
    whole = hosts.agg(F.sum("host_n").alias("n"), F.sum("host_total").alias("total")).first()
    prior = min(max(whole.total / whole.n, EDGE), 1 - EDGE) if whole.n else 0.5
    host_weight = strength(hosts, "host_n", "host_total", F.lit(prior))
    host_mean = (F.col("host_total") + host_weight * prior) / (F.col("host_n") + host_weight)
    known = hosts.withColumn("host_p", host_mean).withColumnRenamed("host", "h")
    sites = paths.join(known, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    path_weight = strength(sites, "n", "total", F.col("host_p"))
    sites = sites.withColumn("path_p", (F.col("total") + path_weight * F.col("host_p")) / (F.col("n") + path_weight))
    sites = sites.withColumnsRenamed({"host": "h", "path": "s"})
    joined = scored.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("s")))
    # what the other documents of the path and host say
    others_host = (F.col("host_total") - F.col("p") + host_weight * prior) / (F.col("host_n") - 1 + host_weight)
    others = (F.col("total") - F.col("p") + path_weight * others_host) / (F.col("n") - 1 + path_weight)
    odds = _logit(F.col("p")) - _logit(F.lit(prior)) + _logit(others)
    return joined.select(
        "doc_id", "host", "path", F.col("p").alias("document_p"), "host_p", "path_p", (1 / (1 + F.exp(-odds))).alias("posterior")
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    *,
    host: Column | None = None,
    path: Column | None = None,
    label: str = "quality",
    threshold: float = THRESHOLD,
    bounds: FitBounds = FitBounds(),
) -> DataFrame:
    """Posterior quality of every document, and ``kept`` by a fixed threshold.

    Documents have no address, so the host is their source and the path the language section in it; give other columns
    where there are addresses.
    """
    model = fit(labelled_sample(docs, labels, label, bounds), bounds)
    host = F.col("source") if host is None else host
    path = F.concat_ws("/", "source", "lang") if path is None else path
    scored = stage(evidence(docs, model, host, path), "document-evidence")
    return posteriors(scored).withColumn("kept", F.col("posterior") >= threshold)


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the classifier keeps, unchanged. Rows without a doc_id are kept: no decision names them."""
    rejected = classify(docs, labels, **options).where("not kept and doc_id is not null").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)
