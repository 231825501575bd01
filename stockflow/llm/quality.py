"""Quality by hierarchical empirical Bayes.

A text classifier gives each document its odds. Documents of a host, and of a
path of a host, share a posterior: the host's mean is drawn towards the mean of
all documents, a path's mean towards its host's, each by a prior strength that
is estimated from how far hosts and paths differ beyond chance. A document's
odds are then moved by how far its path's posterior lies from the global mean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import held_out
from stockflow.llm.text_model import labelled_texts, scored, train
from stockflow.operators.joins import join_lookup
from stockflow.session import materialize

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.5
SAMPLE_ROWS = 16_000  # labelled rows the classifier is trained on, at most about this many
FEATURES = 1024  # features it keeps
LEAST_SPREAD = 1e-4  # of the share of variance between groups; bounds the strength


def strength(spread: float, expected: float, weight: float, variance: float) -> float:
    """Prior strength by the method of moments.

    ``spread`` is the summed squared distance of the groups' rates from the rate
    above them, ``expected`` what chance alone makes of it.
    """
    if variance <= 0 or weight <= 0:
        return 1 / LEAST_SPREAD
    share = (spread - expected) / (variance * weight)
    share = min(max(share, LEAST_SPREAD), 1 - LEAST_SPREAD)
    return (1 - share) / share


def odds(p: Column) -> Column:
    p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(p / (1 - p))


def site_posteriors(evidence: DataFrame) -> tuple[DataFrame, float, float]:
    """Posteriors of all paths from rows (``host``, ``path``, ``p``), the global
    mean and the strength of the hosts' priors on their paths.

    Three grouped aggregations, each combined before it is shuffled.
    """
    paths = evidence.groupBy("host", "path").agg(
        F.count("*").cast("double").alias("n"), F.sum("p").alias("s")
    )
    paths = materialize(paths, "paths")
    hosts = paths.groupBy("host").agg(
        F.sum("n").alias("host_n"),
        F.sum("s").alias("host_s"),
        F.count("*").alias("host_paths"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    )
    hosts = materialize(hosts, "hosts")
    n, s, k, squares = hosts.agg(
        F.sum("host_n"), F.sum("host_s"), F.count("*"), F.sum(F.col("host_n") * F.col("host_n"))
    ).first()
    if not n:
        empty = paths.select("host", "path", "n", "s", F.lit(0.5).alias("host_mean"))
        return empty, 0.5, 1 / LEAST_SPREAD
    mean = s / n
    variance = mean * (1 - mean)
    rate = F.col("host_s") / F.col("host_n")
    far = hosts.agg(F.sum(F.col("host_n") * (rate - mean) * (rate - mean))).first()[0]
    strong = strength(far, variance * (k - 1), n - squares / n - (k - 1), variance)
    host_mean = (F.col("host_s") + strong * mean) / (F.col("host_n") + strong)
    hosts = hosts.withColumns({"rate": rate, "host_mean": host_mean})
    paths = join_lookup(paths, hosts, ["host"], null_safe=True)
    own = F.col("s") / F.col("n") - F.col("rate")
    inside = F.col("rate") * (1 - F.col("rate"))
    far, expected, weight = paths.agg(
        F.sum(F.col("n") * own * own),
        F.sum(inside * (1 - F.col("n") / F.col("host_n"))),
        F.sum(inside * F.col("n") * (1 - F.col("n") / F.col("host_n"))),
    ).first()
    path_strong = strength(far, expected, weight - expected, 1.0)
    return paths.select("host", "path", "n", "s", "host_mean"), mean, path_strong


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    path_col: str = "lang",
    label_col: str = "quality",
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``text_score``
    (classifier alone), ``site_score`` (posterior of its path without itself),
    ``score`` and ``predicted``.

    Labels of held-out ids are never used. A null host or path is a site like
    any other; a null or empty text has the odds of a text without words, moved
    by its site. Without both labels the classifier is a constant. Repeated rows
    count as often as they occur. Other columns of ``docs`` are not read.
    """
    learn = labels.filter(~held_out(F.col(id_col), FOLDS, HELD_OUT))
    sample = labelled_texts(docs, learn, id_col, text_col, label_col, sample_rows)
    model = train(sample, shapes=True, most=FEATURES)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(host_col).cast("string").alias("host"),
        F.col(path_col).cast("string").alias("path"),
        F.col(text_col).cast("string").alias("__t"),
    )
    rows = scored(rows, model, "__t", ["doc_id", "host", "path"])
    rows = materialize(rows.withColumn("p", 1 / (1 + F.exp(-F.col("logit")))), "texts")
    paths, mean, strong = site_posteriors(rows)
    rows = join_lookup(rows, paths, ["host", "path"], null_safe=True)
    site = (F.col("s") - F.col("p") + strong * F.col("host_mean")) / (F.col("n") - 1 + strong)
    moved = F.col("logit") + odds(site) - odds(F.lit(mean))
    score = 1 / (1 + F.exp(-moved))
    return rows.select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        F.col("p").alias("text_score"),
        site.alias("site_score"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
    )
