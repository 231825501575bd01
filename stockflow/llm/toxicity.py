"""Toxicity by a counterfactual-regularised classifier.

Labelled texts that mention a group are trained together with a copy in which
every mention is replaced by another group of the same kind; the squared change
of the log-odds between the two is penalised, so that a mention by itself
hardly moves a score.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import held_out
from stockflow.llm.text_model import SAMPLE_ROWS, labelled_texts, scored, train

# Words that name groups, by kind; a swap stays within its kind.
IDENTITY_TERMS = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "arab"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("immigrants", "refugees", "foreigners", "natives"),
    ("mexican", "american", "african", "chinese", "european"),
    ("mujeres", "hombres"),
    ("femmes", "hommes"),
    ("frauen", "männer"),
    ("musulmanes", "cristianos", "judíos"),
    ("musulmans", "chrétiens", "juifs"),
    ("muslime", "christen", "juden"),
)
PENALTY = 1.0
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def swapped(text: str, pattern: re.Pattern, following: dict[str, str]) -> str:
    """``text`` with every group mention replaced by the next one of its kind."""
    return pattern.sub(lambda m: following[m[0].lower()], text)


def swapper(terms: tuple[tuple[str, ...], ...]):
    following = {
        term: kind[(spot + 1) % len(kind)] for kind in terms for spot, term in enumerate(kind)
    }
    if not following:
        return None
    words = "|".join(sorted(map(re.escape, following), key=len, reverse=True))
    pattern = re.compile(rf"(?<!\w)(?:{words})(?!\w)", re.IGNORECASE)
    return partial(swapped, pattern=pattern, following=following)


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
    penalty: float = PENALTY,
    threshold: float = THRESHOLD,
    sample_rows: int = SAMPLE_ROWS,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``,
    ``predicted`` and the ``keep`` columns.

    Labels of held-out ids are never used. At most about ``sample_rows`` others
    train the model; without both labels every score is the share of positive
    ones, one half where there is none. Null and empty texts get the score of
    a text without words. A null id is scored like any other, its labels are
    not used. An id with several labels is toxic if one of them says so;
    repeated rows get a row each. Other columns of ``docs`` are not read.
    """
    ids = F.col(id_col)
    learn = labels.filter(~held_out(ids, FOLDS, HELD_OUT))
    sample = labelled_texts(docs, learn, id_col, text_col, label_col, sample_rows)
    model = train(sample, swap=swapper(terms), penalty=penalty)
    text = "__t" if text_col not in keep else text_col
    own = [F.col(text_col).cast("string").alias("__t")] if text == "__t" else []
    rows = docs.select(ids.alias("doc_id"), *keep, *own)
    kept = [c for c in rows.columns if c != "__t"]
    score = 1 / (1 + F.exp(-F.col("logit")))
    return scored(rows, model, text, kept).select(
        "doc_id",
        held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        *kept[1:],
    )
