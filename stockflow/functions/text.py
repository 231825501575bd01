"""Text extraction, message templates and keyword routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockflow.fixed_values import (
    ACTUAL_PATTERN,
    ANSWERS,
    BATCH_PATTERN,
    CATEGORY_PATTERN,
    DEFAULT_ANSWER,
    NOT_AVAILABLE,
    PREDICTED_PATTERN,
)
from stockflow.functions.numbers import float_text


def first_group(text: Column, pattern: str) -> Column:
    """First capture group, null where the pattern does not match."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def clean_text(value: Column) -> Column:
    """Text with missing values (null or the word ``nan``) as the empty string."""
    text = value.cast("string")
    return F.when(text == "nan", "").otherwise(F.coalesce(text, F.lit("")))


def or_not_available(value: Column) -> Column:
    return F.coalesce(value, F.lit(NOT_AVAILABLE))


def described_quantity(description: Column, which: str) -> Column:
    """Quantity quoted in an anomaly description, rendered; ``N/A`` if absent."""
    pattern = {"predicted": PREDICTED_PATTERN, "actual": ACTUAL_PATTERN}[which]
    number = first_group(description, pattern).try_cast("double")
    return or_not_available(float_text(number))


def quantities_text(predicted: Column, actual: Column) -> Column:
    """Anomaly description that quotes a predicted and an actual quantity."""
    return F.concat(
        F.lit("Predicted Quantity: "),
        float_text(predicted),
        F.lit(", Actual Quantity: "),
        or_not_available(actual),
    )


def category_in_text(text: Column) -> Column:
    return first_group(text, CATEGORY_PATTERN)


def batch_number(product_id: Column) -> Column:
    return first_group(product_id, BATCH_PATTERN).try_cast("bigint")


def labelled_lines(*parts: Column | tuple[str, Column]) -> Column:
    """Multi-line message; a tuple is a ``label: value`` line.

    A missing value prints as ``None`` so that no line is ever lost.
    """
    lines = [
        F.concat(F.lit(f"{part[0]}: "), F.coalesce(part[1].cast("string"), F.lit("None")))
        if isinstance(part, tuple)
        else part
        for part in parts
    ]
    return F.concat_ws("\n", *lines)


def answer_for(question: Column) -> Column:
    """Answer of the first keyword found in the question."""
    lowered = F.lower(question)
    (keyword, answer), *rest = ANSWERS
    choice = F.when(lowered.contains(keyword), answer)
    for keyword, answer in rest:
        choice = choice.when(lowered.contains(keyword), answer)
    return choice.otherwise(DEFAULT_ANSWER)
