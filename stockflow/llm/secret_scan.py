"""Secret scan: fixed patterns, and a randomness test battery for other strings.

Strings of encoding characters are tested for randomness in the alphabet they
seem to be written in: uniformity of the symbols (chi-squared), runs above and
below the middle, and correlation of neighbours. A string that the three tests
together do not reject as random gets as its p-value how often ordinary text of
its length and alphabet has symbols as even as its own; that follows from the
chi-squared statistic's distribution for the repetition of letters in ordinary
text. Those that pass at the false-discovery rate asked for, over all strings,
are added. The same rule holds for any number of strings. Everything is built
from column expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import ROW, numbered
from stockflow.session import materialize

# Fixed patterns; the keywords of the first match in either case.
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
VALUE_CHARACTERS = 8  # of an assigned value at least

LEAST = 20  # characters of a string that is tested
RATE = 0.05  # of false discoveries among the strings added
_CHARACTERS = "A-Za-z0-9+/_=-"
STRING = rf"(?<![{_CHARACTERS}])[{_CHARACTERS}]{{{LEAST},}}+"

KINDS = ("assign", "access", "hex", "random")

# Alphabets by name, in the order in which they are tried.
ALPHABETS = {
    "decimal": (r"^[0-9]+$", "0123456789"),
    "hex": (r"^[0-9a-f]+$", "0123456789abcdef"),
    "upper hex": (r"^[0-9A-F]+$", "0123456789ABCDEF"),
    "base32": (r"^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "lower": (r"^[a-z]+$", "abcdefghijklmnopqrstuvwxyz"),
    "lower digits": (r"^[a-z0-9]+$", "abcdefghijklmnopqrstuvwxyz0123456789"),
    "letters": (r"^[A-Za-z]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    "base64": (
        r"^",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    ),
}
# Chance that two letters of ordinary text are equal (index of coincidence of English).
REPEATED = 0.0667
REJECTED = 16.27  # of the three tests together: one of 1,000 random strings has more
STEP, STEPS = 100, 4000  # in which the logarithms of p-values are counted


def found(text: Column, pattern: str) -> Column:
    """All matches, and the lengths of what lies before, between and behind them."""
    gaps = F.transform(F.split(text, pattern, -1), F.char_length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.struct(
        F.array().cast("array<int>").alias("gaps"), F.array().cast("array<string>").alias("found")
    )
    some = F.struct(gaps.alias("gaps"), matches.alias("found"))
    return F.when(text.rlike(pattern), some).otherwise(none)


def located(rows: DataFrame) -> DataFrame:
    """One row per match: ``kind``, ``start``, ``end`` (exclusive) and ``match``."""
    kinds = F.array(
        *[F.struct(F.lit(kind).alias("kind"), f"{kind}.*") for kind in KINDS]
    )
    each = rows.select(ROW, F.explode(kinds).alias("k")).filter(F.size("k.found") > 0)
    pairs = F.arrays_zip(F.slice("k.gaps", F.lit(1), F.size("k.found")), F.col("k.found"))
    each = each.select(ROW, "k.kind", F.posexplode(pairs).alias("at", "m"))
    each = each.select(
        ROW, "kind", "at", F.col("m.0").alias("gap"), F.col("m.found").alias("match")
    )
    upto = Window.partitionBy(ROW, "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.char_length("match")).over(upto)
    each = each.withColumn("end", end).withColumn("start", end - F.char_length("match"))
    return each.select(ROW, "kind", "start", "end", "match")


def tested(strings: DataFrame) -> DataFrame:
    """``strings`` with ``step``, minus the logarithm of their p-value in ``STEP`` steps."""
    name = F.lit("base64")
    for known, (pattern, _) in reversed(list(ALPHABETS.items())[:-1]):
        name = F.when(F.col("match").rlike(pattern), known).otherwise(name)
    letters = F.create_map(*[F.lit(x) for k, (_, v) in ALPHABETS.items() for x in (k, v)])
    plain = F.translate(F.rtrim(F.col("match"), F.lit("=")), "-_=", "+/")
    strings = strings.withColumns({"letters": letters[name], "plain": plain})
    strings = strings.withColumns(
        {
            "k": F.char_length("letters").cast("double"),
            "n": F.char_length("plain").cast("double"),
            "symbols": F.transform(
                F.filter(F.split("plain", ""), lambda c: c != ""),
                lambda c: (F.instr(F.col("letters"), c) - 1).cast("double"),
            ),
        }
    )
    strings = strings.filter("n >= 8")
    k, n = F.col("k"), F.col("n")
    squares = F.aggregate(
        F.sequence(F.lit(0), F.col("k").cast("int") - 1),
        F.lit(0.0),
        lambda total, s: total
        + F.pow(F.size(F.filter("symbols", lambda v: v == s)).cast("double"), F.lit(2.0)),
    )
    ahead = F.slice("symbols", F.lit(2), F.size("symbols") - 1)
    behind = F.slice("symbols", F.lit(1), F.size("symbols") - 1)
    middle = (k - 1) / 2
    runs = F.aggregate(
        F.zip_with(behind, ahead, lambda a, b: ((a > middle) != (b > middle)).cast("double")),
        F.lit(1.0),
        lambda total, v: total + v,
    )
    product = F.aggregate(
        F.zip_with(behind, ahead, lambda a, b: (a - middle) * (b - middle)),
        F.lit(0.0),
        lambda total, v: total + v,
    )
    strings = strings.withColumns(
        {"chi": squares * k / n - n, "runs": runs, "product": product, "free": k - 1}
    )
    spread = 2 / (9 * F.col("free"))
    z_chi = (F.cbrt(F.greatest("chi", F.lit(0.0)) / F.col("free")) - (1 - spread)) / F.sqrt(spread)
    z_runs = (F.col("runs") - 1 - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    z_serial = F.col("product") / ((n - 1) * (k * k - 1) / 12) * F.sqrt(n - 1)
    far = F.pow(F.greatest(z_chi, F.lit(0.0)), F.lit(2.0))
    far = far + z_runs * z_runs + z_serial * z_serial
    # Of ordinary text the statistic has a distribution with this shift.
    shift = (n - 1) * F.greatest(k * REPEATED - 1, F.lit(0.0))
    z = (F.col("chi") - F.col("free") - shift) / F.sqrt(2 * F.col("free") + 4 * shift)
    # Where the alphabet is as repetitive as ordinary text nothing can be told.
    p = F.when((far > REJECTED) | (shift <= 0), 1.0).otherwise(normal_share(z))
    step = F.floor(-F.log10(F.greatest(p, F.lit(1e-300))) * STEP)
    return strings.withColumn("step", F.least(step, F.lit(STEPS)).cast("int"))


def normal_share(z: Column) -> Column:
    """Share of a standard normal distribution below ``z`` (Zelen and Severo 1964)."""
    t = 1 / (1 + 0.2316419 * F.abs(z))
    terms = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    series = F.lit(0.0)
    for term in reversed(terms):
        series = (series + term) * t
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series
    return F.when(z < 0, tail).otherwise(1 - tail)


def discoveries(strings: DataFrame, rate: float) -> DataFrame:
    """Strings that look random at the false-discovery rate (Benjamini and Hochberg),
    from the numbers of strings by the step of their p-value."""
    counts = materialize(strings.groupBy("step").agg(F.count("*").alias("n")), "steps")
    # At most STEPS rows from here to the threshold.
    upto = Window.orderBy(F.desc("step"))
    ranked = counts.withColumn("rank", F.sum("n").over(upto))
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # The largest p-value of a step stands for all of it.
    p = F.pow(F.lit(10.0), -F.col("step") / STEP)
    least = ranked.filter(p * total <= rate * F.col("rank")).agg(F.min("step")).first()[0]
    return strings.filter(F.col("step") >= (STEPS + 1 if least is None else least))


def scan_secrets(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``spans``, an array of
    (``start``, ``end``, ``kind``) in code points, the end exclusive, by start
    and then in the order of ``KINDS``.

    Spans of the patterns are all kept; strings found by the test battery are
    added where they overlap none of those. A null or empty text has no spans.
    Repeated rows get a row each and count as often in the rates. Other columns
    are not read.
    """
    if not 0 <= rate < 1:
        raise ValueError("the rate lies within 0 and 1")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    patterns = dict(zip(KINDS, (ASSIGN, ACCESS, HEX, STRING), strict=True))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *[found(text, p).alias(k) for k, p in patterns.items()]
    )
    rows = numbered(rows, "matches")
    matches = materialize(located(rows), "located")
    value = F.char_length(F.regexp_extract("match", ASSIGN, 2))
    base = matches.filter(F.col("kind") != "random").filter(
        (F.col("kind") != "assign") | (value >= VALUE_CHARACTERS)
    )
    strings = materialize(tested(matches.filter("kind = 'random'")), "tested")
    added = discoveries(strings.select(ROW, "kind", "start", "end", "step"), rate)
    order = F.when(F.col("kind") == "random", 3)
    for place, kind in enumerate(KINDS[:-1]):
        order = order.when(F.col("kind") == kind, place)
    span = F.struct(
        F.col("start").cast("bigint").alias("start"),
        order.alias("order"),
        F.col("end").cast("bigint").alias("end"),
        "kind",
    )
    columns = [ROW, "kind", "start", "end"]
    spans = base.select(*columns).union(added.select(*columns))
    spans = spans.groupBy(ROW).agg(F.array_sort(F.collect_list(span)).alias("all"))
    fixed = F.filter("all", lambda s: s["kind"] != "random")
    kept = F.filter(
        "all",
        lambda s: (s["kind"] != "random")
        | ~F.exists(fixed, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    plain = F.transform(kept, lambda s: F.struct(s["start"], s["end"], s["kind"]))
    out = rows.select(ROW, "doc_id").join(spans.select(ROW, plain.alias("spans")), ROW, "left")
    none = F.array().cast("array<struct<start: bigint, end: bigint, kind: string>>")
    return out.select("doc_id", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
