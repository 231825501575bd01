"""Line dedup by winnowing over line hashes.

A window is the shortest run of whole lines, from a line on or up to a line,
that holds ``least`` words; its fingerprint is the last of the smallest line hashes in it.
Windows whose fingerprint occurs once in the corpus cannot repeat and go. Equal
windows are joined by their content; the earliest one stays. Every repeated run
of ``least`` words or more is a union of such windows, those that start in it
and those that end in it, so it is found whole, as if each shared fingerprint
had been extended both ways, without pairing occurrences with each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import ROW, numbered
from stockflow.operators.joins import join_lookup
from stockflow.session import discard, materialize

LEAST = 50  # words of the shortest run that is deleted
WORDS = r"[^\x20\x09-\x0D]+"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_rows(rows: DataFrame) -> DataFrame:
    """Hash and word count of every line with words, and the words before it."""
    lines = F.transform(
        lines_of(F.col("text")),
        lambda line: F.struct(
            F.xxhash64(F.trim(line)).alias("h"),
            F.regexp_count(line, F.lit(WORDS)).cast("bigint").alias("n"),
        ),
    )
    lines = rows.select(ROW, "id", F.posexplode(lines).alias("pos", "line"))
    lines = lines.select(ROW, "id", "pos", "line.*").filter("n > 0")
    upto = F.sum("n").over(Window.partitionBy(ROW).orderBy("pos"))
    return lines.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))


def windows(lines: DataFrame, least: int) -> DataFrame:
    """Both windows of each line: their lines, fingerprint and content."""
    own = Window.partitionBy(ROW)
    frames = {
        "from_": own.orderBy("before").rangeBetween(0, least - 1),
        "to_": own.orderBy("upto").rangeBetween(1 - least, 0),
    }
    for name, frame in frames.items():
        lines = lines.withColumn(
            name,
            F.struct(
                F.min("pos").over(frame).alias("start"),
                F.max("pos").over(frame).alias("end"),
                F.sum("n").over(frame).alias("words"),
                F.min(F.struct("h", (-F.col("pos")).alias("back"))).over(frame).alias("least"),
                F.collect_list("h").over(frame).alias("lines"),
            ),
        )
    both = lines.select(ROW, "id", F.explode(F.array("from_", "to_")).alias("w"))
    both = both.select(ROW, "id", "w.*").filter(F.col("words") >= least)
    return both.select(
        ROW,
        "id",
        "start",
        "end",
        F.col("least.h").alias("fingerprint"),
        F.col("least.back").alias("back"),
        F.xxhash64(F.lit(1), "lines").alias("content"),
        F.xxhash64(F.lit(2), "lines").alias("content2"),
    ).distinct()


def repeated_runs(found: DataFrame) -> DataFrame:
    """Later occurrences of repeated windows, merged to runs of lines per row."""
    # Fingerprints that were selected at two places at least.
    place = F.struct(ROW, "back")
    seen = found.groupBy("fingerprint").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    seen = seen.filter("one != other").select("fingerprint")
    found = join_lookup(found, seen, ["fingerprint"])
    first = found.groupBy("content", "content2").agg(
        F.min(F.struct("id", ROW, "start")).alias("first"), F.count("*").alias("n")
    )
    first = first.filter("n > 1").drop("n")
    later = join_lookup(found, first, ["content", "content2"])
    later = later.filter(F.struct("id", ROW, "start") != F.col("first"))
    own = Window.partitionBy(ROW).orderBy("start", "end")
    reach = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    later = later.select(ROW, "start", "end").withColumn("reach", reach)
    fresh = (F.coalesce("reach", F.lit(-2)) + 1 < F.col("start")).cast("int")
    later = later.withColumn("run", F.sum(fresh).over(own))
    runs = later.groupBy(ROW, "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy(ROW).agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs"))


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``text`` without the runs of
    lines that occurred before, ``n_lines``, ``n_deleted`` and ``runs`` (first
    and last number of the deleted lines).

    Rows stand in the order of their ids, null first; equal ids in any fixed
    order. Lines end at newlines, are compared without surrounding spaces and
    deleted with the blank lines between them; runs shorter than ``least``
    words stay. A null text stays null and has no lines; an empty one has one
    empty line. A run that overlaps its own earlier occurrence goes too.
    Repeated rows lose all runs but in the first of them. Other columns are not
    read.
    """
    if least < 1:
        raise ValueError("a run has at least one word")
    rows = numbered(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")),
        "texts",
    )
    found = materialize(windows(line_rows(rows), least), "windows")
    runs = materialize(repeated_runs(found), "runs")
    discard(found)
    rows = join_lookup(rows, runs, [ROW], "left", written=True)
    lines = lines_of(F.col("text"))
    kept = F.filter(
        lines,
        lambda line, at: ~F.exists("runs", lambda r: at.between(r["start"], r["end"])),
    )
    deleted = F.aggregate(
        "runs", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"] + 1
    )
    return rows.select(
        F.col("id").alias("doc_id"),
        F.when(F.col("runs").isNull(), F.col("text"))
        .otherwise(F.array_join(kept, "\n"))
        .alias("text"),
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(deleted, F.lit(0)).cast("bigint").alias("n_deleted"),
        "runs",
    )
