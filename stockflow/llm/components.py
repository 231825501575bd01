"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.operators.joins import join_lookup
from stockflow.session import discard, materialize


def components(links: DataFrame) -> DataFrame:
    """Rows (``node``, ``root``) for every node of ``links`` (``a``, ``b`` bigint).

    Nodes have equal roots if links connect them; the root is one of them.
    Every round merges each node into the neighbour with the most links, itself
    included, ties by a hash of the round, and keeps the links between what is
    left: a star goes in one round, and even of a long path a fixed share of the
    nodes goes in each. Rounds are written to the shared folder, neighbours are
    combined before they are shuffled, and nothing but row counts reaches the
    driver. Self links count as nodes without neighbours; nulls are left out.
    """
    links = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    links = materialize(links.filter("a is not null and b is not null").distinct(), "links")
    steps = []
    while not links.isEmpty():
        ends = F.array(
            *[
                F.struct(F.col(u).alias("u"), F.col(v).alias("v"))
                for u, v in (("a", "a"), ("a", "b"), ("b", "a"), ("b", "b"))
            ]
        )
        both = links.select(F.inline(ends))
        degree = both.groupBy("v").agg(F.count("*").alias("degree"))
        ranked = F.struct("degree", F.xxhash64(F.lit(len(steps)), "v"), "v")
        step = both.join(degree, "v").groupBy("u").agg(F.max(ranked)["v"].alias("to"))
        step = materialize(step, "merged")
        steps.append(step)
        moved = links.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b")
        moved = moved.filter("x != y")
        before = links
        links = moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        links = materialize(links.distinct(), "links")
        discard(before)
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0].toDF("node", "root")
    for step in steps[1:]:
        later = step.toDF("root", "to")
        out = join_lookup(out, later, ["root"], "left", written=True)
        out = out.select("node", F.coalesce("to", "root").alias("root"))
    return out
