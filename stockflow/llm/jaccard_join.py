"""N-gram Jaccard join by a token-group matrix.

Equal shingle sets fold into classes. Similar classes form groups: each class
joins the most central class that shares one of its rare shingles, if the two
do link. A group keeps the union of its shingles. A class is held against a
group only if they share a shingle of their prefixes, its overlap with the
group's union then bounds its overlap with every member, and only groups whose
bound allows a link are opened. No link is missed: two sets with Jaccard of at
least the threshold share a shingle of the prefixes used here, under any one
order of shingles, and rare ones come first in this order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import bitmap, in_bitmap, numbered, packed, small
from stockflow.llm.components import components
from stockflow.llm.words import NOT_SPACE, Splitter, grams, mix
from stockflow.operators.joins import join_lookup
from stockflow.session import discard, materialize

SHINGLE = 3  # words
PERCENT = 90  # two sets link at this Jaccard similarity
CELL_BITS = 22  # cells of the frequency sketch: 4 MiB
CELLS_A_ROW = 1 << 16
LEVELS = 8  # levels of frequency for each doubling
FILTER_BITS, PROBES = 26, 4  # Bloom filters of shingles and classes met: 8 MiB each
GROUP_TOKENS = 1 << 18  # shingles of a group's part, summed over its members
LOOKUP_BYTES = 8 << 20  # of a broadcast table; the driver holds it several times over
QUERIES_A_PART = 2048  # classes held against one part at a time


def shingle_sets(batch: pa.Array, splitter: Splitter, k: int) -> Iterator[tuple]:
    """For each row its number and its shingles, sorted and distinct."""
    for part in splitter.split(batch):
        keys = grams(part.hashes, k)
        low = 0
        for row, high in enumerate(part.ends):
            n = int(high - low)
            if n >= k:
                found = np.unique(keys[low : high - k + 1])
            elif n:
                found = grams(part.hashes[low:high], n) ^ np.uint64(n)
            else:
                found = keys[:0]
            yield part.first + row, found
            low = high


def set_class(found: np.ndarray) -> int:
    """64-bit identity of a shingle set; empty sets are -1's class apart."""
    if not len(found):
        return -1
    with np.errstate(over="ignore"):
        total = mix(found + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(found))
        return int(mix(np.array([total]))[0].astype(np.int64))


def cell_of(found: np.ndarray, bits: int) -> np.ndarray:
    return (found >> np.uint64(64 - bits)).astype(np.int64)


def described(k: int, bits: int):
    """Task function: size and class of each row's set, and at the end how many
    rows of the task hold a shingle of each cell (255 at most)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(NOT_SPACE)
        cells = np.zeros(1 << bits, np.uint8)
        schema = None
        for batch in batches:
            sizes, classes = [], []
            for _, found in shingle_sets(batch.column(1), splitter, k):
                sizes.append(len(found))
                classes.append(set_class(found))
                at = cell_of(found, bits)
                cells[at] += cells[at] < 255
            none = pa.nulls(batch.num_rows, pa.int32())
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.int64()),
                    none,
                    pa.nulls(batch.num_rows, pa.binary()),
                ],
                ["doc_id", "n", "class", "chunk", "cells"],
            )
            schema = out.schema
            yield out
        if schema is not None:
            chunks = cells.reshape(-1, min(CELLS_A_ROW, len(cells)))
            used = np.flatnonzero(chunks.any(1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(len(used), schema.field(0).type),
                    pa.nulls(len(used), pa.int64()),
                    pa.nulls(len(used), pa.int64()),
                    pa.array(used.astype(np.int32)),
                    pa.array([zstandard.compress(chunks[c]) for c in used], pa.binary()),
                ],
                schema=schema,
            )

    return run


def summed_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: for each chunk the frequency levels of its cells."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for chunk, blob in zip(
            batch.column("chunk").to_pylist(), batch.column("cells").to_pylist(), strict=True
        ):
            counts = np.frombuffer(zstandard.decompress(blob), np.uint8).astype(np.uint64)
            totals[chunk] = totals[chunk] + counts if chunk in totals else counts
    for chunk, counts in totals.items():
        level = np.minimum(LEVELS * np.log2(counts.astype(float) + 1), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), packed([level])], ["chunk", "cells"]
        )


def frequency_levels(rows: DataFrame, bits: int) -> np.ndarray:
    """Level of each cell of the sketch; at most 2 ** bits bytes."""
    parts = rows.filter("chunk is not null").select("chunk", "cells").repartition("chunk")
    levels = np.zeros(1 << bits, np.uint8)
    table = parts.mapInArrow(summed_cells, "chunk int, cells binary").toArrow()
    width = min(CELLS_A_ROW, len(levels))
    for chunk, blob in zip(table["chunk"].to_pylist(), table["cells"].to_pylist(), strict=True):
        levels[chunk * width : (chunk + 1) * width] = np.frombuffer(blob, np.uint8)
    return levels


def rare_first(found: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    level = levels[cell_of(found, len(levels).bit_length() - 1)].astype(np.uint64)
    # ``found`` is sorted, and the sort is stable: equal keys keep their order.
    order = np.argsort((level << np.uint64(56)) | (found >> np.uint64(8)), kind="stable")
    return found[order], level


def misses(n: int, percent: int) -> int:
    """How many shingles of a set of ``n`` a linked set can lack at most."""
    return n + n * -percent // 100


def prefixes(k: int, percent: int, levels):
    """Task function: the rare shingles by which a set can be met.

    Of the sets' first ``misses + 1`` shingles (role 1 and 2) linked sets share
    one; the smaller set's lies within its first few (role 2). Of the first
    ``2 * misses + 1`` (any role) they share ``misses + 1`` of the smaller set,
    so a set with fewer than ``least`` shared ones links with none. Copies
    within the task give rows once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(NOT_SPACE)
        seen: set[int] = set()
        for batch in small(batches, 2048):
            tokens, found_sets = [], []
            for _, found in shingle_sets(batch.column(0), splitter, k):
                size = len(found)
                own = set_class(found)
                if not size or own in seen:
                    continue
                seen.add(own)
                order, level = rare_first(found, levels.value)
                may_miss = misses(size, percent)
                tokens.append(order[: 2 * may_miss + 1].copy())
                indexed = size + 2 * size * -percent // (100 + percent) + 1
                least = misses(size - may_miss, percent) + 1
                found_sets.append(
                    (own, size, len(tokens[-1]), may_miss, indexed, least, level.mean())
                )
            fields = list(zip(*found_sets, strict=True)) or [()] * 7
            lengths = np.array(fields[2], np.int64)
            rank = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)

            def each(spot: int, kind: type, fields=fields, lengths=lengths) -> np.ndarray:
                return np.repeat(np.array(fields[spot], kind), lengths)

            role = (rank <= each(3, np.int64)).astype(np.int32) + (rank < each(4, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([*tokens, np.zeros(0, np.uint64)]).astype(np.int64)),
                    pa.array(each(0, np.int64)),
                    pa.array(each(1, np.int64)),
                    pa.array(role.astype(np.int32)),
                    pa.array(each(5, np.int32)),
                    pa.array(each(6, np.float32)),
                ],
                ["token", "class", "n", "role", "least", "central"],
            )

    return run


def passing(filled):
    """Task function: the rows whose shingle the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column("token").to_numpy().astype(np.uint64)
            yield batch.filter(pa.array(in_bitmap(filled.value, keys, PROBES)))

    return run


def chosen_sets(k: int, chosen):
    """Task function: whole sets of the classes that the filter lets through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter = Splitter(NOT_SPACE)
        seen: set[int] = set()
        for batch in batches:
            classes, sets = [], []
            for _, found in shingle_sets(batch.column(0), splitter, k):
                own = set_class(found)
                if not len(found) or own in seen:
                    continue
                key = np.array([own], np.int64).astype(np.uint64)
                if in_bitmap(chosen.value, key, PROBES)[0]:
                    seen.add(own)
                    classes.append(own)
                    sets.append(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), packed(sets)], ["class", "tokens"]
            )

    return run


def needed(one: int, other: int, percent: int) -> int:
    """Smallest overlap of two sets of these sizes that makes a link."""
    return -(-percent * (one + other) // (100 + percent))


def overlap(one: np.ndarray, other: np.ndarray) -> int:
    return len(np.intersect1d(one, other, assume_unique=True))


def split_roles(rows: pa.Table) -> tuple[list[int], list[np.ndarray], list[int], list]:
    """Ids and sets of the queries (role 0) and of the members (role 1)."""
    out: tuple = ([], [], [], [])
    for own, role, blob in zip(
        rows["class"].to_pylist(), rows["role"].to_pylist(), rows["tokens"], strict=True
    ):
        out[2 * role].append(own)
        out[2 * role + 1].append(np.frombuffer(blob.as_buffer(), np.uint64))
    return out


def link_table(a: list[int], b: list[int]) -> pa.Table:
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def linked(percent: int):
    """Group function: which classes link with their leader, the only member."""

    def run(rows: pa.Table) -> pa.Table:
        ids, sets, leader, (leads, *_) = split_roles(rows)
        least = [needed(len(s), len(leads), percent) for s in sets]
        a = [i for i, s, n in zip(ids, sets, least, strict=True) if overlap(s, leads) >= n]
        return link_table(a, leader * len(a))

    return run


def opened(percent: int):
    """Group function: links between queries and one part of a group.

    Members of a group are connected already, so the first link is enough.
    """

    def run(rows: pa.Table) -> pa.Table:
        ids, queries, members, sets = split_roles(rows)
        a, b = [], []
        sizes = np.array([len(s) for s in sets], np.int64)
        union = np.unique(np.concatenate([*sets, np.zeros(0, np.uint64)]))
        for own, query in zip(ids, queries, strict=True):
            n = len(query)
            fits = np.flatnonzero((100 * sizes >= percent * n) & (sizes <= n))
            if not len(fits):
                continue
            bound = overlap(query, union)
            for at in fits:
                least = needed(n, int(sizes[at]), percent)
                if bound >= least and overlap(query, sets[at]) >= least:
                    a.append(own)
                    b.append(members[at])
                    break
        return link_table(a, b)

    return run


def turn(column: str, splits: Column) -> Column:
    """Which of ``splits`` shares of a large group a class falls to."""
    return F.pmod(F.xxhash64(column, F.lit(1)), splits).cast("int")


def jaccard_groups(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    cell_bits: int = CELL_BITS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles`` and
    ``component_id``, the smallest id among the rows its links lead to.

    Two rows link if the Jaccard similarity of their sets of word shingles is at
    least ``percent`` hundredths. A text of fewer words is one shingle; a null or
    empty text has none, links with nothing and is its own component. Rows with a
    null id take part; their id is never the smallest unless it is the only one.
    Repeated rows get a row each. Other columns are not read. Sets are told
    apart by 64-bit hashes.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies within 1 and 100")
    spark = docs.sparkSession
    lookup = partial(join_lookup, broadcast_bytes=LOOKUP_BYTES)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    id_type = texts.schema["doc_id"].dataType.simpleString()
    rows = numbered(
        texts.mapInArrow(
            described(shingle, cell_bits),
            f"doc_id {id_type}, n bigint, class bigint, chunk int, cells binary",
        ),
        "described",
    )
    levels = spark.sparkContext.broadcast(frequency_levels(rows, cell_bits))
    sized = rows.filter("chunk is null").select("doc_id", "n", "class")

    tokens = materialize(
        texts.select("t").mapInArrow(
            prefixes(shingle, percent, levels),
            "token bigint, class bigint, n bigint, role int, least int, central float",
        ),
        "prefixes",
    )
    levels.destroy()
    shared = tokens.groupBy("token").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    shared = materialize(shared.filter("low != high").select("token"), "shared")
    filled = spark.sparkContext.broadcast(bitmap(shared, "token", FILTER_BITS, PROBES))
    near = tokens.mapInArrow(passing(filled), tokens.schema).join(shared, "token", "left_semi")
    near = materialize(near.distinct(), "near")
    filled.destroy()
    discard(tokens, shared)
    active = near.groupBy("class").agg(F.count("*").alias("shared"), F.max("least").alias("least"))
    active = active.filter("shared >= least").select("class")
    met = near.filter("role > 0").join(active, "class", "left_semi")
    met = materialize(met.withColumn("in_index", F.col("role") == 2).drop("role", "least"), "met")
    discard(near)
    leader = F.max(F.struct("central", "n", "class")).alias("leader")
    leaders = met.filter("in_index").groupBy("token").agg(leader)
    first, met = met, materialize(met.join(leaders, "token").drop("central"), "met")
    discard(first)
    pairs = met.groupBy("class").agg(F.max("leader")["class"].alias("leader"))
    pairs = materialize(pairs, "leaders")
    chosen = spark.sparkContext.broadcast(bitmap(pairs, "class", FILTER_BITS, PROBES))
    others = pairs.filter("class != leader").groupBy("leader").agg(
        F.ceil(F.count("*") / QUERIES_A_PART).alias("splits")
    )
    others = materialize(others, "splits")
    known = lookup(pairs, others, ["leader"], "left", written=True)
    known = known.join(others.toDF("class", "leads"), "class", "left")
    sets = texts.select("t").mapInArrow(
        chosen_sets(shingle, chosen), "class bigint, tokens binary"
    )
    sets = sets.groupBy("class").agg(F.any_value("tokens").alias("tokens"))
    sets = materialize(sets.join(known, "class"), "sets")
    chosen.destroy()

    # Groups: classes that link with the same leader.
    zero, one = F.lit(0), F.lit(1)
    asks = F.struct(
        F.col("leader").alias("key"), turn("class", F.col("splits")).alias("turn"), zero.alias("role")
    )
    answers = F.transform(
        F.sequence(zero, F.coalesce("leads", zero).cast("int")),
        lambda t: F.struct(F.col("class").alias("key"), t.alias("turn"), one.alias("role")),
    )
    rows_ = F.concat(
        F.when(F.col("class") != F.col("leader"), F.array(asks)).otherwise(F.array()),
        F.slice(answers, one, F.coalesce("leads", zero).cast("int")),
    )
    star = sets.select("class", "tokens", F.explode(rows_).alias("r"))
    star = star.select("class", "tokens", "r.*").groupBy("key", "turn")
    star = materialize(star.applyInArrow(linked(percent), "a bigint, b bigint"), "star")
    root = components(star)
    member = sets.select("class", (F.octet_length("tokens") / 8).alias("n"))
    member = member.join(star.toDF("class", "group"), "class", "left")
    member = member.join(root.toDF("class", "root"), "class", "left")
    member = materialize(
        member.select(
            "class",
            "n",
            F.coalesce("group", "class").alias("group"),
            F.coalesce("root", "class").alias("root"),
        ),
        "members",
    )
    parts = member.groupBy("group").agg(F.ceil(F.sum("n") / GROUP_TOKENS).alias("parts"))
    member = lookup(member, parts, ["group"])
    part = F.pmod(F.xxhash64("class"), F.col("parts")).cast("int")
    member = materialize(member.select("class", "group", "root", part.alias("part")), "parts")

    # Which classes meet which groups, by the shingles of their prefixes.
    first = met
    met = lookup(met.select("token", "class", "n", "in_index"), member, ["class"])
    met = materialize(met, "met")
    discard(first)
    index = met.filter("in_index").groupBy("token", "group", "part")
    index = index.agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("root").alias("group_root")
    )
    probes = met.select("token", "class", "n", "root")
    asked = (
        probes.join(index, "token")
        .filter(f"root != group_root and low <= n and 100 * high >= {percent} * n")
        .groupBy("class", "group", "part")
        .agg(F.lit(1).alias("one"))
        .drop("one")
    )
    asked = materialize(asked, "asked")
    splits = asked.groupBy("group", "part").agg(
        F.ceil(F.count("*") / QUERIES_A_PART).cast("int").alias("splits")
    )
    splits = materialize(splits, "splits")
    queries = lookup(asked, splits, ["group", "part"], written=True).select(
        "class", "group", "part", turn("class", F.col("splits")).alias("turn"), zero.alias("role")
    )
    held = lookup(member, splits, ["group", "part"], written=True).select(
        "class",
        "group",
        "part",
        F.explode(F.sequence(zero, F.col("splits") - 1)).alias("turn"),
        one.alias("role"),
    )
    # A class may ask many groups; its set is joined to all its rows at once.
    wanted = lookup(queries.union(held), sets.select("class", "tokens"), ["class"], written=True)
    links = wanted.groupBy("group", "part", "turn").applyInArrow(
        opened(percent), "a bigint, b bigint"
    )
    links = materialize(links, "links")
    discard(sets, met, asked)
    root = components(star.union(links))

    # The smallest id of each component, for classes of several rows only.
    classes = sized.filter("n > 0").groupBy("class")
    classes = classes.agg(F.min("doc_id").alias("least"), F.count("*").alias("rows"))
    classes = classes.join(root.toDF("class", "root"), "class", "left")
    classes = materialize(classes.filter("rows > 1 or root is not null"), "classes")
    key = F.coalesce("root", "class").alias("root")
    least = classes.groupBy(key).agg(F.min("least").alias("component_id"))
    named = lookup(classes.select("class", key), least, ["root"]).drop("root")
    out = lookup(sized, named, ["class"], "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
