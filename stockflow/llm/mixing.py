"""Mixing sources to target weights by a splitting tree of block quotas.

Every source's documents stand in a permuted order, cut into blocks. A source
is drawn as often in full as its target allows, and then a beginning of its
order up to the rest of the target. The drawn blocks of all sources are tickets
in an urn that is split in halves again and again, without replacement, until
there is one urn per output shard: the numbers of a source's tickets in the
urns are multivariate hypergeometric quotas, and they add up exactly. A shard
takes as many further blocks of the source's order as its quota says, and
orders the documents of all its blocks at random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.common import ROW, numbered
from stockflow.operators.joins import join_lookup
from stockflow.session import discard, materialize

WEIGHTS = (3, 1, 2)  # of the sources in their order, repeating
SHARE = 1.5  # words of the mix, as a share of all words
CAP = 2.0  # words taken of a source, as a share of its words
SHARDS = 16
BLOCKS = 4096  # blocks of all sources together; every source has one at least
SEED = 11
ROUNDS = 3  # times that smaller rows are drawn for what is left at a cut
WORDS = r"[^\x20\x09-\x0D]+"

_KEY_BITS, _DIGIT = 60, 12  # bits of an order key, and of a digit of it


def ranked_sources(sized: DataFrame) -> DataFrame:
    """Sources with their sizes and places in code point order, null last."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Sorted in ranges: places within a range, then the numbers of sources before it.
    order = [F.col("source").isNull(), F.col("source")]
    sources = sources.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    sources = materialize(sources, "sources")
    counts = sources.groupBy("range").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("range")) - F.col("n")  # one row per range
    within = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    sources = sources.withColumn("within", within).join(
        F.broadcast(counts.select("range", before.alias("before"))), "range"
    )
    place = (F.col("before") + F.col("within") - 1).cast("bigint")
    return sources.select("source", "source_size", place.alias("place"))


def with_targets(
    sources: DataFrame, weights: tuple[float, ...], share: float, cap: float
) -> DataFrame:
    """Targets by weight; what exceeds ``cap`` goes to the others by weight."""
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]),
        (F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("int"),
    )
    sources = materialize(sources.withColumn("weight", weight), "weights")
    most = F.col("source_size") * cap
    all_words = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = -1.0  # words for each unit of weight
    while True:
        full = F.col("weight") * level > most
        capped, open_ = sources.agg(
            F.coalesce(F.sum(F.when(full, most)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not open_ or (all_words * share - capped) / open_ <= level:
            break
        level = (all_words * share - capped) / open_
    return sources.withColumn("target", F.least(F.col("weight") * max(level, 0.0), most))


def split_urn(tickets: DataFrame, shards: int, seed: int) -> DataFrame:
    """``tickets`` with the ``shard`` each falls to, as even as can be.

    An urn of several shards is divided at random in proportion to the shards
    on either side. Tickets are no more than blocks, a number set beforehand.
    """
    first, last = F.col("first"), F.col("last")
    urns = tickets.withColumns({"first": F.lit(0), "last": F.lit(shards - 1)})
    for level in range(max(shards - 1, 0).bit_length()):
        draw = F.xxhash64(F.lit(seed), F.lit(level), "place", "ticket")
        one = Window.partitionBy("first", "last")
        left = F.floor((first + last) / 2)
        share = (left - first + 1) / (last - first + 1)
        urns = urns.withColumns(
            {
                "drawn": F.row_number().over(one.orderBy(draw, "place", "ticket")),
                "all": F.count("*").over(one),
            }
        )
        goes_left = F.col("drawn") <= F.floor(F.col("all") * share)
        urns = urns.select(
            "place",
            "ticket",
            F.when(goes_left, first).otherwise(F.least(left + 1, last)).cast("int").alias("first"),
            F.when(goes_left, left).otherwise(last).cast("int").alias("last"),
        )
    return urns.select("place", "ticket", first.alias("shard"))


def digit(key: Column, level: int) -> Column:
    shift = _KEY_BITS - _DIGIT * (level + 1)
    return F.shiftright(key, shift).bitwiseAND(F.lit((1 << _DIGIT) - 1))


def cuts(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """Where the beginning of each source's order ends that holds ``rest`` words.

    Counts words per digit of the order keys, goes on within the digit where
    the rest ends, and stops at single rows. ``cut1``, ``cut2`` bound the keys
    of the rows that are drawn; ``left`` words are wanting then.
    """
    zero = F.lit(0).cast("bigint")
    found = sources.select("place", F.col("rest").alias("left"), zero.alias("cut1"))
    found = materialize(found.withColumns({"cut2": zero, "done": F.col("left") <= 0}), "cuts")
    levels = _KEY_BITS // _DIGIT
    for level in range(2 * levels):
        if found.filter("not done").isEmpty():
            break
        key, cut = ("key1", "cut1") if level < levels else ("key2", "cut2")
        shift = _KEY_BITS - _DIGIT * (level % levels + 1)
        inside = join_lookup(rows, found.filter("not done"), ["place"], written=True)
        if level >= levels:
            inside = inside.filter("key1 = cut1")
        if level % levels:
            inside = inside.filter(
                F.shiftright(key, shift + _DIGIT) == F.shiftright(cut, shift + _DIGIT)
            )
        cells = inside.groupBy("place", digit(F.col(key), level % levels).alias("digit")).agg(
            F.sum("size").alias("words"), F.count("*").alias("n")
        )
        # At most 4096 rows a source.
        upto = Window.partitionBy("place").orderBy("digit")
        cells = cells.withColumn("upto", F.sum("words").over(upto))
        at = cells.join(found.filter("not done"), "place").groupBy("place").agg(
            F.min(
                F.when(F.col("upto") > F.col("left"), F.struct("digit", "upto", "words", "n"))
            ).alias("c"),
            F.max("upto").alias("whole"),
        )
        step = found.join(at, "place", "left")
        more = F.shiftleft(F.coalesce("c.digit", F.lit(0)), shift)
        left = F.col("left") - F.col("c.upto") + F.col("c.words")
        single = (F.col("c.n") == 1) | F.lit(level == 2 * levels - 1)
        # Without a cell the rest covers all rows: the cut lies behind them.
        beyond = F.col("c").isNull() & ~F.col("done")
        old, found = found, materialize(
            step.select(
                "place",
                F.when(beyond, F.col("left") - F.coalesce("whole", F.lit(0)))
                .otherwise(F.coalesce(left, "left"))
                .alias("left"),
                *[
                    F.when(beyond, F.lit((1 << 62)))
                    .when(F.col("done"), F.col(c))
                    .otherwise(F.col(c) + (more if c == cut else zero))
                    .cast("bigint")
                    .alias(c)
                    for c in ("cut1", "cut2")
                ],
                (F.col("done") | beyond | F.coalesce(single, F.lit(False))).alias("done"),
            ),
            "cuts",
        )
        discard(old)
    return found.select("place", "cut1", "cut2", "left")


def in_ranges() -> Column:
    """Whether a row lies in one of its source's ``ranges`` and is small enough."""
    own = F.struct("key1", "key2")
    return F.exists(
        "ranges",
        lambda r: (F.col("size") <= r["most"])
        & (own >= F.struct(r["from1"].alias("key1"), r["from2"].alias("key2")))
        & (own < F.struct(r["to1"].alias("key1"), r["to2"].alias("key2"))),
    )


def fitting(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``ranges``: where rows behind the cut are drawn that fit.

    The row at a cut is too large for what is left; smaller ones behind it are
    drawn in their order up to the next cut, and so on. At last the row nearest
    to what is left is drawn if that brings the source nearer to its target.
    """
    ranges = "array<struct<from1: bigint, from2: bigint, to1: bigint, to2: bigint, most: bigint>>"
    found = found.withColumn("ranges", F.array().cast(ranges))
    found = found.withColumns({"first1": F.col("cut1"), "first2": F.col("cut2")})
    found = materialize(found, "ranges")
    for _ in range(ROUNDS):
        behind = join_lookup(rows, found, ["place"], written=True)
        behind = behind.filter("size > 0 and size <= left and (key1, key2) >= (cut1, cut2)")
        behind = materialize(behind.select(*rows.columns), "behind")
        after = cuts(behind, found.select("place", F.col("left").alias("rest")))
        after = after.toDF("place", "to1", "to2", "rest")
        step = F.struct(
            F.col("cut1").alias("from1"),
            F.col("cut2").alias("from2"),
            "to1",
            "to2",
            F.floor("left").cast("bigint").alias("most"),
        )
        old, found = found, found.join(after, "place").select(
            "place",
            F.col("to1").alias("cut1"),
            F.col("to2").alias("cut2"),
            F.col("rest").alias("left"),
            F.array_append("ranges", step).alias("ranges"),
            "first1",
            "first2",
        )
        found = materialize(found, "ranges")
        discard(old, behind)
    behind = join_lookup(rows, found, ["place"], written=True)
    behind = behind.filter("size > 0 and size < 2 * left and (key1, key2) >= (first1, first2)")
    off = F.abs(F.col("left") - F.col("size"))
    best = behind.filter(~in_ranges()).groupBy("place")
    best = best.agg(F.min(F.struct(off.alias("off"), "key1", "key2", "size")).alias("best"))
    alone = F.struct(
        F.col("best.key1").alias("from1"),
        F.col("best.key2").alias("from2"),
        F.col("best.key1").alias("to1"),
        (F.col("best.key2") + 1).alias("to2"),
        F.col("best.size").alias("most"),
    )
    found = found.join(best, "place", "left")
    more = F.when(F.col("best").isNull(), F.col("ranges"))
    return found.select("place", more.otherwise(F.array_append("ranges", alone)).alias("ranges"))


def block_of(key: Column, blocks: Column) -> Column:
    return F.shiftright(F.shiftright(key, 30) * blocks, 30)


def mix_plan(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    shards: int = SHARDS,
    blocks: int = BLOCKS,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``source``, ``size``,
    ``source_size``, ``target``, ``draws`` (one ``shard`` and ``position`` for
    each time the mix takes the row) and the ``keep`` columns.

    A null text has size 0; a null source is a source, the last one. A source of
    size 0 has target 0 and nothing is drawn from it. Equal rows are drawn as
    often as their number asks for, whichever of them it is. The order depends
    on ids, texts and the seed alone, so reruns agree. No row is drawn more than
    ``ceil(cap)`` times. A source misses its target by less than half of the
    smallest row that is not drawn, and mostly by far less.
    """
    if shards < 1 or blocks < 1 or cap <= 0 or share <= 0:
        raise ValueError("shards, blocks, cap and share have to be positive")
    if share > cap:
        raise ValueError("the mix cannot hold more than the cap of every source")
    text = F.col(text_col).cast("string")
    hashed = F.xxhash64(F.lit(seed), F.col(id_col), F.xxhash64(text))
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("bigint").alias("size"),
        F.shiftrightunsigned(hashed, 64 - _KEY_BITS).alias("key1"),
        *[F.col(c).alias(f"__{c}") for c in keep],
    )
    sized = numbered(sized, "sizes")
    again = F.shiftrightunsigned(F.xxhash64(F.lit(seed), ROW), 64 - _KEY_BITS)
    sized = sized.withColumn("key2", again)
    sources = with_targets(ranked_sources(sized), weights, share, cap)
    all_words = F.lit(max(sources.agg(F.sum("source_size")).first()[0] or 0, 1))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    full = F.coalesce(full, F.lit(0)).cast("int")
    sources = materialize(
        sources.withColumns(
            {
                "full": full,
                "rest": F.col("target") - full * F.col("source_size"),
                "blocks": F.greatest(
                    F.lit(1), F.round(F.col("source_size") / all_words * blocks)
                ).cast("bigint"),
            }
        ),
        "targets",
    )
    places = sources.select("source", "place")
    rows = join_lookup(
        sized.select("source", "size", "key1", "key2"), places, ["source"], null_safe=True
    )
    rows = rows.drop("source")
    first = materialize(cuts(rows, sources), "first")
    sources = sources.join(first.drop("left"), "place").join(fitting(rows, first), "place")
    sources = materialize(sources, "cut")

    # Tickets: the blocks drawn, in the order of the copies and of the keys.
    last = block_of(F.least("cut1", F.lit((1 << _KEY_BITS) - 1)), F.col("blocks"))
    partly = F.when((F.col("cut1") > 0) | (F.col("cut2") > 0), last + 1).otherwise(F.lit(0))
    drawn = (F.col("full") * F.col("blocks") + partly).cast("bigint")
    tickets = sources.filter("source_size > 0").select(
        "place", "blocks", F.explode(F.sequence(F.lit(0).cast("bigint"), drawn)).alias("ticket")
    )
    tickets = tickets.join(sources.select("place", drawn.alias("drawn")), "place")
    tickets = tickets.filter("ticket < drawn").drop("drawn")
    urns = split_urn(tickets.select("place", "ticket"), shards, seed)
    # The quota of a shard is a run of the source's tickets.
    run = Window.partitionBy("place").orderBy("shard", "ticket")
    urns = urns.select("place", "shard", (F.row_number().over(run) - 1).alias("ticket"))
    placed = tickets.join(urns, ["place", "ticket"]).groupBy(
        "place", F.pmod("ticket", "blocks").alias("block")
    )
    copy = F.floor(F.col("ticket") / F.col("blocks"))
    placed = placed.agg(
        F.map_from_entries(F.collect_list(F.struct(copy.alias("copy"), "shard"))).alias("shards")
    )
    rows = join_lookup(sized, sources, ["source"], null_safe=True)
    rows = rows.withColumn("block", block_of(F.col("key1"), F.col("blocks")))
    rows = join_lookup(rows, placed, ["place", "block"], "left")
    before_cut = (F.col("key1") < F.col("cut1")) | (
        (F.col("key1") == F.col("cut1")) & (F.col("key2") < F.col("cut2"))
    )
    taken_too = before_cut | (in_ranges() & (F.col("size") > 0))
    times = F.when(
        F.col("source_size") > 0, F.col("full") + taken_too.cast("int")
    ).otherwise(F.lit(0))
    copies = F.filter(
        F.sequence(F.lit(0), F.lit(int(cap) + 1)), lambda c: c < F.col("__times")
    )
    draws = F.transform(
        copies,
        lambda c: F.struct(
            # Rows that fill a gap lie in blocks without a ticket.
            F.coalesce(
                F.element_at("shards", c.cast("bigint")), F.pmod(F.xxhash64("key1", c), F.lit(shards)).cast("int")
            ).alias("shard"),
            F.xxhash64(F.lit(seed), c, "key1").alias("position"),
        ),
    )
    rows = rows.withColumn("__times", times)
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        draws.alias("draws"),
        *[F.col(f"__{c}").alias(c) for c in keep if c not in ("doc_id", "source")],
    )


def mixed(plan: DataFrame, columns: list[str]) -> DataFrame:
    """The rows of the mix, one for each draw, shard after shard, each in its order."""
    rows = plan.select(*columns, F.explode("draws").alias("__draw"))
    order = ["__draw.shard", "__draw.position"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
