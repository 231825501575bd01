"""Removal of byte runs that earlier documents hold too, by suffix arrays.

Every window of ``length`` bytes belongs to the smallest hash of the byte grams
in it, so equal windows have equal hashes, and consecutive windows of one hash
make a stretch of text. Stretches whose hash only one text has are left out, by
a filter of fixed size that may keep some. Equal stretches fold into one with
its smallest document. The different stretches of each hash meet in one task,
where their suffixes are sorted and a scan with a stack over the common prefix
lengths of neighbours closes the intervals of the prefix tree: all occurrences
of one repeated string. An interval whose occurrences all stand behind the same
byte is part of the longer repeat one byte to the left and is passed over; the
others are the maximal repeats, whose occurrences outside their smallest
document are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import bitmap, in_bitmap, small
from stockflow.llm.words import mix
from stockflow.operators.joins import join_lookup
from stockflow.session import materialize, new_location, spread

LENGTH = 50  # bytes of the shortest repeat
GRAM = 20  # bytes of the grams that place windows
FILTER_BITS = 27  # of the filter of repeated hashes: 16 MiB
MARKED_BITS = 26  # of the filter of stretches that lose something: 8 MiB
CROWD = 1 << 14  # different stretches of one hash beyond which its windows are dealt anew
CHUNK = 1 << 20  # bytes of text hashed at once
PIECE = 1 << 20  # hashes that a task combines before it hands them on
BLOCK = 1 << 22  # bytes of stretches whose suffixes are sorted at once
LONGEST = 1 << 6  # windows of a stretch, or as many as a window has bytes
NO_ID = -(1 << 63)  # stands for a null id, which comes before all others

_ODD = 0x9E3779B97F4A7C15
_MIXED = -1


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """Hash of each run of ``gram`` bytes, from hashes of runs of 1, 2, 4, ... bytes."""
    total, size = None, 0
    part, step = (data + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03), 1
    while True:
        if gram & step:
            if total is None:
                total = part
            else:
                n = len(data) - size - step + 1
                total = total[:n] * np.uint64(pow(_ODD, step, 1 << 64)) + part[size : size + n]
            size += step
        if size == gram:
            break
        n = len(part) - step
        part = part[:n] * np.uint64(pow(_ODD, step, 1 << 64)) + part[step:]
        step *= 2
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return values if step == width else np.minimum(values[: step - width], values[width - step :])


def chunks(texts: pa.Array, length: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, byte offset within it, bytes, and where each row ends.

    Long texts come in parts that share ``length - 1`` bytes, so that each
    window lies in exactly one part; others come several at once, from their start.
    """
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(offsets, offsets[low] + CHUNK, "right")) - 1
        high = min(max(high, low + 1), len(texts))
        own = data[offsets[low] : offsets[high]]
        if len(own) <= CHUNK:
            yield low, 0, own, offsets[low : high + 1] - offsets[low]
        else:
            for at in range(0, len(own) - length + 1, CHUNK):
                part = own[at : at + CHUNK + length - 1]
                yield low, at, part, np.array([0, len(part)])
        low = high


def stretches(data: np.ndarray, cuts: np.ndarray, length: int, gram: int):
    """Runs of windows of one hash: their rows, first windows, sizes and hashes."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64)
    with np.errstate(over="ignore"):
        hashes = smallest(gram_hashes(data, gram), length - gram + 1)
    n = len(hashes)
    first = np.ones(n, bool)
    first[1:] = hashes[1:] != hashes[:-1]
    first[cuts[cuts < n]] = True
    beyond = cuts[1:] - length + 1  # windows from here on reach into the next row
    first[beyond[(beyond >= 0) & (beyond < n)]] = True
    starts = np.flatnonzero(first)
    sizes = np.diff(starts, append=n)
    # Only text that repeats itself makes longer ones. Short pieces of it are mostly
    # equal, and bound how many bytes two suffixes have in common.
    most = max(LONGEST, length)
    long = -(-sizes // most)
    if len(long) and long.max() > 1:
        turn = np.arange(long.sum()) - np.repeat(np.cumsum(long) - long, long)
        starts = np.repeat(starts, long) + turn * most
        sizes = np.minimum(np.repeat(sizes, long) - turn * most, most)
    rows = np.searchsorted(cuts, starts, "right") - 1
    inside = starts + length <= cuts[rows + 1]
    starts = starts[inside]
    # Minima crowd at small values: scrambled once more they spread evenly.
    return rows[inside], starts, sizes[inside], mix(hashes[starts])


def texts_per_hash(length: int, gram: int, parts: int):
    """The different hashes of the texts with the text's class, or 0 where a piece
    has several, dealt by the upper ``parts`` bits of the hash.

    An entry has 32 bits of the hash below those, and 48 of the class.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            hashes, kinds = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.argsort(hashes)
            hashes, kinds = hashes[order], kinds[order]
            first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
            low, high = np.minimum.reduceat(kinds, first), np.maximum.reduceat(kinds, first)
            kind, hashes = np.where(low == high, low, np.uint64(0)), hashes[first]
            part = hashes >> np.uint64(64 - parts)
            cuts = np.flatnonzero(np.diff(part, prepend=~part[:1]))
            fields = [
                ((hashes << np.uint64(parts)) >> np.uint64(32)).astype("<u4"),
                kind.astype("<u4"),
                (kind >> np.uint64(32)).astype("<u2"),
            ]
            blobs = [
                b"".join(field[a:b].tobytes() for field in fields)
                for a, b in zip(cuts, [*cuts[1:], len(part)], strict=True)
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(part[cuts].astype(np.int32)), pa.array(blobs, pa.binary())],
                ["part", "entries"],
            )

        for batch in batches:
            kinds = batch.column("h").to_numpy().view(np.uint64) >> np.uint64(16)
            kinds = np.maximum(kinds, np.uint64(1))
            for low, _, data, cuts in chunks(batch.column("t"), length):
                rows, _, _, hashes = stretches(data, cuts, length, gram)
                held.append((hashes, kinds[low + rows]))
            if sum(len(x[0]) for x in held) >= PIECE:
                yield packed()
                held.clear()
        if sum(len(x[0]) for x in held):
            yield packed()

    return run


def repeated_slots(parts: int, bits: int):
    """The part of the filter with the hashes that several texts have."""

    def run(group: pa.Table) -> pa.Table:
        blobs = [blob.as_py() for blob in group.column("entries")]
        sizes = [len(blob) // 10 for blob in blobs]

        def field(kind: str, at: int) -> np.ndarray:
            pairs = zip(blobs, sizes, strict=True)
            return np.concatenate([np.frombuffer(blob, kind, n, at * n) for blob, n in pairs])

        hashes = field("<u4", 0)
        kinds = field("<u2", 8).astype(np.uint64) << np.uint64(32) | field("<u4", 4)
        order = np.argsort(hashes)
        hashes, kinds = hashes[order], kinds[order]
        first = np.flatnonzero(np.diff(hashes, prepend=~hashes[:1]))
        low, high = np.minimum.reduceat(kinds, first), np.maximum.reduceat(kinds, first)
        several = hashes[first][(low != high) | (low == 0)]
        slots = (several >> np.uint32(32 - (bits - parts))).astype(np.int64)
        filled = np.zeros(1 << (bits - parts), bool)
        filled[slots] = True
        part = group.column("part")[0].as_py()
        packed = np.packbits(filled).tobytes()
        return pa.table({"part": pa.array([part], pa.int32()), "slots": pa.array([packed])})

    return run


def repeated_filter(texts: DataFrame, n_bytes: int, length: int, gram: int, bits: int) -> np.ndarray:
    """Bits of the hashes that several different texts have, and maybe of others."""
    expected = 2 * n_bytes // (length - gram + 2)
    # So many that about 2 ** 20 hashes meet in a task.
    parts = min(max((expected >> 20).bit_length(), 4), bits - 3)
    pieces = texts.select("t", "h").mapInArrow(
        texts_per_hash(length, gram, parts), "part int, entries binary"
    )
    slots = pieces.groupBy("part").applyInArrow(repeated_slots(parts, bits), "part int, slots binary")
    filled = np.zeros((1 << parts, (1 << (bits - parts)) // 8), np.uint8)
    for row in slots.toLocalIterator():
        filled[row["part"]] = np.frombuffer(row["slots"], np.uint8)
    return filled.ravel()


def repeated_stretches(length: int, gram: int, bits: int, table, marked=None):
    """The texts' stretches whose hash passes the filter: their contents, or with a
    second filter the places and content hashes of those that pass it as well."""

    def passing(batch: pa.RecordBatch):
        for low, base, data, cuts in chunks(batch.column("t"), length):
            rows, starts, sizes, hashes = stretches(data, cuts, length, gram)
            slots = hashes >> np.uint64(64 - bits)
            byte = table.value[(slots >> np.uint64(3)).astype(np.int64)]
            passed = (byte >> (7 - (slots & np.uint64(7)).astype(np.uint8))) & 1 == 1
            rows, starts, sizes = rows[passed], starts[passed], sizes[passed]
            raw, ends = data.tobytes(), starts + sizes + length - 1
            contents = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield low + rows, base + starts - cuts[rows], hashes[passed].view(np.int64), contents

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 4096):
            ids = batch.column("id").to_numpy()
            for rows, _, buckets, contents in passing(batch):
                columns = [pa.array(ids[rows]), pa.array(buckets), pa.array(contents, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "bucket", "content"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in small(batches, 4096):
            keys = [batch.column(c).to_numpy() for c in ("h", "id")]
            for rows, at, buckets, contents in passing(batch):
                # As Spark's own function hashes bytes.
                c = np.array([xxh64_intdigest(x, 42) for x in contents], np.uint64)
                hit = in_bitmap(marked.value, c)
                columns = [pa.array(key[rows[hit]]) for key in keys]
                columns += [pa.array(x[hit]) for x in (at, buckets, c.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["h", "id", "at", "bucket", "c"])

    return places if marked else whole


class SuffixArray:
    """Sorted suffixes of at least ``length`` bytes of some stretches, and the
    numbers of bytes that neighbours have in common.

    ``data`` holds bytes of UTF-8, so adding 1 to each leaves 0 for the end.
    """

    def __init__(self, contents: list[bytes], length: int) -> None:
        sizes = np.array([len(c) for c in contents])
        joined = np.frombuffer(b"".join(c + bytes(8) for c in contents), np.uint8)
        starts = np.cumsum(sizes + 8) - sizes - 8
        self.symbols = joined + np.uint8(1)
        gaps = (starts + sizes)[:, None] + np.arange(8)
        self.symbols[gaps.ravel()] = 0
        words = np.ndarray((len(joined) - 7,), ">u8", self.symbols, strides=(1,))
        self.words = words.astype(np.uint64)
        n = sizes - length + 1
        self.owner = np.repeat(np.arange(len(sizes)), n)
        self.offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        self.at = starts[self.owner] + self.offset
        self.end = (starts + sizes)[self.owner]
        self._sort()
        self._prefixes()

    def _word(self, suffixes: np.ndarray, turn: int) -> np.ndarray:
        return self.words[np.minimum(self.at[suffixes] + 8 * turn, self.end[suffixes])]

    def _sort(self) -> None:
        """Eight bytes at a time, going on with the suffixes that are still equal."""
        key = self._word(np.arange(len(self.at)), 0)
        order = np.argsort(key, kind="stable")
        self.order = order
        slots, key = np.arange(len(order)), key[order]
        groups = np.cumsum(np.diff(key, prepend=~key[:1]) != 0)
        turn = 1
        while True:
            twin = np.zeros(len(groups), bool)
            same = groups[1:] == groups[:-1]
            twin[1:] |= same
            twin[:-1] |= same
            twin &= key != 0  # ended suffixes are equal for good
            slots, groups = slots[twin], groups[twin]
            if not len(slots):
                return
            members = self.order[slots]
            key = self._word(members, turn)
            order = np.lexsort((key, groups))
            self.order[slots], key = members[order], key[order]
            new = (np.diff(key, prepend=~key[:1]) != 0) | (np.diff(groups, prepend=-1) != 0)
            groups = np.cumsum(new)
            turn += 1

    def _prefixes(self) -> None:
        left, right = self.order[:-1], self.order[1:]
        prefix = np.zeros(len(left), np.int64)
        active, turn = np.arange(len(left)), 0
        while len(active):
            a, b = self._word(left[active], turn), self._word(right[active], turn)
            differ = a ^ b
            for byte in range(1, 9):
                prefix[active] += (differ >> np.uint64(64 - 8 * byte)) == 0
            active = active[(differ == 0) & (a != 0)]
            turn += 1
        rest = self.end - self.at
        self.prefix = np.minimum(prefix, np.minimum(rest[left], rest[right]))

    def before(self) -> np.ndarray:
        """The byte before each suffix, or none where its stretch begins."""
        return np.where(self.offset > 0, self.symbols[self.at - 1].astype(np.int64), _MIXED)


def removed_spans(contents: list[bytes], firsts: np.ndarray, length: int) -> dict[int, list]:
    """Per stretch the parts that stretches of smaller documents hold as well."""
    array = SuffixArray(contents, length)
    order = array.order
    owner = array.owner[order]
    least, before = firsts[owner], array.before()[order]
    # Clusters share their first ``length`` bytes: subtrees of the prefix tree.
    prefix = np.append(array.prefix, 0)
    border = np.append(True, array.prefix < length)
    cluster = np.flatnonzero(border)
    of_several = np.minimum.reduceat(least, cluster) < np.maximum.reduceat(least, cluster)
    low, high = np.minimum.reduceat(before, cluster), np.maximum.reduceat(before, cluster)
    diverse = (low != high) | (low == _MIXED)
    found: dict[int, list] = {}
    bounds = np.append(cluster, len(order))
    for number in np.flatnonzero(of_several & diverse):
        part = slice(bounds[number], bounds[number + 1])
        repeats = closed_intervals(
            prefix[part].tolist(), least[part].tolist(), before[part].tolist(), length
        )
        for depth, members in repeats:
            for member in members:
                suffix = order[part.start + member]
                start = int(array.offset[suffix])
                found.setdefault(int(array.owner[suffix]), []).append((start, start + depth))
    return found


def closed_intervals(
    prefix: list[int], least: list[int], before: list[int], length: int
) -> Iterator[tuple[int, list[int]]]:
    """Maximal repeats of neighbouring suffixes: their length, and those of the
    occurrences whose document is not the smallest, each at its longest one.

    ``prefix`` holds what each suffix has in common with the next one.
    """
    stack: list[list] = []  # depth, smallest document, byte before, its and the other members
    for suffix, document in enumerate(least):
        node = [0, document, before[suffix], [suffix], []]
        common = prefix[suffix] if suffix + 1 < len(least) else 0
        while stack and stack[-1][0] > common:
            node = joined(stack.pop(), node)
            if node[4] and node[2] == _MIXED:
                yield node[0], node[4]
            # Others were met here or, behind one byte, in the repeat to the left.
            node[4] = []
        if stack and stack[-1][0] == common:
            joined(stack[-1], node)
        elif common >= length:
            stack.append([common, *node[1:]])


def joined(interval: list, child: list) -> list:
    """The interval with one more child; members of larger documents stand aside."""
    if child[1] < interval[1]:
        interval[4] += interval[3]
        interval[1], interval[3] = child[1], child[3]
    elif child[1] > interval[1]:
        interval[4] += child[3]
    else:
        interval[3] += child[3]
    if child[2] != interval[2]:
        interval[2] = _MIXED
    return interval


def shared_spans(length: int, block: int):
    """Stretches that several documents hold, or parts of them, bucket by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            buckets = batch.column("bucket").to_numpy()
            size += batch.column("content").nbytes
            if size < block or buckets[0] == buckets[-1]:
                held.append(batch)
                continue
            last = int(np.searchsorted(buckets, buckets[-1]))
            yield from spans_of([*held, batch.slice(0, last)], length)
            held = [batch.slice(last)]
            size = held[0].column("content").nbytes
        if held:
            yield from spans_of(held, length)

    return run


def spans_of(batches: list[pa.RecordBatch], length: int) -> list[pa.RecordBatch]:
    table = pa.Table.from_batches(batches).combine_chunks()
    bucket, first, last = (table.column(c).to_numpy() for c in ("bucket", "first", "last"))
    starts = np.flatnonzero(np.diff(bucket, prepend=~bucket[:1]))
    several = np.minimum.reduceat(first, starts) < np.maximum.reduceat(first, starts)
    rows = np.flatnonzero(np.repeat(several, np.diff(starts, append=len(bucket))))
    spans: list = [None] * len(bucket)
    if len(rows):
        contents = table.column("content").take(pa.array(rows)).to_pylist()
        for at, parts in removed_spans(contents, first[rows], length).items():
            spans[rows[at]] = [low << 32 | high for low, high in merged(parts)]
    keep = (first < last) | np.array([s is not None for s in spans])
    out = table.select(["bucket", "c", "first", "n"])
    out = out.append_column("spans", pa.array(spans, pa.list_(pa.int64())))
    return out.filter(pa.array(keep)).to_batches()


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of overlapping or touching spans."""
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def single_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, 1024):
            contents = batch.column("content").to_pylist()
            n = [len(c) - length + 1 for c in contents]
            row = np.repeat(np.arange(len(n)), n)
            windows = [c[i : i + length] for c, m in zip(contents, n, strict=True) for i in range(m)]
            at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            columns = [batch.column(c).take(pa.array(row)) for c in ("bucket", "c", "first")]
            columns += [pa.array(at), pa.array(windows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "c", "first", "at", "window"])

    return run


def crowd_spans(crowd: DataFrame, length: int) -> DataFrame:
    """The same as ``shared_spans`` for stretches that are too many for one task:
    their windows fold by content instead and are looked up one by one."""
    windows = crowd.select("bucket", "c", "first", "content").mapInArrow(
        single_windows(length), "bucket bigint, c bigint, first bigint, at bigint, window binary"
    )
    windows = materialize(windows, "windows")
    least = windows.groupBy("window").agg(
        F.min("first").alias("least"), F.max("first").alias("most")
    )
    least = least.filter("least < most").drop("most")
    later = join_lookup(windows, least, ["window"]).filter("least < first")
    spans = F.collect_set(F.shiftleft("at", 32) + F.col("at") + length).alias("spans")
    parts = later.groupBy("bucket", "c").agg(spans)
    marked = join_lookup(crowd.drop("content"), parts, ["bucket", "c"], "left")
    marked = marked.filter("first < last or spans is not null")
    return marked.select("bucket", "c", "first", "n", "spans")


def merged_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each text as pairs of unsigned 32-bit numbers."""
    for batch in small(batches, 4096):
        blobs = []
        for spans in batch.column("spans"):
            pairs = [(s >> 32, s & 0xFFFFFFFF) for s in spans.as_py()]
            blobs.append(np.array(merged(pairs), "<u4").tobytes())
        columns = [batch.column("h"), batch.column("id"), pa.array(blobs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["h", "id", "spans"])


def kept_bytes(with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows, kept = [], []
            for text, spans, whole in zip(*map(batch.column, ("t", "spans", "whole")), strict=True):
                data = text.as_py().encode()
                cuts = np.frombuffer(spans.as_py() or b"", "<u4").tolist()
                if whole.as_py():
                    cuts = [0, len(data)]
                rest = b"".join(
                    data[a:b]
                    for a, b in zip([0, *cuts[1::2]], [*cuts[::2], len(data)], strict=True)
                )
                digest = hashlib.sha256(rest).hexdigest()
                rows.append((len(data), len(data) - len(rest), len(cuts) // 2, digest))
                kept.append(rest)
            n_bytes, n_removed, n_spans, digests = zip(*rows, strict=True)
            columns = [batch.column("doc_id")]
            columns += [pa.array(x, pa.int64()) for x in (n_bytes, n_removed, n_spans)]
            columns += [pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def described(different: DataFrame) -> DataFrame:
    """Stretches with the hash and the size of their content."""
    return different.withColumn("c", F.xxhash64("content")).withColumn(
        "n", F.octet_length("content").cast("bigint")
    )


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
    bits: int = FILTER_BITS,
    crowd: int = CROWD,
    block: int = BLOCK,
    with_kept: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_bytes``, ``n_removed``,
    ``n_spans`` (maximal removed runs), ``kept_sha256``, and with ``with_kept`` the
    bytes that stay as ``kept``.

    A byte goes if a string of ``length`` bytes over it also starts in a row with
    a smaller id. Ids are integers; a null id is smaller than all others. Rows
    with equal ids, equal or not, do not remove from each other. Null texts are
    empty. Matches cross no rows and may begin and end within a character, so
    what stays is bytes. An empty table has no rows. Other columns are not read.
    """
    if not gram <= length:
        raise ValueError("gram must not be longer than length")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID))
    # Two hashes tell the texts apart: equal texts fold.
    texts = docs.select(
        F.col(id_col).alias("doc_id"),
        own.alias("id"),
        text.alias("t"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.lit(1), text).alias("g"),
    )
    long = texts.filter(F.octet_length("t") >= length)
    classes = materialize(
        long.groupBy("h", "g").agg(
            F.min("id").alias("copied"), F.max("id").alias("last"), F.max(F.octet_length("t")).alias("n")
        ),
        "classes",
    )
    copies = materialize(classes.filter("copied < last").select("h", "g", "copied"), "copies")
    n_bytes = classes.agg(F.sum("n")).first()[0] or 0
    broadcast = docs.sparkSession.sparkContext.broadcast
    repeated = broadcast(repeated_filter(long, n_bytes, length, gram, bits))
    different = (
        long.select("id", "t")
        .mapInArrow(
            repeated_stretches(length, gram, bits, repeated),
            "id bigint, bucket bigint, content binary",
        )
        .groupBy("bucket", "content")
        .agg(F.min("id").alias("first"), F.max("id").alias("last"))
    )
    # Mostly text: a fifth smaller than with the default codec.
    path = new_location(docs.sparkSession, "stretches")
    different.write.option("compression", "zstd").parquet(path)
    different = docs.sparkSession.read.schema(different.schema).parquet(path)
    crowded = different.groupBy("bucket").count().filter(F.col("count") > crowd).select("bucket")
    crowded = materialize(crowded, "crowded")
    usual = join_lookup(different, crowded, ["bucket"], "left_anti", written=True)
    marks = (
        described(spread(usual, "bucket").sortWithinPartitions("bucket"))
        .mapInArrow(
            shared_spans(length, block),
            "bucket bigint, c bigint, first bigint, n bigint, spans array<bigint>",
        )
    )
    if not crowded.isEmpty():
        many = join_lookup(different, crowded, ["bucket"], "left_semi", written=True)
        marks = marks.union(crowd_spans(described(many), length))
    marks = materialize(marks, "marks")
    marked = broadcast(bitmap(marks, "c", MARKED_BITS))
    places = long.select("h", "id", "t").mapInArrow(
        repeated_stretches(length, gram, bits, repeated, marked),
        "h bigint, id bigint, at bigint, bucket bigint, c bigint",
    )
    hits = join_lookup(places, marks, ["bucket", "c"], written=True)
    shift = F.shiftleft("at", 32) + F.col("at")
    span = F.when(F.col("id") > F.col("first"), F.array(shift + F.col("n"))).otherwise(
        F.transform("spans", lambda s: s + shift)
    )
    # A text with a given id is told by one of its hashes.
    spans = hits.select("h", "id", F.explode(span).alias("span")).groupBy("h", "id")
    spans = spans.agg(F.collect_set("span").alias("spans"))
    spans = spans.mapInArrow(merged_spans, "h bigint, id bigint, spans binary")
    # Of equal texts only those with the smallest id keep anything.
    whole = join_lookup(long.select("h", "g", "id"), copies, ["h", "g"], written=True)
    whole = whole.filter("id > copied").select("h", "id").distinct()
    removed = (
        spans.withColumn("whole", F.lit(False))
        .unionByName(whole.withColumn("whole", F.lit(True)), allowMissingColumns=True)
        .groupBy("h", "id")
        .agg(F.max("spans").alias("spans"), F.max("whole").alias("whole"))
    )
    removed = materialize(removed, "removed")
    rows = join_lookup(texts, removed, ["h", "id"], "left", written=True)
    kind = texts.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return rows.select("doc_id", "t", "spans", "whole").mapInArrow(
        kept_bytes(with_kept), schema + (", kept binary" if with_kept else "")
    )
