"""Alignment of the tokens that two tokenizers cut the same bytes into.

The cumulative byte ends of both token rows are dictionaries from end to index;
the ends that both hold, in order, cut the two rows into groups, and within a
group every pair of tokens whose byte ranges overlap is linked.

Both tokenizers cut before a space between two characters that are no white
space, so a text falls into pieces that are aligned one by one, and the last
pieces' alignments are remembered.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, count

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.llm.common import small
from stockflow.llm.token_output import (
    LETTERS,
    LONGEST,
    MARKS,
    WordEncoder,
    per_process,
    plain_letters,
)
from stockflow.operators.joins import join_lookup
from stockflow.session import materialize

CACHED_PIECES = 200_000  # of each of two generations; about 130 MiB for each worker process
HELD_LINKS = 1 << 22  # links that a task holds before it counts them
MOST_PAIRS = 1 << 21  # different pairs that a task holds before it hands them on
FREQUENT = 1 << 20  # pairs whose counts are broadcast (12 MiB); others are joined
STEPS = 8  # by so many steps counts double, where frequent ones are told from others
ROW = "__row"
SHIFT = 1 << 16  # a pair is A's id times this plus B's id

COUNTED = "counted array<struct<pair: bigint, n: bigint>>"
FIGURES = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"


def piece_bytes(piece: str) -> bytes:
    """The bytes that a piece stands for; ``<0xHH>`` is one byte, U+2581 a space."""
    if re.fullmatch(r"<0x[0-9A-F]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def ends(tokens: list[int], sizes: list[int]) -> dict[int, int]:
    """From the byte end of each token to the index behind it."""
    return dict(zip(accumulate(map(sizes.__getitem__, tokens)), count(1)))


def links_of(
    a: list[int], b: list[int], sizes_a: list[int], sizes_b: list[int]
) -> Iterator[tuple[int, int]]:
    """Pairs of tokens of one group whose bytes overlap."""
    i = j = 0
    end_a, end_b = sizes_a[a[0]], sizes_b[b[0]]
    while True:
        yield a[i], b[j]
        # No end but the last is common: the shorter side goes on.
        if end_a < end_b:
            i += 1
            end_a += sizes_a[a[i]]
        elif end_b < end_a:
            j += 1
            end_b += sizes_b[b[j]]
        else:
            return


class Aligner:
    """Alignments of texts, piece by piece; one for each worker process."""

    def __init__(self, byte_path: str, piece_path: str, most: int = CACHED_PIECES) -> None:
        from sentencepiece import SentencePieceProcessor

        self.words = WordEncoder(byte_path, plain=True, most=most // 10)
        vocabulary = self.words.tokenizer.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.words.tokenizer.get_added_tokens_decoder().values()}
        self.sizes_a = [0] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            # Each character stands for one byte, except in added tokens.
            self.sizes_a[number] = len(token.encode() if token in added else token)
        self.pieces = SentencePieceProcessor(model_file=piece_path)
        shown = [self.pieces.id_to_piece(n) for n in range(self.pieces.get_piece_size())]
        self.bytes_b = [piece_bytes(piece) for piece in shown]
        self.sizes_b = [len(b) for b in self.bytes_b]
        self.starts_b = [piece.startswith("▁") for piece in shown]
        self.names = [str(n) for n in range(max(len(self.sizes_a), len(shown)))]
        # Letters and the marks behind them never share a token of the first; where
        # they share none of the second either, both are aligned for themselves.
        shared = re.compile(f"[{LETTERS}][{MARKS}]")
        self.apart = not any(shared.search(p) for p in shown if not p.startswith("<"))
        self.marks = "".join(c for c in map(chr, range(128)) if re.match(f"[{MARKS}]", c))
        self.tails: dict[str, tuple | None] = {}
        self.most = most
        self.known: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}
        self.cut = re.compile(r"(?<=\S) (?=\S)")

    def second_ids(self, words: list[str]) -> Iterator[list[int]]:
        """The second tokenizer's ids of words of letters, encoded as one text.

        Each word's first token begins with the space before it, no other does.
        """
        ids = self.pieces.encode(" ".join(words), num_threads=1) if words else []
        cuts = [spot for spot, token in enumerate(ids) if self.starts_b[token]]
        if len(cuts) != len(words):
            yield from self.pieces.encode(words, num_threads=1)
            return
        for low, high in zip(cuts, [*cuts[1:], len(ids)]):
            yield ids[low:high]

    def other(self, piece: str) -> tuple | None:
        """The alignment of a piece that is more than letters and marks; nothing if
        the second tokenizer's ids do not give back the bytes."""
        b = self.pieces.encode(piece, num_threads=1)
        if b"".join(map(self.bytes_b.__getitem__, b)) != b" " + piece.encode():
            return None
        runs = self.words.runs.fullmatch(piece)
        a = self.words.word(piece) if runs else self.words.bare(" " + piece)
        return self.aligned(array("I", a).tolist(), b)

    def tail(self, marks: str) -> tuple:
        """The alignment of marks behind letters, which have no space before them."""
        if marks not in self.tails:
            if len(self.tails) >= self.most // 10:
                self.tails.clear()
            # Behind a letter, since the second tokenizer puts a space in front.
            _, *b = self.pieces.encode("x" + marks, num_threads=1)
            self.tails[marks] = self.aligned(self.words.piece_ids(marks), b)
        return self.tails[marks]

    def aligned(self, a: list[int], b: list[int]) -> tuple[int, int, int, str, bytes]:
        """Numbers of tokens and groups, the groups as text, and the linked pairs."""
        names = self.names
        ends_a, ends_b = ends(a, self.sizes_a), ends(b, self.sizes_b)
        common = sorted(ends_a.keys() & ends_b.keys())
        if len(common) == 1 and (len(a) == 1 or len(b) == 1):
            group = f"{','.join([names[x] for x in a])}|{','.join([names[y] for y in b])}"
            links = [x * SHIFT + y for x in a for y in b]
            return len(a), len(b), 1, group, array("Q", links).tobytes()
        links, groups = [], []
        i = k = 0
        for end in common:
            j, m = ends_a[end], ends_b[end]
            if j == i + 1 and m == k + 1:
                groups.append(f"{names[a[i]]}|{names[b[k]]}")
                links.append(a[i] * SHIFT + b[k])
            else:
                own, other = a[i:j], b[k:m]
                sides = (",".join([names[x] for x in side]) for side in (own, other))
                groups.append("|".join(sides))
                pairs = links_of(own, other, self.sizes_a, self.sizes_b)
                links += [x * SHIFT + y for x, y in pairs]
            i, k = j, m
        return len(a), len(b), len(common), ";".join(groups), array("Q", links).tobytes()

    def remembered(self, piece: str) -> bool:
        """Whether the piece is known, brought on from the old generation if need be."""
        if piece in self.known:
            return True
        if piece in self.old:
            self.known[piece] = self.old[piece]
            return True
        return False

    def text(self, text: str | None) -> list[tuple] | None:
        """The alignments of a text's pieces in order, nothing if it has no tokens.

        Two generations of pieces are remembered; what no text asks for while one
        fills up goes, and long pieces go with their text. New words are encoded
        together.
        """
        if len(self.known) >= self.most:
            self.known, self.old = {}, self.known
            self.words.known = self.words.known.turned()
            self.words.inner = self.words.inner.turned()
        if not text:
            return None
        known, pieces = self.known, self.cut.split(text)
        words, tailed, long = set(), [], []
        for piece in set(pieces).difference(known):
            if self.remembered(piece):
                continue
            if plain_letters(piece):
                words.add(piece)
            elif self.apart and plain_letters(word := piece.rstrip(self.marks)):
                tailed.append((piece, word))
                if not self.remembered(word):
                    words.add(word)
            else:
                known[piece] = self.other(piece)
            if len(piece) > LONGEST:
                long.append(piece)
        words = list(words)
        for word, b in zip(words, self.second_ids(words), strict=True):
            known[word] = self.aligned(self.words.piece_ids(" " + word), b)
        for piece, word in tailed:
            one, two = known[word], self.tail(piece[len(word) :])
            counts = (x + y for x, y in zip(one[:3], two[:3]))
            known[piece] = (*counts, f"{one[3]};{two[3]}", one[4] + two[4])
            if len(word) > LONGEST:
                long.append(word)
        found = list(map(known.__getitem__, pieces))
        for piece in long:
            known.pop(piece, None)
        return None if None in found else found


def process_aligner(byte_path: str, piece_path: str) -> Aligner:
    key = ("alignment", byte_path, piece_path)
    return per_process(key, lambda: Aligner(byte_path, piece_path))


def packed_pairs(pairs: np.ndarray, times: np.ndarray, press) -> bytes:
    """Ascending pairs and how often each is there, compressed."""
    steps = np.diff(pairs, prepend=np.uint64(0)).astype("<u4")
    planes = np.concatenate([x.view(np.uint8).reshape(-1, 4).T.ravel() for x in (steps, times)])
    return press.compress(planes.tobytes())


def unpacked_pairs(packed: bytes, press) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(press.decompress(packed), np.uint8).reshape(2, 4, -1)
    steps, times = (np.ascontiguousarray(x.T).view("<u4").ravel() for x in planes)
    return np.cumsum(steps, dtype=np.uint64), times


class PairCounts:
    """Documents of each pair so far, in bounded memory."""

    def __init__(self, held: int, most: int) -> None:
        self.held, self.most = held, most
        self.waiting: list[np.ndarray] = []
        self.n = 0
        self.pairs = np.zeros(0, np.uint64)
        self.counts = np.zeros(0, np.int64)

    def add(self, pairs: np.ndarray) -> bool:
        """Whether it is time to hand the counts on."""
        self.waiting.append(pairs)
        self.n += len(pairs)
        if self.n >= self.held:
            self.combine()
        return len(self.pairs) >= self.most

    def combine(self) -> None:
        pairs = np.concatenate([self.pairs, *self.waiting])
        weights = np.concatenate([self.counts, np.ones(self.n, np.int64)])
        order = np.argsort(pairs, kind="stable")
        pairs, weights = pairs[order], weights[order]
        first = np.flatnonzero(np.diff(pairs, prepend=~pairs[:1]))
        self.pairs = pairs[first]
        self.counts = np.add.reduceat(weights, first) if len(first) else weights
        self.waiting, self.n = [], 0

    def taken(self, rows: int = 1 << 16) -> Iterator[pa.Array]:
        """Lists of pairs and counts; nothing is held afterwards."""
        self.combine()
        for low in range(0, len(self.pairs), rows):
            part = slice(low, low + rows)
            values = pa.StructArray.from_arrays(
                [pa.array(self.pairs[part].astype(np.int64)), pa.array(self.counts[part])],
                ["pair", "n"],
            )
            yield pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        self.pairs, self.counts = self.pairs[:0], self.counts[:0]


def aligned_texts(byte_path: str, piece_path: str, held: int, most: int):
    """A row per document, and rows with the documents' numbers of pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = process_aligner(byte_path, piece_path)
        press = zstandard.ZstdCompressor(level=1)
        number = TaskContext.get().partitionId() << 33
        counts = PairCounts(held, most)
        names = [ROW, "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        names += ["pairs", "counted"]
        kinds = [pa.int64(), pa.null(), *[pa.int64()] * 4, pa.string(), pa.binary()]
        kinds.append(pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())])))

        def with_counts() -> Iterator[pa.RecordBatch]:
            for array_ in counts.taken():
                columns = [pa.nulls(1, kind) for kind in kinds[:-1]]
                yield pa.RecordBatch.from_arrays([*columns, array_], names)

        for batch in small(batches):
            kinds[1] = batch.schema.field(0).type
            figures, digests, packs = [], [], []
            full = False
            for text in batch.column(1):
                found = aligner.text(text.as_py())
                if found is None:
                    figures.append((0, 0, 0, 0))
                    digests.append("")
                    packs.append(None)
                    continue
                links = np.frombuffer(b"".join(x[4] for x in found), np.uint64)
                pairs, times = np.unique(links, return_counts=True)
                full = counts.add(pairs) or full
                packs.append(packed_pairs(pairs, times.astype("<u4"), press))
                digests.append(hashlib.sha256(";".join(x[3] for x in found).encode()).hexdigest())
                figures.append((*(sum(x[i] for x in found) for i in range(3)), len(links)))
            n = len(figures)
            rows = np.array(figures, np.int64).reshape(n, 4)
            columns = [pa.array(np.arange(number, number + n)), batch.column(0)]
            columns += [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(4)]
            columns += [pa.array(digests, pa.string()), pa.array(packs, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.nulls(n, kinds[-1])], names)
            number += n
            if full:
                yield from with_counts()
        yield from with_counts()

    return run


def frequent_links(table):
    """Sums over each document's links to frequent pairs, and its other pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = table.value
        press = zstandard.ZstdDecompressor()
        for batch in small(batches):
            best_links, sums, rest = [], [], []
            for packed in batch.column("pairs"):
                if packed.as_py() is None:
                    best_links.append(0), sums.append(0), rest.append([])
                    continue
                own, times = unpacked_pairs(packed.as_py(), press)
                spot = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
                found = pairs[spot] == own if len(pairs) else np.zeros(len(own), bool)
                hit, n = spot[found], times[found].astype(np.int64)
                sums.append(int((counts[hit] * n).sum()))
                best_links.append(int(n[best[hit]].sum()))
                other = zip(own[~found].tolist(), times[~found].tolist(), strict=True)
                rest.append([{"pair": p, "n": n} for p, n in other])
            kind = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
            columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "pairs"]
            names = [name for name in batch.schema.names if name != "pairs"]
            columns += [pa.array(best_links, pa.int64()), pa.array(sums, pa.int64())]
            columns.append(pa.array(rest, kind))
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_best", "count_sum", "rest"])

    return run


def align_tokens(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequent: int = FREQUENT,
    held: int = HELD_LINKS,
    most: int = MOST_PAIRS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_a`` and ``n_b`` (tokens of both
    tokenizers), ``n_groups``, ``n_links``, ``groups_sha256``, ``n_best`` (links
    whose pair is in as many documents as any of its A id) and ``count_sum`` (sum
    over links of the documents that hold the pair).

    Null and empty texts, and texts whose tokens do not give back their bytes,
    have no tokens: zeros and an empty digest. Rows that are equal count as
    documents each; ids, which may be null, are only passed on. Other columns
    are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    written = materialize(
        rows.mapInArrow(
            aligned_texts(byte_path, piece_path, held, most),
            f"{ROW} bigint, doc_id {kind}, {FIGURES}, pairs binary, {COUNTED}",
        ),
        "aligned",
    )
    counted = written.select(F.explode("counted").alias("c")).select("c.*")
    counts = materialize(counted.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    # One row per id of the first vocabulary.
    token = F.shiftrightunsigned("pair", 16).alias("token")
    top = counts.groupBy(token).agg(F.max("n").alias("top"))
    step = F.floor(F.log2("n") * STEPS).cast("int")
    figures = join_lookup(counts.withColumn("token", token), top, ["token"]).select(
        "pair", "n", (F.col("n") == F.col("top")).alias("best"), step.alias("step")
    )
    least, total = 0, 0
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > frequent:
            least = row["step"] + 1
            break
    common = figures.filter(F.col("step") >= least).drop("step").toArrow().sort_by("pair")
    table = spark.sparkContext.broadcast(
        (
            common["pair"].to_numpy().astype(np.uint64),
            common["n"].to_numpy(),
            common["best"].to_numpy(zero_copy_only=False),
        )
    )
    names = [name.split()[0] for name in FIGURES.split(", ")]
    documents = written.filter(f"{ROW} is not null").select(ROW, "doc_id", *names, "pairs")
    documents = materialize(
        documents.mapInArrow(
            frequent_links(table),
            f"{ROW} bigint, doc_id {kind}, {FIGURES}, n_best bigint, count_sum bigint, "
            "rest array<struct<pair: bigint, n: bigint>>",
        ),
        "documents",
    )
    rare = figures.filter(F.col("step") < least)
    links = documents.select(ROW, F.explode("rest").alias("r"))
    links = links.select(ROW, "r.pair", F.col("r.n").alias("times"))
    sums = links.join(rare, "pair").groupBy(ROW).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("rare_best"),
        F.sum(F.col("n") * F.col("times")).alias("rare_sum"),
    )
    zero = F.lit(0)
    return join_lookup(documents.drop("rest"), sums, [ROW], "left").select(
        "doc_id",
        *names,
        (F.col("n_best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("rare_sum", zero)).alias("count_sum"),
    )


def token_groups(
    docs: DataFrame,
    byte_path: str,
    piece_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Rows ``doc_id``, ``groups``: the ids of both tokenizers in each group.

    Texts without tokens (see ``align_tokens``) have no groups.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = process_aligner(byte_path, piece_path)
        out = pa.list_(pa.struct([("a", pa.list_(pa.int64())), ("b", pa.list_(pa.int64()))]))
        for batch in batches:
            found = [as_lists(aligner.text(text.as_py())) for text in batch.column(1)]
            columns = [batch.column(0), pa.array(found, out)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "groups"])

    schema = f"doc_id {kind}, groups array<struct<a: array<bigint>, b: array<bigint>>>"
    return rows.mapInArrow(run, schema)


def as_lists(found: list[tuple] | None) -> list[dict[str, list[int]]]:
    groups = chain.from_iterable(x[3].split(";") for x in found or [])
    sides = (group.split("|") for group in groups)
    return [
        {"a": list(map(int, a.split(","))), "b": list(map(int, b.split(",")))} for a, b in sides
    ]
