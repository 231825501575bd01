"""Token ids in a bit-plane-shuffled file format.

Layout: a Parquet folder of chunks, each row some whole consecutive documents.
The ids of a chunk are cut into blocks of a fixed number of ids (the last one
filled up with zeros); the bytes of a block's little-endian 32-bit ids are
transposed into four byte planes, or 32 bit planes, and each plane becomes a
zstandard frame. The row's index holds the size of every frame, the ids and
lengths of its documents and where it starts within its part; parts are
numbered in the order of the documents' ids.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.session import new_location

END = 0  # id appended to every document
BLOCK = 1 << 14  # ids of a block
CHUNK = 1 << 17  # ids after which a chunk is closed
CACHED_WORDS = 200_000  # of each of two generations; about 60 MiB for each worker process
LONGEST = 64  # characters of words that are remembered
# Latin letters, and ASCII marks but the apostrophe: contractions follow a rule of their own.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
MARKS = r"!-&(-/:-@\[-`{-~"


class Recent(dict):
    """Answers of a function of one text, asked once for each of the last texts.

    When a generation is full it becomes the old one, in which texts are looked
    up before the function is asked; what was in the old one by then goes. Long
    texts are not remembered.
    """

    def __init__(self, answer: Callable[[str], object], most: int, old: dict | None = None) -> None:
        self.answer, self.most, self.old = answer, most, old or {}

    def __missing__(self, text: str) -> object:
        found = self.old.get(text)
        if found is None:
            found = self.answer(text)
        if len(text) <= LONGEST:
            self[text] = found
        return found

    def turned(self) -> Recent:
        """The cache to go on with."""
        if len(self) < self.most:
            return self
        return Recent(self.answer, self.most, dict(self))


def plain_letters(word: str) -> bool:
    """Whether these are letters only, and such as any Unicode version knows."""
    return word.isalpha() and max(word) < "\u0250"


class WordEncoder:
    """Ids of texts, word by word from a cache of what the tokenizer said.

    The byte-level pre-tokenizer always cuts before a space that a character
    other than white space follows, and between such a character and the white
    space after it. Encoding what lies between these cuts one by one therefore
    gives the ids of the whole text. Behind the one space at its start a word
    falls into runs of letters, of digits and of marks; each run is one piece,
    which the tokenizer's model takes without another pass of the pre-tokenizer.
    With ``plain`` the strings of special tokens are ordinary text.
    """

    def __init__(self, path: str, plain: bool = False, most: int = CACHED_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.tokenize = self.tokenizer.model.tokenize
        special = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if plain else [token.content for token in special]
        # Words behind a space; one that starts with a newline stands for itself.
        self.known = Recent(self.word, most)
        self.inner = Recent(self.piece, most // 10)  # runs inside of words
        self.cut = re.compile(r" (?=\S)")
        # Runs as the pre-tokenizer cuts them.
        self.run = re.compile(f"[{LETTERS}]+|[0-9]+|[{MARKS}]+")
        self.runs = re.compile(f"[{LETTERS}0-9{MARKS}]+")
        # White space but the space and the newline.
        self.odd = [c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"]
        # The byte-level alphabet: printable bytes stand for themselves.
        shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
        hidden = [byte for byte in range(256) if byte not in shown]
        self.alphabet = {byte: 0x100 + spot for spot, byte in enumerate(hidden)}
        self.space = chr(self.alphabet[0x20])
        self.newline = self.bare("\n")

    def bare(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of one text."""
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def piece_ids(self, text: str) -> list[int]:
        """Ids of a text that the pre-tokenizer leaves whole."""
        if text.isascii():
            shown = text.replace(" ", self.space)
        else:
            shown = text.encode().decode("latin-1").translate(self.alphabet)
        return [t.id for t in self.tokenize(shown)]

    def piece(self, text: str) -> bytes:
        return array("I", self.piece_ids(text)).tobytes()

    def word(self, word: str) -> bytes:
        if plain_letters(word):
            return self.piece(" " + word)
        if word[-1:] in (",", ".") and plain_letters(word[:-1]):
            return self.known[word[:-1]] + self.inner[word[-1]]
        start = word[:1] == "\n"  # one byte, and no space
        if not self.runs.fullmatch(word, start):
            return self.bare(word if start else " " + word)
        runs = self.run.findall(word, start)
        if start:
            return self.newline + b"".join(map(self.inner.__getitem__, runs))
        first, *rest = runs
        ids = self.known[first] if rest else self.piece(" " + first)
        return ids + b"".join(map(self.inner.__getitem__, rest))

    def rest(self) -> None:
        """Keep one generation only, while the process waits for its next task."""
        self.known.old, self.inner.old = {}, {}

    def encode(self, text: str) -> bytes:
        self.known, self.inner = self.known.turned(), self.inner.turned()
        if any(token in text for token in self.special):
            return self.bare(text)
        if any(two in text for two in ("  ", " \n", "\n ", "\n\n", *self.odd)):
            parts = self.cut.split(text)
        else:
            parts = text.replace("\n", " \n").split(" ")
        first = self.bare(parts[0]) if parts[0] else b""
        return first + b"".join(map(self.known.__getitem__, islice(parts, 1, None)))


def per_process(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, once for each Python worker process and key.

    This package travels inside the tasks, so its own globals are new in each;
    a module of the process holds what its tasks share.
    """
    shared = sys.modules.setdefault("_stockflow_process", types.ModuleType("_stockflow_process"))
    if key not in shared.__dict__:
        shared.__dict__[key] = make()
    return shared.__dict__[key]


def process_encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker process, whose tasks share its cache."""
    return per_process(("words", path), lambda: WordEncoder(path))


def planes(block: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes, or bit planes, of one block of ids."""
    columns = block.astype("<u4").view(np.uint8).reshape(-1, 4).T
    if not bits:
        return [np.ascontiguousarray(c).tobytes() for c in columns]
    return [np.packbits((c >> bit) & 1).tobytes() for c in columns for bit in range(8)]


def from_planes(parts: list[bytes], size: int) -> np.ndarray:
    """The ids of a block from its planes."""
    out = np.zeros((size, 4), np.uint8)
    if len(parts) == 4:
        for byte, plane in enumerate(parts):
            out[:, byte] = np.frombuffer(plane, np.uint8)
    else:
        for spot, plane in enumerate(parts):
            values = np.unpackbits(np.frombuffer(plane, np.uint8), count=size)
            out[:, spot // 8] |= values << (spot % 8)
    return out.view("<u4").ravel()


def shuffled(ids: np.ndarray, block: int, bits: bool, level: int) -> tuple[bytes, list[int]]:
    """Compressed planes of all blocks, one after the other, and their sizes."""
    press = zstandard.ZstdCompressor(level=level)
    filled = np.zeros(-(-len(ids) // block) * block, np.uint32)
    filled[: len(ids)] = ids
    frames = [
        press.compress(plane)
        for start in range(0, len(filled), block)
        for plane in planes(filled[start : start + block], bits)
    ]
    return b"".join(frames), [len(f) for f in frames]


def unshuffled(blob: bytes, sizes: list[int], n: int, block: int, bits: bool) -> np.ndarray:
    press = zstandard.ZstdDecompressor()
    edges = np.concatenate([[0], np.cumsum(sizes)])
    frames = [press.decompress(blob[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
    each = 32 if bits else 4
    blocks = [
        from_planes(frames[at : at + each], block) for at in range(0, len(frames), each)
    ]
    return np.concatenate([*blocks, np.zeros(0, "<u4")])[:n]


def written_chunks(path: str, block: int, chunk: int, bits: bool, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = process_encoder(path)
        part = TaskContext.get().partitionId()
        start = number = held = 0
        docs: list = []
        ids: list[bytes] = []

        def row(kind: pa.DataType) -> pa.RecordBatch:
            values = np.frombuffer(b"".join(ids), "<u4")
            blob, sizes = shuffled(values, block, bits, level)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([number], pa.int64()),
                    pa.array([start], pa.int64()),
                    pa.array([len(values)], pa.int64()),
                    pa.array([docs], pa.list_(kind)),
                    pa.array([[len(i) // 4 for i in ids]], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([blob], pa.binary()),
                ],
                ["part", "chunk", "start", "n", "doc_ids", "lengths", "index", "planes"],
            )

        kind = pa.null()
        for batch in batches:
            kind = batch.schema.field(0).type
            names = batch.column(0).to_pylist()
            for name, text in zip(names, batch.column(1), strict=True):
                docs.append(name)
                ids.append(encoder.encode(text.as_py() or "") + END.to_bytes(4, "little"))
                held += len(ids[-1]) // 4
                if held >= chunk:
                    yield row(kind)
                    start, number, held = start + held, number + 1, 0
                    docs.clear()
                    ids.clear()
        if docs:
            yield row(kind)
        encoder.rest()

    return run


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
    chunk: int = CHUNK,
    bits: bool = False,
    level: int = 3,
) -> str:
    """Encode every row's text and write the ids under ``path``, ascending by id.

    Each document ends with id 0; a null or empty text is that id alone. Null
    ids come first; rows with equal ids follow each other by text. An empty
    table makes a folder without chunks. Other columns are not read. Strings of
    special tokens get the ids that the tokenizer gives them.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("t")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.repartitionByRange("doc_id", F.xxhash64("t")).sortWithinPartitions("doc_id", "t")
    chunks = rows.mapInArrow(
        written_chunks(tokenizer_path, block, chunk, bits, level),
        f"part int, chunk bigint, start bigint, n bigint, doc_ids array<{kind}>, "
        "lengths array<bigint>, index array<int>, planes binary",
    )
    # The planes are compressed already.
    chunks.write.option("compression", "none").parquet(path)
    return path


def read_ids(batches: Iterator[pa.RecordBatch], block: int, bits: bool):
    """Each chunk's row number within its batch, its documents' lengths and ids."""
    for batch in batches:
        column = {name: batch.column(name).to_pylist() for name in batch.schema.names}
        for at in range(batch.num_rows):
            ids = unshuffled(
                column["planes"][at], column["index"][at], column["n"][at], block, bits
            )
            yield batch, at, np.array(column["lengths"][at], np.int64), ids


def digests(block: int, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at, lengths, ids in read_ids(batches, block, bits):
            ends = np.cumsum(lengths)
            raw = ids.astype("<u4").tobytes()
            crc = [
                zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends, lengths, strict=True)
            ]
            start = batch.column("start")[at].as_py()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_ids")[at].values,
                    pa.array(np.full(len(ends), batch.column("part")[at].as_py(), np.int32)),
                    pa.array(start + ends - lengths),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "part", "start", "n_tokens", "ids_crc32"],
            )

    return run


def texts_ids(block: int, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, at, lengths, ids in read_ids(batches, block, bits):
            pieces = np.split(ids.astype(np.int64), np.cumsum(lengths)[:-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[at].values, pa.array(pieces, pa.list_(pa.int64()))],
                ["doc_id", "ids"],
            )

    return run


def _chunks(spark, path: str) -> tuple[DataFrame, str]:
    chunks = spark.read.parquet(path)
    return chunks, chunks.schema["doc_ids"].dataType.elementType.simpleString()


def read_tokens(spark, path: str, *, block: int = BLOCK, bits: bool = False) -> DataFrame:
    """Rows (``doc_id``, ``ids``) of a written folder."""
    chunks, kind = _chunks(spark, path)
    return chunks.mapInArrow(texts_ids(block, bits), f"doc_id {kind}, ids array<bigint>")


def token_digests(spark, path: str, *, block: int = BLOCK, bits: bool = False) -> DataFrame:
    """One row per document of a written folder: ``doc_id``, ``start`` (ids of
    all documents before it), ``n_tokens`` and ``ids_crc32``."""
    chunks, kind = _chunks(spark, path)
    # One number per part reaches the driver.
    totals = chunks.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before, bases = 0, []
    for row in totals:
        bases.append((row["part"], before))
        before += row["n"]
    bases = spark.createDataFrame(bases, "part int, base bigint")
    rows = chunks.mapInArrow(
        digests(block, bits),
        f"doc_id {kind}, part int, start bigint, n_tokens bigint, ids_crc32 bigint",
    )
    return rows.join(F.broadcast(bases), "part").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def tokenize_documents(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the ids of ``docs`` to the shared folder and digest what is read back."""
    path = new_location(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, **options)
    return token_digests(docs.sparkSession, path)
