"""Vectorised word splitting and hashing of text columns inside tasks.

Words are runs of bytes of a class. Both classes used here end at ASCII bytes
only, and every byte of a non-ASCII character is at least 0x80, so splitting
UTF-8 bytes gives the same words as splitting code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Word bytes: everything but ASCII white space.
NOT_SPACE = "not_space"
# Word bytes: digits, letters and everything beyond ASCII.
ALPHANUMERIC = "alphanumeric"

_ODD = 0x9E3779B97F4A7C15
_SEED = 0xD1B54A32D192ED03
_CHUNK = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scramble of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_bytes(rule: str) -> np.ndarray:
    """For each byte value, whether it belongs to a word."""
    inside = np.zeros(256, bool)
    inside[0x80:] = True
    if rule == ALPHANUMERIC:
        for low, high in (("0", "9"), ("A", "Z"), ("a", "z")):
            inside[ord(low) : ord(high) + 1] = True
    else:
        inside[:0x80] = True
        inside[[0x20, *range(0x09, 0x0E)]] = False
    return inside


class Words:
    """Words of consecutive rows: their hashes, and where each row's words end."""

    def __init__(
        self,
        first: int,
        hashes: np.ndarray,
        ends: np.ndarray,
        at: np.ndarray,
        starts_with: dict[int, np.ndarray] | None = None,
        kinds: np.ndarray | None = None,
    ) -> None:
        self.first = first  # number of the first row in the array
        # For some lengths in bytes the hash of a longer word's beginning, else 0.
        self.starts_with = starts_with or {}
        # Bytes of each row: all, ASCII signs, digits, capitals.
        self.kinds = kinds
        self.hashes = hashes
        self.ends = ends  # words of the rows so far, one entry for each row
        self.at = at  # byte spans of the words within the array's data

    @property
    def rows(self) -> int:
        return len(self.ends)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.ends, prepend=0))


class Splitter:
    """Splits text arrays into words; one object per task."""

    def __init__(
        self,
        rule: str,
        lower: bool = True,
        beginnings: tuple[int, ...] = (),
        count_kinds: bool = False,
    ) -> None:
        self.count_kinds = count_kinds
        self.inside = word_bytes(rule)
        self.beginnings = beginnings
        code = np.arange(256)
        if lower:
            code[ord("A") : ord("Z") + 1] += 32
        self.value = mix((code.astype(np.uint64) + np.uint64(1)) * np.uint64(_SEED))
        self.power = np.ones(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            with np.errstate(over="ignore"):
                base = np.full(n, _ODD, np.uint64)
                base[0] = 1
                self.power = np.cumprod(base)
                base[1:] = pow(_ODD, -1, 1 << 64)
                self.inverse = np.cumprod(base)

    def split(self, texts: pa.Array) -> Iterator[Words]:
        """Words of the rows of ``texts``, about a quarter megabyte at a time.

        Nulls count as empty. A row longer than that comes whole, alone.
        """
        texts = texts.cast(pa.large_binary())
        if texts.null_count:
            texts = texts.fill_null(b"")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        low = 0
        while low < len(texts):
            high = int(np.searchsorted(offsets, offsets[low] + _CHUNK, "right")) - 1
            high = min(max(high, low + 1), len(texts))
            yield self._chunk(low, data, offsets[low : high + 1])
            low = high

    def _chunk(self, first: int, data: np.ndarray, offsets: np.ndarray) -> Words:
        data = data[offsets[0] : offsets[-1]]
        cuts = offsets - offsets[0]
        n = len(data)
        if not n:
            none = np.zeros(0, np.int64)
            no_hashes = none.astype(np.uint64)
            short = dict.fromkeys(self.beginnings, no_hashes)
            kinds = np.zeros((4, len(cuts) - 1), np.int64)
            return Words(first, no_hashes, np.zeros(len(cuts) - 1, np.int64), none, short, kinds)
        self._powers(max(n, _CHUNK))
        inside = self.inside[data]
        border = np.zeros(n + 1, bool)
        border[cuts] = True
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        starts = np.flatnonzero(inside & (~before | border[:n]))
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        ends = np.flatnonzero(inside & (~after | border[1:])) + 1
        with np.errstate(over="ignore"):
            terms = self.value[data]
            terms *= self.power[:n]
            own = terms[starts]
            np.cumsum(terms, out=terms)
            hashes = (terms[ends - 1] - terms[starts] + own) * self.inverse[starts]
            hashes = mix(hashes + (ends - starts).astype(np.uint64))
            starts_with = {}
            for size in self.beginnings:
                last = np.minimum(starts + size, ends) - 1
                part = (terms[last] - terms[starts] + own) * self.inverse[starts]
                part = mix(part ^ np.uint64(size << 56))
                starts_with[size] = np.where(ends - starts > size, part, np.uint64(0))
        spans = np.stack([starts, ends], 1) + offsets[0]
        kinds = None
        if self.count_kinds:
            digit = (data >= ord("0")) & (data <= ord("9"))
            capital = (data >= ord("A")) & (data <= ord("Z"))
            small = (data >= ord("a")) & (data <= ord("z"))
            sign = (data > 0x20) & (data < 0x7F) & ~(digit | capital | small)
            sums = [np.concatenate([[0], np.cumsum(x)])[cuts] for x in (sign, digit, capital)]
            kinds = np.stack([np.diff(x) for x in (cuts, *sums)])
        ends_at = np.searchsorted(starts, cuts[1:])
        return Words(first, hashes, ends_at, spans, starts_with, kinds)


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        total = hashes[:n].copy()
        for step in range(1, k):
            total *= np.uint64(_ODD)
            total += hashes[step : step + n]
        return mix(total)


def inside_row(ends: np.ndarray, words: int, k: int) -> np.ndarray:
    """Which runs of ``k`` words lie within one row."""
    n = words - k + 1
    if n <= 0:
        return np.zeros(0, bool)
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    return row[:n] == row[k - 1 :]
