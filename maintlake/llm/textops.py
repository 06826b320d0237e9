"""Whole batches of texts as numpy arrays: words, their codes, and codes of runs of words.

A word is ``[^\\x20\\x09-\\x0D]+``, found on UTF-8 bytes, where those separators never occur inside another
character.

:class:`Rolling` codes are cheap but linear: certain different stretches of a thousand characters share them whatever the
multiplier. They only propose candidates. What is merged, removed or linked is told by ``hashes`` or ``digests``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Odd multipliers; any odd numbers would do.
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(maxsize=4)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    def table(b: int) -> np.ndarray:
        out = np.full(size, b, U)
        out[0] = 1
        return np.cumprod(out, dtype=U)

    return table(base), table(pow(base, -1, 1 << 64))


class Rolling:
    """Codes of any stretches of ``values`` from one running sum: equal content gives equal codes at any place."""

    def __init__(self, values: np.ndarray, seed: int = 0) -> None:
        size = 1 << max(12, int(values.size).bit_length())
        up, self.down = _powers(_BASES[seed], size)
        self.total = np.zeros(values.size + 1, U)
        np.cumsum((values.astype(U) + U(1)) * up[: values.size], dtype=U, out=self.total[1:])

    def codes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        code = (self.total[ends] - self.total[starts]) * self.down[starts]
        return mix(code + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))


def span_codes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return Rolling(values, seed).codes(starts, ends)


#: Stretches of more bytes than this are hashed one by one.
_LANED = 512


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit cryptographic digests of stretches of bytes, as two numbers a row."""
    raw = memoryview(np.ascontiguousarray(data))
    found = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist()))
    return np.frombuffer(found, U).reshape(-1, 2)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit codes of stretches of bytes: eight bytes a step, mixed before the next ones come in."""
    sizes = ends - starts
    padded = np.append(data, np.zeros(8, np.uint8))
    lanes = np.ndarray((data.size + 1,), np.dtype("<u8"), padded.data, strides=(1,))
    code = mix(sizes.astype(U) + U(_BASES[seed]))
    left = np.flatnonzero((sizes > 0) & (sizes <= _LANED))
    step = 0
    while left.size:
        rest = np.minimum(sizes[left] - step, 8)
        value = lanes[starts[left] + step] & (~U(0) >> ((8 - rest) * 8).astype(U))
        code[left] = mix(code[left] * U(_BASES[1 - seed]) + value)
        step += 8
        left = left[sizes[left] > step]
    long = np.flatnonzero(sizes > _LANED)
    if long.size:
        code[long] = digests(data, starts[long], ends[long])[:, seed]
    return code


def run_codes(codes: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """Codes of every ``length`` consecutive items, by place of the first."""
    n = codes.size - length + 1
    if n <= 0:
        return np.zeros(0, U)
    out = np.zeros(n, U)
    factor = 1
    for j in range(length):
        factor = factor * _BASES[seed] % (1 << 64)
        out += codes[j : j + n] * U(factor | 1)
    return mix(out)


@dataclass
class Words:
    """Words of consecutive texts: those of text t are ``first[t]`` up to ``first[t + 1]``."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(self.first.size - 1), self.counts)

    def codes(self, seed: int = 0) -> np.ndarray:
        return span_codes(self.data, self.starts, self.ends, seed)

    def hashes(self, seed: int = 0) -> np.ndarray:
        return hashes(self.data, self.starts, self.ends, seed)

    def joined(self, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words joined by one space each, as bytes, with each word's start and end in them (of kept words only)."""
        starts, ends = (self.starts, self.ends) if keep is None else (self.starts[keep], self.ends[keep])
        lengths = ends - starts + 1
        stops = np.cumsum(lengths)
        at = np.repeat(starts - (stops - lengths), lengths) + np.arange(int(stops[-1]) if stops.size else 0)
        out = np.append(self.data, np.uint8(32))[at]
        out[stops - 1] = 32
        return out, stops - lengths, stops - 1


def find_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    inside = ~_SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < data.size)]
    opens[cuts] = inside[cuts]
    closes[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(opens)
    return Words(data, offsets, starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, offsets))


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, nothing else changed."""
    return data + (((data >= 65) & (data <= 90)) * np.uint8(32))


def text_blocks(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Whole texts in blocks of about ``limit`` bytes (a longer text is a block of its own): first and last index,
    bytes, and offsets of the texts in them. Null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(texts))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last
