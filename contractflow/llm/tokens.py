"""Token hashes of a whole Arrow batch at once, from the bytes of its texts."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .base import LOWER

_R = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_R_INVERSE = pow(_R, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Bytes that end a token. ``BLANKS``: blank and \x09 to \x0D. ``SYMBOLS``: all ASCII but letters and digits.
BLANKS = np.zeros(256, bool)
BLANKS[[32, *range(9, 14)]] = True
SYMBOLS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_LOWER = np.frombuffer(LOWER, np.uint8).astype(np.uint64) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Tokens:
    """``hashes``, and where tokens start and end in ``data``; the tokens of text ``i`` are ``first[i]`` to ``first[i+1]``."""

    data: np.ndarray
    hashes: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray


def tokenize(column: pa.Array, breaks: np.ndarray = BLANKS) -> Tokens:
    """Tokens of an Arrow string column with A-Z taken as a-z; a null text has none.

    A token's hash is the polynomial of its bytes, taken from running sums, so the cost is a few passes over the bytes.
    """
    column = pa.concat_arrays([column.fill_null("").cast(pa.large_binary())])
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets, n = offsets - offsets[0], offsets[-1] - offsets[0]
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~breaks[data]
    text_start = np.zeros(n + 1, bool)
    text_start[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | text_start))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | text_start))
    if len(_powers[0]) < n + 1:
        size = max(n + 1, 1 << 20)
        for k, r in enumerate((_R, _R_INVERSE)):
            power = np.full(size, r, np.uint64)
            power[0] = 1
            _powers[k] = np.multiply.accumulate(power)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_LOWER[data] * _powers[0][:n], out=sums[1:])
    hashes = mix((sums[end] - sums[start]) * _powers[1][start] + (end - start).astype(np.uint64))
    return Tokens(data, hashes, start, end, np.searchsorted(start, offsets))
