"""Words of many texts at once, as numpy arrays.

A word is a maximal run of characters other than ASCII white space. Words are known
by 64-bit hashes: a polynomial over code points, taken from running sums, so that a
slice of texts costs a few array operations whatever its words are.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0, base ** 1, ... modulo 2 ** 64; kept for the next slice."""
    known = _powers.get(int(base))
    if known is None or len(known) < n:
        grown = np.full(max(n, 1 << 20), base, np.uint64)
        grown[0] = 1
        known = _powers[int(base)] = np.cumprod(grown, dtype=np.uint64)
    return known[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def windows_hash(values: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of `size` neighbours; fewer values give none."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(values) - size + 1, np.uint64)
    for k in range(size):
        out = out * _STEP + values[k : len(values) - size + 1 + k]
    return mixed(out)


@dataclass
class Words:
    """The words of some texts: where they start and end, whose they are, their hashes."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    first: np.ndarray  #: for each text, its first word; one more entry for the end


def words_of(texts: list[str], lower: bool = False) -> Words:
    """The words of `texts`; `lower` folds A-Z to a-z before hashing."""
    codes = code_points("\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    inside = ~((codes == 32) | ((codes >= 9) & (codes <= 13)))
    turns = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0))
    start, end = turns[::2], turns[1::2]
    if lower:
        codes = np.where((codes >= 65) & (codes <= 90), codes + 32, codes)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mixed(codes + np.uint64(1)) * _power(_STEP, len(codes)), out=total[1:])
    hashes = (total[end] - total[start]) * _power(_BACK, len(codes) + 1)[start]
    doc = np.searchsorted(ends, start, side="right")
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    return Words(start, end, doc, mixed(hashes + (end - start).astype(np.uint64)), first)
