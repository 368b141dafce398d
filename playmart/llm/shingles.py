"""Word shingles of whole Arrow batches as 64-bit hashes, without a Python loop over words.

Words are runs of Unicode letters, marks and numbers; a character of a script that is written without spaces is a word of
its own. A-Z count as a-z; other letters are taken as they are, so callers lower-case first.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
#: Bytes that may belong to a word: ASCII letters and digits, and bytes beyond ASCII; A-Z count as a-z.
_WORD = np.zeros(256, "u1")
for _c in (*range(48, 58), *range(97, 123), *range(128, 256)):
    _WORD[_c] = _c
_WORD[65:91] = np.arange(97, 123)
#: Ranges of scripts written without spaces: South-East Asian ones, kana, ideographs.
UNSPACED = ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))
_kinds: list[np.ndarray] = []
_powers = {"up": np.ones(1, _U), "down": np.ones(1, _U)}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(which: str, n: int) -> np.ndarray:
    have = _powers[which]
    if len(have) < n:
        base = _U(BASE if which == "up" else BASE_INVERSE)
        out = np.full(max(n, 1 << 16), base, _U)
        out[0] = 1
        have = _powers[which] = np.multiply.accumulate(out)
    return have[:n]


def text_buffer(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string array and its n + 1 offsets into them; nulls are empty."""
    if array.null_count:
        array = array.fill_null("")
    array = array.cast(pa.large_string())
    _, offsets, data = array.buffers()
    bounds = np.frombuffer(offsets, "i8")[array.offset : array.offset + len(array) + 1]
    return np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1"), bounds


def slices(bounds: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about `limit` bytes, one text at least."""
    start, n = 0, len(bounds) - 1
    while start < n:
        stop = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
        yield start, min(stop, n)
        start = stop


def code_kinds() -> np.ndarray:
    """Of every code point: 0 between words, 1 part of a word, 2 a word of its own."""
    if not _kinds:
        kinds = np.zeros(0x110000, "u1")
        kinds[:0x32400] = [unicodedata.category(chr(c))[0] in "LMN" for c in range(0x32400)]
        for low, high in UNSPACED:
            kinds[low : high + 1] *= 2
        _kinds.append(kinds)
    return _kinds[0]


def _beyond_ascii(raw: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Clears the bytes of characters between words from `b`; first and last bytes of the words of one character."""
    lead = np.flatnonzero(raw >= 0xC2)
    if not lead.size:
        return lead, lead
    first = raw[lead].astype("i4")
    n = 2 + (first >= 0xE0) + (first >= 0xF0)
    code = first & (0xFF >> (n + 1))
    for k in range(1, 4):
        more = n > k
        code[more] = code[more] << 6 | raw[lead[more] + k] & 0x3F
    kind = code_kinds()[code]
    for k in range(4):
        b[lead[(kind == 0) & (n > k)] + k] = 0
    own = kind == 2
    return lead[own], lead[own] + n[own] - 1


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words of the texts data[bounds[i]:bounds[i + 1]], their texts, and their first bytes."""
    low = int(bounds[0])
    raw = data[low : int(bounds[-1])]
    b = _WORD[raw]
    alone, till = _beyond_ascii(raw, b)
    cuts = bounds - low
    inside = b > 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    first = cuts[:-1][cuts[:-1] < len(b)]
    begins[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = cuts[1:] - 1
    last = last[last >= 0]
    ends[last] = inside[last]
    begins[alone] = ends[till] = True
    after, before = till[till + 1 < len(b)] + 1, alone[alone > 0] - 1
    begins[after] = inside[after]
    ends[before] = inside[before]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    total = np.zeros(len(b) + 1, _U)
    np.cumsum(b.astype(_U) * _power("up", len(b)), out=total[1:])
    hashes = mix((total[stop] - total[start]) * _power("down", len(b) + 1)[start] + (stop - start).astype(_U))
    return hashes, np.searchsorted(cuts, start, "right") - 1, start


def shingle_hashes(data: np.ndarray, bounds: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `words` words, in order, and each text's n + 1 bounds into them.

    A text with fewer words, but some, has one shingle of all of them.
    """
    n = len(bounds) - 1
    hashes, owner, _ = word_hashes(data, bounds)
    count = np.bincount(owner, minlength=n)
    first = np.concatenate(([0], np.cumsum(count)))
    made = np.where(count >= words, count - words + 1, (count > 0).astype(count.dtype))
    out_bounds = np.concatenate(([0], np.cumsum(made)))
    doc = np.repeat(np.arange(n), made)
    at = first[doc] + np.arange(len(doc)) - out_bounds[doc]
    padded = np.concatenate((hashes, np.zeros(words, _U)))
    sums = np.zeros(len(doc), _U)
    for k in range(words):
        part = padded[at + k]
        if k:
            part = np.where(k < count[doc], part, _U(0))
        sums = mix(sums * _U(0xD6E8FEB86659FD93) + part)
    return sums, out_bounds
