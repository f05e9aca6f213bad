"""Words of byte texts as 64-bit codes, and hashes of word n-grams."""

from __future__ import annotations

import numpy as np
import xxhash

# Letters, digits and bytes of non-ASCII characters stay; A-Z are lower-cased.
_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in bytes(range(256)).lower())

LONG_WORD = 256           # bytes; longer words have one library hash
CHUNK = 1 << 16           # bytes whose words are hashed together
_ODD = 0x9E3779B97F4A7C15


def folded(text: bytes) -> bytes:
    """``text`` with spaces for ASCII characters that are no letter or digit,
    A-Z lower-cased."""
    return text.translate(_FOLD)


def _powers(base: int) -> np.ndarray:
    out = np.full(CHUNK + LONG_WORD, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _INVERSE = _powers(_ODD), _powers(pow(_ODD, -1, 1 << 64))
_BYTE = np.array([xxhash.xxh64_intdigest(bytes([i])) for i in range(256)], np.uint64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _coded(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(codes, first bytes) of the words."""
    data = np.frombuffer(text, np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[data], prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    codes = np.empty(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + CHUNK, CHUNK))
    for i, j in zip(cuts[:-1], cuts[1:], strict=True):
        if i == j:
            continue
        first = starts[i]
        at = starts[i:j] - first
        to = at + np.minimum(ends[i:j] - starts[i:j], LONG_WORD)
        span = data[first:first + to[-1]]
        sums = np.zeros(len(span) + 1, np.uint64)
        np.cumsum(_BYTE[span] * _POWER[:len(span)], out=sums[1:])
        codes[i:j] = (sums[to] - sums[at]) * _INVERSE[at]
    for i in np.flatnonzero(ends - starts > LONG_WORD):
        codes[i] = xxhash.xxh64_intdigest(text[starts[i]:ends[i]])
    codes ^= codes >> np.uint64(32)
    codes *= np.uint64(_ODD)
    return codes ^ (codes >> np.uint64(29)) | np.uint64(1), starts


def word_codes(text: bytes) -> np.ndarray:
    """A 64-bit code, never 0, for each word between ASCII white space."""
    return _coded(text)[0]


def joined_codes(texts: list[bytes], gap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, places, sizes): the codes of many texts in one array with
    ``gap`` zeros before each and at the end; where each text begins, and its
    number of words."""
    codes, starts = _coded(b"\n".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    first = np.searchsorted(starts, np.concatenate([[0], ends]))
    sizes = np.diff(first)
    places = first[:-1] + gap * np.arange(1, len(texts) + 1)
    out = np.zeros(len(codes) + gap * (len(texts) + 1), np.uint64)
    out[np.arange(len(codes)) + np.repeat(places - first[:-1], sizes)] = codes
    return out, places, sizes


def text_groups(column, limit: int = 1 << 20):
    """(first row, texts) of a column of binary texts, in groups of about
    ``limit`` bytes; a longer text is a group of its own."""
    group, held, first = [], 0, 0
    for i, t in enumerate(column):
        t = t.as_py()
        if group and held + len(t) > limit:
            yield first, group
            group, held, first = [], 0, i
        group.append(t)
        held += len(t)
    if group:
        yield first, group


def shaped_grams(codes: np.ndarray, shape: tuple[int, ...]) -> np.ndarray:
    """For each place a hash of the words that stand ``shape`` words after it,
    as far as the last of them exists."""
    places = max(0, len(codes) - shape[-1])
    h = np.full(places, sum(s << 6 * i for i, s in enumerate(shape)) % 2 ** 64, np.uint64)
    for i in shape:
        h = (h ^ codes[i:i + places]) * np.uint64(_ODD)
        h ^= h >> np.uint64(31)
    return h


def grams(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words."""
    return shaped_grams(codes, tuple(range(size)))
