"""Sets of word shingles as sorted 64-bit hashes, and their fast similarity sketches, in numpy over whole batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Coordinates of a sketch, coordinates per band.
COORDINATES, ROWS = 128, 4
BANDS = COORDINATES // ROWS
#: Bytes of text that one pass of the arrays below handles; a longer document is a pass of its own.
PASS_BYTES = 1 << 18

_U = np.uint64
_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(0, 2**63, size=256, dtype=np.uint64) * _U(2) + _U(1)
_BYTE[np.arange(65, 91)] = _BYTE[np.arange(97, 123)]  # A-Z as a-z
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_STEP = _U(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(0, 2**63, size=64, dtype=np.uint64) * _U(2) + _U(1)
_SEED = _rng.integers(0, 2**63, size=2 * COORDINATES, dtype=np.uint64)
_FULL = _U(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers = np.empty(0, dtype=np.uint64)
_inverse = np.empty(0, dtype=np.uint64)


def _tables(n: int) -> None:
    global _powers, _inverse
    if len(_powers) < n:
        size = max(n, PASS_BYTES + 1)
        one = np.ones(1, dtype=np.uint64)
        back = _U(pow(int(_STEP), -1, 2**64))
        _powers = np.concatenate([one, np.cumprod(np.full(size - 1, _STEP))])
        _inverse = np.concatenate([one, np.cumprod(np.full(size - 1, back))])


def _texts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the offsets of each text; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    n = len(texts)
    if not n:
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _pass(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of some texts, not yet distinct, and how many each text has."""
    n = len(offsets) - 1
    if not len(raw):
        return np.empty(0, dtype=np.uint64), np.zeros(n, dtype=np.int64)
    _tables(len(raw) + 1)
    word = ~_IS_SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    after = np.concatenate([word[1:], [False]])
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    if not len(starts):
        return np.empty(0, dtype=np.uint64), np.zeros(n, dtype=np.int64)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[raw] * _powers[: len(raw)])])
    words = mix((sums[ends] - sums[starts]) * _inverse[starts] + (ends - starts).astype(np.uint64))
    first = np.searchsorted(starts, offsets)  # the first word of each text
    count = np.diff(first)
    place = np.arange(len(words)) - np.repeat(first[:-1], count)
    room = np.repeat(count, count)
    whole = place <= room - k
    at = np.flatnonzero(whole)
    out = np.zeros(len(at), dtype=np.uint64)
    for j in range(k):
        out += words[at + j] * _PLACE[j]
    out, owner = mix(out + _U(k)), np.repeat(np.arange(n), count)[at]
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        parts = np.zeros(len(short), dtype=np.uint64)
        for j in range(k - 1):
            has = count[short] > j
            parts[has] += words[first[short[has]] + j] * _PLACE[j]
        out = np.concatenate([out, mix(parts + count[short].astype(np.uint64))])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, np.bincount(owner, minlength=n)


def sets(texts: pa.Array, k: int = 5) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the first text, distinct sorted shingle hashes of each) for some texts at a time.

    Words are runs without U+0020 and U+0009 to U+000D, A-Z lower-cased. Shingles are k words; a text with fewer words
    has one, its whole sequence; without words it has none.
    """
    raw, offsets = _texts(texts)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + PASS_BYTES, side="right")) - 1)
        hashes, count = _pass(raw[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
        ends = np.cumsum(count)
        yield a, [np.unique(hashes[e - c : e]) for e, c in zip(ends, count)]
        a = b


def digest(members: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed longs."""
    with np.errstate(over="ignore"):
        a, b = mix(members + _STEP).sum(), mix(members ^ _SEED[0]).sum()
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def sketches(members: list[np.ndarray]) -> np.ndarray:
    """Fast similarity sketching of some non-empty sets, COORDINATES values each.

    In round i every element is hashed to a bin and offers the value (i, hash) there; a bin keeps the least. A set is done
    after the first round that leaves none of its bins empty. From round COORDINATES on, all elements go to one bin a
    round, so every coordinate fills. Two sets agree in a coordinate with probability their similarity, and the share of
    agreeing coordinates is concentrated as for independent ones.
    """
    n, t = len(members), COORDINATES
    out = np.full(n * t, _FULL, dtype=np.uint64)
    if not n:
        return out.reshape(n, t)
    sizes = np.array([len(m) for m in members])
    elements, owner = np.concatenate(members), np.repeat(np.arange(n, dtype=np.int64), sizes)
    for i in range(2 * t):
        h = mix(elements ^ _SEED[i])
        bins = owner * t + ((h & _U(t - 1)).astype(np.int64) if i < t else i - t)
        np.minimum.at(out, bins, (_U(i) << _U(56)) | (h >> _U(8)))
        open_ = (out.reshape(n, t) == _FULL).any(axis=1)
        if not open_.any():
            break
        keep = open_[owner]
        if not keep.all():
            elements, owner = elements[keep], owner[keep]
    return out.reshape(n, t)


def bands(sketch: np.ndarray) -> np.ndarray:
    """Bucket keys, BANDS for each sketch, as signed longs; a key holds its band's number."""
    part = sketch.reshape(len(sketch), BANDS, ROWS)
    out = np.zeros(part.shape[:2], dtype=np.uint64)
    for j in range(ROWS):
        out = mix(out ^ (part[:, :, j] * _PLACE[j]))
    return mix(out + np.arange(BANDS, dtype=np.uint64) * _STEP).view(np.int64)


def short(sketch: np.ndarray) -> np.ndarray:
    """One byte of each coordinate, enough to estimate similarity."""
    return (mix(sketch) & _U(255)).astype(np.uint8)
