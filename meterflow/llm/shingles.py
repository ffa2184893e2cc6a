"""Words and word shingles of whole texts as 64-bit hashes, worked on a few megabytes at a time."""

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)
_ORDER = np.random.default_rng(8).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_POWERS: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The base, or its inverse, to the powers 0 to n - 1, modulo 2 ** 64."""
    name = "inverse" if inverse else "base"
    if len(_POWERS.get(name, ())) < n:
        step = np.full(1 << max(16, (n - 1).bit_length()), _BASE_INVERSE if inverse else _BASE)
        step[0] = 1
        _POWERS[name] = np.multiply.accumulate(step)
    return _POWERS[name][:n]


def running_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums of a polynomial over the bytes: one longer than ``data``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data)), out=out[1:])
    return out


def span_hash(running: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end], alike wherever the bytes stand."""
    return mixed((running[ends] - running[starts]) * powers(len(running), inverse=True)[starts])


def words(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (in the joined text) of every word, and where each text's words begin (one more than texts).

    Words are runs of bytes other than space and 9 to 13; only A to Z are lower-cased.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    blank = _BLANK[data]
    edge = np.flatnonzero(np.diff(blank, prepend=True))
    starts, ends = edge[::2], edge[1::2]
    running = running_hash(_LOWER[data] if lower else data)
    text_starts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts]))).astype(np.int64)
    return span_hash(running, starts, ends), starts, ends, np.searchsorted(starts, text_starts)


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of each text; fewer words than ``size`` make one shingle of all words."""
    hashes, _, _, at = words(texts)
    n = len(hashes)
    rows = np.zeros(max(0, n - size + 1), np.uint64)
    for i in range(size):
        rows += hashes[i:i + len(rows)] * _ORDER[i]
    rows = mixed(rows + np.uint64(size))
    out = []
    for a, b in zip(at[:-1], at[1:]):
        if b - a >= size:
            out.append(np.unique(rows[a:b - size + 1]))
        elif b > a:
            out.append(mixed((hashes[a:b] * _ORDER[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
