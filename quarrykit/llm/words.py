"""Word and shingle hashes that several operators share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash

_WORD = re.compile(r"\w+")
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


#: What a worker keeps from one task to the next.
_KEPT: dict = {}


def kept(key, make: Callable):
    """What ``make`` made when this worker first asked for ``key``. A worker keeps one thing, the last."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def trim(keep=None) -> None:
    """Drop what is kept under other keys and give freed memory back to the system: a worker that is used again else holds the most that any task before took."""
    for key in [k for k in _KEPT if k != keep]:
        del _KEPT[key]
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another libc
        pass


def trimmed(run: Callable, keep=None) -> Callable:
    """A function of Arrow batches that leaves no freed memory behind it, and of what is ``kept`` at most that key."""

    def inner(batches):
        trim(keep)
        yield from run(batches)
        trim(keep)

    return inner


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every bit of 64."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def fold_words(text: str) -> list[str]:
    """Lower-case runs of letters, digits and underscores."""
    return _WORD.findall(text.lower())


def hash_words(words: list) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def grams(ids: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of all runs of ``n`` ids."""
    m = len(ids) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = (h + ids[k : k + m]) * _A + _B
            h ^= h >> np.uint64(29)
        return mix(h + _C)


def text_shingles(text: str | None, n: int) -> np.ndarray | None:
    """The distinct word n-gram hashes of a text; of a shorter text its one padded gram; None where it has no word."""
    words = fold_words(text) if text else []
    if not words:
        return None
    words += [""] * (n - len(words))
    return np.unique(grams(hash_words(words), n))
