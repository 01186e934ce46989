"""Word splitting and small helpers shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Collection

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

#: white space that separates words: space and U+0009 to U+000D
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def plain_words(text: Column) -> Column:
    """Array of maximal runs without white space; null text has none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def words_key(text: Column) -> Column:
    """128-bit key (hex) of the word sequence; null when there is no word."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed != "", F.md5(F.regexp_replace(trimmed, SPACE_RUN, " ")))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once: a lambda variable is not
    inlined by the optimizer, a projected column used in a lambda can be."""
    return F.element_at(F.transform(F.array(value), body), 1)


def drawn(h: Column, n: int, limit: int) -> Column:
    """About ``limit`` of ``n`` rows by their 64-bit hash ``h``; every row, if
    there are no more than that."""
    if n <= limit:
        return F.lit(True)
    return F.shiftrightunsigned(h, 1) < F.lit((limit << 63) // n)


#: what this Python worker keeps from one task to the next, by its user
_kept: dict[str, tuple[str, object]] = {}


def keep(user: str, name: str, build: Callable[[], object]) -> object:
    """``build()`` of ``user``, kept by the worker for the tasks that follow
    under the same ``name``; what other users had kept goes, and so does what
    building it took for a while."""
    if _kept.get(user, (None,))[0] != name:
        forget()
        _kept[user] = name, build()
        _trim(0)
    return _kept[user][1]


_trim = getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)  # glibc has it


def forget() -> None:
    """Another operator's tasks begin: nothing of earlier ones stays in memory,
    and what they have freed goes back to the system, as Spark uses a Python
    worker again for later stages."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    _trim(0)


def split_words(text: str | None) -> list[str]:
    """Python twin of :func:`plain_words` (ASCII white space only)."""
    if not text:
        return []
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()  # str.split also cuts at U+001C..U+001F and beyond ASCII
    return [w for w in text.translate(_TO_SPACE).split(" ") if w]


_TO_SPACE = {ord(c): " " for c in "\t\n\x0b\x0c\r"}


class WordHash(dict):
    """word -> 64-bit hash, remembered up to ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    @staticmethod
    def fresh(words: Collection[str | bytes]) -> np.ndarray:
        """Hashes of words (text or its UTF-8) without looking them up: for
        distinct words of a large vocabulary the lookup costs more."""
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))

    def array(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer (xor-shift and multiply) on uint64."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))
