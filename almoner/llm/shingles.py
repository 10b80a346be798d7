"""Word shingles as 64-bit hashes, for code that runs in Python workers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import xxhash

from almoner.llm.chunks import give_back, held

#: Words whose hashes are kept, and how long these may be.
WORDS, LONG_WORD = 100_000, 64
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG_WORD:
            if len(self) >= WORDS:
                self.clear()
            self[word] = found
        return found


_hashes = _Hashes()


def forget() -> None:
    _hashes.clear()


def forgetting(run: Callable[[Iterable], Iterator]) -> Callable[[Iterable], Iterator]:
    """A task that leaves no hashes behind: the worker's next one may be another stage's."""

    def task(batches):
        held("shingles", dict)
        try:
            yield from run(batches)
        finally:
            forget()
            give_back()

    return task


def _scattered(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of ``text``.

    A-Z count as a-z; words end at ASCII white space. With fewer than ``k`` words
    the whole sequence is the one shingle; without words there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    ids = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    short = len(words) < k
    k = min(k, len(words))
    n = len(words) - k + 1
    out = np.full(n, len(words) if short else 0, np.uint64)
    for i in range(k):
        out = _scattered(out + ids[i : i + n] * _MIX[i % len(_MIX)])
    return np.unique(out)
