"""Texts as chunks, each distinct one looked at once.

Byte-level splitting patterns (letters, digits or other signs with at most one blank
before them; runs of white space, of which the last character stays with what follows)
end a piece in places that can be told from the bytes around them. So a text's tokens
are those of its chunks cut there, and of several texts only distinct chunks have to be
encoded. Places that can't be told for sure are left inside a chunk.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Hashable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on together, and how long chunks may be to be remembered.
SLICE, LONG_CHUNK = 1 << 22, 64

#: Kinds of bytes; 0 is anything that may or may not be white space, or part of it.
LETTER, DIGIT, SIGN, BLANK, BREAK = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.int8)
_KIND[33:127] = SIGN
_KIND[[*range(65, 91), *range(97, 123)]] = LETTER
_KIND[48:58] = DIGIT
_KIND[32] = BLANK
_KIND[9:14] = BREAK
#: Bytes that begin characters some of which are white space.
_DOUBTFUL = np.zeros(256, bool)
_DOUBTFUL[[0xC2, 0xE1, 0xE2, 0xE3]] = True

_HELD: dict[Hashable, Any] = {}


def give_back() -> None:
    """Return the memory of what isn't used any more: the worker may idle, or serve
    another stage, beside others that need it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc alone has it
        ctypes.CDLL(None).malloc_trim(0)


def held(kind: Hashable, make: Callable[[], Any]) -> Any:
    """The tables a Python worker keeps from task to task. It keeps those of one kind
    of task; the first task of another kind gives them up."""
    if kind not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[kind] = make()
    return _HELD[kind]


def slices(texts: pa.Array, most: int = SLICE) -> Iterator[slice]:
    """Ranges of rows with at most ``most`` bytes of text, or one row."""
    begin, held = 0, 0
    for i, size in enumerate(pc.binary_length(texts).to_pylist()):
        if held and held + size > most:
            yield slice(begin, i)
            begin, held = i, 0
        held += size
    if begin < len(texts):
        yield slice(begin, len(texts))


def _starts(b: np.ndarray, signs: bool) -> np.ndarray:
    """Where a piece surely begins."""
    kind = _KIND[b]
    wide = b >= 128
    plain = (kind >= LETTER) & (kind <= SIGN)
    # whether the character that ends (begins) at a byte surely isn't white space
    ended, begun = plain.copy(), plain | (wide & ~_DOUBTFUL[b])
    ended[2:] |= wide[2:] & ~_DOUBTFUL[b[1:-1]] & ~_DOUBTFUL[b[:-2]]
    starts = np.zeros(len(b), bool)
    # white space after anything else
    starts[1:] = (kind[1:] >= BLANK) & ended[:-1]
    # what follows a single break
    starts[2:] |= begun[2:] & (kind[1:-1] == BREAK) & ended[:-2]
    if signs:
        # letters, digits and other signs side by side; what follows an apostrophe may belong to it
        starts[1:] |= plain[1:] & plain[:-1] & (kind[1:] != kind[:-1]) & (b[:-1] != 39)
    return starts


def cut(texts: pa.Array, signs: bool = True) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct chunks; per chunk of the texts its number among these; per text its end.

    Text ``i`` has the chunks from ``ends[i - 1]`` to ``ends[i]``. Without ``signs``
    chunks are cut at white space alone.
    """
    texts = texts.cast(pa.large_binary())
    places = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if places[-1] == places[0]:
        return [], np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    data = texts.buffers()[2].slice(int(places[0]), int(places[-1] - places[0]))
    places, b = places - places[0], np.frombuffer(data, np.uint8)
    starts = _starts(b, signs)
    starts[places[:-1][np.diff(places) > 0]] = True
    begins = np.flatnonzero(starts)
    offsets = np.append(begins, len(b)).astype(np.int32)
    coded = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), data]).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(begins, places[1:])


def gathered(found: list[bytes], kind: np.dtype, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of chunk after chunk, and where each chunk's begin, and the last ends."""
    lengths = np.fromiter(map(len, found), np.int64, len(found)) // kind.itemsize
    begins, values = np.cumsum(lengths) - lengths, np.frombuffer(b"".join(found), kind)
    own = lengths[numbers]
    ends = np.cumsum(own)
    offsets = np.concatenate([[0], ends])
    return values[np.repeat(begins[numbers] - offsets[:-1], own) + np.arange(offsets[-1])], offsets


class Recent:
    """What recent chunks are encoded as; the older half goes when the newer is full."""

    def __init__(self, most: int):
        self.most = most
        self.newer: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def look_up(self, chunks: list[bytes]) -> list[bytes | None]:
        """What is known of each chunk."""
        found, older = list(map(self.newer.get, chunks)), self.older
        for i in [i for i, known in enumerate(found) if known is None and chunks[i] in older]:
            found[i] = older[chunks[i]]
            self.put(chunks[i], found[i])
        return found

    def put(self, chunk: bytes, coded: bytes) -> None:
        if len(chunk) <= LONG_CHUNK:
            if len(self.newer) >= self.most:
                self.newer, self.older = {}, self.newer
            self.newer[chunk] = coded
