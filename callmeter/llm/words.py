"""Words of many texts at once, as numbers: bytes are classed by table, never looped over."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Between words of plain texts: space, tab and the line separators.
BLANKS = b" \t\n\x0b\x0c\r"


class Words(NamedTuple):
    """The words of some texts: ``codes`` into ``vocabulary``, and where each stands in ``data``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    codes: np.ndarray
    vocabulary: pa.BinaryArray
    text: np.ndarray
    piece: np.ndarray


def portions(texts: Iterable[bytes], most: int) -> Iterator[list[bytes]]:
    """Texts in lists of about ``most`` bytes; a longer text is a list of its own."""
    held, size = [], 0
    for text in texts:
        if held and size + len(text) > most:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text) + 1
    if held:
        yield held


def split_words(texts: list[bytes], blanks: bytes = BLANKS, breaks: bytes = b"\n", lower: bool = False) -> Words:
    """Words between ``blanks``; ``breaks`` also end a piece, and every text ends one.

    UTF-8 letters beyond ASCII have no byte below 128, so no letter is cut. ``lower`` changes
    A-Z only. ``piece`` numbers the pieces; words next to each other in one piece share it.
    """
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    if lower:
        data = np.frombuffer(data.tobytes().lower(), np.uint8)
    edges = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    ends_word, ends_piece = np.zeros(256, bool), np.zeros(256, bool)
    ends_word[list(blanks + breaks)] = True
    ends_piece[list(breaks)] = True
    blank = ends_word[data]
    blank[edges[:-1]] = True
    inside = np.diff((~blank).view(np.int8), prepend=0, append=0)
    start, end = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    offsets = np.zeros(len(start) + 1, np.int64)
    np.cumsum(end - start, out=offsets[1:])
    letters = np.ascontiguousarray(data[~blank])
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    coded = found.dictionary_encode()
    closing = ends_piece[data]
    closing[edges[:-1]] = True
    piece = np.cumsum(closing, dtype=np.int64)[start] if len(start) else start
    return Words(
        data, start, end, coded.indices.to_numpy(), coded.dictionary, np.searchsorted(edges, start), piece
    )


def mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit values of 64-bit values, one to one."""
    x = x.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))
