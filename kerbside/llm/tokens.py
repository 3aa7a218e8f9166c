"""Words of many texts at once, as numpy arrays: where they lie, whose they are, and 64-bit hashes."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
BLOCK_BYTES = 1 << 20
GAP = b" \n "


class Words(NamedTuple):
    """Words of one block of texts, in order."""

    block: bytes
    start: np.ndarray  # first byte of each word in the block
    end: np.ndarray  # one past its last byte
    owner: np.ndarray  # index of its text within the block
    hash: np.ndarray  # uint64 of its bytes
    n_texts: int


def kinds(words: bytes, signs: bytes = b"") -> np.ndarray:
    """Kind of each byte: 1 in words, 2 in signs, else 0. Bytes of a kind in a row form one token."""
    table = np.zeros(256, dtype=np.uint8)
    table[list(words)] = 1
    table[list(signs)] = 2
    return table


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    base = pow(int(BASE), -1, 1 << 64)
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, np.uint64(base), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def blocks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Lists of whole texts of about BLOCK_BYTES together; a longer text is a block of its own."""
    part: list[bytes] = []
    size = 0
    for t in texts:
        part.append(t)
        size += len(t)
        if size >= BLOCK_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def words_of(texts: list[bytes], table: np.ndarray) -> Words:
    """The words of some texts, by the kinds of their bytes. GAP must consist of bytes of kind 0."""
    block = GAP + GAP.join(texts) + GAP
    firsts = np.cumsum([len(GAP), *(len(t) + len(GAP) for t in texts)])[:-1]
    a = np.frombuffer(block, dtype=np.uint8)
    kind = table[a]
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    inside = kind[change] != 0
    start = change[inside]
    after = np.flatnonzero(inside) + 1
    end = change[after]  # the last byte has kind 0, so every word ends
    up, down = _powers(1 << max(20, int(len(a)).bit_length()))
    sums = np.zeros(len(a) + 1, dtype=np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * up[: len(a)], out=sums[1:])
    h = mix((sums[end] - sums[start]) * down[start])
    owner = np.searchsorted(firsts, start, side="right") - 1
    return Words(block, start, end, owner, h, len(texts))


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")
