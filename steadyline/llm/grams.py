"""Hashed character n-grams of whole texts, computed on UTF-8 bytes with numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# A text is hashed in pieces of at most this many bytes, cut at spaces, so memory does not follow its length.
PIECE_BYTES = 1 << 19

_SPACE = bytes(c if c >= 0x80 or chr(c).isalpha() else 0x20 for c in range(256))
_STEP = np.uint32(16777619)
_MIX = np.uint32(2654435769)


def normal(text: str) -> bytes:
    """Lower case, everything in ASCII that is no letter as one space, a space at both ends."""
    words = text.lower().encode("utf-8", "surrogatepass").translate(_SPACE).split()
    return b" " + b" ".join(words) + b" " if words else b""


def _pieces(data: bytes) -> Iterator[bytes]:
    start = 0
    while len(data) - start > PIECE_BYTES:
        cut = data.rfind(b" ", start + 1, start + PIECE_BYTES)
        if cut < 0:  # one word longer than a piece
            cut = start + PIECE_BYTES
        yield data[start : cut + 1]
        start = cut
    yield data[start:]


def gram_hashes(data: bytes, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Hashes below ``2**bits`` of the n-grams of each size, piece by piece.

    A gram may begin or end with a space (the edge of a word) but has none inside.
    """
    shift = np.uint32(32 - bits)
    for piece in _pieces(data):
        b = np.frombuffer(piece, np.uint8)
        wide = b.astype(np.uint32)
        space = b == 0x20
        h, inner = wide + np.uint32(1), np.zeros(len(b), bool)
        for n in range(2, max(sizes) + 1):
            if len(b) < n:
                break
            if n > 2:
                inner = inner[:-1] | space[n - 2 : len(b) - 1]
            else:
                inner = inner[:-1]
            h = h[:-1] * _STEP + wide[n - 1 :]
            if n in sizes:
                kept = h if n == 2 else h[~inner]
                yield (kept * _MIX) >> shift


def gram_list(data: bytes, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    found = list(gram_hashes(data, sizes, bits))
    return np.concatenate(found) if found else np.zeros(0, np.uint32)
