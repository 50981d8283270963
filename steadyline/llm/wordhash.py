"""Words of many texts at once: their numbers within the texts, and 64-bit hashes of words and word n-grams.

Splitting, numbering and hashing run on whole arrays, so the cost of a word is that of a few array steps.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken together up to this many bytes; a longer text is alone.
TOGETHER = 4 << 20
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit integers that scatters them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of sequences that go on by one word."""
    return mixed(left * _FACTOR + right)


def hashes_of(words: pa.LargeBinaryArray, family: int = 0) -> np.ndarray:
    """Hash of each word from its bytes and their places; never zero. Words are not empty. Families are independent."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    if len(words) == 0:
        return np.zeros(0, np.uint64)
    values, factor = mixed(np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * family)), _FACTOR + np.uint64(2 * family)
    sizes = np.diff(offsets)
    content = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    place = np.arange(len(content)) - np.repeat(offsets[:-1] - offsets[0], sizes)
    powers = np.cumprod(np.full(int(sizes.max()), factor))
    sums = np.add.reduceat(values[content] * powers[place], offsets[:-1] - offsets[0])
    return np.maximum(mixed(sums + sizes.astype(np.uint64)), np.uint64(1))


class Words:
    """The words of some texts, each text given as its words with one blank between them."""

    def __init__(self, texts: list[bytes]):
        full = [t for t in texts if t]
        lists = pc.split_pattern(pa.array(full, pa.large_binary()), " ")
        numbered = lists.flatten().dictionary_encode()
        if isinstance(numbered, pa.ChunkedArray):
            numbered = numbered.combine_chunks()
        #: how many words each text has; the number of each word in ``distinct``; the hash of each word
        self.counts = np.zeros(len(texts), np.int64)
        self.counts[[bool(t) for t in texts]] = lists.value_lengths().to_numpy(zero_copy_only=False)
        self.ids = numbered.indices.to_numpy(zero_copy_only=False)
        self.distinct = numbered.dictionary
        self.hashes = hashes_of(self.distinct)[self.ids]

    def others(self) -> np.ndarray:
        """A second hash of each word."""
        return hashes_of(self.distinct, 1)[self.ids]

    def joined(self, at: np.ndarray, n: int) -> pa.Array:
        """The ``n`` words from each place on, with one blank between them."""
        texts = self.distinct.take(pa.array(self.ids[at]))
        for k in range(1, n):
            texts = pc.binary_join_element_wise(texts, self.distinct.take(pa.array(self.ids[at + k])), pa.scalar(b" ", texts.type))
        return texts

    def starts(self) -> np.ndarray:
        """Where each text's words begin, and the end."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def together(sizes: list[int], most: int = TOGETHER) -> Iterator[slice]:
    """Consecutive slices of texts of these sizes, each of at most ``most`` bytes or a single text."""
    low, held = 0, 0
    for at, size in enumerate(sizes):
        if at > low and held + size > most:
            yield slice(low, at)
            low, held = at, 0
        held += size
    if low < len(sizes):
        yield slice(low, len(sizes))
