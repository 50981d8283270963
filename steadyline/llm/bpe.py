"""Byte-pair encoding and decoding from a public tokenizer file.

Merging uses a priority queue of (rank, place) over a doubly linked list of symbols: the best merge is
taken, its right neighbour is unlinked, and the two new pairs are pushed. Entries whose symbols have
changed since are skipped when they come up.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, texts_of
from steadyline.llm.units import Remembered, byte_alphabet

_UNIT_CHARS = 48


class PairEncoder:
    """The vocabulary, merges, normalizer and pre-tokenizer of a tokenizers file with word ends.

    Supported: byte-level symbols, an end-of-word suffix, NFC, white space replaced, lower case, one
    splitting pattern, special tokens found first. Anything else in the file is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self._refuse_unknown(spec)
        self.vocabulary: dict[str, int] = dict(model["vocab"])
        self.suffix: str = model.get("end_of_word_suffix") or ""
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = [""] * (1 + max([*self.vocabulary.values(), *specials.values()]))
        for text, i in {**self.vocabulary, **specials}.items():
            self.strings[i] = text
        self.specials = specials
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(specials, key=len, reverse=True))) + ")") if specials else None
        # (left id, right id) -> (rank, merged id)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            key = (self.vocabulary[left], self.vocabulary[right])
            self.merges[key] = (rank, self.vocabulary[left + right])
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # The file's \s is Unicode white space, without the four information separators.
        self.pieces = regex.compile(pattern.replace(r"[^\s\p{L}", r"[^\p{White_Space}\p{L}"))
        self.alphabet = byte_alphabet()
        self.units, self.words = Remembered(), Remembered()

    @staticmethod
    def _refuse_unknown(spec: dict) -> None:
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        steps = [p["type"] for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
        if kinds != ["NFC", "Replace", "Lowercase"] or steps != ["Split", "ByteLevel"]:
            raise ValueError(f"normalizer {kinds} and pre-tokenizer {steps} are not supported")
        if spec["model"].get("byte_fallback") or spec["model"].get("ignore_merges") or spec["decoder"]:
            raise ValueError("byte fallback, ignored merges and decoders are not supported")

    def merge(self, piece: str) -> list[int]:
        """The ids of one pre-token, given as text."""
        symbols = [self.alphabet[b] for b in piece.encode("utf-8")]
        symbols[-1] += self.suffix
        ids = [self.vocabulary[s] for s in symbols]
        n, merges = len(ids), self.merges
        following = [*range(1, n), -1]
        before = [*range(-1, n - 1)]
        queue = [(*found, i) for i in range(n - 1) if (found := merges.get((ids[i], ids[i + 1])))]
        heapq.heapify(queue)
        # rank, merged id, place: equal ranks have the same id, so the leftmost place comes first
        while queue:
            _, merged, i = heapq.heappop(queue)
            j = following[i] if ids[i] >= 0 else -1
            if j < 0 or (found := merges.get((ids[i], ids[j]))) is None or found[1] != merged:
                continue  # stale
            ids[i], ids[j] = merged, -1
            following[i] = k = following[j]
            if k >= 0:
                before[k] = i
                if found := merges.get((merged, ids[k])):
                    heapq.heappush(queue, (*found, i))
            if (h := before[i]) >= 0 and (found := merges.get((ids[h], merged))):
                heapq.heappush(queue, (*found, h))
        return [x for x in ids if x >= 0]

    def _word(self, piece: str) -> bytes:
        found = self.words.find(piece)
        if found is None:
            found = np.array(self.merge(piece), "<i4").tobytes()
            if len(piece) <= _UNIT_CHARS:
                self.words.learn(piece, found)
        return found

    def _plain(self, text: str) -> bytes:
        """Ids of a text without special tokens and, but for its own sake, white space."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # lower case letter by letter
        return b"".join([self._word(p) for p in self.pieces.findall(text.lower())])

    def _unit(self, unit: str) -> bytes:
        found = self.units.find(unit)
        if found is None:
            if self.special and self.special.search(unit):
                parts = self.special.split(unit)
                found = b"".join([
                    np.array([self.specials[p]], "<i4").tobytes() if p in self.specials else self._plain(p)
                    for p in parts if p
                ])
            else:
                found = self._plain(unit)
            if len(unit) <= _UNIT_CHARS:
                self.units.learn(unit, found)
        return found

    def encode(self, text: str) -> np.ndarray:
        """The ids of a whole text. Words are independent, so those seen before are looked up."""
        known, unit = self.units.get, self._unit
        blank = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return np.frombuffer(b"".join([known(u) or unit(u) for u in blank.split(" ")]), "<i4")

    def decode(self, ids: np.ndarray) -> str:
        """The vocabulary strings of the ids, special tokens included.

        The file has no decoder; the strings then stand side by side with a blank between them.
        """
        return " ".join(map(self.strings.__getitem__, ids.tolist()))


@lru_cache(maxsize=4)
def pair_encoder(path: str) -> PairEncoder:
    return PairEncoder(path)


def encode_documents(docs: DataFrame, tokenizer: str, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every whole text, and with ``decoded`` the text the ids stand for.

    A null or empty text has no id and decodes to the empty text. Repeated rows are encoded one by one;
    other columns are ignored.
    """

    def make():
        bpe = pair_encoder(tokenizer)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [bpe.encode(t) for t in texts_of(batch)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.array(np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32))
            columns = {"doc_id": batch.column("doc_id"), "ids": pa.ListArray.from_arrays(pa.array(offsets), flat)}
            if decoded:
                columns["decoded"] = pa.array([bpe.decode(x) for x in ids], pa.string())
            return pa.RecordBatch.from_pydict(columns)

        return work

    schema = "doc_id long, ids array<int>" + ", decoded string" * decoded
    return in_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), schema, make)


def decode_documents(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, decoded) from (doc_id, ids); null ids decode to the empty text."""

    def make():
        bpe = pair_encoder(tokenizer)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [bpe.decode(np.array(x or [], np.int64)) for x in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "decoded": pa.array(texts, pa.string())})

        return work

    return in_arrow(encoded.select("doc_id", "ids"), "doc_id long, decoded string", make)
