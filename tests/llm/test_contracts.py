"""Every registered document query on the smallest tables: columns, types, flags and digests computed anew."""

from __future__ import annotations

import hashlib
import os
import sys
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from steadyline.llm import queries, simhash

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import connect, differences  # noqa: E402

SF = "/root/testdata/sf0.001"
# The columns that each query returns at least, with their types.
COLUMNS = {
    "op1": {"doc_id": "bigint", "size": "bigint", "text_crc32": "bigint", "law": "string", "shard": "int", "slot": "bigint", "grown_shard": "int"},
    "op2": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
            "near_edited": "double", "near_next": "double"},
    "op5": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op6": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op7": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op8": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint", "n_dup_lines": "bigint",
            "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op9": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op10": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op11": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op12": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op13": {"lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint"},
}
NAMES = {name.split("_")[0]: name for name in queries.QUERIES}


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    return dict(sorted((r.doc_id, r.text or "") for r in rows))


@pytest.fixture(scope="module")
def results(spark):
    found = {}

    def of(op):
        if op not in found:
            df = queries.QUERIES[NAMES[op]](spark, SF)
            assert COLUMNS[op].items() <= dict(df.dtypes).items()
            found[op] = df.collect()
        return found[op]

    return of


@pytest.mark.parametrize("op", sorted(set(COLUMNS) - {"op9", "op12", "op13"}))
def test_one_row_for_each_document(results, texts, op):
    assert sorted(r.doc_id for r in results(op)) == list(texts)


def test_shards(results, texts):
    for r in results("op1"):
        assert (r.size, r.text_crc32) == (len(texts[r.doc_id].encode()) + 8, zlib.crc32(texts[r.doc_id].encode()))
    counts = np.bincount([r.shard for r in results("op1")], minlength=24)
    assert len(counts) == 24 and counts.max() - counts.min() <= 1
    assert sorted((r.shard, r.slot) for r in results("op1")) == [(s, k) for s in range(24) for k in range(counts[s])]


def test_token_ids(results, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    stored, coded, at = ({r.doc_id: r for r in results(op)} for op in ("op2", "op6", "op2"))
    at = 0
    for i in texts:
        own = np.array([*ids[i], 2], "<u4")
        assert tuple(stored[i])[:4] == (i, at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)
        decoded = tokenizer.decode(ids[i], skip_special_tokens=False)
        assert coded[i].n_tokens == len(ids[i])
        assert coded[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids[i])).encode()).hexdigest()
        assert coded[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_packed_pieces(results, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in results("op9"):
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(pieces) == list(texts)
    for i, own in pieces.items():
        ids, at = np.array([*tokenizer.encode(texts[i], add_special_tokens=False).ids, 0], "<u4"), 0
        for n, r in enumerate(sorted(own, key=lambda r: r.piece)):
            assert (r.piece, r.start, r.ids_crc32) == (n, at, zlib.crc32(ids[at : at + r.length].tobytes()))
            at += r.length
        assert at == len(ids) and (len(own) == 1) == (len(ids) <= 2048)
    for places in sequences.values():
        ends = np.cumsum([n for _, n in sorted(places)])
        assert [o for o, _ in sorted(places)] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


@pytest.mark.parametrize(("op", "modulus", "out"), [("op3", 3, 1), ("op7", 5, 0), ("op10", 5, 0)])
def test_scores_and_held_out_rows(results, op, modulus, out):
    for r in results(op):
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == out)
        assert 0 <= r.score <= 1
        assert op == "op10" or r.predicted == (r.score >= 0.5)


def test_edited_texts(results, texts):
    order = list(texts)
    following = dict(zip(order, [*order[1:], order[0]], strict=True))
    prints = {}
    for r in results("op4"):
        text, after = texts[r.doc_id], texts[following[r.doc_id]]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half] if half else text
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_fingerprints(results, texts):
    for r in results("op5"):
        assert r.fingerprint == f"{simhash.fingerprint(texts[r.doc_id], 3) % (1 << 64):016x}"
        assert r.component_id <= r.doc_id


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equal_to_sql(spark, name):
    con = connect(SF)
    assert differences(queries.QUERIES[name](spark, SF), con, queries.ORACLE[name]) is None
