"""Collocations against counting every n-gram in Python, and the parsing's own properties."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from steadyline.llm import phrases, wordhash

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, phrase STRING, n STRING, score STRING, words STRING"


def pieces_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", lowered)]


def grams_of(rows):
    counts = Counter()
    for lang, text in rows:
        for w in pieces_of(text):
            for n in range(1, 5):
                counts.update((lang or "und", tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    return counts


def plain(rows, least, count):
    f = grams_of(rows)
    total = Counter()
    for (lang, p), c in f.items():
        total[lang] += c * (len(p) == 1)
    candidates = {k: c for k, c in f.items() if len(k[1]) > 1 and c >= least}
    dropped = set()
    for (lang, p), c in candidates.items():
        for n in range(2, len(p)):
            for i in range(len(p) - n + 1):
                inner = lang, p[i : i + n]
                if 100 * c >= 80 * candidates[inner]:
                    dropped.add(inner)
    by_lang = {}
    for (lang, p), a in candidates.items():
        if (lang, p) not in dropped:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            phrase = " ".join(p)
            by_lang.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, f[lang, p[:k]], f[lang, p[k:]]))
    return Counter(
        (lang, i + 1, x[3], -x[1], x[4], x[5], total[lang], -x[0])
        for lang, own in by_lang.items()
        for i, x in enumerate(sorted(own)[:count])
    )


def found(spark, rows, least=30, count=2000):
    docs = spark.createDataFrame([(i, t, g, *[None] * 4) for i, (g, t) in enumerate(rows)], SCHEMA).repartition(3)
    out = phrases.collocations(docs, least, count).collect()
    return Counter((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out)


def rows_of(count, seed):
    chance = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    fixed = [" ".join(chance.choices(words, k=chance.randint(2, 9))) for _ in range(12)]
    rows = []
    for n in range(count):
        parts = [chance.choice(fixed) if chance.random() < 0.5 else chance.choice(words) for _ in range(chance.randint(0, 60))]
        text = "".join(p + chance.choice([" ", " ", "  ", "\t", ". ", ",\n", " Is "]) for p in parts)
        rows.append((chance.choice(["en", "en", "de", None]), text))
    return rows


def test_parsing_counts_every_gram_once():
    chance = random.Random(2)
    sequences = [
        [chance.choice([b"."] + [b"t%d" % k for k in range(alphabet)]) for _ in range(size)]
        for size in (0, 1, 2, 3, 4, 5, 50, 3000)
        for alphabet in (1, 2, 30)
    ]
    got, want = [Counter() for _ in sequences], [Counter() for _ in sequences]
    for text, chunk, last, own in phrases.parse([b" ".join(t) for t in sequences]):
        tokens = chunk.split(b" ")
        starts = len(tokens) if last else len(tokens) - phrases.OVERLAP
        assert own == sum(t != b"." for t in tokens[:starts])
        for n in range(1, 5):
            got[text].update((n, tuple(tokens[i : i + n])) for i in range(starts) if i + n <= len(tokens))
    for counts, tokens in zip(want, sequences, strict=True):
        for n in range(1, 5):
            counts.update((n, tuple(tokens[i : i + n])) for i in range(len(tokens) - n + 1))
    assert got == want


def test_equal_passages_fall_into_equal_chunks():
    chance = random.Random(3)
    passage = [b"p%d" % chance.randrange(10**6) for _ in range(3000)]
    texts = [b" ".join([b"q%d" % chance.randrange(10**6) for _ in range(chance.randint(5, 500))] + passage) for _ in range(2)]
    chunks = [set(), set()]
    for text, chunk, _, _ in phrases.parse(texts):
        chunks[text].add(chunk)
    assert len(chunks[0] & chunks[1]) > 0.7 * 3000 / phrases.EVERY


def test_long_runs_are_cut(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 50)
    parsed = list(phrases.parse([b" ".join([b"same"] * 1000)]))
    assert max(len(chunk.split(b" ")) for _, chunk, _, _ in parsed) <= 53
    assert sum(own for _, _, _, own in parsed) == 1000


def test_words_of_texts():
    texts = [b"a bb ccc a", b"", b"x" * 5000, "été bb".encode(), b"a"]
    words = wordhash.Words(texts)
    assert words.counts.tolist() == [4, 0, 1, 2, 1]
    assert [words.distinct[i].as_py() for i in words.ids.tolist()] == [w for t in texts for w in t.split()]
    by_word = {}
    for i, h in zip(words.ids.tolist(), words.hashes.tolist(), strict=True):
        assert by_word.setdefault(i, h) == h and h
    assert len(set(by_word.values())) == len(by_word)
    again = wordhash.Words([b"zzz a"]).hashes  # the same hash in other company
    assert again[1] == words.hashes[0]
    assert list(wordhash.together([5, wordhash.TOGETHER, 1, 1])) == [slice(0, 1), slice(1, 2), slice(2, 4)]
    assert len(wordhash.Words([]).ids) == len(wordhash.Words([b""]).ids) == 0


def test_equals_counting_every_gram(spark):
    rows = rows_of(250, 1)
    want = plain(rows, 30, 2000)
    assert len(want) > 100 and len({k[0] for k in want}) == 3
    assert found(spark, rows) == want


@pytest.mark.parametrize("count", [1, 7])
def test_top_of_each_language(spark, count):
    rows = rows_of(120, 4)
    assert found(spark, rows, 10, count) == plain(rows, 10, count)


def test_messy_rows(spark):
    long = " ".join(f"word{i % 97} and the {i % 7}th, line\n" for i in range(20_000))
    rows = [(None, None), ("en", None), ("en", ""), ("en", " . , \t"), (None, "a b c d a b c d " * 20), ("de", long), ("de", long),
            ("fr", "Été ÉTÉ été\x0bété\x00x İst 日本 語 " * 40), ("es", "same " * 500), ("en", "A-B c_d " * 31)]
    want = plain(rows, 30, 2000)
    assert found(spark, rows) == want and len(want) > 20
    assert found(spark, []) == Counter()


def test_different_phrases_of_one_hash_stay_apart(monkeypatch):
    """With hashes of few values everything collides; the counts are still those of the texts."""
    rows = rows_of(40, 6)
    texts = [phrases.tokens_of(t or "") for _, t in rows]
    parsed = [(rows[text][0] or "und", chunk, last) for text, chunk, last, own in phrases.parse(texts) if own]
    batch = pa.RecordBatch.from_pydict(
        {
            "lang": [p[0] for p in parsed],
            "chunk": [p[1].decode() for p in parsed],
            "last": [p[2] for p in parsed],
            "times": [1] * len(parsed),
        }
    )
    monkeypatch.setattr(phrases, "joined", lambda left, right: (left + right) & np.uint64(7))
    grams = phrases.Grams(batch, 4)
    found = Counter()
    for n in range(1, 5):
        at, f, hashes = grams.counts(n, batch.column("times").to_numpy())
        assert len(set(hashes.tolist())) <= 8
        for place, text, times in zip(at.tolist(), grams.words.joined(at, n).to_pylist(), f.tolist(), strict=True):
            found[batch.column("lang")[grams.chunk[place]].as_py(), tuple(text.decode().split(" "))] += times
    assert found == grams_of(rows)


def test_chunks_are_given_out_before_the_batch_ends(monkeypatch):
    monkeypatch.setattr(phrases, "PARSED", 200)
    texts = [None, "", "a b c. d e", "x" * 500, *(f"the {k} of the {k + 1}, and" for k in range(100)), "A\tb"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * len(texts)), pa.array(texts)], ["lang", "text"])
    parts = list(phrases.chunks_of(iter([batch])))
    assert len(parts) > 5 and max(p.nbytes for p in parts) < 2000
    assert sum(sum(p.column("words").to_pylist()) for p in parts) == sum(len(w) for t in texts for w in pieces_of(t))
    assert list(phrases.chunks_of(iter([batch.slice(0, 0)]))) == []
