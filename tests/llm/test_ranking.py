"""Dense search against plain scoring in Python integers and against DuckDB."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from steadyline.llm import ranking

DOCS = "doc_id BIGINT, text STRING, item_id STRING, score STRING, rank STRING, n STRING, term STRING"
ITEMS = "item_id BIGINT, text STRING, doc_id STRING, score STRING"


def plain_terms(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lowered)


def plain(docs, items, k):
    counts = [(i, Counter(plain_terms(t))) for i, t in docs]
    total, documents = sum(c.total() for _, c in counts), sum(bool(c) for _, c in counts)
    holding = Counter(t for _, c in counts for t in c)
    own = {}
    for i, t in items:
        own.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, asked in own.items():
        scores = []
        for i, c in counts:
            if c:
                m = 50 + (50 * c.total() * documents) // total
                s = sum(
                    math.floor(1000 * math.log((2 * documents + 2) / (2 * holding[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
                    for t in asked & c.keys()
                )
                if s > 0:
                    scores.append((-s, i is None, i or 0, i))
        out += [(item, n + 1, s[3], -s[0]) for n, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k])]
    return Counter(out)


def ranked(spark, docs, items, k):
    table = spark.createDataFrame([(i, t, *[None] * 5) for i, t in docs], DOCS).repartition(4)
    out = ranking.rank_documents(table, spark.createDataFrame([(i, t, None, None) for i, t in items], ITEMS), k).collect()
    return Counter((r.item_id, r.rank, r.doc_id, r.score) for r in out)


def rows_of(count, seed, words=300):
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    return [(i, " ".join(chance.choices(vocabulary, weights=[1 / (r + 1) for r in range(words)], k=chance.randint(0, 60)))) for i in range(count)]


@pytest.mark.parametrize("k", [1, 10, 500])
def test_equals_plain_scoring(spark, monkeypatch, k):
    for name, value in (("ITEMS", 3), ("TERMS", 7), ("DOCUMENTS", 16)):  # many tiles of each kind
        monkeypatch.setattr(ranking, name, value)
    docs, items = rows_of(300, 1), rows_of(11, 2)
    assert ranked(spark, docs, items, k) == plain(docs, items, k)


def test_batches_of_items(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BATCH_ITEMS", 4)
    docs, items = rows_of(120, 3), rows_of(15, 4)
    assert ranked(spark, docs, items, 5) == plain(docs, items, 5)


def test_messy_rows(spark):
    long = " ".join(f"word{i % 997} the" for i in range(30_000))
    docs = [
        (5, "The same words, THE same"), (4, "the same words the same"), (4, "the same words the same"), (None, "the same words the same"),
        (1, None), (2, ""), (3, " ,.; "), (9, long), (8, "Été İstanbul 日本語 été\x00word7"), (-3, "the same words the same"),
    ]
    items = [(0, "the SAME"), (1, "word7 été"), (2, None), (3, ""), (None, "words"), (0, "日本語 the the"), (6, "absent"), (7, long)]
    assert ranked(spark, docs, items, 3) == plain(docs, items, 3)
    assert ranked(spark, docs, items, 50) == plain(docs, items, 50)
    assert ranked(spark, docs, [], 3) == ranked(spark, [], items, 3) == ranked(spark, [(1, None)], items, 3) == Counter()


def test_equals_sql(spark):
    docs, items = rows_of(200, 5), rows_of(9, 6)
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.execute(f"CREATE TABLE {name} ({key} BIGINT, text VARCHAR)")
        con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    assert ranked(spark, docs, items, 50) == Counter(con.execute(ranking.ORACLE_SQL).fetchall())


def test_best_keeps_ties_by_id():
    scores, ids = np.array([3, 9, 3, 0, 3, 9, 3]), np.array([70, 5, 20, 1, 10, 4, 30])
    assert ids[ranking.best(scores, ids, np.zeros(7, bool), 4)].tolist() == [4, 5, 10, 20]
    assert ids[ranking.best(scores, ids, ids == 10, 6)].tolist() == [4, 5, 20, 30, 70, 10]
    assert len(ranking.best(np.zeros(3, np.int64), np.arange(3), np.zeros(3, bool), 2)) == 0
