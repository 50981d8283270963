"""SuperMinHash near-duplicates against comparing every pair of shingle sets."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from steadyline.llm import minhash, sieve

SCHEMA = "doc_id BIGINT, text STRING, node STRING, same STRING, kept STRING, component_id STRING, n_shingles STRING"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected(rows, words):
    """(doc_id, n_shingles, component_id, kept) by comparing every pair."""
    texts = [[w for w in lowered(t).replace("\t", " ").replace("\n", " ").split(" ") if w] for _, t in rows]
    sets = [{tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set() for w in texts]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if both and 100 * both >= 80 * (len(x) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return Counter(
        (doc_id, len(sets[i]), least.get(find(i)), doc_id == least.get(find(i))) for i, (doc_id, _) in enumerate(rows)
    )


def found(spark, rows, words=4):
    docs = spark.createDataFrame([(i, t, *[None] * 5) for i, t in rows], SCHEMA).repartition(3)
    out = minhash.near_duplicates(docs, words).collect()
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in out)


def slow_signature(elements, places):
    """The same offers one element and one step at a time, without an early end."""
    least = [None] * places
    for e in elements.tolist():
        order = list(range(places))
        for step in range(places):
            drawn = int(minhash.mixed(np.array([(e + (step + 1) * int(minhash._GOLDEN)) % (1 << 64)], np.uint64))[0])
            other = step + ((drawn >> 32) * (places - step) >> 32)
            order[step], order[other] = order[other], order[step]
            offer = step << 32 | drawn & 0xFFFFFFFF
            place = order[step]
            least[place] = offer if least[place] is None else min(offer, least[place])
    return least


@pytest.mark.parametrize("size", [1, 2, 7, 40, 400])
def test_signature_ends_early_with_the_same_offers(size):
    elements = np.random.default_rng(size).integers(0, 1 << 63, size).astype(np.uint64)
    assert minhash.signature(elements, 32).tolist() == slow_signature(elements, 32)


def test_estimates_have_lower_variance_than_independent_places():
    chance = np.random.default_rng(3)
    errors = []
    for _ in range(150):
        own = chance.integers(0, 1 << 63, 60).astype(np.uint64)  # few elements: the gain is largest
        a, b = own[:50], own[10:]
        errors.append(minhash.likeness(minhash.signature(a), minhash.signature(b)) - 40 / 60)
    independent = (2 / 3) * (1 / 3) / minhash.PLACES
    assert abs(np.mean(errors)) < 0.01 and np.var(errors) < 0.85 * independent


def test_messy_rows(spark):
    long = " ".join(f"word{i % 997} and the {i}th" for i in range(30_000))
    rows = [
        (7, "The quick brown fox\njumps over it"), (7, "The quick brown fox\njumps over it"), (3, None), (4, ""),
        (None, "no id here at all"), (None, None), (5, long), (6, "  \t\n "), (8, "Été Σίσυφος İstanbul 日本語 😀"),
        (9, "THE quick brown fox jumps OVER it"), (10, "a"), (11, "A"), (12, "a b"), (13, "no id here at ALL"),
        (14, long + " end"), (-1, "one of a kind, negative"), (15, "a a a a a a a a"), (16, "a a a a"),
    ]
    assert found(spark, rows) == expected(rows, 4)
    assert found(spark, [(None, "x y"), (None, "x y"), (None, None)]) == Counter({(None, 1, None, True): 2, (None, 0, None, True): 1})
    assert found(spark, []) == Counter()


def test_edits_at_the_threshold(spark):
    """Scattered and contiguous edits around 0.8, ties at exactly 80 in 100 included."""
    chance, rows = random.Random(12), []
    for n in range(150):
        size = chance.choice((9, 60, 150, 400))
        base = [f"w{chance.randrange(5000)}" for _ in range(size)]
        own = size - 3
        if n % 3 == 0:
            cut = max(1, round(own * chance.choice((0.08, 0.1, 0.105, 0.12))))
            other = base[: size - cut] + [f"t{chance.randrange(5000)}" for _ in range(cut)]
        elif n % 3 == 1:
            more = max(1, round(own * chance.choice((0.19, 0.24, 0.25, 0.27))))
            other = base + [f"a{chance.randrange(5000)}" for _ in range(more)]
        else:
            other = list(base)
            for _ in range(max(1, round(own * chance.choice((0.02, 0.027, 0.035))))):
                other[chance.randrange(size)] = "changed"
        rows += [(2 * n, " ".join(base)), (2 * n + 1, " ".join(other))]
    want = expected(rows, 4)
    assert found(spark, rows) == want
    assert 150 < sum(n for (_, _, _, kept), n in want.items() if kept) < 280


def test_large_groups_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "_COLUMNS", 64)
    chance, rows, base = random.Random(13), [], [f"w{k}" for k in range(100)]
    for n in range(150):
        changed = list(base)
        for _ in range(chance.randint(1, 8)):
            changed[chance.randrange(100)] = f"c{n}"
        rows.append((n, " ".join(changed)))
    rows += [(200 + n, " ".join([*(f"v{k}" for k in range(100)), f"end{n}"])) for n in range(40)]  # one component
    rows += [(300 + n, rows[n][1]) for n in range(60)]  # copies
    want = expected(rows, 4)
    assert found(spark, rows) == want
    assert 3 < len({c for _, _, c, _ in want}) < 150


def test_a_sieve_lets_everything_through_that_was_put_in(spark):
    hashes = np.random.default_rng(4).integers(-(1 << 63), 1 << 63, 5000)
    table = sieve.build(spark.createDataFrame([(int(h),) for h in hashes[:2500]], "h long"), "h")
    passed = sieve.passes(table, hashes.view(np.uint64))
    assert passed[:2500].all() and passed[2500:].sum() <= 5
