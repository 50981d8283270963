"""Quality rules as a short-circuit cascade, cheapest rejection first."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from steadyline.llm.common import in_arrow, ship, texts_of

SAMPLE_ROWS = 400
SAMPLE_CHARS = 20_000

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MAX_DUP_LINE_PERCENT = 60
MIN_MEAN_CHARS, MAX_MEAN_CHARS = 3, 10
MAX_CAPITAL_PERCENT = 30
MIN_LETTERED_PERCENT = 70

_BLANK = bytes([0x20, *range(0x09, 0x0E)])
_SYMBOLS = b"#*$%&|<>"
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_NO_LETTER = bytes(
    c for c in range(128) if c not in _BLANK and not (ord("A") <= c <= ord("Z") or ord("a") <= c <= ord("z"))
)


def _count(data: bytes, of: bytes) -> int:
    return len(data) - len(data.translate(None, of))


class Measures:
    """Counts over a whole text, each taken when a rule first asks for it."""

    def __init__(self, text: str):
        self.text = text

    @cached_property
    def data(self) -> bytes:
        return self.text.encode("utf-8", "surrogatepass")

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - _count(self.data, _BLANK)

    @cached_property
    def n_symbols(self) -> int:
        return _count(self.data, _SYMBOLS)

    @cached_property
    def n_capitals(self) -> int:
        return _count(self.data, _CAPITALS)

    @cached_property
    def n_lettered(self) -> int:
        """Words with an ASCII letter or any character beyond ASCII."""
        return len(self.data.translate(None, _NO_LETTER).split())

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip(_BLANK)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a 3-word window found twice or more, first occurrences included."""
        if self.n_words < 4:
            return 0
        seen: dict[bytes, int] = {}
        ids = np.array([seen.setdefault(w, len(seen)) for w in self.words], np.int64)
        pairs = ids[:-1] * len(seen) + ids[1:]
        if len(seen) > 1 << 20:  # three numbers would not fit in 63 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        _, place, often = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
        again = often[place] >= 2
        covered = np.zeros(len(ids), bool)
        for shift in range(3):
            covered[shift : shift + len(again)] |= again
        return int(covered.sum())


# A rule says whether to reject. All are exact comparisons of whole numbers.
Rule = Callable[[Measures], bool]

RULES: dict[str, Rule] = {
    "few_words": lambda m: m.n_words < MIN_WORDS,
    "repeated_windows": lambda m: 100 * m.n_repeat_words > MAX_REPEAT_PERCENT * m.n_words,
    "symbols": lambda m: 100 * m.n_symbols > MAX_SYMBOL_PERCENT * m.n_words,
    "repeated_lines": lambda m: 100 * m.n_dup_lines > MAX_DUP_LINE_PERCENT * len(m.lines),
    "word_length": lambda m: not MIN_MEAN_CHARS * m.n_words <= m.word_chars <= MAX_MEAN_CHARS * m.n_words,
    "capitals": lambda m: 100 * m.n_capitals > MAX_CAPITAL_PERCENT * m.word_chars,
    "lettered_words": lambda m: 100 * m.n_lettered < MIN_LETTERED_PERCENT * m.n_words,
}


def estimate_order(texts: list[str], rules: dict[str, Rule] = RULES) -> list[str]:
    """The order of greatest rejection per cost, greedily over what earlier rules leave of the sample.

    Cost is the time of a rule on texts of which nothing is measured yet. The order changes the work, never
    the verdict. With no text the order given stands.
    """
    left, order = [Measures(t) for t in texts], []
    cost = {}
    for name, rule in rules.items():
        start = time.perf_counter()
        for text in texts:
            rule(Measures(text))
        cost[name] = max(1e-9, (time.perf_counter() - start) / max(1, len(texts)))
    rest = list(rules)
    while rest:
        best = max(rest, key=lambda n: sum(map(rules[n], left)) / max(1, len(left)) / cost[n])
        order.append(best)
        rest.remove(best)
        left = [m for m in left if not rules[best](m)]
    return order


def sample_order(docs: DataFrame, rules: dict[str, Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[str]:
    """The order estimated on about ``rows`` texts of at most ``SAMPLE_CHARS`` code points, chosen by a hash of the id."""
    total = docs.count()
    cut = int((1 << 31) * min(1.0, rows / max(1, total)))
    chosen = docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) <= cut)
    found = chosen.filter(F.char_length("text") <= SAMPLE_CHARS).select("text").limit(2 * rows).collect()
    return estimate_order([r.text for r in found], rules)


def first_rejection(measures: Measures, order: list[str], rules: dict[str, Rule]) -> str | None:
    """The first rule in ``order`` that rejects; later rules are not evaluated."""
    return next((name for name in order if rules[name](measures)), None)


def keep_documents(docs: DataFrame, order: list[str] | None = None, rules: dict[str, Rule] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that no rule rejects.

    A null text is judged as an empty one. Repeated rows share their verdict; an empty table stays empty.
    """
    order = sample_order(docs, rules) if order is None else order
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            kept = [first_rejection(Measures(t), order, rules) is None for t in texts_of(batch)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def judge_documents(docs: DataFrame, order: list[str] | None = None, rules: dict[str, Rule] = RULES) -> DataFrame:
    """(doc_id, the base measures, base_failed, kept) for every row, the verdict by the cascade.

    A null or empty text has no word, fails the base rules and is not kept. A word is a run of characters
    other than blank and U+0009 to U+000D. Repeated rows are judged one by one; other columns are ignored.
    """
    order = sample_order(docs, rules) if order is None else order

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ms = [Measures(t) for t in texts_of(batch)]
            kept = [first_rejection(m, order, rules) is None for m in ms]
            failed = [RULES["few_words"](m) or RULES["repeated_windows"](m) for m in ms]
            columns = [
                pa.array([getattr(m, name) for m in ms], pa.int64())
                for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            ]
            verdicts = [pa.array(failed, pa.bool_()), pa.array([k and not f for k, f in zip(kept, failed, strict=True)], pa.bool_())]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns, *verdicts],
                ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
            )

        return work

    return in_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean",
        make,
    )


# The same measures and verdict in DuckDB SQL, over a relation of (place, doc_id, text).
MEASURES_SQL = r"""
judged_in AS ({source}),
word AS (
  SELECT place, generate_subscripts(ws, 1) AS pos, unnest(ws) AS w
  FROM (SELECT place, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM judged_in)
),
shingle AS (
  SELECT place, pos, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p AS key FROM word
  WINDOW p AS (PARTITION BY place ORDER BY pos)
),
again AS (
  SELECT place, pos FROM (
    SELECT place, pos, count(*) OVER (PARTITION BY place, key) AS n FROM shingle WHERE key IS NOT NULL
  ) WHERE n >= 2
),
repeated AS (
  SELECT place, count(DISTINCT pos + shift) AS n FROM again, (VALUES (0), (1), (2)) AS s(shift) GROUP BY place
),
line AS (
  SELECT place, count(*) AS n, count(*) - count(DISTINCT l) AS dup
  FROM (SELECT place, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM judged_in)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY place
),
per_word AS (
  SELECT place, count(*) AS n, sum(length(w)) AS chars,
    count(*) FILTER (regexp_matches(w, '[A-Za-z]|[^\x00-\x7F]')) AS lettered
  FROM word GROUP BY place
),
measured AS (
  SELECT d.place, d.doc_id, coalesce(p.n, 0)::BIGINT AS n_words, coalesce(p.chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g'))::BIGINT AS n_capitals,
    coalesce(p.lettered, 0) AS n_lettered, coalesce(l.n, 0) AS n_lines,
    coalesce(l.dup, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM judged_in d LEFT JOIN per_word p USING (place) LEFT JOIN line l USING (place) LEFT JOIN repeated r USING (place)
),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 100 * n_symbols > 10 * n_words
      OR 100 * n_dup_lines > 60 * n_lines OR word_chars NOT BETWEEN 3 * n_words AND 10 * n_words
      OR 100 * n_capitals > 30 * word_chars OR 100 * n_lettered < 70 * n_words) AS kept
  FROM measured
)
"""
ORACLE_SQL = (
    "WITH "
    + MEASURES_SQL.replace("{source}", "SELECT row_number() OVER () AS place, doc_id, text FROM documents")
    + "SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged"
)
