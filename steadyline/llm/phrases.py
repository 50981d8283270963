"""Phrase collocations: counts of word n-grams by prefix-free parsing, exact scores, ranking by language.

Parsing. A text is a sequence of words and breaks. A window of three tokens whose hash meets a fixed condition is a
trigger; a chunk runs from one trigger to the end of the next, so neighbouring chunks overlap by the
trigger, and equal passages fall into equal chunks wherever they stand. Distinct chunks with their frequencies are
the dictionary: a passage that thousands of documents share is looked into once. An n-gram of up to four words belongs to the chunk
in which it starts before the overlap, and lies within it; so each occurrence counts once, with the chunk's frequency.

Counting takes three rounds over the dictionary: words and pairs; triples both of whose pairs are frequent; sequences of four
words both of whose triples are frequent. What is frequent is told by bit tables of fixed size (``sieve``), which
turn phrases away early and never decide a count. A phrase is counted under two independent hashes of its
language and words, of 64 and 32 bits, with one chunk that holds it; its text is read from that chunk in the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from steadyline.llm import sieve
from steadyline.llm.common import in_arrow, ship, texts_of
from steadyline.llm.grouping import stored
from steadyline.llm.wordhash import Words, joined, mixed, together

LONGEST = 4
OVERLAP = LONGEST - 1
# One window in so many is a trigger; chunks without one end after so many tokens.
EVERY = 64
CHUNK = 4096
# Texts are parsed together up to this many bytes; a longer text is alone.
PARSED = 1 << 20
COUNTED = 2 << 20  # chunks of the dictionary likewise
# Phrases of a language are ranked in this many parts first.
_PARTS = 256

# Characters that end a piece, all shown as a full stop; tabs as blanks.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_BREAK = b"."
_MAP = bytes(46 if c in _ENDS else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256))


def tokens_of(text: str) -> bytes:
    """Words in order and a full stop wherever a piece ends, with one blank between them."""
    whole = text.encode("utf-8", "surrogatepass").translate(_MAP).replace(_BREAK, b" . ")
    return b" ".join(whole.split())


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    """Each place has the value ``by`` places on; zero beyond the end."""
    if not by:
        return values
    out = np.zeros_like(values)
    out[:-by] = values[by:]
    return out


def _is_word(words: Words) -> np.ndarray:
    at = words.distinct.index(_BREAK)
    return words.ids != at.as_py()


def parse(texts: list[bytes]) -> Iterator[tuple[int, bytes, bool, int]]:
    """Chunks (text, tokens, last, words of its own): all but the last end with the window that the next begins with.

    A chunk begins where its text does, at each trigger, and ``CHUNK`` tokens after a start without one.
    """
    words = Words(texts)
    if not len(words.ids):
        return
    begins, counts = words.starts()[:-1], words.counts
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - begins[owner]
    window = np.zeros(len(owner), np.uint64)
    for k in range(OVERLAP):
        window = joined(window, _shifted(words.hashes, k))
    room = counts[owner] - place > OVERLAP  # a start leaves at least one token after its window
    first = (place == 0) | (room & (window % np.uint64(EVERY) == 0))
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], len(owner))
    long = np.flatnonzero(ends - starts > CHUNK)
    if len(long):
        more = [np.arange(starts[k] + CHUNK, ends[k], CHUNK) for k in long]
        more = np.concatenate(more)
        starts = np.union1d(starts, more[room[more]])
        ends = np.append(starts[1:], len(owner))
    last = ends == (begins + counts)[owner[starts]]
    sizes = np.diff(np.frombuffer(words.distinct.buffers()[1], np.int64)[: len(words.distinct) + 1])
    at = np.concatenate([[0], np.cumsum(sizes[words.ids] + 1)])  # bytes before each token, blanks included
    before = np.concatenate([[0], np.cumsum(_is_word(words))])
    own = before[ends] - before[starts]
    upto = np.where(last, ends, ends + OVERLAP)
    for text, low, high, is_last, n in zip(
        owner[starts].tolist(),
        (at[starts] - at[begins[owner[starts]]]).tolist(),
        (at[upto] - at[begins[owner[starts]]]).tolist(),
        last.tolist(),
        own.tolist(),
        strict=True,
    ):
        yield text, texts[text][low : high - 1], is_last, n


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, chunk, last, words) of the texts (lang, text), given out as texts are taken together, so a task never
    holds the words and chunks of a whole batch."""
    kinds = {"lang": pa.string(), "chunk": pa.string(), "last": pa.bool_(), "words": pa.int64()}
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        for part in together(sizes, PARSED):
            own = batch.slice(part.start, part.stop - part.start)
            langs, found = own.column("lang").to_pylist(), {name: [] for name in kinds}
            for text, chunk, last, n in parse([tokens_of(t) for t in texts_of(own)]):
                if n:
                    for name, value in zip(kinds, (langs[text], chunk, last, n), strict=True):
                        found[name].append(value)
            yield pa.RecordBatch.from_arrays([pa.array(found[k], kind) for k, kind in kinds.items()], list(kinds))


def dictionary(docs: DataFrame) -> DataFrame:
    """(lang, chunk, last, words, times, number): the distinct chunks of all texts of a language and their frequencies.

    Numbers hold once the dictionary is stored.
    """

    ship(docs.sparkSession)
    read = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = read.mapInArrow(chunks_of, "lang string, chunk string, last boolean, words long")
    distinct = chunks.groupBy("lang", "chunk", "last", "words").agg(F.count(F.lit(1)).alias("times"))
    return distinct.withColumn("number", F.monotonically_increasing_id())


class Grams:
    """The n-grams of some chunks: two hashes by place and length, and which places may start one."""

    def __init__(self, batch: pa.RecordBatch, longest: int, pairs: np.ndarray | None = None, triples: np.ndarray | None = None):
        words = Words([c.as_py().encode("utf-8", "surrogatepass") for c in batch.column("chunk")])
        self.words = words
        counts = words.counts
        self.chunk = np.repeat(np.arange(len(counts)), counts)
        langs = batch.column("lang").to_pylist()
        left = np.repeat(words.starts()[1:], counts) - np.arange(len(self.chunk))  # tokens to the chunk's end
        last = batch.column("last").to_numpy(zero_copy_only=False)
        self.own = last[self.chunk] | (left > OVERLAP)
        gram, other = (np.array([xxhash.xxh64_intdigest(x, k) for x in langs], np.uint64)[self.chunk] for k in (0, 1))
        whole, word, others = np.ones(len(left), bool), _is_word(words), words.others()
        self.hash, self.other, self.possible = [], [], []
        for n in range(1, longest + 1):
            whole = whole & (left >= n) & _shifted(word, n - 1)
            gram, other = joined(gram, _shifted(words.hashes, n - 1)), mixed(other + _shifted(others, n - 1))
            may = whole
            if n > 2:  # both parts of one word less
                may = whole & self.possible[-1] & _shifted(self.possible[-1], 1)
            table = {2: pairs, 3: triples}.get(n)
            if table is not None:
                may = may.copy()
                at = np.flatnonzero(may)
                may[at] = sieve.passes(table, gram[at])
            self.hash.append(gram)
            self.other.append((other >> np.uint64(32)).astype(np.uint32))
            self.possible.append(may)

    def places(self, n: int) -> np.ndarray:
        """Where possible n-grams of the chunks' own start."""
        return np.flatnonzero(self.possible[n - 1] & self.own)

    def counts(self, n: int, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A place of each possible n-gram, its frequency, and its hash; ``times`` of each chunk."""
        at = self.places(n)
        hashes, first, which = np.unique(self.hash[n - 1][at], return_index=True, return_inverse=True)
        other = self.other[n - 1][at]
        alike = other == other[first][which]
        f = np.bincount(which[alike], times[self.chunk[at[alike]]], len(first)).astype(np.int64)
        # Phrases that share a first hash with another one are told place by place.
        rest = at[~alike]
        return np.concatenate([at[first], rest]), np.concatenate([f, times[self.chunk[rest]]]), np.concatenate([hashes, self.hash[n - 1][rest]])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in together(pc.binary_length(batch.column("chunk")).to_pylist(), COUNTED):
        yield batch.slice(part.start, part.stop - part.start)


_COUNTS = "size int, gram long, other int, f long, first long"


def _counted(chunks: DataFrame, sizes: list[int], sent: list[Broadcast]) -> DataFrame:
    """(size, gram, other, f, first): counts of the n-grams of these sizes that the tables of pairs and triples let through."""

    def make():
        tables = [sieve.opened(t) for t in sent]

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            none = np.zeros(0, np.int64)
            found = [(np.zeros(0, np.int32), none, np.zeros(0, np.int32), none, none)]
            for part in _parts(batch):
                grams = Grams(part, sizes[-1], *tables)
                times, numbers = part.column("times").to_numpy(), part.column("number").to_numpy()
                for n in sizes:
                    at, f, hashes = grams.counts(n, times)
                    other = grams.other[n - 1][at].view(np.int32)
                    found.append((np.full(len(at), n, np.int32), hashes.view(np.int64), other, f, numbers[grams.chunk[at]]))
            columns = [pa.array(np.concatenate([row[k] for row in found])) for k in range(5)]
            return pa.RecordBatch.from_arrays(columns, ["size", "gram", "other", "f", "first"])

        return work

    counted = in_arrow(chunks.select("lang", "chunk", "last", "times", "number"), _COUNTS, make)
    return counted.groupBy("size", "gram", "other").agg(F.sum("f").alias("f"), F.min("first").alias("first"))


def read_grams(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(lang, phrase, size, f): the texts of the phrases that a chunk is asked for in ``grams``."""
    langs, texts, sizes, counts = [], [], [], []
    for part in _parts(batch):
        grams = Grams(part, LONGEST)
        lists = part.column("grams")
        row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
        asked = lists.flatten()
        size, gram, other, f = (asked.field(k).to_numpy(zero_copy_only=False) for k in range(4))
        own_langs = part.column("lang").to_pylist()
        for n in range(1, LONGEST + 1):
            mine = np.flatnonzero(size == n)
            at = grams.places(n)

            def keyed(chunk, a, b):
                return joined(joined(mixed(chunk.astype(np.uint64)), a.view(np.uint64)), b.view(np.uint32).astype(np.uint64))

            there, first = np.unique(keyed(grams.chunk[at], grams.hash[n - 1][at], grams.other[n - 1][at]), return_index=True)
            start = at[first[np.searchsorted(there, keyed(row[mine], gram[mine], other[mine]))]]
            texts += grams.words.joined(start, n).to_pylist()
            langs += [own_langs[k] for k in row[mine].tolist()]
            sizes += [n] * len(mine)
            counts += f[mine].tolist()
    columns = [pa.array(langs, pa.string()), pa.array(texts, pa.string()), pa.array(sizes, pa.int32()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "size", "f"])


def frequent_phrases(chunks: DataFrame, least: int) -> DataFrame:
    """(lang, phrase, size, f) of all phrases of one to four words that occur ``least`` times or more.

    ``chunks`` is a stored dictionary.
    """
    found, sent = [], []
    for sizes in ([1, 2], [3], [4]):
        found.append(stored(_counted(chunks, sizes, sent).filter(F.col("f") >= least), "grams"))
        if sizes[-1] < LONGEST:
            sent.append(sieve.sent(found[-1].filter(F.col("size") == sizes[-1]), "gram"))
    every = found[0].unionByName(found[1]).unionByName(found[2])
    asked = every.groupBy("first").agg(F.collect_list(F.struct("size", "gram", "other", "f")).alias("grams"))  # of one chunk
    held = chunks.select("lang", "chunk", "last", F.col("number").alias("first")).join(asked, "first")
    return in_arrow(held.drop("first"), "lang string, phrase string, size int, f long", lambda: read_grams)


def _top(scored: DataFrame, count: int) -> DataFrame:
    """The first ``count`` of each language with their rank, found in parts first, so that no task sees a whole language."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = Window.partitionBy("lang", "part").orderBy(*order)
    some = scored.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(_PARTS)))
    some = some.withColumn("rank", F.row_number().over(parts)).filter(F.col("rank") <= count)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= count)


def collocations(docs: DataFrame, least: int = 30, count: int = 2000, inside_percent: int = 80) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``count`` best phrases of two to four words.

    ``a`` is the phrase's frequency, ``l`` and ``r`` those of its two parts at the cut with the lowest score,
    floor(2000000 a / (l + r)). Phrases whose words lie inside a longer one that has ``inside_percent`` of
    their occurrences are left out. A null lang is ``und``; null and empty texts have no words; repeated rows count each.
    An empty table gives no row; other columns are ignored.
    """
    ship(docs.sparkSession)
    chunks = stored(dictionary(docs), "chunks", "zstd")
    totals = chunks.groupBy("lang").agg(F.sum(F.col("words") * F.col("times")).alias("n"))
    found = stored(frequent_phrases(chunks, least), "phrases")
    phrases = found.filter("size > 1")
    part = F.split("phrase", " ")
    cut = phrases.select("lang", "phrase", "size", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cut = cut.withColumns(
        {"first": F.array_join(F.slice(part, 1, F.col("k")), " "), "rest": F.array_join(F.slice(part, F.col("k") + 1, F.col("size") - F.col("k")), " ")}
    )
    lefts = found.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rights = found.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    score = F.expr("CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(7,0)) div (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))")
    cuts = cut.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"]).withColumn("score", score)
    scored = (
        cuts.groupBy("lang", "phrase", "size", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
        .select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    )
    # The most frequent longer phrase around each phrase.
    places = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda at: F.array_join(F.slice(part, at, n), " ")),
        )
    )
    around = (
        phrases.filter("size > 2")
        .select("lang", F.explode(F.array_distinct(places)).alias("phrase"), "f")
        .groupBy("lang", "phrase")
        .agg(F.max("f").alias("longer"))
    )
    free = scored.join(around, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer") < inside_percent * F.col("a"))
    )
    best = _top(free.drop("longer"), count)
    return best.join(F.broadcast(totals), "lang").select(  # one row for each language
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), totals AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM worded GROUP BY lang
), placed AS (
  SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM worded, (SELECT unnest([1, 2, 3, 4]) AS size) WHERE len(w) >= size
), counted AS (
  SELECT lang, w[i:i + size - 1] AS p, size, count(*) AS f FROM placed GROUP BY lang, p, size HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.p, c.size, c.f AS a, x.size AS k, x.f AS l, y.f AS r,
         CAST((CAST(c.f AS HUGEINT) * 2000000) // (x.f + y.f) AS BIGINT) AS score
  FROM counted c JOIN counted x ON x.lang = c.lang AND x.size < c.size AND x.p = c.p[1:x.size]
  JOIN counted y ON y.lang = c.lang AND y.size = c.size - x.size AND y.p = c.p[x.size + 1:]
  WHERE c.size > 1
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, f, p[i:i + size - 1] AS p
  FROM (SELECT lang, f, p, size, unnest(range(1, own - size + 2)) AS i
        FROM (SELECT lang, f, p, size AS own, unnest(range(2, size)) AS size FROM counted WHERE size > 2))
), longer AS (
  SELECT lang, p, max(f) AS f FROM inner_phrases GROUP BY lang, p
), kept AS (
  SELECT s.lang, array_to_string(s.p, ' ') AS phrase, s.a, s.l, s.r, s.score
  FROM scored s LEFT JOIN longer g ON g.lang = s.lang AND g.p = s.p WHERE g.f IS NULL OR 100 * g.f < 80 * s.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, t.n, score
FROM kept k JOIN totals t ON t.lang = k.lang
QUALIFY rank <= 2000
"""
