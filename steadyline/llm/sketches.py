"""Document fingerprints as invertible Bloom lookup sketches, in DataFrame functions alone.

A text is a set of paragraph digests: each line in pieces of at most ``PIECE_WORDS`` words, hashed to a
long. A sketch has three tables of cells; a digest goes into one cell of each. A cell holds how many
digests it has, their exclusive or, and that of a second hash of them. Sketches of two versions subtract
cell by cell; digests of both cancel. A cell with one digest left and a matching second hash is *pure*:
its digest is read, taken out of its other cells, and so on until nothing is left.

A set is split by digest bits into parts of a few digests each, one small sketch for each part, so cells and
work grow with the text. The fingerprint is these cells as text: :func:`difference` subtracts and peels two
stored fingerprints without their texts. Where both versions are at hand what stays of a part when its peeling stalls is
sketched again, its cells chosen by other bits, and with larger tables in the end.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE_WORDS = 8
PIECE_CHARS = 48  # longer words are cut, so that unspaced text has pieces too
# Cells per table of the sketches that are written, and at the retries.
WRITTEN_CELLS = 4
TABLE_CELLS = (WRITTEN_CELLS, 8, 32, 128, 512)
# Digests of one version that a part is meant for, at most.
PART_DIGESTS = 6
ROUNDS = 8
# Documents of a range of ids that meets in one window, about; ranges whose borders are looked up.
_RANGE_ROWS = 2000
_COARSE = 500

_WORD = "[^ \\n]{1," + str(PIECE_CHARS) + "}"
_PIECE = f"{_WORD}(?: {_WORD}){{0,{PIECE_WORDS - 1}}}"
# Bits of a digest that choose its cell in each table; the low bits choose the part. The written sketches take two bits
# from each of these places; what stalls is tried again with the next two bits, so many times in all.
_SHIFTS = (22, 36, 50)
_TRIES = 4

Cells = Column


def _with(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once, however often ``then`` uses it, and not copied."""
    return F.aggregate(F.array(), value, lambda x, _: x, then)


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text; an empty text has none."""
    pieces = F.regexp_extract_all(text, F.lit(_PIECE), F.lit(0))
    return F.array_distinct(F.transform(pieces, lambda p: F.xxhash64(p)))


def _cell(digest: Column, table: int, cells: int, above: Column | None = None) -> Column:
    bits = F.shiftright(digest, _SHIFTS[table])
    if above is not None:
        bits = F.call_function("shiftright", digest, above + _SHIFTS[table])
    return bits.bitwiseAND(F.lit(cells - 1).cast("long"))


def _nothing() -> Column:
    zero = F.lit(0).cast("long")
    return F.struct(zero.alias("n"), zero.alias("key"), zero.alias("check"))


def _combined(x: Column, y: Column, sign: int = 1) -> Column:
    n = x["n"] + y["n"] if sign > 0 else x["n"] - y["n"]
    return F.struct(
        n.alias("n"), x["key"].bitwiseXOR(y["key"]).alias("key"), x["check"].bitwiseXOR(y["check"]).alias("check")
    )


def _placed(entries: Column, cells: int, above: Column | None = None) -> Column:
    return F.transform(
        entries,
        lambda e: F.struct(
            e["n"], e["key"], e["check"], *[_cell(e["key"], t, cells, above).alias(f"c{t}") for t in range(3)]
        ),
    )


def _total(entries: Column) -> Column:
    """The cell that holds these entries."""

    def xor(entries: Column, field: str) -> Column:
        return F.aggregate(entries, F.lit(0).cast("long"), lambda x, e: x.bitwiseXOR(e[field]))

    n = F.aggregate(entries, F.lit(0).cast("long"), lambda x, e: x + e["n"])
    some = F.struct(n.alias("n"), xor(entries, "key").alias("key"), xor(entries, "check").alias("check"))
    return F.when(F.size(entries) == 0, _nothing()).otherwise(some)


def sketch(entries: Column, cells: int, above: Column | None = None) -> Cells:
    """Three tables of ``cells`` cells, one after the other, over entries (n, key, check).

    ``above`` takes the bits that choose a cell from so many places higher.
    """

    def table(placed: Column, t: int) -> Column:
        return F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(cells - 1).cast("long")),
            lambda i: _with(F.filter(placed, lambda e: e[f"c{t}"] == i), _total),
        )

    return _with(_placed(entries, cells, above), lambda placed: F.flatten(F.array(*[table(placed, t) for t in range(3)])))


def as_entries(keys: Column, n: int = 1) -> Column:
    return F.transform(
        keys, lambda k: F.struct(F.lit(n).cast("long").alias("n"), k.alias("key"), F.xxhash64(k).alias("check"))
    )


def subtract(a: Cells, b: Cells) -> Cells:
    return F.zip_with(a, b, lambda x, y: _combined(x, y, -1))


def _pure(cell: Column) -> Column:
    return (F.abs(cell["n"]) == 1) & (F.xxhash64(cell["key"]) == cell["check"])


def _empty(cell: Column) -> Column:
    return (cell["n"] == 0) & (cell["key"] == 0)


def _peeled(difference: Cells, cells: int, above: Column | None = None, most: Column | None = None) -> Column:
    """(cells, found): the digests that peeling finds, and the cells that hold something without them.

    The tables take turns. The pure cells of one table hold different digests, which are taken out of all three, each
    out of its own cell alone. ``most`` is how many digests can be found, where that is known: a round finds some or is
    the last. Arrays are put together by ``flatten``, which costs much less than ``concat`` inside a lambda.
    """
    tables = ("t0", "t1", "t2")

    def without(own: Column, pure: Column, t: int) -> Column:
        def taken(own: Column, e: Column) -> Column:
            at = _cell(e["key"], t, cells, above).cast("int")
            return _with(at, lambda i: F.transform(own, lambda c, j: F.when(j == i, _combined(c, e, -1)).otherwise(c)))

        return F.aggregate(pure, own, taken)

    def turn(state: Column, t: int) -> Column:
        def after(pure: Column) -> Column:
            less = [without(state[name], pure, u).alias(name) for u, name in enumerate(tables)]
            return F.when(F.size(pure) == 0, state).otherwise(F.struct(*less, F.flatten(F.array(state["found"], pure)).alias("found"), state["done"]))

        return _with(F.filter(state[tables[t]], _pure), after)

    def round_of(before: Column) -> Column:
        def ended(state: Column) -> Column:
            rest = [F.filter(state[name], lambda c: ~_empty(c)).alias(name) for name in tables]
            end = F.struct(*rest, state["found"], F.lit(True).alias("done"))
            idle = F.size(state["found"]) == F.size(before["found"])
            return F.when(idle | ~F.exists(state["t0"], lambda c: ~_empty(c)), end).otherwise(state)

        return _with(turn(before, 0), lambda x: _with(turn(x, 1), lambda y: _with(turn(y, 2), ended)))

    def start(c: Column) -> Column:
        own = [F.slice(c, t * cells + 1, cells).alias(name) for t, name in enumerate(tables)]
        return F.struct(*own, F.slice(c, 1, 0).alias("found"), F.lit(False).alias("done"))

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    if most is not None:
        rounds = F.slice(rounds, F.lit(1), F.least(F.greatest(most, F.lit(1)), F.lit(ROUNDS)))
    return F.aggregate(
        rounds,
        _with(difference, start),
        lambda state, _: F.when(state["done"], state).otherwise(round_of(state)),
        lambda state: F.struct(F.flatten(F.array(*[state[name] for name in tables])).alias("cells"), state["found"].alias("found")),
    )


def _clear(cells: Cells) -> Column:
    return ~F.exists(cells, lambda c: ~_empty(c))


def peel(difference: Cells, cells: int) -> Column:
    """The digests (n, key, check) that differ, n 1 or -1 by the version that has them; null where peeling stalls."""
    return _with(_peeled(difference, cells), lambda state: F.when(_clear(state["cells"]), state["found"]))


def _differing_in_part(part: Column) -> Column:
    """How many digests of a part, entries with n 1 or -1 by their version, only one version has.

    What stays when peeling stalls is sketched again by other bits, then in larger tables. Should the largest stall
    as well, the digests themselves are compared.
    """

    def again(state: Column, above: Column) -> Column:
        def after(peeled: Column) -> Column:
            stay = F.filter(state["rest"], lambda e: ~F.exists(peeled["found"], lambda f: f["key"] == e["key"]))
            none = F.filter(state["rest"], lambda _: F.lit(False))
            return F.struct(
                F.when(_clear(peeled["cells"]), none).otherwise(stay).alias("rest"),
                (state["found"] + F.size(peeled["found"])).alias("found"),
            )

        peeled = _peeled(sketch(state["rest"], WRITTEN_CELLS, above), WRITTEN_CELLS, above, F.size(state["rest"]))
        return F.when(F.size(state["rest"]) == 0, state).otherwise(_with(peeled, after))

    def larger(rest: Column) -> Column:
        tries = [_with(peel(sketch(rest, c), c), lambda f: F.when(f.isNotNull(), F.size(f))) for c in TABLE_CELLS[1:]]
        single = F.filter(rest, lambda e: ~F.exists(rest, lambda o: (o["key"] == e["key"]) & (o["n"] != e["n"])))
        return F.coalesce(*tries, F.size(single))

    def result(state: Column) -> Column:
        return F.when(F.size(state["rest"]) == 0, state["found"]).otherwise(state["found"] + larger(state["rest"]))

    start = F.struct(part.alias("rest"), F.lit(0).alias("found"))
    return F.aggregate(F.array(*[F.lit(2 * k) for k in range(_TRIES)]), start, again, result)


def part_bits(digests: Column) -> Column:
    """How many low bits of a digest number the parts of its set."""
    return F.ceil(F.log2(F.greatest(F.lit(1.0), F.size(digests) / PART_DIGESTS))).cast("int")


def _per_part(entries: Column, bits: Column, then: Callable[[Column, Column], Column]) -> Column:
    """``then`` of the entries of each part that has some, in ascending order of the part's number, and of how many
    parts without any come before it.

    Entries are sorted by their part's number and place, so that a part is a slice.
    """
    place = (1 << 31) - 1

    def number(code: Column) -> Column:
        return F.shiftright(code, 31)

    def slices(v: Column, codes: Column, starts: Column) -> Column:
        def part(start: Column, j: Column) -> Column:
            size = F.coalesce(F.get(starts, j + 1), F.size(codes)) - start
            own = F.transform(
                F.slice(codes, start + 1, size), lambda c: F.get(v["entries"], c.bitwiseAND(F.lit(place).cast("long")).cast("int"))
            )
            before = F.when(start == 0, F.lit(-1).cast("long")).otherwise(number(F.get(codes, start - 1)))
            return then(own, number(F.get(codes, start)) - before - 1)

        return F.transform(starts, part)

    def sorted_codes(v: Column) -> Column:
        codes = F.transform(v["entries"], lambda e, i: F.shiftleft(e["key"].bitwiseAND(v["mask"]), 31).bitwiseOR(i.cast("long")))
        return F.sort_array(codes)

    def starts_of(codes: Column) -> Column:
        first = F.transform(codes, lambda c, i: F.when((i == 0) | (number(c) != number(F.get(codes, i - 1))), i))
        return F.filter(first, lambda i: i.isNotNull())

    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    return _with(
        F.struct(entries.alias("entries"), mask.alias("mask")),
        lambda v: _with(sorted_codes(v), lambda codes: _with(starts_of(codes), lambda starts: slices(v, codes, starts))),
    )


def differing(a: Column, b: Column) -> Column:
    """Digests that only one of two versions has, by sketches of their parts, those of the larger version.

    The cells of both versions are put together with opposite signs, which is the subtraction of their sketches.
    """
    entries = F.concat(as_entries(a), as_entries(b, -1))
    each = _per_part(entries, F.greatest(part_bits(a), part_bits(b)), lambda part, _: _differing_in_part(part))
    return F.aggregate(each, F.lit(0).cast("long"), lambda x, y: x + y)


def likeness(a: Column, b: Column) -> Column:
    """Shared digests over all digests of both versions, from their difference; 1 where both are empty."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(1.0 - differing(a, b) / total)


_CELL_DIGITS = 40


def written(digests: Column) -> Column:
    """The sketches of a set's parts as hexadecimal text: the number of part bits, then n, key and check of each cell."""

    def as_text(c: Column) -> Column:
        some = F.concat(F.lpad(F.hex(c["n"]), 8, "0"), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(c["check"]), 16, "0"))
        return F.when(c["n"] == 0, "0" * _CELL_DIGITS).otherwise(some)

    digits = 3 * WRITTEN_CELLS * _CELL_DIGITS  # of a part

    def text_of(part: Column, without: Column) -> Column:
        own = F.array_join(F.transform(sketch(part, WRITTEN_CELLS), as_text), "")
        return F.concat(F.repeat(F.lit("0"), (without * digits).cast("int")), own)

    bits = part_bits(digests)
    parts = F.array_join(_per_part(as_entries(digests), bits, text_of), "")
    length = F.call_function("shiftleft", F.lit(digits), bits)
    return F.lower(F.concat(F.lpad(F.hex(bits), 2, "0"), F.rpad(parts, length, F.lit("0"))))


def _long(digits: Column) -> Column:
    """A long from its sixteen hexadecimal digits."""
    half = [F.conv(F.substring(digits, at, 8), 16, 10).cast("long") for at in (1, 9)]
    return F.shiftleft(half[0], 32).bitwiseOR(half[1])


def _read(fingerprint: Column, bits: Column) -> Column:
    """The parts of a written fingerprint, added up to ``2 ** bits`` parts: cells are sums, so parts add up."""
    own = F.conv(F.substring(fingerprint, 1, 2), 16, 10).cast("int")
    width = 3 * WRITTEN_CELLS

    def cell(i: Column) -> Column:
        at = (i * _CELL_DIGITS + 3).cast("int")
        return F.struct(
            F.conv(F.substring(fingerprint, at, F.lit(8)), 16, 10).cast("long").alias("n"),
            _long(F.substring(fingerprint, at + 8, F.lit(16))).alias("key"),
            _long(F.substring(fingerprint, at + 24, F.lit(16))).alias("check"),
        )

    def part(p: Column) -> Column:
        fold = F.sequence(F.lit(0).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), own - bits) - 1)
        step = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
        return F.transform(
            F.sequence(F.lit(0).cast("long"), F.lit(width - 1).cast("long")),
            lambda i: F.aggregate(fold, _nothing(), lambda x, j: _combined(x, cell((p + j * step) * width + i))),
        )

    numbers = F.sequence(F.lit(0).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)
    return F.transform(numbers, part)


def difference(a: Column, b: Column) -> Column:
    """(only_a, only_b): the digests that one of two stored fingerprints has and the other lacks; null where peeling stalls.

    The finer of the two is added up to the parts of the coarser. After a stall, :func:`differing` with both
    sets of digests goes on with larger tables.
    """
    bits = F.least(*[F.conv(F.substring(f, 1, 2), 16, 10).cast("int") for f in (a, b)])
    parts = F.zip_with(_read(a, bits), _read(b, bits), lambda x, y: peel(subtract(x, y), WRITTEN_CELLS))

    def keys(found: Column, n: int) -> Column:
        return F.transform(F.filter(found, lambda c: c["n"] == n), lambda c: c["key"])

    def sides(found: Column) -> Column:
        return F.when(found.isNotNull(), F.struct(keys(found, 1).alias("only_a"), keys(found, -1).alias("only_b")))

    # flatten of parts with a null among them is null
    return _with(F.flatten(parts), sides)


def _edges(docs: DataFrame) -> tuple[list[int], int]:
    """Borders of at most ``_COARSE`` ranges of doc_id with about as many rows each, and their fine parts.

    The last border is beyond the largest id. Only these few numbers reach the driver.
    """
    rows = docs.agg(F.count("doc_id").alias("n")).first().n
    coarse = max(1, min(_COARSE, rows // _RANGE_ROWS))
    shares = F.array(*[F.lit(i / coarse) for i in range(coarse + 1)])
    found = docs.agg(F.percentile_approx("doc_id", shares, 10_000).alias("q")).first().q or [0]
    return sorted({*found[:-1], found[-1] + 1} if len(found) > 1 else {found[0], found[0] + 1}), -(-rows // (coarse * _RANGE_ROWS)) or 1


def _range_of(doc_id: Column, edges: list[int], parts: int) -> Column:
    """The number of an id's range: never smaller for a larger id, -1 for null; a function of the id alone."""
    borders = F.array(*[F.lit(e).cast("long") for e in edges])
    coarse = F.size(F.filter(borders, lambda e: e <= doc_id))
    low, high = F.get(borders, coarse - 1), F.get(borders, coarse)
    fine = F.least(F.lit(parts - 1), F.floor((doc_id - low) / (high - low) * parts))
    return F.when(doc_id.isNull(), -1).otherwise(coarse.cast("long") * parts + fine)


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, next): every text with that of the next document in ascending doc_id; the first follows the last.

    Null texts count as empty, null ids come first, equal ids follow the order of their texts' hash. Rows are
    dealt out by ranges of doc_id and looked at within their range; only the first text of each range
    travels to the range before it.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    edges, parts = _edges(read)
    ranged = read.withColumns({"tie": F.xxhash64("text"), "range": _range_of(F.col("doc_id"), edges, parts)})
    heads = ranged.groupBy("range").agg(F.min_by("text", F.struct("doc_id", "tie")).alias("head"))
    # The numbers of the ranges alone, one narrow row for some two thousand documents.
    order = Window.orderBy("range")
    first = F.min("range").over(order.rowsBetween(Window.unboundedPreceding, 0))
    follower = ranged.select("range").distinct().select("range", F.coalesce(F.lead("range").over(order), first).alias("follower"))
    border = follower.join(heads.select(F.col("range").alias("follower"), "head"), "follower").select("range", "head")
    within = Window.partitionBy("range").orderBy("doc_id", "tie")
    return (
        ranged.withColumns({"next": F.lead("text").over(within), "last": F.lead(F.lit(False), 1, True).over(within)})
        .join(border, "range")
        .select("doc_id", "text", F.when(F.col("last"), F.col("head")).otherwise(F.col("next")).alias("next"))
    )


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The edited text is the text with its last ``n_chars // 2`` code points replaced by the first as many of the
    next document. A null or empty text has no digest, an empty sketch and likeness 1 to another such. Repeated
    rows have equal fingerprints; other columns are ignored.
    """
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - char_length(text) div 2)"), F.substring("next", F.lit(1), half))
    rows = (
        with_next(docs)
        .withColumn("n_chars", n.cast("long"))
        .withColumn("edited", edited)
        .select(
            "doc_id",
            "n_chars",
            F.sha2("edited", 256).alias("edited_sha256"),
            digests(F.col("text")).alias("own"),
            digests(F.col("edited")).alias("changed"),
            digests(F.col("next")).alias("following"),
        )
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("own")).alias("fingerprint"),
        written(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
