"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Links are given as memberships (node, link): nodes with a link in common are neighbours, so a group of
any size needs no pairs. Law ``rows``: shard counts differ by at most one. All steps are joins and
aggregates of narrow rows.

Propagation goes on until no move is admitted or the cut stops falling; shards may run over by ``SLACK`` meanwhile, since
between full shards nothing could move. Then the shards are settled. What a link has in a label is a unit, in
pieces of at most a shard; each shard keeps its largest units while they fit, the others go whole to
where there is room, and only units that fit nowhere are split over the last free slots. The driver
sees numbers for each shard and the counts of units by shard and size, of which there are at most about
the square root of twice the rows for each shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from steadyline.llm.grouping import stored

ROUNDS = 12
SLACK = 1.25
# Documents of about this number share a window when they are numbered, or a join key when they have one link.
_BUCKET_ROWS = 2000
# A link is heavy beyond this share of all memberships, and its members are dealt to so many join keys.
_HEAVY_SHARE, _HEAVY_KEYS = 1000, 64


def numbered(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """Gapless numbers from 0 within ``group``, without gathering a group in one task.

    Rows are dealt into buckets by a hash of ``order``; a row's number is that within its bucket after
    all rows of earlier buckets. Rows equal in ``order`` get different numbers in some order.
    """
    buckets = max(1, rows.count() // _BUCKET_ROWS)
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(*group, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy(*group, "bucket").orderBy(*order)
    return (
        dealt.withColumn(name, F.row_number().over(within).cast("long") - 1)
        .join(bases, [*group, "bucket"])
        .withColumn(name, F.col(name) + F.col("base"))
        .drop("bucket", "base")
    )


def _by_shard(values: dict[int, int], shards: int) -> Column:
    return F.array(*[F.lit(values.get(s, 0)).cast("long") for s in range(shards)])


def _share(*columns: str) -> Column:
    """A number in [0, 1) fixed by a hash."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << 20)) / float(1 << 20)


def _salted(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, link, salt) and (link, salt): members of a heavy link are dealt to several keys, others have salt 0."""
    total = members.count()
    bar = max(_BUCKET_ROWS, total // _HEAVY_SHARE)
    sizes = members.groupBy("link").agg(F.count(F.lit(1)).alias("n"))
    heavy = stored(sizes.filter(F.col("n") > bar).select("link", F.lit(True).alias("heavy")), "heavy")
    marked = members.join(F.broadcast(heavy), "link", "left")  # at most `_HEAVY_SHARE` links
    salt = F.when(F.col("heavy"), F.pmod(F.xxhash64("node"), F.lit(_HEAVY_KEYS))).otherwise(F.lit(0)).cast("int")
    members = stored(marked.select("node", "link", salt.alias("salt")), "salted")
    return members, members.select("link", "salt").distinct()


def propagate(members: DataFrame, shards: int, capacity: int, rounds: int = ROUNDS) -> DataFrame:
    """(node, label) for every linked node: label propagation with about ``SLACK * capacity`` nodes for a label at most.

    ``members`` holds (node, link). Labels start at a hash of the node. In each round a link ranks the labels
    by how many of its members have them, and its members fill these labels in that order as far as
    there is room, at most ``capacity`` of them in each; a member goes where most of its links put it. Moves into a label beyond
    its room are thinned by a hash, those with the most neighbours there first. Work per round follows the memberships.
    """
    members, keys = _salted(members)
    keys = stored(keys, "keys")
    quota = int(capacity * SLACK) + 1
    labels = stored(
        members.select("node").distinct().select("node", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(shards)).cast("int").alias("label")),
        "labels",
    )
    least_cut, best = None, labels
    for _ in range(rounds + 1):
        joined = members.join(labels, "node")
        counts = stored(joined.groupBy("link", "label").agg(F.count(F.lit(1)).alias("n")), "counts")
        # Labels of a link beyond its first one, and beyond those that its size needs.
        needed = F.ceil(F.sum("n") / max(1, capacity))
        cut = counts.groupBy("link").agg((F.count(F.lit(1)) - needed).alias("cut")).agg(F.sum(F.greatest("cut", F.lit(0)))).first()[0]
        if least_cut is not None and cut >= least_cut:
            break
        least_cut, best = cut, labels
        if not cut:
            break
        held = {r.label: r.n for r in labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        room = {s: max(0, quota - held.get(s, 0)) for s in range(shards)}
        # Of a link: its size and its labels, most members first, each with the members it can hold. Every
        # label is ranked, at most `shards` of them; equal counts follow a hash, so links spread evenly.
        ranked = counts.groupBy("link").agg(F.sum("n").alias("size"), F.map_from_entries(F.collect_list(F.struct("label", "n"))).alias("of"))
        every = F.transform(
            F.sequence(F.lit(0), F.lit(shards - 1)),
            lambda s: F.struct(
                (-F.coalesce(F.col("of")[s], F.lit(0).cast("long"))).alias("less"),
                F.xxhash64("link", s).alias("tie"),
                s.alias("label"),
                F.least(
                    F.coalesce(F.col("of")[s], F.lit(0).cast("long")) + F.get(_by_shard(room, shards), s), F.lit(capacity).cast("long")
                ).alias("holds"),
            ),
        )
        filled = F.aggregate(
            F.array_sort(every),
            F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<struct<label:int,until:bigint,n:bigint>>").alias("out")),
            lambda state, x: F.when(state["total"] >= F.col("size"), state).otherwise(
                F.struct(
                    (state["total"] + x["holds"]).alias("total"),
                    F.concat(
                        state["out"],
                        F.array(F.struct(x["label"].alias("label"), (state["total"] + x["holds"]).alias("until"), (-x["less"]).alias("n"))),
                    ).alias("out"),
                )
            ),
            lambda state: state["out"],
        )
        wishes = ranked.select("link", "size", filled.alias("places")).join(keys, "link")
        # A member already in one of the link's labels stays; others go by their share of the link.
        place = F.coalesce(
            F.get(F.filter("places", lambda p: p["label"] == F.col("label")), F.lit(0)),
            F.get(F.filter("places", lambda p: p["until"] > F.col("share") * F.col("size")), F.lit(0)),
            F.get(F.col("places"), F.lit(0)),
        )
        wanted = (
            joined.join(wishes, ["link", "salt"])
            .withColumn("share", _share("node", "link"))
            .select("node", "label", place.alias("p"))
            .groupBy("node", "label", F.col("p.label").alias("goal"))
            .agg(F.sum("p.n").alias("gain"))
            .groupBy("node", "label")
            .agg(F.max_by("goal", F.struct("gain", "goal")).alias("goal"), F.max("gain").alias("gain"))
        )
        wanted = stored(wanted.withColumn("share", _share("node")), "wishes")
        # Room of a label: what was free and what leaves it. A histogram of arrivals by gain and hash says
        # from which mark on they are turned away; equal marks come in or stay out together.
        moves = wanted.filter("goal <> label")
        leaving = {r.label: r.n for r in moves.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        mark = (F.floor(F.log2(F.greatest(F.lit(1.0), F.col("gain").cast("double")))) * -1024 + F.floor(F.col("share") * 1024)).cast("int")
        arrivals = moves.groupBy("goal", mark.alias("mark")).agg(F.count(F.lit(1)).alias("n"))
        up_to = Window.partitionBy("goal").orderBy("mark").rowsBetween(Window.unboundedPreceding, 0)
        total_room = {s: room[s] + leaving.get(s, 0) // 2 for s in range(shards)}
        admitted = arrivals.withColumn("upto", F.sum("n").over(up_to)).filter(
            F.col("upto") <= F.get(_by_shard(total_room, shards), F.col("goal"))
        )
        last = admitted.groupBy("goal").agg(F.max("mark").alias("last"))
        bounds = {r.goal: r.last for r in last.collect()}
        if not bounds:
            break
        none = -(1 << 30)
        bound = F.array(*[F.lit(bounds.get(s, none)) for s in range(shards)])
        moving = (F.col("goal") != F.col("label")) & (mark <= F.get(bound, F.col("goal")))
        labels = stored(wanted.select("node", F.when(moving, F.col("goal")).otherwise(F.col("label")).alias("label")), "labels")
    return best


def settle(counts: dict[tuple[int, int], int], room: list[int]) -> tuple[list[tuple[int, int, int, int, int, int]], list[int], int]:
    """Where units go, as (label, size, low, high, shard, base): units low to high - 1 of a label and size, one after another.

    ``counts`` of units by (label, size), ``room`` of each shard. Shard -1: split over what is left free, the third
    result being how many rows these are; the second is how much of each shard is used.
    """
    room, used, plan, split = list(room), [0] * len(room), [], 0
    by_size: dict[int, list[tuple[int, int]]] = {}
    for (label, size), n in counts.items():
        by_size.setdefault(size, []).append((label, n))

    def put(label: int, size: int, low: int, n: int, shard: int) -> int:
        n = min(n, room[shard] // size)
        if n:
            plan.append((label, size, low, low + n, shard, used[shard]))
            used[shard] += n * size
            room[shard] -= n * size
        return low + n

    for size in sorted(by_size, reverse=True):
        left = [(label, put(label, size, 0, n, label), n) for label, n in sorted(by_size[size])]
        for label, low, n in left:
            while low < n:
                shard = max(range(len(room)), key=lambda s: room[s])
                if room[shard] < size:
                    plan.append((label, size, low, n, -1, split))
                    split += (n - low) * size
                    break
                low = put(label, size, low, n - low, shard)
    return plan, used, split


def shard_rows(nodes: DataFrame, members: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(node, shard, slot): every node placed, counts of shards at most one apart, slots gapless from 0.

    ``nodes`` holds distinct nodes, ``members`` (node, link) the links. No node gives no row; with fewer
    nodes than shards the last shards stay empty.
    """
    spark = nodes.sparkSession
    total = nodes.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    piece = max(1, total // shards)
    members = stored(members, "memberships")
    labels = propagate(members, shards, piece, rounds)
    own = members.groupBy("node").agg(F.min("link").alias("link"), F.count(F.lit(1)).alias("links")).join(labels, "node")
    # What is left of a group in several labels comes together where most of it is, if a shard can hold it.
    alone = own.filter("links = 1").groupBy("link", "label").agg(F.count(F.lit(1)).alias("n"))
    homes = alone.groupBy("link").agg(F.max_by("label", F.struct("n", "label")).alias("home"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("labels"))
    homes = homes.filter((F.col("labels") > 1) & (F.col("n") <= piece)).select("link", "home")
    label = F.when(F.col("links") == 1, F.coalesce("home", "label")).otherwise(F.col("label"))
    own = own.join(homes, "link", "left").select("node", "link", label.alias("label"))
    ranked = numbered(own, ["link", "label"], ["node"], "rank")
    units = stored(
        ranked.select("node", "link", "label", F.floor(F.col("rank") / piece).alias("piece"), (F.col("rank") % piece).alias("pos")), "units"
    )
    sizes = units.groupBy("link", "label", "piece").agg(F.count(F.lit(1)).alias("size"))
    pieces = stored(numbered(sizes, ["label", "size"], ["link", "piece"], "k"), "pieces")
    counts = {(r.label, r.size): r.n for r in pieces.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan, used, split = settle(counts, capacity)
    planned = spark.createDataFrame(plan, "label int, size long, low long, high long, shard int, base long")
    starts = pieces.join(planned, ["label", "size"]).filter("k >= low AND k < high")
    # Rows of a large unit meet its start under several keys.
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / _BUCKET_ROWS)))
    starts = starts.select("link", "label", "piece", part.alias("part"), "shard", (F.col("base") + (F.col("k") - F.col("low")) * F.col("size")).alias("base"))
    met = units.withColumn("part", F.floor(F.col("pos") / _BUCKET_ROWS)).join(starts, ["link", "label", "piece", "part"])
    met = stored(met.select("node", "shard", (F.col("base") + F.col("pos")).alias("at")), "placed")
    # Rows of split units, then nodes without links, take the free slots in order of shard.
    others = numbered(nodes.join(members, "node", "left_anti").withColumn("all", F.lit(0)), ["all"], ["node"], "k")
    free = met.filter("shard < 0").select("node", F.col("at").alias("k")).unionByName(others.select("node", (F.col("k") + split).alias("k")))
    bounds, at = [], 0
    for s in range(shards):
        end = at + capacity[s] - used[s]
        bounds.append(F.struct(F.lit(s).alias("shard"), F.lit(at).cast("long").alias("low"), F.lit(end).cast("long").alias("high"), F.lit(used[s]).cast("long").alias("used")))
        at = end
    place = F.get(F.filter(F.array(*bounds), lambda b: (b["low"] <= F.col("k")) & (F.col("k") < b["high"])), F.lit(0))
    filled = free.select("node", place.alias("b"), "k").select("node", "b.shard", (F.col("k") - F.col("b.low") + F.col("b.used")).alias("slot"))
    return met.filter("shard >= 0").select("node", "shard", F.col("at").alias("slot")).unionByName(filled)


def shard_documents(docs: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row; equal texts are linked.

    ``size``: UTF-8 bytes plus 8; a null text has none and the crc32 of nothing, 0. Null texts and empty texts are
    one text. Repeated rows are rows of their own and placed one by one. An empty table gives no row. ``grown_shard`` is null
    under the law ``rows``. Other columns are ignored.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("node"),
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 8).alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.substring(F.sha2(text, 256), 1, 32).alias("link"),
    )
    rows = stored(rows, "documents")  # which fixes the numbers
    groups = rows.groupBy("link").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("link")
    members = rows.select("node", "link").join(groups, "link", "left_semi")
    placed = shard_rows(rows.select("node"), members, shards, rounds)
    return placed.join(rows, "node").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
