"""Mixing sources to target weights by a Pfair schedule of source blocks."""

from __future__ import annotations

import bisect
import heapq
import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator, Mapping
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.llm.common import salted_rank, whole_row

BLOCK = 16  # documents; more where there would be over MOST_BLOCKS blocks
MOST_BLOCKS = 1 << 20  # that the driver schedules
MOST_CUTS = 1 << 20  # sources x ranges of slots, in `mix`
GROUP = 1 << 12  # rows of a source that are ranked in one task, about
CHUNK = 64  # blocks of a source whose slots are broadcast in one row
SHARES = 1000  # of whole_shares
ENDS = ("repeat", "stop", "rest")


def whole_shares(weights: Mapping[str, float], total: int = SHARES) -> dict[str, int]:
    """Weights as whole numbers of at least 1 that add up to total, by largest remainders, ties by name."""
    if len(weights) > total:
        raise ValueError(f"{len(weights)} sources; at most {total} have a whole share")
    whole = sum(weights.values())
    exact = {k: w * total / whole for k, w in weights.items()}
    shares = {k: max(1, int(x)) for k, x in exact.items()}
    while (rest := total - sum(shares.values())) != 0:
        if rest > 0:
            for k in sorted(exact, key=lambda k: (shares[k] - exact[k], k))[:rest]:
                shares[k] += 1
        else:
            for k in sorted((k for k in exact if shares[k] > 1), key=lambda k: (exact[k] - shares[k], k))[:-rest]:
                shares[k] -= 1
    return shares


def pfair(weights: Mapping[str, float], blocks: Mapping[str, int], end: str = "rest") -> Iterator[tuple[str, int, int, int, int]]:
    """The schedule of so many blocks of each source, by slots: rows (source, k, release, deadline, slot), k from 0 in its source.

    Block k of a source with weight w of W in all may run from floor(kW/w) and must run before ceil((k+1)W/w). In each
    slot the released block of the earliest deadline runs (ties: smaller source's name). Weights are taken as exact
    fractions, so this meets every deadline, and while no source has run out a source's blocks so far differ from its
    due share by less than one, however long the schedule. What happens when a source has run out is the caller's choice:

    repeat: it begins anew, and k goes on, until every source has run once; the weights hold to the last slot.
    stop: the schedule ends before the first slot that would need a missing block; the weights hold to there.
    rest: its blocks are missing, the others keep their windows, and slots without a released block stay empty; every
    block runs once, and the weights hold until the first source has run out.
    """
    if end not in ENDS:
        raise ValueError(f"{end!r} is none of {ENDS}")
    exact = {name: Fraction(w) for name, w in weights.items() if blocks.get(name)}
    if not exact:
        return
    scale = math.lcm(*(x.denominator for x in exact.values()))
    own = {name: int(x * scale) for name, x in exact.items()}
    whole = sum(own.values()) if end == "repeat" else int(sum(map(Fraction, weights.values())) * scale)
    last = max(-(-blocks[name] * whole // w) for name, w in own.items()) if end == "repeat" else None
    coming = [(0, -(-whole // w), name, 0) for name, w in own.items()]
    heapq.heapify(coming)
    ready: list[tuple[int, str, int, int]] = []
    slot = 0
    while (coming or ready) and slot != last:
        if not ready:
            slot = max(slot, coming[0][0])
        while coming and coming[0][0] <= slot:
            release, deadline, name, k = heapq.heappop(coming)
            heapq.heappush(ready, (deadline, name, k, release))
        deadline, name, k, release = heapq.heappop(ready)
        if slot >= deadline:
            raise AssertionError("a deadline is missed")
        if end == "stop" and k >= blocks[name]:
            return
        yield name, k, release, deadline, slot
        if end != "rest" or k + 1 < blocks[name]:
            heapq.heappush(coming, ((k + 1) * whole // own[name], -(-(k + 2) * whole // own[name]), name, k + 1))
        slot += 1


def pfair_period(shares: Mapping[str, int]) -> list[tuple[str, int, int, int, int]]:
    """The schedule of whole shares up to where it repeats, after as many slots as they add up to."""
    return list(pfair(shares, shares, "stop"))


def counted_weights(docs: DataFrame, source_col: str = "source", power: float = 1.0) -> dict[str, float]:
    """Documents of each source to the power; 1 keeps the sources' own proportions. One row per source comes to the driver."""
    rows = docs.groupBy(F.coalesce(F.col(source_col), F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["source"]: float(r["n"]) ** power for r in rows}


def targets(weights: Mapping[str, float] | None, counts: Mapping[str, float], block: int, end: str) -> tuple[dict[str, float], int, dict[str, int]]:
    """A weight for each counted source, the block size, and each source's blocks.

    A source's weight is the given one or, where it is missing or not positive, the least of the given ones; without
    weights it is the source's own count of blocks, so that all run out together. Blocks hold `block` documents, or so
    many more that all epochs of all sources make at most MOST_BLOCKS blocks (and one a source).
    """
    least = min([w for w in weights.values() if w > 0], default=1.0) if weights else 1.0
    given = {s: weights[s] if weights.get(s, 0) > 0 else least for s in counts} if weights is not None else None
    documents = sum(counts.values())
    if given and end == "repeat":
        documents = max(counts[s] * sum(given.values()) / given[s] for s in counts)
    block = max(block, math.ceil(documents / MOST_BLOCKS))
    blocks = {s: -(-int(n) // block) for s, n in counts.items()}
    return given or {s: float(n) for s, n in blocks.items()}, block, blocks


def schedule(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, id_col: str = "doc_id", source_col: str = "source", end: str = "repeat") -> DataFrame:
    """One row per document and epoch: doc_id, source, epoch, block, release, deadline, slot, place, deviation.

    A source's documents get blocks of `block` (see targets) in a fixed pseudo-random order; every block has its slot,
    release and deadline in the schedule of all blocks under the exact weights; place is 0-based within the block;
    deviation is how many blocks the source is ahead of its due share after the slot, always between -1 and 1 while the
    weights hold. With `end` "repeat" (see pfair) every document comes at least once and the target weights hold over the
    whole output; with "rest" every document comes once; with "stop" those after the first source's end are left out.
    A null source counts as the source ''. Sources without a weight get the smallest weight. Without weights the sources'
    own proportions are the target, under which all run out together. Repeated rows have places of their own.

    One row per source comes to the driver; it schedules at most MOST_BLOCKS blocks, whose slots are broadcast.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"))
    counts = counted_weights(rows)
    if not counts:
        return spark.createDataFrame([], "doc_id long, source string, epoch long, block long, release long, deadline long, slot long, place int, deviation double")
    target, block, blocks = targets(weights, counts, block, end)
    plan = list(pfair(target, blocks, end))
    ranked = salted_rank(rows, "source", ["doc_id"], max(1, -(-int(max(counts.values())) // GROUP)), "_rank")
    again = in_epochs(ranked, plan, blocks, block)
    due = spark.createDataFrame([(s, target[s] / sum(target.values())) for s in counts], "source string, _due double")
    placed = with_slots(again, plan, block, ("release", "deadline", "slot")).join(F.broadcast(due), "source")
    return placed.select(
        "doc_id", "source", "epoch", (F.col("block") - F.col("epoch") * F.col("_blocks")).alias("block"), "release", "deadline", "slot", "place", (F.col("block") + 1 - F.col("_due") * (F.col("slot") + 1)).alias("deviation")
    )


def epochs_of(plan: Iterable[tuple[str, int, int, int, int]], blocks: Mapping[str, int]) -> dict[str, int]:
    """How often each source begins in a schedule."""
    epochs = dict.fromkeys(blocks, 0)
    for s, k, *_ in plan:
        epochs[s] = max(epochs[s], k // blocks[s] + 1)
    return epochs


def in_epochs(ranked: DataFrame, plan: list[tuple[str, int, int, int, int]], blocks: Mapping[str, int], block: int) -> DataFrame:
    """Rows (source, _rank) once for each epoch of their source, _rank going on from epoch to epoch."""
    table = [(s, e, blocks[s]) for s, n in epochs_of(plan, blocks).items() for e in range(n)]
    epochs = ranked.sparkSession.createDataFrame(table, "source string, epoch long, _blocks long")
    return ranked.join(F.broadcast(epochs), "source").withColumn("_rank", F.col("_rank") + F.col("epoch") * F.col("_blocks") * block)


def with_slots(ranked: DataFrame, scheduled: Iterable[tuple[str, int, int, int, int]], block: int, names: tuple[str, ...]) -> DataFrame:
    """Rows (source, _rank) with block, place and the named ones of release, deadline and slot; rows without a slot go.

    They are broadcast as arrays over CHUNK blocks of a source: 8 bytes a block and name.
    """
    picked = [("release", "deadline", "slot").index(n) + 2 for n in names]
    lists: dict[tuple[str, int], list[list[int]]] = defaultdict(lambda: [[] for _ in names])
    for row in scheduled:
        for values, i in zip(lists[row[0], row[1] // CHUNK], picked, strict=True):
            values.append(row[i])
    keys = list(lists)
    columns = [pa.array([s for s, _ in keys], pa.string()), pa.array([c for _, c in keys], pa.int64())]
    columns += [pa.array([lists[key][i] for key in keys], pa.list_(pa.int64())) for i in range(len(names))]
    table = ranked.sparkSession.createDataFrame(pa.Table.from_arrays(columns, ["source", "_chunk", *[f"_{n}" for n in names]]))
    blocks = ranked.withColumn("block", F.floor(F.col("_rank") / block)).withColumn("place", F.pmod("_rank", F.lit(block)).cast("int")).withColumn("_chunk", F.floor(F.col("block") / CHUNK))
    at = F.pmod("block", F.lit(CHUNK)).cast("int")
    others = [c for c in blocks.columns if c not in ("source", "_chunk", "place")]
    found = blocks.join(F.broadcast(table), ["source", "_chunk"]).select("source", *others, *[F.get(F.col(f"_{n}"), at).alias(n) for n in names], "place")
    return found.where(F.col(names[-1]).isNotNull())


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block: int = BLOCK, partitions: int | None = None, end: str = "repeat") -> DataFrame:
    """docs in the order of the schedule, all columns kept: partition p holds the p-th range of slots, in order of slots.

    `weights` and `end` are those of `schedule`: with "repeat" documents of sources that run out come again. Texts are
    shuffled once. A source's documents are ordered by a hash of the id and the row; where the ranges of slots begin in
    this order is found from counts of salted groups (about 4 a partition and one a source) and, in the groups that
    reach over the end of a range, from the ranks of their rows without texts. So each row goes to the range of its own
    slot. Ranges are so many that sources x ranges are at most MOST_CUTS, which with the groups bounds what the driver
    holds. Only rows that are equal in all columns stay together.
    """
    spark = docs.sparkSession
    rows = docs.select(whole_row(docs).alias("_whole"), F.col("doc_id").cast("long").alias("_id"), F.coalesce(F.col("source"), F.lit("")).alias("source"))
    own = {s: int(n) for s, n in counted_weights(docs).items()}
    if not own:
        return docs
    parts = min(partitions or max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), max(1, MOST_CUTS // len(own)))
    a_group = -(-sum(own.values()) // (4 * parts))
    salts = spark.createDataFrame([(s, -(-n // a_group)) for s, n in own.items()], "source string, _salts long")
    rows = rows.join(F.broadcast(salts), "source").withColumn("_key", F.xxhash64("_id", "_whole")).withColumn("_salt", F.pmod("_key", F.col("_salts")).cast("int"))
    counts = rows.groupBy("source", "_salt").agg(F.count(F.lit(1)).alias("n")).collect()
    target, block, blocks = targets(weights, own, block, end)
    plan = list(pfair(target, blocks, end))
    size = -(-len(plan) // parts)
    # the first ranks of a source in the ranges that hold some of it
    begins: dict[str, list[tuple[int, int]]] = defaultdict(list)
    for i, (s, k, *_) in enumerate(plan):
        if not begins[s] or begins[s][-1][1] < i // size:
            begins[s].append((k * block, i // size))
    # what lies behind a source's last scheduled block goes nowhere
    for s, count in Counter(s for s, *_ in plan).items():
        begins[s].append((count * block, -1))
    epochs = epochs_of(plan, blocks)
    seen: dict[str, int] = dict.fromkeys(own, 0)
    groups = []
    for r in sorted(counts, key=lambda r: (r["source"], r["_salt"])):
        s, salt, n = r["source"], r["_salt"], r["n"]
        firsts = [(e, seen[s] + e * blocks[s] * block) for e in range(epochs[s])]
        groups += [(s, salt, e, first, n) for e, first in firsts if first < begins[s][-1][0]]
        seen[s] += n
    groups.sort(key=lambda g: (g[0], g[3]))
    starts = {s: [x for x, _ in pairs] for s, pairs in begins.items()}
    ranges = {s: [p for _, p in pairs] for s, pairs in begins.items()}
    cut = [(s, salt, e, first, starts[s][bisect.bisect_right(starts[s], first) : bisect.bisect_left(starts[s], first + n)]) for s, salt, e, first, n in groups]
    split = spark.createDataFrame([(s, salt, e, first, c) for s, salt, e, first, c in cut if c], "source string, _salt int, _epoch int, _first long, _cuts array<long>")
    within = Window.partitionBy("source", "_salt", "_epoch").orderBy("_key")
    found = rows.select("source", "_salt", "_key").join(F.broadcast(split), ["source", "_salt"])
    found = found.withColumn("_rank", F.col("_first") + F.row_number().over(within) - 1).withColumn("_least", F.col("_first") + F.rank().over(within) - 1)
    at: dict[tuple[str, int, int], list[tuple[int, int, int]]] = defaultdict(list)
    for r in found.where(F.array_contains("_cuts", F.col("_rank"))).collect():
        at[r["source"], r["_salt"], r["_epoch"]].append((r["_rank"], r["_key"], r["_least"]))
    table, base = [], {}
    for s, salt, e, first, _ in cut:
        to = ranges[s][bisect.bisect_right(starts[s], first) - 1]
        base.setdefault((s, e, to), first)
        keys, tos = [], [to]
        for rank, key, least in sorted(at.get((s, salt, e), [])):
            keys.append(key)
            tos.append(ranges[s][bisect.bisect_right(starts[s], rank) - 1])
            base[s, e, tos[-1]] = least
        table.append((s, salt, e, keys, tos, [base[s, e, t] for t in tos]))
    known = spark.createDataFrame(table, "source string, _salt int, _epoch int, _keys array<long>, _tos array<int>, _bases array<long>")
    over = F.size(F.filter("_keys", lambda k: k <= F.col("_key")))
    dealt = rows.join(F.broadcast(known), ["source", "_salt"]).withColumn("_to", F.get("_tos", over)).withColumn("_base", F.get("_bases", over))
    dealt = dealt.where("_to >= 0").drop("_keys", "_tos", "_bases", "_salts").repartitionById(parts, F.col("_to"))
    order = Window.partitionBy("_to", "source", "_epoch").orderBy("_salt", "_key")
    ranked = dealt.withColumn("_rank", F.col("_base") + F.row_number().over(order) - 1)
    return with_slots(ranked, plan, block, ("slot",)).sortWithinPartitions("_to", "slot", "place").select("_whole.*")
