"""Near-duplicates by Jaccard similarity of word shingles: BK-trees over SimHash codes, in shards of a minima sketch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.bktree import shard_roots, tree_edges
from cardlens.llm.common import bound_batches, components, durable, empty_if_null, whole_row, with_least
from cardlens.llm.simhash import group_bounds, grouped, shingle_hashes, simhash

MINIMA = 128
BAND = 5
SLACK = 0.15  # over four standard errors of the estimate
#: Bits that the codes of two texts of similarity 0.8 or more hardly ever exceed.
RADIUS = 24


def multipliers() -> np.ndarray:
    return np.random.default_rng(11).integers(1, 1 << 63, MINIMA, dtype=np.uint64) | np.uint64(1)


def minima(hashes: np.ndarray, by: np.ndarray) -> np.ndarray:
    """The least of the shingles' hashes under each of MINIMA multiplications, top 32 bits."""
    distinct = np.unique(hashes)
    least = np.full(len(by), np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(distinct), 512):
        np.minimum(least, (distinct[at : at + 512, None] * by[None, :]).min(0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def sketches(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, code long, sketch binary, bands array<long>) of every row; empty texts have no bands.

    Code and sketch are of the distinct shingles, as the similarity is.
    """
    bound_batches(docs.sparkSession)
    starts = list(range(0, MINIMA - BAND + 1, BAND))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = multipliers()
        for batch in batches:
            codes, sketch, bands = [], [], []
            for text in batch.column(1).to_pylist():
                h = np.unique(shingle_hashes(text, words))
                codes.append(simhash(h))
                if not len(h):
                    sketch.append(b"")
                    bands.append([])
                    continue
                m = minima(h, by)
                sketch.append((m & np.uint32(0xFFFF)).astype("<u2").tobytes())
                mixed = [int.from_bytes(m[s : s + BAND].tobytes(), "little") * 0x9E3779B97F4A7C15F39CC0605CEDC835 >> 70 & 0x3FFFFFFFFFFFFFFF for s in starts]
                bands.append(mixed)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(np.array(codes, np.uint64).view(np.int64)), pa.array(sketch, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "text_hash", "code", "sketch", "bands"]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"), F.xxhash64(empty_if_null(text_col)).alias("text_hash"))
    return rows.mapInArrow(make, "doc_id long, text_hash long, code long, sketch binary, bands array<long>")


def exact_roots(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """For each set the position of the first of its component under Jaccard similarities of at least `similarity`.

    Explored breadth first: one set at a time is met with all that are not reached yet, by exact counts.
    """
    roots = np.arange(len(sets))
    sizes = np.array([len(x) for x in sets], np.int64)
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    marked = np.zeros(len(values), bool)
    alive = np.ones(len(sets), bool)
    # members of `held` and their shingles, end to end; made anew when half of them are reached
    held, held_flat = np.arange(len(sets)), flat
    left = len(sets)
    for first in range(len(sets)):
        if not alive[first]:
            continue
        alive[first] = False
        left -= 1
        frontier = [first]
        while frontier and left:
            now = frontier.pop()
            if left * 2 < len(held):
                held = held[alive[held]]
                held_flat = np.concatenate([flat[ends[i] - sizes[i] : ends[i]] for i in held])
            own = flat[ends[now] - sizes[now] : ends[now]]
            marked[own] = True
            common = np.add.reduceat(marked[held_flat], np.cumsum(sizes[held]) - sizes[held], dtype=np.int64)
            marked[own] = False
            new = held[alive[held] & (common >= similarity * (sizes[held] + sizes[now] - common) - 1e-9)]
            alive[new] = False
            left -= len(new)
            roots[new] = first
            frontier += new.tolist()
    return roots


def near_groups(docs: DataFrame, words: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, kept_id) of every row of docs: kept_id is the smallest doc_id of the texts linked to its text.

    Texts link at a Jaccard similarity of `similarity` or more of their distinct shingles. Texts of equal codes and
    sketches meet once. A shard is one band of five minima, which similar texts share in some of 25 bands but for
    one in 20,000; its BK-tree over the SimHash codes finds the pairs within 24 bits, and 128 minima of 16 bits
    (standard error 0.035) propose from an estimate of `similarity` - 0.15 up, or where they are equal. What is
    proposed forms groups, in which the exact similarities of the texts' shingle hashes decide: all pairs of a group
    count but those that are linked already. A text's shingles stand in one group, which one task holds. Empty and
    null texts are alike and form one group.
    """
    rows = durable(sketches(docs, words, id_col, text_col), "sketches")
    texts = durable(rows.groupBy("code", "sketch").agg(F.min("doc_id").alias("first"), F.min(F.struct("text_hash", "doc_id")).alias("sample"), F.first("bands").alias("bands")).withColumn("h", F.xxhash64("code", "sketch")), "texts")
    keys = texts.select("h", F.posexplode("bands").alias("k", "v"))
    shared = keys.groupBy("k", "v").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k", "v")
    suspects = durable(keys.join(shared, ["k", "v"]), "suspects")
    small = texts.select("h", "code", "sketch").join(suspects.select("h").distinct(), "h", "left_semi")
    placed = suspects.join(small, "h").select("k", "v", "h", "code", "sketch").repartition("k", "v").sortWithinPartitions("k", "v", "h")
    least = similarity - SLACK

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 2):
            h = table.column("h").to_numpy()
            codes = table.column("code").to_numpy().view(np.uint64)
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for lo, hi in group_bounds(table, 2):
                own = np.frombuffer(b"".join(table.column("sketch").slice(lo, hi - lo).to_pylist()), "<u2").reshape(hi - lo, MINIMA)
                roots = shard_roots(codes[lo:hi], RADIUS, lambda i, j, own=own: alike(own, i, j, least), block=16)
                member, parent = tree_edges(roots)
                _, same = np.unique(own.view(f"V{own.itemsize * MINIMA}").ravel(), return_inverse=True)
                order = np.argsort(same, kind="stable")
                equal = np.flatnonzero(same[order][1:] == same[order][:-1])
                a += [h[lo:hi][member], h[lo:hi][order[equal + 1]]]
                b += [h[lo:hi][parent], h[lo:hi][order[equal]]]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    proposed = components(placed.mapInArrow(link, "a long, b long").distinct()).toDF("h", "root")
    asked = proposed.join(texts.select("h", "sample"), "h").select("root", "h", F.col("sample.text_hash").alias("text_hash"), F.col("sample.doc_id").alias("_id"))
    given = docs.select(F.col(id_col).cast("long").alias("_own"), empty_if_null(text_col).alias("text")).withColumn("_hash", F.xxhash64("text"))
    # text and id together, so that the many copies of a text are no hot key; repeated rows are met in `decide`
    found = given.join(asked, (F.col("_hash") == F.col("text_hash")) & F.col("_own").eqNullSafe(F.col("_id"))).select("root", "h", "text")

    def distinct_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, words)).astype("<u8").tobytes() for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.binary())], ["root", "h", "shingles"])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 1):
            h = table.column("h").to_numpy()
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for lo, hi in group_bounds(table, 1):
                own, at = np.unique(h[lo:hi], return_index=True)
                part = table.column("shingles").slice(lo, hi - lo)
                roots = exact_roots([np.frombuffer(part[int(i)].as_py(), "<u8") for i in at], similarity)
                a.append(own)
                b.append(own[roots])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["h", "root"])

    sets = found.mapInArrow(distinct_shingles, "root long, h long, shingles binary").repartition("root").sortWithinPartitions("root", "h")
    linked = durable(sets.mapInArrow(decide, "h long, root long"), "linked")
    named = texts.select("h", "code", "sketch", "first").join(linked, "h", "left")
    final = with_least(named, "first", "kept_id").select("code", "sketch", "kept_id")
    return rows.select("doc_id", "code", "sketch").join(final, ["code", "sketch"]).select("doc_id", "kept_id")


def alike(own: np.ndarray, i: np.ndarray, j: np.ndarray, least: float) -> np.ndarray:
    out = np.zeros(len(i), bool)
    for at in range(0, len(i), 8192):
        out[at : at + 8192] = (own[i[at : at + 8192]] == own[j[at : at + 8192]]).mean(1) >= least
    return out


def drop_near_duplicates(docs: DataFrame, words: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs with one row of each group of near-duplicates: that of the smallest doc_id (of repeated rows, one).

    Rows with a null doc_id stay only where no id can name the group. Rows that repeat a doc_id give one row. All
    columns are kept.
    """
    groups = near_groups(docs, words, similarity)
    kept = durable(groups.select(F.col("kept_id").alias("_kept")).distinct(), "kept").hint("merge")
    # the list of kept ids grows with docs, so it is never broadcast
    chosen = docs.join(kept, docs["doc_id"].cast("long").eqNullSafe(kept["_kept"]), "left_semi")
    return once(chosen)


def once(docs: DataFrame) -> DataFrame:
    """One row per doc_id, where ids repeat: the rows are grouped only for ids that come more than once."""
    counts = durable(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_d")), "repeats")
    if not counts.take(1):
        return docs
    repeats = docs["doc_id"].eqNullSafe(counts["_d"])
    single, many = docs.join(counts, repeats, "left_anti"), docs.join(counts, repeats, "left_semi")
    firsts = many.groupBy("doc_id").agg(F.first(whole_row(docs)).alias("_row")).select("_row.*")
    return single.unionByName(firsts)
