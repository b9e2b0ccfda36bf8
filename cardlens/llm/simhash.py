"""SimHash near-duplicates, found with BK-trees over shards of the fingerprints."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.bktree import shard_roots, tree_edges
from cardlens.llm.common import bound_batches, components, durable, empty_if_null, with_least

SEED = 42
SHARD = 8192  # codes in a tree, about


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; A-Z lower-cased, words split at ASCII white space."""
    parts = text.encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    if len(parts) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(line[a:b], SEED) for a, b in zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)),
        np.uint64,
        len(parts) - words + 1,
    )


def simhash(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; zero without hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096]
        counts += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << int(k) for k in np.flatnonzero(2 * counts > len(hashes)))


def fingerprints(docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, code long) per row of docs. A null text counts as empty, and that has the code zero."""
    bound_batches(docs.sparkSession)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.array([simhash(shingle_hashes(t, words)) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.view(np.int64))], ["doc_id", "code"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    return rows.mapInArrow(code, "doc_id long, code long")


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of every choice of blocks - radius of the blocks: codes within the radius agree on one of them."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(each, blocks - radius)]


def blocks_for(codes: int, radius: int) -> int:
    """So many blocks that a shard has about SHARD codes or fewer: the fewer blocks, the fewer copies of a code."""
    bits = max(1, codes).bit_length() - SHARD.bit_length()
    return next((k for k in range(radius + 1, radius + 5) if 64 * (k - radius) // k >= bits), radius + 4)


def grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables that hold whole groups only, from batches that are sorted by their first `keys` columns."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(k)[batch.num_rows - 1] for k in range(keys)]
        same = np.ones(batch.num_rows, bool)
        for k in range(keys):
            same &= batch.column(k).to_numpy(zero_copy_only=False) == last[k].as_py()
        cut = int(np.argmax(same))
        if held and [held[-1].column(k)[held[-1].num_rows - 1] for k in range(keys)] == last and cut == 0:
            held.append(batch)
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def group_bounds(table: pa.Table, keys: int) -> Iterator[tuple[int, int]]:
    """Ranges of the groups with two rows or more."""
    new = np.zeros(table.num_rows, bool)
    new[:1] = True
    for k in range(keys):
        c = table.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], table.num_rows)
    many = ends - starts > 1
    return zip(starts[many].tolist(), ends[many].tolist(), strict=True)


def code_links(codes: DataFrame, radius: int = 4) -> DataFrame:
    """Edges (a, b) between distinct codes (column code) whose components are those of all pairs within the radius.

    Shards are keyed by a choice of bit blocks on which two codes within the radius must agree, so each link meets
    in some shard. A shard's BK-tree is built in the task that has the shard: shards grow with the data, so they
    are placed by their key instead of broadcast. A shard holds distinct codes, 8 bytes each, and gives at most one
    edge per code, in trees of bounded width. Codes are read twice and should come from files.
    """
    distinct = codes.select("code").distinct()
    masks = block_masks(radius, blocks_for(distinct.count(), radius))
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    shards = distinct.select(
        "code", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col("code").bitwiseAND(F.lit(m)).alias("v")) for k, m in enumerate(signed)])).alias("s")
    ).select(F.col("s.k").alias("k"), F.col("s.v").alias("v"), "code")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, 2):
            own = table.column("code").to_numpy().view(np.uint64)
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for lo, hi in group_bounds(table, 2):
                part = own[lo:hi]
                member, parent = tree_edges(shard_roots(part, radius))
                a.append(part[member].view(np.int64))
                b.append(part[parent].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    placed = shards.repartition("k", "v").sortWithinPartitions("k", "v", "code")
    return placed.mapInArrow(link, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null texts count as empty; empty texts have fingerprint zero and link like any other. A null doc_id never is a
    component_id unless all of its component are null. Repeated rows give repeated results; other columns of docs
    are not looked at. Equal fingerprints meet once, as one code. Beside fingerprints and components nothing is written:
    codes and classes come from these by one shuffle, and a task's file costs the executor several processes.
    """
    rows = durable(fingerprints(docs, words, id_col, text_col), "fingerprints")
    codes = rows.groupBy("code").agg(F.min("doc_id").alias("first"))
    linked = codes.join(components(code_links(codes, radius)).withColumnRenamed("node", "code"), "code", "left")
    named = with_least(linked, "first", "component_id").select("code", "component_id")
    return rows.join(named, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
