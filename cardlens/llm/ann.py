"""Nearest neighbours by multi-index hashing of learned, rotated binary codes."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.llm.common import durable

SAMPLE = 8192  # vectors that tables and radius are fitted on
LEARNED = 2048  # of these the rotations
BLOCK = 16_384  # vectors indexed together
TABLES = (4, 8, 16, 32, 48)  # substrings to choose from; 16 bits each
PROBE = 1e-8  # seconds a probe and
RERANK = 1e-7  # a fetched code take, about: what the choice of tables weighs


@dataclass
class Codes:
    """Binary codes of `tables` substrings of 16 bits: signs under learned rotations of the centred vectors.

    Probes reach substrings within `reach` bits, so by the pigeonhole principle they retrieve every code within
    tables x (reach + 1) - 1 bits of the query's, and many farther ones; those within `radius` bits are reranked.
    """

    mean: np.ndarray
    rotation: np.ndarray  # dimension x bits
    reach: int
    radius: int

    @property
    def tables(self) -> int:
        return self.rotation.shape[1] // 16

    def encode(self, x: np.ndarray) -> np.ndarray:
        """(vectors, tables) substrings."""
        bits = ((x - self.mean) @ self.rotation > 0).astype(np.uint8)
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def rotations(x: np.ndarray, bits: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """Rotations, 64 bits at a time, that change the centred vectors least when they are rounded to signs, found by turns
    as in iterative quantisation, each from its own start."""
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    project = np.pad(axes[:64].T, ((0, 0), (0, 64 - min(64, len(axes)))))
    spread = x @ project
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(-(-bits // 64)):
        turn = np.linalg.qr(rng.standard_normal((64, 64)))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(spread @ turn > 0, 1.0, -1.0).T @ spread)
            turn = (u @ v).T
        out.append(project @ turn)
    return np.hstack(out)[:, :bits]


def fit_codes(sample: np.ndarray, k: int, total: int, target: float = 0.96) -> Codes:
    """Codes for the k nearest among `total` vectors, of which sample holds some.

    The nearest of the whole table are as near as a smaller number of nearest in the sample; twice that number is taken,
    to err on the far side. Of all choices of tables and reach that find `target` of those, the one that costs least
    counts, by its probes and by the share of other pairs that it fetches; the radius holds 99 % of them.
    """
    mean = sample.mean(0)
    turned = rotations(sample[:LEARNED] - mean, 16 * max(TABLES))
    own = Codes(mean, turned, 0, 0).encode(sample)
    asked = np.arange(0, len(sample), max(1, len(sample) // 256))
    score = sample[asked] @ sample.T
    score[np.arange(len(asked)), asked] = -np.inf
    near = min(len(sample) - 1, k, max(1, math.ceil(2 * k * len(sample) / max(total, 1))))
    if near < 1:
        return Codes(mean, turned[:, :64], 16, 64)
    top = np.argpartition(-score, near - 1, axis=1)[:, :near]
    far = np.bitwise_count(own[np.repeat(asked, near)] ^ own[top.ravel()])
    others = np.random.default_rng(1).integers(0, len(sample), (2, 4096))
    apart = np.bitwise_count(own[others[0]] ^ own[others[1]])
    best = (math.inf, max(TABLES), 16)
    for tables in TABLES:
        for reach in range(17):
            if (far[:, :tables] <= reach).any(1).mean() >= target:
                share = (apart[:, :tables] <= reach).any(1).mean()
                cost = tables * sum(math.comb(16, i) for i in range(reach + 1)) * PROBE + share * min(total, BLOCK) * RERANK
                best = min(best, (cost, tables, reach))
                break
    _, tables, reach = best
    radius = int(np.quantile(far[:, :tables].astype(int).sum(1), 0.99, method="higher"))
    return Codes(mean, turned[:, : 16 * tables], reach, radius)


class SubstringIndex:
    """Each 16-bit substring of the codes, sorted, with the bounds of its values."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = np.ascontiguousarray(codes).view("<u8")  # tables come in fours
        self.orders = np.argsort(codes, axis=0, kind="stable").T.astype(np.int32)
        values = np.arange(65537)
        self.bounds = np.concatenate([np.searchsorted(codes[order, t], values) + t * len(codes) for t, order in enumerate(self.orders)]).astype(np.int32)
        self.orders = self.orders.ravel()

    @staticmethod
    def masks(bits: int) -> np.ndarray:
        return np.array([sum(1 << b for b in c) for n in range(bits + 1) for c in itertools.combinations(range(16), n)], np.uint16)

    def fetch(self, code: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """Positions of all codes of which a substring is the query's under one of the masks."""
        probes = (code[:, None] ^ masks[None, :]).astype(np.int32)
        probes += 65537 * np.arange(len(code), dtype=np.int32)[:, None]
        low = self.bounds[probes.ravel()]
        n = self.bounds[probes.ravel() + 1] - low
        some = np.flatnonzero(n)
        low, n = low[some], n[some]
        seen = np.zeros(len(self.codes), bool)
        if len(n):
            seen[self.orders[np.arange(n.sum()) + np.repeat(low - np.concatenate(([0], np.cumsum(n)[:-1])), n)]] = True
        return np.flatnonzero(seen)

    def within(self, code: np.ndarray, masks: np.ndarray, radius: int) -> np.ndarray:
        """What is fetched and lies within the radius."""
        got = self.fetch(code, masks)
        return got[np.bitwise_count(self.words[got] ^ np.ascontiguousarray(code).view("<u8")).sum(1, dtype=np.int64) <= radius]


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part: not null, no null or non-finite component, not zero."""
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where("vec_id is not null and v is not null").where(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))).where(F.exists("v", lambda x: x != 0))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(-1, width)


def nearest(table: DataFrame, k: int = 20, query_modulus: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """For each query (vec_id divisible by query_modulus) the k candidates of largest inner product that the index finds.

    Rows query_id, rank, vec_id, score (double precision on the original vectors; ties to the smaller vec_id). The
    query's own vec_id is no candidate. Vectors that are null, zero or hold null or non-finite components, and those
    with a null id, take no part; of several rows with one vec_id each is a candidate, and of equal queries one is
    asked; only vectors of a query's own length are its candidates. An empty table gives no rows.

    Vectors are dealt to blocks by a hash, and each query is sent to every block, in one shuffle. A task indexes its
    block by substrings, then takes the queries as they come, and gives each one's k best of the block. A query for
    which fewer than k candidates come back is asked again of all vectors.
    """
    spark = table.sparkSession
    rows = durable(valid_vectors(table, id_col, vector_col).withColumn("width", F.size("v")), "vectors")
    counts = {r["width"]: r["n"] for r in rows.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    results = None
    for width, n in sorted(counts.items()):
        own = rows.where(F.col("width") == width).select("vec_id", "v")
        sample = np.array([r["v"] for r in own.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()], float)
        codes = fit_codes(sample, k, n)
        asked = own.where(F.col("vec_id") % query_modulus == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
        first = search(own, asked, codes, k, width, n)
        found = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min(k, n)).select("query_id")
        short = durable(asked.join(found, F.col("vec_id") == F.col("query_id"), "left_anti"), "short")
        if n > 1 and short.take(1):
            again = search(own, short, None, k, width, n)
            first = first.join(short.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").union(again)
        results = first if results is None else results.union(first)
    if results is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return results.select("query_id", "rank", "vec_id", "score")


def search(own: DataFrame, asked: DataFrame, codes: Codes | None, k: int, width: int, total: int) -> DataFrame:
    """k best for each query of `asked` among own (both vec_id, v): by the index, or without codes by all products."""
    blocks = max(1, -(-total // BLOCK))
    dealt = own.select(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("asks"), "vec_id", "v")
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("asks"), "vec_id", "v")
    placed = dealt.union(sent).repartitionById(blocks, F.col("block")).sortWithinPartitions("block", "asks", "vec_id")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = SubstringIndex.masks(codes.reach) if codes else None
        vectors, ids = [], []
        x = xid = index = None
        for batch in batches:
            kinds = batch.column(1).to_numpy()
            cut = int(np.searchsorted(kinds, 1))
            if cut:
                vectors.append(matrix(batch.column(3).slice(0, cut), width))
                ids.append(batch.column(2).to_numpy()[:cut])
            if cut == batch.num_rows or not ids:
                continue
            if x is None:
                x, xid = np.concatenate(vectors), np.concatenate(ids)
                index = SubstringIndex(codes.encode(x)) if codes else None
            queries, query_ids = matrix(batch.column(3).slice(cut), width), batch.column(2).to_numpy()[cut:]
            asked_codes = codes.encode(queries) if codes else None
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for q, query_id in enumerate(query_ids):
                got = index.within(asked_codes[q], masks, codes.radius) if codes else np.arange(len(x))
                got = got[xid[got] != query_id]
                score = (x[got] * queries[q]).sum(1)
                if len(got) > k:
                    near = score >= np.partition(score, len(score) - k)[len(score) - k]
                    got, score = got[near], score[near]
                top = np.lexsort((xid[got], -score))[:k]
                out.append((np.full(len(top), query_id), xid[got[top]], score[top]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], ["query_id", "vec_id", "score"])

    best = placed.mapInArrow(find, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return durable(best.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "nearest")
