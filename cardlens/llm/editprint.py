"""Fingerprints by a randomised embedding of edit distance into Hamming distance."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import bound_batches, components, durable, empty_if_null

SEED = 20_260_101
ROWS = 2048  # the walk's random bits repeat after so many steps
SAMPLES = 96  # places sampled from the embedding at each of a text's two levels
STRETCH = 1 << 16  # longer texts are walked in stretches of so many code points, each from the walk's start
LEAST_LEVEL = 4
HELD = 24_000_000  # code points walked together


def walk_bits() -> np.ndarray:
    """Row j: whether a character class steps on at step j; class 0 marks the end and never does."""
    bits = np.random.default_rng(SEED).integers(0, 2, (ROWS, 256)).astype(np.int64)
    bits[:, 0] = 0
    return bits


def places(level: int) -> np.ndarray:
    """The sampled places of a level: texts of at most 2**level code points are embedded in three times as many."""
    return np.sort(np.random.default_rng([SEED, level]).integers(0, 3 << level, SAMPLES))


def level_of(length: int) -> int:
    return max(LEAST_LEVEL, (max(length, 1) - 1).bit_length())


def classes(text: str) -> np.ndarray:
    """Characters as classes 1 to 255."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return ((points ^ (points >> 8) * np.uint32(31)) % np.uint32(255) + 1).astype(np.uint8)


def embed(texts: list[str], bits: np.ndarray) -> list[str]:
    """Fingerprints: the level as two hex digits, then the sampled classes at that level and the next one."""
    levels = np.array([level_of(len(t)) for t in texts], int)
    out = np.zeros((len(texts), 2 * SAMPLES), np.uint8)
    coded = [classes(t) for t in texts]
    lanes = [(i, k, min(STRETCH, len(c) - k * STRETCH)) for i, c in enumerate(coded) for k in range(max(1, -(-len(c) // STRETCH)))]
    lanes.sort(key=lambda x: -x[2])
    flat = np.zeros(sum(n for _, _, n in lanes) + len(lanes), np.uint8)
    at = np.empty(len(lanes), np.int64)
    begin = 0
    members: dict[tuple[int, int], list[list[int]]] = defaultdict(lambda: [[], [], []])
    for lane, (i, k, n) in enumerate(lanes):
        flat[begin : begin + n] = coded[i][k * STRETCH : k * STRETCH + n]
        at[lane] = begin
        begin += n + 1
        for half in (0, 1):
            for column, x in zip(members[int(levels[i]) + half, k], (lane, i, half), strict=True):
                column.append(x)
    events: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
    for (level, k), (lane, text, half) in members.items():
        lane, text, half = np.array(lane), np.array(text), np.array(half)
        for s, place in enumerate(places(level).tolist()):
            if place // (3 * STRETCH) == k:
                events[place % (3 * STRETCH)].append((lane, text, half * SAMPLES + s))
    c, step, active = np.empty(len(lanes), np.uint8), np.empty(len(lanes), np.int64), len(lanes)
    for j in range(max(events, default=-1) + 1):
        if j % 256 == 0:
            going = np.flatnonzero(flat[at[:active]])
            active = int(going[-1]) + 1 if len(going) else 0
            if not active:
                break
        for lane, text, column in events.get(j, ()):
            out[text, column] = flat[at[lane]]
        np.take(flat, at[:active], out=c[:active], mode="clip")
        np.take(bits[j % ROWS], c[:active], out=step[:active], mode="clip")
        at[:active] += step[:active]
    return [f"{level:02x}{row.tobytes().hex()}" for level, row in zip(levels.tolist(), out, strict=True)]


def likeness(a: str, b: str) -> float:
    """Share of equal samples at the levels that both have, places past both ends aside; 1 for equal fingerprints."""
    if a == b:
        return 1.0
    la, lb = int(a[:2], 16), int(b[:2], 16)
    x, y = np.frombuffer(bytes.fromhex(a[2:]), np.uint8), np.frombuffer(bytes.fromhex(b[2:]), np.uint8)
    same = used = 0
    for level in {la, la + 1} & {lb, lb + 1}:
        p, q = x[(level - la) * SAMPLES :][:SAMPLES], y[(level - lb) * SAMPLES :][:SAMPLES]
        some = (p > 0) | (q > 0)
        used += int(some.sum())
        same += int(((p == q) & some).sum())
    return same / used if used else 0.0


def in_ring(docs: DataFrame, rows_a_bucket: int = 4096, least: int = 48, most: int = 20_000) -> DataFrame:
    """Rows (bucket, doc_id, text, guard), a bucket's rows in one partition, by descending doc_id (ties by the text's hash).

    A bucket is a range of doc_ids as doubles, within which the ids themselves order the rows; its last row, the guard, is a copy of the first row of the bucket that follows (after
    the last bucket: of the first). Texts are shuffled once. The driver holds at most `most` cuts and first rows.
    """
    n = docs.count()
    buckets = min(most, max(least, -(-n // rows_a_bucket)))
    keyed = docs.withColumn("key", F.coalesce(F.col("doc_id").cast("double"), F.lit(-1.7e308)))
    cuts = sorted(set(keyed.approxQuantile("key", [i / buckets for i in range(1, buckets)], min(0.01, 0.2 / buckets)))) if n else []
    splitter = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="key", outputCol="range") if cuts else None
    rows = splitter.transform(keyed) if splitter else keyed.withColumn("range", F.lit(0.0))
    rows = rows.withColumn("bucket", (F.lit(len(cuts)) - F.col("range")).cast("int")).withColumn("text_hash", F.xxhash64("text"))
    firsts = rows.groupBy("bucket").agg(F.max(F.struct("doc_id", (-F.col("text_hash").cast("decimal(20,0)")).alias("h"))).alias("x")).select("bucket", "x.doc_id", "x.h").orderBy("bucket").collect()
    before = {r["bucket"]: firsts[i - 1]["bucket"] for i, r in enumerate(firsts)}
    guards = docs.sparkSession.createDataFrame([(r["bucket"], r["doc_id"], int(-r["h"]), before[r["bucket"]]) for r in firsts], "_bucket int, _id long, _hash long, before int")
    first = (F.col("bucket") == F.col("_bucket")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    marked = rows.join(F.broadcast(guards), first, "left")  # a row a bucket
    own = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("guard"))
    copies = F.when(F.col("before").isNotNull(), F.array(own, F.struct(F.col("before").alias("bucket"), F.lit(1).alias("guard")))).otherwise(F.array(own))
    dealt = marked.select("text_hash", "doc_id", "text", F.explode(copies).alias("to"))
    dealt = dealt.select(F.col("to.bucket").alias("bucket"), F.col("to.guard").alias("guard"), "text_hash", "doc_id", "text")
    placed = dealt.repartitionById(len(cuts) + 1, F.col("bucket"))
    return placed.sortWithinPartitions("bucket", "guard", F.desc_nulls_last("doc_id"), "text_hash").select("bucket", "guard", "doc_id", "text")


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text of a document is its own with the last half replaced by the start of the next one (descending
    doc_id, ties by text hash, null ids last; after the last comes the first). Null texts count as empty; two empty
    texts are alike. A single row is its own next. Repeated rows come as often as given.
    """
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = walk_bits()
        held: list[tuple[int, int, int | None, str]] = []
        size = 0

        def finish(part: list[tuple[int, int, int | None, str]]) -> pa.RecordBatch:
            """Results of all rows but the last, which the next part begins with, and but guards."""
            keep = [i for i in range(len(part) - 1) if not part[i][1] and part[i + 1][0] == part[i][0]]
            edited = []
            for i in keep:
                own, after = part[i][3], part[i + 1][3]
                half = len(own) // 2
                edited.append(own[: len(own) - half] + after[:half])
            prints = embed([x[3] for x in part] + edited, bits)
            own, new = prints[: len(part)], prints[len(part) :]
            columns = [
                [part[i][2] for i in keep],
                [len(part[i][3]) for i in keep],
                [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited],
                [own[i] for i in keep],
                new,
                [likeness(own[i], e) for i, e in zip(keep, new, strict=True)],
                [likeness(own[i], own[i + 1]) for i in keep],
            ]
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
            names = [x.split()[0] for x in schema.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held.append(row)
                size += len(row[3])
                if size >= HELD and len(held) > 1:
                    yield finish(held)
                    held = held[-1:]
                    size = len(row[3])
        if len(held) > 1:
            yield finish(held)

    return in_ring(rows).mapInArrow(walk, schema)


def fingerprint_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, text) of every row; null texts count as empty."""
    bound_batches(docs.sparkSession)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = walk_bits()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(embed(batch.column(1).to_pylist(), bits)), batch.column(1)], ["doc_id", "fingerprint", "text"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"))
    return rows.mapInArrow(walk, "doc_id long, fingerprint string, text string")


def edit_distance(a: str, b: str, most: int) -> int:
    """Edit distance of a and b if it is at most `most`, else most + 1: furthest-reaching diagonals, so its cost
    follows the distance and not the product of the lengths."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    reach = {1: 0}
    end = len(b) - len(a)
    before: dict[int, int] = {}
    for d in range(most + 1):
        reach = {}
        for k in range(-d, d + 1):
            x = 0 if d == 0 else max(before.get(k, -2) + 1, before.get(k - 1, -2), before.get(k + 1, -2) + 1)
            x = min(x, len(a), len(b) - k)
            if x < 0 or x + k < 0:
                continue
            while x < len(a) and x + k < len(b) and a[x] == b[x + k]:
                x += 1
            reach[k] = x
        if reach.get(end, -1) >= len(a):
            return d
        before = reach
    return most + 1


def edit_classes(docs: DataFrame, similarity: float = 0.9, bands: int = 24, width: int = 6, further: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, class_id (smallest doc_id of texts linked to it), n_links of its text.

    A band is `width` samples of one level; texts that agree on a band are compared, by their edit distance (at most
    1 - similarity of the longer text). Equal texts meet once. A band's bucket is sorted by `further` more samples of the
    band's own order, which splits a large one as narrower bands would, and a text is compared with the next two there and
    with the one of the smallest hash: three pairs a text, never all. A pair that no band brings side by side is missed;
    a test holds the share against all pairs.
    """
    prints = fingerprint_texts(docs, id_col, text_col).withColumn("h", F.xxhash64("text"))
    rows = durable(prints, "prints")
    texts = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.first("fingerprint").alias("fingerprint"), F.first("text").alias("text"))
    rng = np.random.default_rng([SEED, bands, width])
    drawn = [rng.permutation(SAMPLES)[: width + further].tolist() for _ in range(bands)]
    level = F.conv(F.substring("fingerprint", 1, 2), 16, 10).cast("int")
    samples = lambda half, places: F.concat(*[F.substring("fingerprint", 3 + 2 * (half * SAMPLES + p), 2) for p in places])
    keys = [
        F.struct(F.struct((level + half).alias("level"), F.lit(k).alias("band"), samples(half, some[:width]).alias("v")).alias("key"), samples(half, some[width:]).alias("rest"))
        for half in (0, 1)
        for k, some in enumerate(drawn)
    ]
    banded = texts.select("h", F.explode(F.array(*keys)).alias("b")).select("h", "b.key", "b.rest").where(~F.col("key.v").rlike("^0*$"))
    from pyspark.sql.window import Window

    smallest = banded.groupBy("key").agg(F.min("h").alias("a")).join(banded, "key").where("a <> h").select("a", F.col("h").alias("b"))
    order = Window.partitionBy("key").orderBy("rest", "h")
    beside = banded.select("h", F.lag("h").over(order).alias("one"), F.lag("h", 2).over(order).alias("two"))
    chained = beside.select("h", F.explode(F.array("one", "two")).alias("a")).where("a <> h").select("a", F.col("h").alias("b"))
    pairs = smallest.union(chained).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sides = texts.select("h", "text")
    both = pairs.join(sides.toDF("a", "ta"), "a").join(sides.toDF("b", "tb"), "b")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for i, (ta, tb) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                most = int((1 - similarity) * max(len(ta), len(tb)) + 1e-9)
                kept += [i] if edit_distance(ta, tb, most) <= most else []
            yield batch.take(pa.array(kept, pa.int64())).select([0, 1])

    links = durable(both.select("a", "b", "ta", "tb").mapInArrow(verify, "a long, b long"), "links")
    degree = links.union(links.select("b", "a")).toDF("h", "o").distinct().groupBy("h").agg(F.count(F.lit(1)).alias("n_links"))
    linked = components(links).toDF("h", "root")
    named = texts.select("h", "first").join(linked, "h", "left").withColumn("root", F.coalesce("root", "h"))
    smallest_id = named.groupBy("root").agg(F.min("first").alias("class_id"))
    final = named.join(smallest_id, "root").join(degree, "h", "left").select("h", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.select("doc_id", "h").join(final, "h").select("doc_id", "class_id", "n_links")
