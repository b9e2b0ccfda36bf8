"""Shortest-pack-first packing over the histogram of lengths."""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.llm.common import bound_batches, durable, empty_if_null, ranked_within, salted_rank

CAPACITY = 1024
GROUP = 1 << 16  # pieces of one length that are ranked in one task, about
SPECIAL = "<|endoftext|>"


class Encoder:
    """Ids of byte_bpe_50k. The rank file holds the same vocabulary and gives the same ids faster; a text that has a
    special token's string in it goes to the tokenizer itself."""

    def __init__(self, json_path: str, ranks_path: str, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(ranks_path, "rb"))}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.json_path, self.slow = json_path, None

    def ids(self, text: str) -> np.ndarray:
        if SPECIAL not in text:
            return np.asarray(self.fast.encode_ordinary(text), "<u4")
        if self.slow is None:
            from tokenizers import Tokenizer

            self.slow = Tokenizer.from_file(self.json_path)
        return np.asarray(self.slow.encode(text, add_special_tokens=False).ids, "<u4")


def default_tokenizer() -> tuple[str, str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def pieces(
    docs: DataFrame, capacity: int = CAPACITY, tokenizer: tuple[str, str, str] | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """Rows (doc_id, start, length, ids_crc32, doc_tokens): each document's ids and a closing 0, cut at every capacity.

    A null text counts as empty and gives one piece of length 1. `keep` names columns of docs to carry along.
    """
    bound_batches(docs.sparkSession)
    paths = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(*paths)
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encoder.ids(text), np.uint32(0)).astype("<u4")
                for at in range(0, len(ids), capacity):
                    part = ids[at : at + capacity]
                    row.append(i)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.tobytes()))
                    total.append(len(ids))
            kept = [batch.column(k).take(pa.array(row, pa.int64())) for k in (0, *range(2, 2 + len(keep)))]
            yield pa.RecordBatch.from_arrays(
                [kept[0], *(pa.array(x, pa.int64()) for x in (start, length, crc, total)), *kept[1:]], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *keep]
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), empty_if_null(text_col).alias("text"), *keep)
    kinds = "".join(f", {k} {rows.schema[k].dataType.simpleString()}" for k in keep)
    return rows.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + kinds)


def shortest_pack_first(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths, count of packs). Lengths go longest first; each goes to the packs that are shortest so far,
    if it fits there, and else opens packs. Works on counts, so its cost follows the number of lengths."""
    open_packs: dict[int, list[list]] = {}
    sums: list[int] = []
    done: list[tuple[tuple[int, ...], int]] = []

    def put(pattern: tuple[int, ...], total: int, count: int) -> None:
        if total == capacity:
            done.append((pattern, count))
        elif total in open_packs:
            open_packs[total].append([pattern, count])
        else:
            open_packs[total] = [[pattern, count]]
            heapq.heappush(sums, total)

    for size in sorted(histogram, reverse=True):
        left = histogram[size]
        while left:
            if not sums or sums[0] + size > capacity:
                each = capacity // size
                whole, rest = divmod(left, each)
                if whole:
                    put((size,) * each, size * each, whole)
                if rest:
                    put((size,) * rest, size * rest, 1)
                left = 0
                continue
            total = sums[0]
            packs = open_packs[total]
            pattern, count = packs[-1]
            used = min(left, count)
            left -= used
            if used == count:
                packs.pop()
                if not packs:
                    heapq.heappop(sums)
                    del open_packs[total]
            else:
                packs[-1][1] = count - used
            put((*pattern, size), total + size, used)
    for packs in open_packs.values():
        done += [(p, c) for p, c in packs]
    return done


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, end rank, first sequence, offset): which ranks of a length go where."""
    out, next_rank, sequence = [], {}, 0
    for pattern, count in patterns:
        offset = 0
        for size in pattern:
            rank = next_rank.get(size, 0)
            out.append((size, rank, rank + count, sequence, offset))
            next_rank[size] = rank + count
            offset += size
        sequence += count
    return out


def pack(
    cut: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "start", "ids_crc32"), within: tuple[str, ...] = ()
) -> DataFrame:
    """Give each row of pieces its sequence_id and offset. Rows are ranked by a salt, or, if given, by `within`, then `order`.

    Only the histogram (at most `capacity` rows) comes to the driver, and only the slots (from patterns, whose number
    follows the number of lengths, not of rows) go back. A length's rows get ranks over salted buckets of about GROUP rows.
    """
    spark = cut.sparkSession
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.createDataFrame(slots(shortest_pack_first(histogram, capacity)), "length long, lo long, hi long, first_sequence long, offset long")
    salts = max(1, -(-max(histogram.values(), default=0) // GROUP))
    ranked = ranked_within(cut, "length", within, order, "_rank") if within else salted_rank(cut, "length", list(order), salts, "_rank")
    inside = (F.col("_rank") >= F.col("lo")) & (F.col("_rank") < F.col("hi"))
    placed = ranked.join(F.broadcast(table.withColumnRenamed("length", "_length")), (F.col("length") == F.col("_length")) & inside)
    return placed.withColumn("sequence_id", F.col("first_sequence") + F.col("_rank") - F.col("lo")).drop("_rank", "_length", "lo", "hi", "first_sequence")


def with_place(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs with _part, _file, _stretch and _row: where a row stands in the files that docs is read from.

    Files are in the order of the number that Spark's writer gives them and are counted in stretches of 2^20 rows. Rows
    that come from no file are in the order of partitions.
    """
    rows = docs.select("doc_id", "text")
    try:
        at = docs.metadataColumn("_metadata")
        rows = docs.select("doc_id", "text", at["file_name"].alias("_file"), at["row_index"].alias("_row"))
        rows.schema  # noqa: B018
    except AnalysisException:
        rows = rows.withColumn("_file", F.lit("")).withColumn("_row", F.monotonically_increasing_id())
    number = F.regexp_extract("_file", r"^part-([0-9]+)", 1)
    return rows.withColumn("_part", F.when(number != "", number.cast("long")).otherwise(0)).withColumn("_stretch", F.shiftright("_row", 20))


def pack_in_order(docs: DataFrame, capacity: int = CAPACITY, tokenizer: tuple[str, str, str] | None = None) -> DataFrame:
    """pack_documents, with sequences numbered in the order in which docs stands in its files.

    A length's pieces are ranked in that order, so pieces that follow each other get sequences of one pattern that
    follow each other; a sequence then stands where its first piece does. Ranks and numbers are made in each stretch
    of a file and completed by the stretches' counts; texts are not shuffled.
    """
    stretch = ("_part", "_file", "_stretch")
    cut = durable(pieces(with_place(docs), capacity, tokenizer, keep=(*stretch, "_row")), "pieces")
    packed = durable(pack(cut, capacity, order=("_row", "start"), within=stretch), "packed")
    first = packed.groupBy("sequence_id").agg(F.min(F.struct(*stretch, "_row")).alias("_first")).select("sequence_id", "_first.*")
    numbered = ranked_within(first.withColumn("_all", F.lit(0)), "_all", stretch, ("_row", "sequence_id"), "_number")
    return packed.join(numbered.select("sequence_id", "_number"), "sequence_id").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", F.col("_number").alias("sequence_id"), "offset"
    )


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: tuple[str, str, str] | None = None) -> DataFrame:
    """Tokenise, cut and pack all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Repeated rows are packed as often as they come; a null doc_id stays null; an empty table gives no rows.
    """
    cut = durable(pieces(docs, capacity, tokenizer), "pieces")
    return pack(cut, capacity).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
