"""From raw documents to packed sequences, in five stages; each reads what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import mixing, neardup, packing, pii, toxicity
from cardlens.llm.common import durable, empty_if_null, read_table, whole_row

#: Trained models, sketches and tokenizers have no SQL form; tests hold the stages against plain versions.
ORACLE_SQL = None
TARGET_POWER = 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity machine, fitted on their labels, doesn't reject."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic_documents(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.drop_near_duplicates(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked in their text, and n_chars of the new text."""
    found = pii.find(docs).where("size(base) + size(learned) > 0")
    spans = F.concat(F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), "learned")
    marked = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), spans.alias("_spans")).dropDuplicates(["_id", "_hash"])
    rows = docs.select(whole_row(docs).alias("_whole"))
    key = F.col("_whole.doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64(empty_if_null("_whole.text")) == F.col("_hash"))
    text = F.col("_whole.text")
    masked = rows.join(marked, key, "left").withColumn("_new", F.when(F.col("_spans").isNull(), text).otherwise(pii.redact(text, F.col("_spans"))))
    new = {"text": F.col("_new"), "n_chars": F.length("_new")}
    return masked.select(*[new.get(c, F.col(f"_whole.`{c}`")).cast(t).alias(c) for c, t in docs.dtypes])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which the schedule interleaves their sources to the target weights.

    The targets are the sources' counts to the power TARGET_POWER, which lifts small sources. Their documents come
    again, epoch by epoch, until each document of the largest one has come once; so the weights hold to the end.
    """
    return mixing.mix(docs, mixing.counted_weights(docs, power=TARGET_POWER))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens with their places in sequences, which are numbered in the mixing stage's order."""
    return packing.pack_in_order(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), name)
    return docs
