"""Messages in and out: decode, quarantine, sinks, and scoring of micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cardlens import schemas
from cardlens.functions.scalar import cold_pair, decide, null_nonfinite, parse_iso_utc, utc_date
from cardlens.operators.joins import lookup
from cardlens.sources.message_log import register
from cardlens.streaming.velocity import with_rocksdb


def read_messages(spark: SparkSession, source: dict) -> DataFrame:
    """A stream with the column value: Kafka from the earliest offset; a log of files, so many messages a poll (format
    message_log; with span, polled by executors over ranges of so many bytes); or text files where a folder is given."""
    if source.get("format") == "message_log":
        register(spark)
        return spark.readStream.format("message_log").options(path=source["path"], most=str(source.get("most", 100)), **({"span": str(source["span"])} if "span" in source else {})).load().select("value")
    if source.get("format", "kafka") == "kafka":
        options = {"kafka.bootstrap.servers": source["servers"], "subscribe": source["topic"], "startingOffsets": "earliest", "maxOffsetsPerTrigger": str(source.get("most", 100_000))}
        return spark.readStream.format("kafka").options(**options).load().selectExpr("CAST(value AS STRING) AS value")
    return spark.readStream.format("text").option("maxFilesPerTrigger", source.get("files", 1)).load(source["path"])


def decode(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages by the fixed schema, and those that can't be read (value, reason). A missing latency counts as 0; the
    message's transaction_time becomes created_at, and a time without an offset is UTC."""
    parsed = raw.select("value", F.from_json("value", schemas.MESSAGE + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("m"))
    at = parse_iso_utc(F.col("m.transaction_time"))
    bad = F.col("m").isNull() | F.col("m._corrupt").isNotNull() | F.col("m.transaction_id").isNull() | at.isNull()
    good = parsed.where(~bad).select("m.*", at.alias("created_at")).drop("_corrupt").withColumn("latency_ms", F.coalesce("latency_ms", F.lit(0.0)))
    return good, parsed.where(bad).select("value", F.when(F.col("m._corrupt").isNotNull(), "no JSON").otherwise("no id or time").alias("reason"))


def encode(df: DataFrame, columns: list[str] | None = None, key: str = "request_id") -> DataFrame:
    """(key, value): the columns as one flat JSON object; nulls are written."""
    names = columns or [c.split()[0] for c in schemas.MESSAGE.split(", ")]
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"}).alias("value"))


def publish(scored: DataFrame, sink: dict) -> None:
    """Send a batch's messages: to a Kafka topic keyed by request, or appended to text files where a folder is given.

    `scored` has the message's columns; what is missing is null. Called for a micro-batch it is sent again if the batch
    is, so readers tell messages apart by transaction_id.
    """
    names = [c.split() for c in schemas.MESSAGE.split(", ")]
    rows = encode(scored.select(*[(F.col(n) if n in scored.columns else F.lit(None)).cast(k).alias(n) for n, k in names]))
    if sink.get("format", "kafka") == "kafka":
        rows.write.format("kafka").option("kafka.bootstrap.servers", sink["servers"]).option("topic", sink["topic"]).save()
    else:
        rows.select("value").write.mode("append").text(sink["path"])


def publish_stream(scored: DataFrame, sink: dict, checkpoint: str, **trigger) -> StreamingQuery:
    """publish() for every micro-batch of a stream."""
    return scored.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, _: publish(df, sink)).trigger(**(trigger or {"availableNow": True})).start()


def transactions_of(messages: DataFrame) -> DataFrame:
    names = ["user_id", "card_id", "merchant_id", "device_id", "amount_usd", "currency", "channel", "billing_country_code", "ip_country_code", "email_purchaser", "email_recipient", "status", "created_at"]
    return messages.select(F.col("transaction_id").alias("id"), *names)


def logs_of(messages: DataFrame) -> DataFrame:
    """A log row a message. Its log_id is the request's id, and without one a digest of the whole message, so that a message
    that is delivered again is the same row, and a transaction that is scored again is another."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in messages.columns]
    log_id = F.coalesce("request_id", F.sha2(F.concat_ws("\1", *names), 256))
    return messages.select(log_id.alias("log_id"), "transaction_id", "model_name", "model_version", "fraud_score", "prediction", "threshold", "latency_ms", "created_at")


def write_once(rows: DataFrame, path: str, checkpoint: str, key: str | None = None, **trigger) -> StreamingQuery:
    """Append a stream to a table, each row once, and the first row of each value of `key` only, whatever its other columns.

    Keys seen are the query's state, in RocksDB: a batch looks up and adds its own keys, so its cost follows the batch and not
    the table, and the table is never read. State, offsets and the table's list of files move on together, so a batch that
    fails or comes again neither loses nor repeats rows. Of rows of one batch with the same key any one stays. What the table
    held before has to go through the stream first. Tables with created_at are partitioned by its date in UTC.
    """
    dated = rows.withColumn("date", utc_date(F.col("created_at"))) if "created_at" in rows.columns else rows
    once = dated if key is None else dated.dropDuplicates([key])
    with with_rocksdb(rows.sparkSession):
        writer = once.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
        return (writer.partitionBy("date") if "date" in dated.columns else writer).trigger(**(trigger or {"availableNow": True})).start()


def sink_transactions(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The first message of each transaction id, over all dates, becomes its row."""
    return write_once(transactions_of(messages), path, checkpoint, "id", **trigger)


def sink_prediction_log(messages: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Each message's prediction once, see logs_of."""
    return write_once(logs_of(messages), path, checkpoint, "log_id", **trigger)


SINKS = ("transactions", "log", "bad")


def ingest(stream: DataFrame, tx_path: str, log_path: str, bad_path: str, checkpoint: str, sinks: tuple[str, ...] = SINKS, **trigger) -> list[StreamingQuery]:
    """Messages to the transactions, the log and the quarantine: a query for each of the sinks, with its own offsets and state
    under the checkpoint. A failed one is started again by the same call and goes on where it was."""
    good, bad = decode(stream)
    start = {
        "transactions": lambda at: sink_transactions(good, tx_path, at, **trigger),
        "log": lambda at: sink_prediction_log(good, log_path, at, **trigger),
        "bad": lambda at: write_once(bad, bad_path, at, **trigger),
    }
    return [start[name](f"{checkpoint}/{name}") for name in sinks]


def to_partitions(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append to date partitions."""
    dated = stream.withColumn("date", utc_date(F.col("created_at")))
    return dated.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("date").outputMode("append").trigger(**(trigger or {"availableNow": True})).start()


def assemble(requests: DataFrame, velocity: DataFrame, snapshot: DataFrame, columns: list[str]) -> DataFrame:
    """Requests with served attributes and velocity features; cold_start where no attribute is known."""
    served = lookup(requests, snapshot, ["user_id", "card_id"], columns)
    return served.join(velocity, "id", "left").withColumn("cold_start", cold_pair(columns))


def score(df: DataFrame, predict: Callable[[DataFrame], DataFrame], threshold: float = 0.8) -> DataFrame:
    """df with fraud_score (finite or null), prediction and threshold; predict adds fraud_score to a frame."""
    scored = predict(df).withColumn("fraud_score", null_nonfinite(F.col("fraud_score")))
    return scored.withColumn("prediction", decide(F.col("fraud_score"), threshold)).withColumn("threshold", F.lit(threshold))


def score_stream(stream: DataFrame, snapshot: Callable[[], DataFrame], columns: list[str], predict: Callable[[DataFrame], DataFrame], publish: Callable[[DataFrame, int], None], checkpoint: str, threshold: float = 0.8, **trigger) -> StreamingQuery:
    """Score micro-batches against the snapshot as it is then. `publish` failing doesn't lose scores: the batch is run
    again from its checkpoint."""

    def batch(df: DataFrame, k: int) -> None:
        served = lookup(df, snapshot(), ["user_id", "card_id"], columns).withColumn("cold_start", cold_pair(columns))
        publish(score(served, predict, threshold), k)

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(**(trigger or {"availableNow": True})).start()
