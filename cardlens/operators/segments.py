"""Histories of keys in segments of time, so that a key of any size goes over many tasks.

Rows are cut by time into ranges of about equal numbers of rows; a key's rows of one range are a segment. What reaches back over
segments is carried as a row a segment: totals run up, or the last row seen. Times are whole microseconds in the column _at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardlens.operators.ordered import RANGE_ROWS, in_ranges, range_splits

#: Stands for the time of rows without one: before all others, and out of reach of their frames.
NO_TIME = -(1 << 60)
#: Sums of amounts over frames are exact, as what leaves a frame is taken off again.
EXACT = "decimal(38,10)"


def timed(rows: DataFrame, ts: str = "created_at") -> DataFrame:
    return rows.withColumn("_at", F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(NO_TIME)))


def splits_of(rows: DataFrame, segment_rows: int = RANGE_ROWS) -> list[float]:
    return range_splits(rows.select("_at"), "_at", segment_rows)


def same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def joined(rows: DataFrame, carried: DataFrame, keys: list[str]) -> DataFrame:
    """rows with what is carried into their segment."""
    extra = [c for c in carried.columns if c not in (*keys, "_seg")]
    return rows.alias("l").join(carried.alias("r"), same("l", "r", [*keys, "_seg"]), "left").select("l.*", *[F.col(f"r.{c}") for c in extra])


def running(rows: DataFrame, keys: list[str], tie: list[str], before: dict[str, Column], until: dict[str, Column], splits: list[float]) -> DataFrame:
    """rows (_at, ...) with sums over the key's rows: `before` over those before this one in the order (_at, tie), `until` over
    all up to its time, rows of the same time included. Sums of nothing are null."""
    segments = in_ranges(rows, "_at", splits, "_seg")
    own = Window.partitionBy(*keys, "_seg").orderBy("_at", *tie).rowsBetween(Window.unboundedPreceding, -1)
    peers = Window.partitionBy(*keys, "_seg").orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    run = segments.select("*", *[F.sum(c).over(own).alias(f"_run_{n}") for n, c in before.items()]).select("*", *[F.sum(c).over(peers).alias(f"_run_{n}") for n, c in until.items()])
    both = {**before, **until}
    if not splits:
        return run.select(*rows.columns, *[F.col(f"_run_{n}").alias(n) for n in both])
    earlier = Window.partitionBy(*keys).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    totals = segments.groupBy(*keys, "_seg").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in both.items()])
    carried = totals.select(*keys, "_seg", *[F.sum(f"_t_{n}").over(earlier).alias(f"_o_{n}") for n in both])

    def added(n: str) -> Column:
        return F.coalesce(F.col(f"_run_{n}") + F.col(f"_o_{n}"), F.col(f"_run_{n}"), F.col(f"_o_{n}")).alias(n)

    return joined(run, carried, keys).select(*rows.columns, *map(added, both))


def frames(rows: DataFrame, keys: list[str], tie: list[str], trailing: dict[str, tuple[int, Column]], before: dict[str, Column], splits: list[float]) -> DataFrame:
    """rows (_at, ...) with sums over trailing frames (name: microseconds, value; both ends and rows of the same time
    included) and over all rows before (values in terms of _row.<column>), in one pass.

    A row adds its values at its time, and a copy takes them off just after each span: a frame is a running total.
    """
    spans = sorted({span for span, _ in trailing.values()})
    names = list(trailing)
    value = {n: v for n, (_, v) in trailing.items()}
    payload = F.struct(*rows.columns)
    zero = lambda n: F.lit(0).cast(rows.select(value[n]).schema[0].dataType)
    add = F.struct(F.col("_at").alias("_at"), F.lit(True).alias("_own"), payload.alias("_row"), *[value[n].alias(f"_v_{n}") for n in names])
    drops = [
        F.struct((F.col("_at") + span + 1).alias("_at"), F.lit(False).alias("_own"), F.lit(None).cast(rows.select(payload).schema[0].dataType).alias("_row"), *[(-value[n] if trailing[n][0] == span else zero(n)).alias(f"_v_{n}") for n in names])
        for span in spans
    ]
    events = rows.select(*keys, F.explode(F.array(add, *drops)).alias("e")).select(*keys, "e.*", *[F.col(f"e._row.{t}").alias(f"_tie_{t}") for t in tie])
    prior = {n: F.when(F.col("_own"), c) for n, c in before.items()}
    out = running(events, keys, ["_own", *[f"_tie_{t}" for t in tie]], prior, {n: F.col(f"_v_{n}") for n in names}, splits)
    return out.where("_own").select("_row.*", *before, *names)


def distinct_in_span(rows: DataFrame, key: str, value: str, span_us: int, out: str, splits: list[float]) -> DataFrame:
    """rows (_at, ...) with the number of distinct values in the trailing frame, nulls aside.

    A value counts from each of its rows until its next one or the end of the span, whichever is first; the number of such
    stretches over a time is the number of distinct values. No row holds a set, and sorting is all the work.
    """
    segments = in_ranges(rows, "_at", splits, "_seg")
    within = Window.partitionBy(key, value, "_seg").orderBy("_at")
    follows = segments.withColumn("_next", F.lead("_at").over(within))
    if splits:
        firsts = segments.groupBy(key, value, "_seg").agg(F.min("_at").alias("_first"))
        carried = firsts.select(key, value, "_seg", F.lead("_first").over(Window.partitionBy(key, value).orderBy("_seg")).alias("_after"))
        follows = joined(follows, carried, [key, value]).withColumn("_next", F.coalesce("_next", "_after"))
    end = F.least(F.coalesce("_next", F.col("_at") + span_us + 1), F.col("_at") + span_us + 1)
    one = F.when(F.col(value).isNotNull(), 1).otherwise(0)
    row = F.struct(*rows.columns)
    kind = rows.select(row).schema[0].dataType
    add = F.struct(F.col("_at").alias("_at"), F.lit(True).alias("_own"), row.alias("_row"), one.alias("_v"))
    drop = F.struct(end.alias("_at"), F.lit(False).alias("_own"), F.lit(None).cast(kind).alias("_row"), (-one).alias("_v"))
    events = follows.select(key, F.explode(F.array(add, drop)).alias("e")).select(key, "e.*")
    return running(events, [key], [], {}, {out: F.col("_v")}, splits).where("_own").select("_row.*", F.col(out).cast("int").alias(out))


def asof(left: DataFrame, right: DataFrame, on: list[str], left_ts: str, right_ts: str, columns: list[str], tie: str | None = None, tolerance: str | None = None, segment_rows: int = RANGE_ROWS) -> DataFrame:
    """Each left row with `columns` of the latest right row of its keys at or before left_ts (ties: largest `tie`).

    Both sides meet by keys and segment; the last right row of a segment is carried on to the later ones. Null keys meet
    nothing, and right rows without a time are left out.
    """
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in [*on, right_ts]])
    held = F.struct(F.col(right_ts).alias("_ts"), *[F.col(c).alias(c) for c in columns])
    place = lambda ts, side, t: F.struct(F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(NO_TIME)).alias("at"), F.lit(side).alias("side"), t.cast("string").alias("tie"))
    r = right.where(known).select(*on, place(right_ts, 0, F.col(tie) if tie else F.lit(None)).alias("_place"), held.alias("_held"))
    l = left.select(*on, place(left_ts, 1, F.lit(None)).alias("_place"), F.col(left_ts).alias("_left_ts"), F.struct(*left.columns).alias("_left"))
    both = r.unionByName(l, allowMissingColumns=True).withColumn("_at", F.col("_place.at"))
    times = timed(left.select(F.col(left_ts).alias("t")), "t").unionByName(timed(right.select(F.col(right_ts).alias("t")), "t"))
    splits = splits_of(times, segment_rows)
    segments = in_ranges(both, "_at", splits, "_seg")
    order = Window.partitionBy(*on, "_seg").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    seen = segments.withColumn("_seen", F.last("_held", ignorenulls=True).over(order)).where("_place.side = 1").drop("_held")
    if splits:
        earlier = Window.partitionBy(*on).orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
        last = segments.groupBy(*on, "_seg").agg(F.max_by("_held", F.when(F.col("_held").isNotNull(), F.col("_place"))).alias("_last"))
        carried = last.select(*on, "_seg", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
        seen = joined(seen, carried, on).withColumn("_seen", F.coalesce("_seen", "_carried"))
    if tolerance:
        seen = seen.withColumn("_seen", F.when(F.col("_seen._ts") >= F.col("_left_ts") - F.expr(f"INTERVAL {tolerance}"), F.col("_seen")))
    return seen.select("_left.*", *[F.col(f"_seen.{c}").alias(c) for c in columns])
