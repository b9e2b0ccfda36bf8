"""Running totals over a global order without a single-task window."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Rows that one range of an order holds, about; the number of ranges follows from the number of rows.
RANGE_ROWS = 200_000
MOST_RANGES = 20_000


def range_splits(rows: DataFrame, order: str, range_rows: int = RANGE_ROWS) -> list[float]:
    """Cuts of the values of a numeric column by approximate quantiles, into as many ranges as the count of rows asks for."""
    ranges = min(MOST_RANGES, -(-rows.count() // range_rows))
    if ranges <= 1:
        return []
    keyed = rows.select(F.col(order).cast("double").alias("_order"))
    cuts = keyed.approxQuantile("_order", [i / ranges for i in range(1, ranges)], max(1e-4, 0.2 / ranges))
    return sorted({c for c in cuts if abs(c) != float("inf")})


def in_ranges(rows: DataFrame, order: str, cuts: list[float], out: str = "_range") -> DataFrame:
    """rows with the number of the range that the value of `order`, which must not be null, lies in."""
    if not cuts:
        return rows.withColumn(out, F.lit(0))
    keyed = rows.withColumn("_order", F.col(order).cast("double"))
    splits = [float("-inf"), *cuts, float("inf")]
    return Bucketizer(splits=splits, inputCol="_order", outputCol="_cut").transform(keyed).withColumn(out, F.col("_cut").cast("int")).drop("_order", "_cut")


def with_range(levels: DataFrame, order: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """levels with _range, the number of the range of values that the row lies in."""
    return in_ranges(levels, order, range_splits(levels, order, range_rows))


def ordered_prefix(levels: DataFrame, order: str, sums: list[str], groups: tuple[str, ...] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """levels (one row per group and value of the numeric column `order`) with, for each sum column s, s_before: the
    group's total over smaller values, and `next`: the group's next larger value.

    Ranges' totals (at most MOST_RANGES rows a group) are run up and sent back, and each range is run up by itself.
    """
    rows = with_range(levels, order, range_rows)
    up = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*groups).orderBy("_range")
    totals = rows.groupBy(*groups, "_range").agg(F.min(order).alias("_least"), *[F.sum(s).alias(f"_t_{s}") for s in sums])
    offsets = totals.select(*groups, "_range", F.lead("_least").over(after).alias("_next"), *[F.coalesce(F.sum(f"_t_{s}").over(up), F.lit(0)).alias(f"_o_{s}") for s in sums])
    within = Window.partitionBy(*groups, "_range").orderBy(order)
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    run = rows.select("*", F.lead(order).over(within).alias("_lead"), *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_r_{s}") for s in sums])
    joined = run.join(offsets, [*groups, "_range"])
    return joined.select(*levels.columns, F.coalesce("_lead", "_next").alias("next"), *[(F.col(f"_o_{s}") + F.col(f"_r_{s}")).alias(f"{s}_before") for s in sums])


def exact_percentiles(df: DataFrame, column: str, names: dict[str, float], groups: tuple[str, ...] = (), range_rows: int = RANGE_ROWS) -> DataFrame:
    """(groups, names): linearly interpolated percentiles of the column in each group; null where it has no value.

    Values are counted before they are shuffled, and a group's counts are run up range by range, so no task holds the
    values of a large group.
    """
    levels = df.where(F.col(column).isNotNull()).groupBy(*groups, F.col(column).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    run = ordered_prefix(levels, "_v", ["_c"], groups, range_rows)
    total = levels.groupBy(*groups).agg(F.sum("_c").alias("_n"))
    both = run.join(total, list(groups)) if groups else run.crossJoin(F.broadcast(total))

    def at(place: Column) -> Column:
        return F.max(F.when((F.col("_c_before") <= place) & (place < F.col("_c_before") + F.col("_c")), F.col("_v")))

    picked = []
    for name, p in names.items():
        place = (F.col("_n") - 1) * F.lit(p)
        picked += [at(F.floor(place)).alias(f"_lo_{name}"), at(F.ceil(place)).alias(f"_hi_{name}"), F.max(place - F.floor(place)).alias(f"_part_{name}")]
    ends = both.groupBy(*groups).agg(*picked)
    lo, hi, part = (lambda n: F.col(f"_lo_{n}")), (lambda n: F.col(f"_hi_{n}")), (lambda n: F.col(f"_part_{n}"))
    return ends.select(*groups, *[(lo(n) + (hi(n) - lo(n)) * part(n)).alias(n) for n in names])


def global_rank(df: DataFrame, ts: str, tie: str, out: str = "rank") -> DataFrame:
    """1-based rank by (ts, tie) over all rows."""
    rows = df.withColumn("_at", F.unix_micros(F.col(ts).cast("timestamp")))
    counts = rows.groupBy("_at").agg(F.count(F.lit(1)).alias("n"))
    before = ordered_prefix(counts, "_at", ["n"]).select("_at", "n_before")
    own = F.row_number().over(Window.partitionBy("_at").orderBy(tie))
    return rows.withColumn("_own", own).join(before, "_at").withColumn(out, (F.col("n_before") + F.col("_own")).cast("long")).drop("_own", "n_before", "_at")


def split_by_time(df: DataFrame, ts: str, tie: str, val_frac: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """The first int(n (1 - val_frac)) rows in time, and the rest."""
    ranked = global_rank(df, ts, tie, "_rank")
    cut = int(df.count() * (1 - val_frac) + 1e-9)
    return ranked.where(F.col("_rank") <= cut).drop("_rank"), ranked.where(F.col("_rank") > cut).drop("_rank")


def two_sample_levels(base: DataFrame, current: DataFrame, column: str, transform=None) -> DataFrame:
    """(v, a, b): how often each value comes in either sample."""
    value = transform(F.col(column).cast("double")) if transform else F.col(column).cast("double")
    both = base.select(value.alias("v"), F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(current.select(value.alias("v"), F.lit(0).alias("a"), F.lit(1).alias("b")))
    return both.where("v is not null").groupBy("v").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def cumulative_shares(base: DataFrame, current: DataFrame, column: str, transform=None) -> DataFrame:
    """(v, next, fa, fb): both samples' cumulative shares at each value."""
    run = ordered_prefix(two_sample_levels(base, current, column, transform), "v", ["a", "b"])
    total = run.agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    both = run.crossJoin(F.broadcast(total))
    return both.select("v", "next", ((F.col("a_before") + F.col("a")) / F.col("na")).alias("fa"), ((F.col("b_before") + F.col("b")) / F.col("nb")).alias("fb"))
