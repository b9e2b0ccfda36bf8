"""Quantiles from mergeable sketches: one pass, a bounded row a group, for streams and for tables that grow; exact_quantiles
reads a table once more and decides between the values that the sketches leave open. See ordered.exact_percentiles for
interpolated ones."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SIZE = 200
#: How many bounds of a sketch's error around a share the exact step looks at.
REACH = 3


def rank_error(size: int = SIZE) -> float:
    """How far, as a share of the rows and at 99 % confidence, a sketch's rank of a value may be off (the sketch's published
    bound, 2.296 / size ^ 0.9723). A sketch of no more rows than its size is exact."""
    return 2.296 / size**0.9723


def quantile_sketches(df: DataFrame, column: str, groups: tuple[str, ...], size: int = SIZE) -> DataFrame:
    """(groups, sketch) of the column's values without nulls; groups without values have no row. `df` may be a stream."""
    return df.where(F.col(column).isNotNull()).groupBy(*groups).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(size)).alias("sketch"))


def merged(sketches: DataFrame, groups: tuple[str, ...]) -> DataFrame:
    """Sketches of coarser groups, such as days from hours or all versions from each, without the rows."""
    return sketches.groupBy(*groups).agg(F.kll_merge_agg_double("sketch").alias("sketch"))


def quantiles(sketches: DataFrame, names: dict[str, float]) -> DataFrame:
    """sketches with n and a column for each named share: the least value with at least that share of rows at or below."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(name) for name, p in names.items()]
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.kll_sketch_get_n_double("sketch").alias("n"), *found)


def exact_quantiles(df: DataFrame, column: str, sketches: DataFrame, groups: tuple[str, ...], names: dict[str, float], size: int = SIZE) -> DataFrame:
    """(groups, n, names): n rows of the group, nulls included, and for each named share the least value with at least that
    share of the group's values at or below, null where it has none.

    Sketches (groups, sketch) of the size say between which values each quantile lies. Values in there are counted one by one,
    those outside only by side, so a group's shuffle is small whatever its rows. A quantile that lies outside after all is
    found among all values of its group.
    """
    rows = df.select(*groups, F.col(column).cast("double").alias("_v"))
    e = REACH * rank_error(size)
    edge = lambda p: F.kll_sketch_get_quantile_double("sketch", F.lit(min(1.0, max(0.0, p))))
    bounds = sketches.select(*[F.col(g).alias(f"_g_{g}") for g in groups], *[edge(p + d).alias(f"_{side}_{n}") for n, p in names.items() for side, d in (("lo", -e), ("hi", e))])
    meet = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_g_{g}")) for g in groups], F.lit(True))
    near = _placed(rows.join(bounds, meet, "left"), groups, names, lambda n: (F.col(f"_lo_{n}"), F.col(f"_hi_{n}")))
    missed = near.where(reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names]) & (F.col("_known") > 0)).select(*[F.col(g).alias(f"_g_{g}") for g in groups])
    whole = _placed(rows.join(missed, meet, "left_semi"), groups, names, lambda n: (F.lit(float("-inf")), F.lit(float("nan"))))
    found = whole.select(*[F.col(g).alias(f"_g_{g}") for g in groups], *[F.col(n).alias(f"_all_{n}") for n in names])
    return near.join(found, meet, "left").select(*groups, "n", *[F.coalesce(n, f"_all_{n}").alias(n) for n in names])


def _placed(rows: DataFrame, groups: tuple[str, ...], names: dict[str, float], bounds) -> DataFrame:
    """(groups, n, _known, names) of rows (groups, _v, ...) from counts of the values within bounds(name), and of the rows below,
    above and without a value; null where a quantile isn't within."""
    marks = []
    for name in names:
        lo, hi = bounds(name)
        side = F.when(F.col("_v").isNull(), 2).when(F.col("_v") < lo, -1).when(F.col("_v") <= hi, 0).otherwise(1)
        marks.append(F.struct(F.lit(name).alias("name"), side.alias("side"), F.when(side == 0, F.col("_v")).alias("v")))
    levels = rows.select(*groups, F.explode(F.array(*marks)).alias("_m")).groupBy(*groups, "_m.name", "_m.side", "_m.v").agg(F.count(F.lit(1)).alias("_c"))
    own = Window.partitionBy(*groups, "name")
    run = levels.select("*", F.sum("_c").over(own.orderBy("side", "v").rowsBetween(Window.unboundedPreceding, 0)).alias("_run"), F.sum(F.when(F.col("side") < 2, F.col("_c"))).over(own).alias("_known"))
    share = reduce(lambda a, n: a.when(F.col("name") == n, F.lit(Decimal(str(names[n])))), names, F.when(F.lit(False), F.lit(Decimal(0))))
    rank = F.greatest(F.lit(1), F.ceil(F.col("_known") * share))
    hit = (F.col("side") == 0) & (F.col("_run") >= rank) & (F.col("_run") - F.col("_c") < rank)
    first = F.col("name") == next(iter(names))
    return run.groupBy(*groups).agg(F.sum(F.when(first, F.col("_c"))).alias("n"), F.coalesce(F.max("_known"), F.lit(0)).alias("_known"), *[F.max(F.when(hit & (F.col("name") == n), F.col("v"))).alias(n) for n in names])


def latency_by_version(logs: DataFrame, span: str = "1 hour", size: int = SIZE) -> DataFrame:
    """(bucket, model_version, sketch) of latencies, of a table or of a stream with a watermark on created_at."""
    known = logs.where("model_version is not null").withColumn("created_at", F.col("created_at").cast("timestamp"))
    sketches = quantile_sketches(known.withColumn("_w", F.window("created_at", span)), "latency_ms", ("_w", "model_version"), size)
    return sketches.select(F.col("_w.start").alias("bucket"), "model_version", "sketch")


def psi(base: DataFrame, current: DataFrame, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """Population stability index of two one-row sketches over quantile bins of the base, whose edges come to the driver; see
    monitor.psi."""
    edges = base.select(*[F.kll_sketch_get_quantile_double("sketch", F.lit(i / bins)).alias(f"e{i}") for i in range(1, bins)]).first()
    ranks = lambda df, name: df.select(F.array(F.lit(0.0), *[F.kll_sketch_get_rank_double("sketch", F.lit(e)) for e in edges], F.lit(1.0)).alias(name))
    at = ranks(base, "ra").crossJoin(ranks(current, "rb")).select("ra", "rb", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("i"))
    share = lambda c: F.greatest(F.get(c, F.col("i") + 1) - F.get(c, F.col("i")), F.lit(floor))
    p, q = share("ra"), share("rb")
    return at.agg(F.round(F.sum((q - p) * F.log(q / p)), 6).alias("psi"))
