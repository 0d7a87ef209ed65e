"""Exploration tables: the numbers behind each chart, computed on the cluster."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racecast.functions import flag
from racecast.operators.ordered import DEFAULT_SPLIT, Split, running_total
from racecast.operators.quality import missing
from racecast.session import materialise

Z_95 = 1.959963984540054
WHISKER_REACH = 1.5
SKETCH_ACCURACY = 10_000


# Weights of a row in the replicates of a bootstrap: Poisson with mean 1, cut off where its chance is below 1e-9.
MODULUS = 2**31 - 1
_CHANCES = [math.exp(-1) / math.factorial(k) for k in range(12)]
WEIGHT_LIMITS = [math.floor(MODULUS * math.fsum(_CHANCES[: k + 1])) for k in range(len(_CHANCES))]


@dataclass(frozen=True)
class Bootstrap:
    """Poisson bootstrap: ``row_key`` tells rows apart (default: all columns), rows alike in it get equal weights.

    Each row is hashed once to two numbers; its place in replicate b is first + b x second modulo a prime, so
    replicates are independent in pairs and rows throughout. ``portable`` takes MD5 of the key's text, which other
    engines compute too.
    """

    row_key: tuple[str, ...] = ()
    replicates: int = 1000
    level: float = 0.95
    seed: int = 123
    portable: bool = False


def _two_numbers(df: DataFrame, how: Bootstrap) -> tuple[Column, Column]:
    keys = how.row_key or tuple(df.columns)
    if how.portable:
        text = F.concat_ws("|", F.lit(str(how.seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))
        code = F.md5(text)
        parts = (F.conv(F.substring(code, at, 8), 16, 10).cast("bigint") for at in (1, 9))
    else:
        parts = (F.xxhash64(F.lit(how.seed), F.lit(i), *keys) for i in range(2))
    first, second = (F.pmod(p, F.lit(MODULUS)) for p in parts)
    return first, second


def bootstrap_means(df: DataFrame, keys: Sequence[str], value: str, how: Bootstrap = Bootstrap()) -> DataFrame:
    """(keys, replicate, mean): the mean of each replicate in which a group has any weight.

    One aggregation: a row gives a weight to each replicate, summed within its task, so each task sends on one row
    for a group and replicate. The result depends on the rows only, however they are partitioned.
    """
    first, second = _two_numbers(df, how)
    known = df.filter(~missing(df, value)).select(
        *keys, F.col(value).cast("double").alias("_x"), first.alias("_a"), second.alias("_b")
    )
    drawn = known.select("*", F.explode(F.sequence(F.lit(1), F.lit(how.replicates))).alias("replicate"))
    place = F.pmod(F.col("_a") + F.col("replicate") * F.col("_b"), F.lit(MODULUS))
    weight = F.lit(len(WEIGHT_LIMITS))
    for k, limit in reversed(list(enumerate(WEIGHT_LIMITS))):
        weight = F.when(F.col("_place") < limit, k).otherwise(weight)
    weighed = drawn.withColumn("_place", place).withColumn("_w", weight).filter("_w > 0")
    sums = weighed.groupBy(*keys, "replicate").agg(F.sum("_w").alias("_n"), F.sum(F.col("_w") * F.col("_x")).alias("_s"))
    return sums.select(*keys, "replicate", (F.col("_s") / F.col("_n")).alias("mean"))


def mean_by(
    df: DataFrame, keys: Sequence[str], value: str, interval: str = "normal", bootstrap: Bootstrap = Bootstrap()
) -> DataFrame:
    """n, mean, stddev per key and an interval of the mean.

    ``interval="normal"`` gives the 95% normal approximation, ``"bootstrap"`` the percentiles of ``bootstrap_means``.
    """
    if interval not in ("normal", "bootstrap"):
        raise ValueError(f"interval is 'normal' or 'bootstrap', not {interval!r}")
    known = df.filter(~missing(df, value))
    stats = known.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev(value).alias("stddev")
    )
    if interval == "normal":
        half = F.lit(Z_95) * F.col("stddev") / F.sqrt("n")
        return stats.withColumns({"ci_low": F.col("mean") - half, "ci_high": F.col("mean") + half})
    out = (1 - bootstrap.level) / 2
    # A group has one row for each replicate here, so its exact percentiles hold a bounded number of values.
    ends = bootstrap_means(df, keys, value, bootstrap).groupBy(*(F.col(k).alias(f"_{k}") for k in keys)).agg(
        F.percentile("mean", [out, 1 - out]).alias("_ends")
    )
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return stats.join(ends, same, "left").select(
        *stats.columns, F.get("_ends", 0).alias("ci_low"), F.get("_ends", 1).alias("ci_high")
    )


def value_counts(df: DataFrame, columns: str | Sequence[str], out: str = "n") -> DataFrame:
    """Rows per value (or combination of values), NULLs left out."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    return df.na.drop("any", subset=columns).groupBy(*columns).agg(F.count(F.lit(1)).alias(out))


def pair_counts(df: DataFrame, x: str, y: str) -> DataFrame:
    """The points of a scatter plot, each once with its number of rows."""
    return value_counts(df, [x, y])


def correlation(df: DataFrame, x: str, y: str, out: str = "corr") -> DataFrame:
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(out))


def top_k(df: DataFrame, by: str, k: int, tiebreak: str) -> DataFrame:
    """The k rows with the highest ``by``; NULLs last, ties by ``tiebreak``."""
    return df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(tiebreak)).limit(k)


def ranked(df: DataFrame, by: str, tiebreak: str) -> DataFrame:
    """All rows, highest ``by`` first."""
    return df.orderBy(F.desc_nulls_last(by), F.asc_nulls_last(tiebreak))


def wins_and_points(df: DataFrame, key: str, won: Column, points: str) -> DataFrame:
    """Wins and points per key. Keys without a win have NULL wins; without points, 0 points."""
    wins = F.sum(flag(won))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.when(wins > 0, wins).alias("wins"), F.coalesce(F.sum(points), F.lit(0)).alias("points")
    )


def wins_by(df: DataFrame, key: str, won: Column, name: str) -> DataFrame:
    """(key, name, wins) of the keys with at least one win.

    Counted per key and name first: a text maximum over all rows would have to sort them.
    """
    counted = df.filter(F.col(key).isNotNull()).groupBy(key, name).agg(F.sum(flag(won)).alias("wins"))
    named = counted.groupBy(key).agg(F.max(name).alias(name), F.sum("wins").alias("wins"))
    return named.filter(F.col("wins") > 0)


def _extent(df: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    known = df.filter(~missing(df, value)).select(F.col(value).cast("double").alias("v"))
    return known, known.agg(
        F.min("v").alias("low"), F.max("v").alias("high"), F.stddev("v").alias("spread"),
        F.count("v").cast("double").alias("n"),
    )


def histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """(bin, low, high, n) with equal-width bins over the value range, empty bins included.

    The last bin holds its upper edge. If all values are equal the range is widened by 0.5 to
    each side.
    """
    known, extent = _extent(df, value)
    widen = F.when(F.col("low") == F.col("high"), 0.5).otherwise(0.0)
    ends = extent.select((F.col("low") - widen).alias("low"), (F.col("high") + widen).alias("high"))
    ends = ends.filter(F.col("low").isNotNull()).withColumn("width", (F.col("high") - F.col("low")) / bins)

    def lower_edge(number: Column, low: Column, width: Column) -> Column:
        return low + width * (number - 1)

    at_ends = ends.select(F.struct("low", "high", "width").alias("s")).scalar()
    low, high, width = (at_ends.getField(c) for c in ("low", "high", "width"))
    near = F.least(F.width_bucket("v", low, high, F.lit(bins)), F.lit(bins)).cast("int")
    # The division may put a value on an edge into the wrong neighbour; compare with the edges.
    at = F.col("near")
    number = (
        F.when((at > 1) & (F.col("v") < lower_edge(at, low, width)), at - 1)
        .when((at < bins) & (F.col("v") >= lower_edge(at + 1, low, width)), at + 1)
        .otherwise(at)
    )
    counts = known.withColumn("near", near).groupBy(number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = ends.select(F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"), "low", "width")
    grid = grid.select(
        "bin",
        lower_edge(F.col("bin"), F.col("low"), F.col("width")).alias("low"),
        lower_edge(F.col("bin") + 1, F.col("low"), F.col("width")).alias("high"),
    )
    return grid.join(counts, "bin", "left").na.fill(0, ["n"])


def density_grid(df: DataFrame, value: str, points: int = 200, bandwidth: float | None = None) -> DataFrame:
    """(x, density): Gaussian kernel density at ``points`` places from the lowest to the highest value.

    Default bandwidth: standard deviation x n^(-1/5). Equal values are counted first; each distinct
    value then meets the fixed grid, and the sums per grid point are built up within each task.
    """
    known, extent = _extent(df, value)
    scale = F.lit(bandwidth) if bandwidth else F.col("spread") * F.pow("n", F.lit(-0.2))
    grid = extent.select("low", "n", ((F.col("high") - F.col("low")) / (points - 1)).alias("gap"), scale.alias("h"))
    at_grid = grid.select(F.struct("low", "gap", "h", "n").alias("s")).scalar()
    low, gap, h, n = (at_grid.getField(c) for c in ("low", "gap", "h", "n"))
    at = low + F.col("i") * gap
    kernel = F.col("k") * F.exp(F.lit(-0.5) * F.pow((at - F.col("v")) / h, F.lit(2)))
    placed = (
        known.groupBy("v")
        .agg(F.count(F.lit(1)).alias("k"))
        .select("v", "k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    )
    sums = placed.groupBy("i").agg(F.sum(kernel).alias("s"))
    return sums.select(at.alias("x"), (F.col("s") / (n * h * math.sqrt(2 * math.pi))).alias("density"))


def binning_error(width: float, bandwidth: float) -> float:
    """Most that ``density_binned`` is off at any place, for bins of a width.

    Sharing a value between the ends of its bin replaces the kernel by the straight lines between the ends, which
    are off by at most an eighth of the squared width times the greatest second derivative of the kernel.
    """
    return width**2 / 8 / (bandwidth**3 * math.sqrt(2 * math.pi))


def density_binned(
    df: DataFrame, value: str, points: int = 200, bins: int = 4096, bandwidth: float | None = None
) -> DataFrame:
    """(x, density) as ``density_grid``, up to ``binning_error``, from one row a bin however many values there are.

    Each value is shared between the two ends of its bin in inverse proportion to its distances from them, which one
    aggregation over the bins does; the ends then take the place of the values. Values on the ends are exact.
    """
    known, extent = _extent(df, value)
    scale = F.lit(bandwidth) if bandwidth else F.col("spread") * F.pow("n", F.lit(-0.2))
    span = F.col("high") - F.col("low")
    grid = extent.select("low", "n", (span / bins).alias("width"), (span / (points - 1)).alias("gap"), scale.alias("h"))
    at_grid = grid.select(F.struct("low", "width", "gap", "h", "n").alias("s")).scalar()
    low, width, gap, h, n = (at_grid.getField(c) for c in ("low", "width", "gap", "h", "n"))
    place = F.try_divide(F.col("v") - low, width)
    binned = known.select(place.alias("place")).select(F.floor("place").alias("bin"), (F.col("place") - F.floor("place")).alias("part"))
    sums = binned.groupBy("bin").agg(F.count("part").alias("k"), F.sum("part").alias("upper"))
    ends = F.array(
        F.struct(F.col("bin").alias("end"), (F.col("k") - F.col("upper")).alias("weight")),
        F.struct((F.col("bin") + 1).alias("end"), F.col("upper").alias("weight")),
    )
    weights = sums.select(F.inline(ends)).groupBy("end").agg(F.sum("weight").alias("k"))
    at = low + F.col("i") * gap
    kernel = F.col("k") * F.exp(F.lit(-0.5) * F.pow(F.try_divide(at - (low + F.col("end") * width), h), F.lit(2)))
    spread = weights.filter("k > 0").select("end", "k", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    totals = spread.groupBy("i").agg(F.sum(kernel).alias("s"))
    return totals.select(at.alias("x"), F.try_divide(F.col("s"), n * h * math.sqrt(2 * math.pi)).alias("density"))


BROADCAST_GROUPS = 100_000
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def _value_counts_of(df: DataFrame, group: str, value: str) -> DataFrame:
    known = df.filter(~missing(df, value)).select(group, F.col(value).cast("double").alias("v"))
    return known.groupBy(group, "v").agg(F.count(F.lit(1)).alias("k"))


def _exact_quartiles(counts: DataFrame, group: str, split: Split) -> DataFrame:
    """Quartiles from (group, v, k) counts: the values at the wanted ranks of the running count."""
    running = running_total(counts, [group], ["v"], {"k": "k"}, split, counted=True)
    picks = []
    for name, share in QUARTILES.items():
        rank = F.lit(share) * (F.col("all_k") - 1)
        for end, at in (("below", F.floor(rank)), ("above", F.ceil(rank))):
            picks.append(F.min(F.when(F.col("cum_k") > at, F.col("v"))).alias(f"{name}_{end}"))
    ends = running.groupBy(group).agg(
        F.max("all_k").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), *picks
    )

    def between(name: str, share: float) -> Column:
        rank = F.lit(share) * (F.col("n") - 1)
        below, above = F.col(f"{name}_below"), F.col(f"{name}_above")
        return (below + (above - below) * (rank - F.floor(rank))).alias(name)

    return ends.select(group, "n", "low", *(between(*item) for item in QUARTILES.items()), "high")


def quartiles(
    df: DataFrame, group: str, value: str, exact: bool = True, split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """(group, n, low, q1, median, q3, high), with linear interpolation between ranks.

    The exact form counts equal values and reads the quartiles off each group's running count, so no
    task has to hold a whole group; the counts are materialised for its several passes.
    ``exact=False`` is one pass with a fixed-size sketch and no interpolation.
    """
    if exact:
        return _exact_quartiles(materialise(_value_counts_of(df, group, value)), group, split)
    known = df.filter(~missing(df, value)).withColumn("_v", F.col(value).cast("double"))
    rows = known.groupBy(group).agg(
        F.count("_v").alias("n"),
        F.min("_v").alias("low"),
        F.percentile_approx("_v", list(QUARTILES.values()), SKETCH_ACCURACY).alias("_q"),
        F.max("_v").alias("high"),
    )
    picks = [F.get("_q", i).alias(name) for i, name in enumerate(QUARTILES)]
    return rows.select(group, "n", "low", *picks, "high")


def box_stats(
    df: DataFrame, group: str, value: str, exact: bool = True, split: Split = DEFAULT_SPLIT
) -> DataFrame:
    """``quartiles`` with whiskers (outermost values within 1.5 IQR) and the number of outliers."""
    if exact:
        counts = materialise(_value_counts_of(df, group, value))
        box = _exact_quartiles(counts, group, split)
    else:
        counts = _value_counts_of(df, group, value)
        box = quartiles(df, group, value, exact=False)
    # One row per group: kept and counted, so that it is the broadcast side while that is small.
    box = materialise(box.withColumnRenamed(group, "_g"))
    near = F.broadcast(box) if box.count() <= BROADCAST_GROUPS else box
    reach = F.lit(WHISKER_REACH) * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        counts.join(near, F.col(group).eqNullSafe(F.col("_g")))
        .groupBy(group, *(c for c in box.columns if c != "_g"))
        .agg(
            F.min(F.when(inside, F.col("v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("v"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("k"))).alias("n_outliers"),
        )
    )
