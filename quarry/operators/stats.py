"""Exact order statistics and distribution reports.

Quantiles are computed from a *histogram* (``groupBy(key, value).count()``),
never from a sort of the raw rows: the histogram is bounded by the number of
distinct values (lengths, counts), so the running-sum window over it stays
small however large the input is, and a hot key collapses in the partial
aggregate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _by(by) -> list[str]:
    if by is None:
        return []
    return [by] if isinstance(by, str) else list(by)


def histogram(df: DataFrame, by, value: str) -> DataFrame:
    """``(by..., value, cnt, cum, n)``: running count in value order per group."""
    keys = _by(by)
    h = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))
    w = W.partitionBy(*keys).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    wall = W.partitionBy(*keys)
    return h.withColumn("cum", F.sum("cnt").over(w)).withColumn("n", F.sum("cnt").over(wall))


def value_at_rank(rank: Column, value: str = "value") -> Column:
    """Aggregate over a histogram: the value whose 0-based rank span holds ``rank``."""
    return F.min(F.when((F.col("cum") - F.col("cnt") <= rank) & (rank < F.col("cum")), F.col(value)))


def order_statistics(df: DataFrame, by, value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """For each group: ``n`` and, per name, the value at rank ``fn(n)`` (0-based)."""
    keys = _by(by)
    h = histogram(df, keys, value)
    aggs = [F.max("n").alias("n")] + [value_at_rank(fn(F.col("n")), value).alias(name) for name, fn in ranks.items()]
    return h.groupBy(*keys).agg(*aggs)


def order_statistic(df: DataFrame, by, value: str, rank: Callable[[Column], Column], share: float, name: str) -> DataFrame:
    """For each group: the value at the exact 0-based ``rank(n)``, which lies
    near the ``share`` quantile; for continuous values, whose histogram would
    be as long as the data.

    A quantile sketch brackets the rank (its rank error is far below the
    bracket's width), one pass counts the rows below the bracket, and only the
    rows inside it, a few thousandths of a group, are ranked exactly."""
    keys = _by(by)
    wide = 0.002
    ends = F.array(F.lit(max(0.0, share - wide)), F.lit(min(1.0, share + wide)))
    b = df.groupBy(*keys).agg(F.count(value).alias("n"), F.percentile_approx(value, ends, 10_000).alias("q"))
    b = b.select(*keys, "n", F.col("q")[0].alias("lo"), F.col("q")[1].alias("hi"), rank(F.col("n")).alias("rank"))
    near = df.join(b, keys).where(F.col(value) <= F.col("hi"))
    hist = near.groupBy(*keys, F.greatest(value, "lo").alias("v"), "rank", "lo").agg(
        F.count(F.lit(1)).alias("cnt"), F.min(value).alias("least"))
    # rows below the bracket stand as one entry at its lower end
    w = W.partitionBy(*keys).orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    hist = hist.withColumn("cum", F.sum("cnt").over(w))
    return hist.groupBy(*keys).agg(F.min(F.when(F.col("rank") < F.col("cum"), F.col("v"))).alias(name))


def nearest_rank_index(n: Column, pct: int) -> Column:
    """``min(int(n * p / 100), n - 1)``."""
    return F.least(F.floor(n * F.lit(pct) / F.lit(100)), n - 1)


def nearest_rank(df: DataFrame, by, measures: dict[str, Column], pcts=(75, 90, 95, 99)) -> DataFrame:
    """Nearest-rank quantiles per group and measure, long format:
    ``(by..., measure, P75, P90, ...)``.

    The measures are unpivoted in one pass (``explode`` of an array of
    structs), so the input is scanned once for all of them.
    """
    keys = _by(by)
    names = sorted(measures)
    arr = F.array(*[F.struct(F.lit(m).alias("measure"), measures[m].cast("bigint").alias("value")) for m in names])
    long = df.select(*keys, F.explode(arr).alias("_m")).select(*keys, "_m.measure", "_m.value")
    ranks = {f"P{p}": (lambda n, p=p: nearest_rank_index(n, p)) for p in pcts}
    return order_statistics(long, keys + ["measure"], "value", ranks).drop("n")


def length_stats(df: DataFrame, col: str) -> DataFrame:
    """count, min, max, mean, median (int-truncated), p25/p75/p95/p99 by linear
    interpolation then int-truncation, total.  Empty input gives count 0 and
    nulls elsewhere."""
    v = df.select(F.col(col).cast("bigint").alias("value"))

    def lo(p):
        return lambda n: F.floor((n - 1) * F.lit(p) / F.lit(100))

    def hi(p):
        return lambda n: F.ceil((n - 1) * F.lit(p) / F.lit(100))

    ranks = {
        "_min": lambda n: F.lit(0),
        "_max": lambda n: n - 1,
        "_m0": lambda n: F.when(n % 2 == 0, F.floor(n / 2) - 1).otherwise(F.floor(n / 2)),
        "_m1": lambda n: F.floor(n / 2),
    }
    for p in (25, 75, 95, 99):
        ranks[f"_lo{p}"] = lo(p)
        ranks[f"_hi{p}"] = hi(p)
    h = histogram(v, [], "value")
    aggs = [F.max("n").alias("n"), F.sum(F.col("value") * F.col("cnt")).alias("total")] + [
        value_at_rank(fn(F.col("n"))).alias(name) for name, fn in ranks.items()
    ]
    s = h.agg(*aggs)
    out = [
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("count"),
        F.col("_min").alias("min"),
        F.col("_max").alias("max"),
        (F.col("total") / F.col("n")).alias("mean"),
        F.floor((F.col("_m0") + F.col("_m1")) / 2).cast("bigint").alias("median"),
    ]
    for p in (25, 75, 95, 99):
        k = (F.col("n") - 1) * F.lit(p) / F.lit(100)
        interp = F.col(f"_lo{p}") * (F.ceil(k) - k) + F.col(f"_hi{p}") * (k - F.floor(k))
        out.append(
            F.when(F.floor(k) == F.ceil(k), F.col(f"_lo{p}")).otherwise(F.floor(interp)).cast("bigint").alias(f"p{p}")
        )
    out.append(F.col("total").cast("bigint").alias("total_chars"))
    return s.select(*out)


def distribution(df: DataFrame, by) -> DataFrame:
    """Counts per key with share of total; sort with ``orderBy(desc('count'), key)``."""
    keys = _by(by)
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("count"))
        .withColumn("share", F.col("count") / F.sum("count").over(W.partitionBy()))
    )


def top_k(df: DataFrame, by, k: int) -> DataFrame:
    """``Counter.most_common(k)`` with a key tie-break."""
    keys = _by(by)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), *keys).limit(k)
