"""Box-Cox by maximum likelihood, scaling, column statistics and reshaping, without a driver-side table."""

from __future__ import annotations

from math import expm1, log, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindrift.operators import rank

SHIFT = 0.01


def box_cox(x: Column, lam: Column | float) -> Column:
    lam = lam if isinstance(lam, Column) else F.lit(float(lam))
    return F.when(F.abs(lam) < 1e-12, F.ln(x)).otherwise((F.pow(x, lam) - 1) / lam)


def log_histogram(df: DataFrame, columns: list[str], width: float) -> dict[str, tuple[float, list[tuple[float, ...]]]]:
    """Of each column (shift, bins): values x plus the shift, |least value| + SHIFT, fall into bins of ln x of ``width``; a bin
    is (count, mean of ln x, and the second to fourth central moments of ln x). Two scans: the least values, and one
    aggregate for all columns whose bins, some hundreds a column whatever the table's size, are all that comes back."""
    ends = df.agg(*[F.min(F.col(c).cast("double")).alias(c) for c in columns]).first().asDict()
    shifts = {c: abs(lo) + SHIFT for c, lo in ends.items() if lo is not None}
    if not shifts:
        return {}
    logs = [F.struct(F.lit(i).alias("i"), F.ln(F.col(c).cast("double") + F.lit(shifts[c])).alias("t")) for i, c in enumerate(shifts)]
    t = df.select(F.explode(F.array(*logs)).alias("v")).where("v.t IS NOT NULL").select("v.i", "v.t", F.floor(F.col("v.t") / width).alias("bin"))
    d = F.col("t") - (F.col("bin") + 0.5) * F.lit(width)  # from the bin's middle, so that powers keep their digits
    found = t.groupBy("i", "bin").agg(F.count("*").alias("n"), *[F.sum(F.pow(d, F.lit(float(k)))).alias(f"d{k}") for k in (1, 2, 3, 4)]).collect()
    names, bins = list(shifts), {c: [] for c in shifts}
    for r in found:
        m1, m2, m3, m4 = (r[f"d{k}"] / r["n"] for k in (1, 2, 3, 4))
        central = (m2 - m1**2, m3 - 3 * m1 * m2 + 2 * m1**3, m4 - 4 * m1 * m3 + 6 * m1**2 * m2 - 3 * m1**4)
        bins[names[r["i"]]].append((r["n"], (r["bin"] + 0.5) * width + m1, *central))
    return {c: (shifts[c], sorted(bins[c], key=lambda x: x[1])) for c in shifts}


def profile_likelihood(bins: list[tuple[float, ...]], lam: float) -> float:
    """(lam - 1) * sum ln x - n/2 * ln var(box_cox(x)), up to a constant, from the bins' moments: within a bin exp(lam t) is
    taken by its Taylor polynomial of fourth degree about the mean."""
    n = sum(b[0] for b in bins)
    mean_log = sum(c * mu for c, mu, *_ in bins) / n
    if abs(lam) < 1e-9:
        return -mean_log * n - n / 2 * log(sum(c * ((mu - mean_log) ** 2 + v) for c, mu, v, *_ in bins) / n)

    if abs(lam) * max(abs(b[1] - mean_log) for b in bins) > 300:
        return float("-inf")  # its powers leave a double's range
    one = two = 0.0  # means of u = exp(lam (t - mean_log)) - 1 and of its square
    for c, mu, v, skew, k in bins:
        u = expm1(lam * (mu - mean_log))
        e = 1 + u
        a2, a3, a4 = lam**2 * v / 2, lam**3 * skew / 6, lam**4 * k / 24
        one += c * (u + e * (a2 + a3 + a4))
        two += c * (u * u + e * e * (4 * a2 + 8 * a3 + 16 * a4) - 2 * e * (a2 + a3 + a4))
    var = two / n - (one / n) ** 2
    # var(box_cox) = exp(2 lam mean_log) var / lam^2, whose first factor meets (lam - 1) * sum ln x
    return -mean_log * n - n / 2 * log(var / lam**2) if var > 0 else float("-inf")


def box_cox_lambdas(df: DataFrame, columns: list[str], low: float = -5.0, high: float = 5.0, width: float = 0.02, places: float = 1e-7, digits: int | None = None) -> dict[str, tuple[float, float]]:
    """(shift, lambda) of each column: the maximum of the profile likelihood in [low, high], by golden section about the best
    point of a grid. The table is scanned twice, whatever the precision. NULLs are left out; a constant column keeps
    lambda 1. ``digits`` rounds lambda, so that engines agree to the last bit of what follows."""
    out = {}
    for c, (shift, bins) in log_histogram(df, columns, width).items():
        if len(bins) == 1 and bins[0][2] <= 1e-18:
            out[c] = shift, 1.0
            continue
        grid = [low + (high - low) * k / 100 for k in range(101)]
        best = max(range(101), key=lambda k, b=bins: profile_likelihood(b, grid[k]))
        a, z = grid[max(best - 1, 0)], grid[min(best + 1, 100)]
        ratio = (sqrt(5) - 1) / 2
        x, y = z - ratio * (z - a), a + ratio * (z - a)
        fx, fy = profile_likelihood(bins, x), profile_likelihood(bins, y)
        while z - a > places:
            if fx >= fy:
                z, y, fy = y, x, fx
                x = z - ratio * (z - a)
                fx = profile_likelihood(bins, x)
            else:
                a, x, fx = x, y, fy
                y = a + ratio * (z - a)
                fy = profile_likelihood(bins, y)
        out[c] = shift, (a + z) / 2 if digits is None else round((a + z) / 2, digits)
    return out


def box_cox_transform(df: DataFrame, columns: list[str], **grid) -> DataFrame:
    found = box_cox_lambdas(df, columns, **grid)
    return df.withColumns({c: box_cox(F.col(c) + F.lit(shift), lam) for c, (shift, lam) in found.items()})


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """Centred, with unit sample deviation (0 where it is 0); rows with a NULL among the columns are left out."""
    rows = df.dropna(how="any", subset=columns)
    stats = rows.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns], *[F.stddev_samp(c).alias(f"_s_{c}") for c in columns])
    scaled = {c: F.when(F.coalesce(F.col(f"_s_{c}"), F.lit(0.0)) == 0, 0.0).otherwise((F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")) for c in columns}
    return rows.crossJoin(F.broadcast(stats)).withColumns(scaled).select(*df.columns)


def column_stats(df: DataFrame, column: str, k: int) -> DataFrame:
    """Mean and the k - 1 inner percentiles, in one row: the i-th is the least value that i/k of the values do not exceed.
    Exact: values are counted, and the counts are range-partitioned and summed along the partitions' totals. NULLs are
    left out; a column without values gives two NULLs."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("v")).agg(F.count("*").alias("n"))
    placed = rank.ranged(counts, [F.asc("v")], "p")
    along = Window.orderBy("p")  # one row a partition
    shift = placed.groupBy("p").agg(F.sum("n").alias("total")).select("p", (F.sum("total").over(along) - F.col("total")).alias("before"), F.sum("total").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("rows"))
    rows = placed.withColumn("local", F.sum("n").over(Window.partitionBy("p").orderBy("v"))).join(F.broadcast(shift), "p")
    upto = F.col("before") + F.col("local")
    place = lambda i: F.call_function("div", i * F.col("rows") + (k - 1), F.lit(k))
    inside = F.filter(F.array(*[F.lit(i) for i in range(1, k)]), lambda i: (place(i) > upto - F.col("n")) & (place(i) <= upto))
    found = rows.select("v", F.explode(inside).alias("i")).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("found"))
    percentiles = F.when(F.size("found") > 0, F.transform("found", lambda x: x["v"])).alias("percentiles")
    return df.agg(F.avg(column).alias("mean")).crossJoin(F.broadcast(found.select(percentiles)))


def melt(df: DataFrame, ids: list[str], values: list[str], name: str = "name", value: str = "value") -> DataFrame:
    return df.unpivot(ids, values, name, value)


def replace_levels(column: str, levels: list[str], by: str) -> Column:
    return F.when(F.col(column).isin(levels), by).otherwise(F.col(column))


#: Accuracy of a KLL sketch of size k: a quantile's rank is off by no more than ERROR[0] / k ** ERROR[1] of the rows, with a
#: probability of 99 % (Karnin, Lang, Liberty 2016, as in Apache DataSketches).
ERROR = (2.296, 0.9723)


def rank_error(k: int) -> float:
    return ERROR[0] / k ** ERROR[1]


def quantile_sketches(df: DataFrame, by: list[str], column: str, k: int = 200) -> DataFrame:
    """by, n, sketch: one KLL sketch of some kilobytes a group, whatever its size, to be stored and merged later. NULLs
    are left out; a group of NULLs has no sketch."""
    rows = df.where(F.col(column).isNotNull())
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.kll_sketch_agg_double(F.col(column).cast("double"), k).alias("sketch"))


def merged_sketches(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The sketches of coarser groups (or of all), without a look at the rows; the error stays that of one sketch."""
    return sketches.groupBy(*(by or [])).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch"))


def sketch_quantiles(sketches: DataFrame, shares: list[float]) -> DataFrame:
    """``sketches`` with ``quantiles``: the values at these shares of the rows."""
    return sketches.withColumn("quantiles", F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(s)) for s in shares])))
