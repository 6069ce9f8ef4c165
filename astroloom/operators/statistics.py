"""Statistics of pixels, per image and over the survey.

What an image gives can be added up, so the survey's mean and deviation are
sums of rows that map tasks have made."""

from __future__ import annotations

import math
from decimal import Decimal, localcontext

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.pixels import finite

STATS = ["n_valid_pixels", "sum_pixel_values", "sum_pixel_values_squared", "min", "max", "frac_zeros", "kurtosis"]


def explode_pixels(images: DataFrame, key: list[str], pix: str = "pix") -> DataFrame:
    """A row for each pixel: key and v (double)."""
    return images.select(*key, F.explode(pix).alias("v")).withColumn("v", F.col("v").cast("double"))


def pixel_stats(pixels: DataFrame, key: list[str]) -> DataFrame:
    """The seven statistics over finite pixels; an image without any has zero sums and null extremes. Blocks of an image may lie in different tasks."""
    ok = finite(F.col("v"))
    v = F.when(ok, F.col("v"))
    n = F.count(v)
    return pixels.groupBy(*key).agg(
        n.alias("n_valid_pixels"), F.coalesce(F.sum(v), F.lit(0.0)).alias("sum_pixel_values"), F.coalesce(F.sum(v * v), F.lit(0.0)).alias("sum_pixel_values_squared"),
        F.min(v).alias("min"), F.max(v).alias("max"), F.coalesce(F.try_divide(F.count_if(v == 0), n), F.lit(0.0)).alias("frac_zeros"), F.kurtosis(v).alias("kurtosis"),
    )


def wide(stats: DataFrame, key: list[str], bands: list[str]) -> DataFrame:
    """A row for each tile, with seven columns for each band; bands that are missing are null."""
    cells = [F.max(F.when(F.col("band") == b, F.col(s))).alias(f"{b}_{s}") for b in bands for s in STATS]
    return stats.groupBy(*key).agg(F.concat_ws("", F.array_sort(F.collect_set("band"))).alias("bands"), *cells)


def usable(most_zeros: float = 0.02, most_sum: float = 2e11, kurtosis_bands: tuple = ("g", "z"), least_kurtosis: float = 1000.0) -> Column:
    """Which images count for the survey: few zeros, no runaway sum, and for some bands a peaked distribution. A missing kurtosis fails there."""
    k = F.coalesce(F.nanvl(F.col("kurtosis"), F.lit(None).cast("double")) >= least_kurtosis, F.lit(False))
    return (F.col("frac_zeros") <= most_zeros) & (F.col("sum_pixel_values") <= most_sum) & (~F.col("band").isin(*kurtosis_bands) | k)


def survey_mean_std(stats: DataFrame, key: list[str] | None = None) -> DataFrame:
    """n, mean and std (as 32-bit floats in the stored form) over the images, for each key or for all."""
    n, s, q = F.sum("n_valid_pixels"), F.sum("sum_pixel_values"), F.sum("sum_pixel_values_squared")
    sums = stats.groupBy(*(key or [])).agg(n.alias("n"), s.alias("s"), q.alias("q"))
    var = F.try_divide(F.col("q") - F.try_divide(F.col("s") * F.col("s"), F.col("n")), F.col("n"))
    return sums.select(*(key or []), "n", F.try_divide(F.col("s"), F.col("n")).alias("mean"), F.sqrt(F.greatest(var, F.lit(0.0))).alias("std"))


def exact_mean_std(stats: DataFrame, key: list[str]) -> DataFrame:
    """The same with sums in 100-digit decimals: tasks add up what they read, and the few sums of each key meet."""
    import pandas as pd

    def part(batches):
        total: dict = {}
        with localcontext() as c:
            c.prec = 100
            for pdf in batches:
                for row in pdf.itertuples(index=False):
                    t = total.setdefault(tuple(row[: len(key)]), [0, Decimal(0), Decimal(0)])
                    t[0] += int(row[-3])
                    t[1] += Decimal(row[-2])
                    t[2] += Decimal(row[-1])
        yield pd.DataFrame([(*k, n, str(s), str(q)) for k, (n, s, q) in total.items()], columns=[*key, "n", "s", "q"])

    def final(pdf):
        with localcontext() as c:
            c.prec = 100
            n, s, q = int(pdf["n"].sum()), sum(map(Decimal, pdf["s"])), sum(map(Decimal, pdf["q"]))
            mean, var = (s / n, (q - s * s / n) / n) if n else (Decimal("NaN"),) * 2
            std = var.sqrt() if n and var > 0 else Decimal(0) if n else Decimal("NaN")
            return pd.DataFrame([(*(pdf[k].iloc[0] for k in key), n, float(mean), float(std))], columns=[*key, "n", "mean", "std"])

    own = stats.select(*key, "n_valid_pixels", "sum_pixel_values", "sum_pixel_values_squared")
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields[: len(key)])
    return own.mapInPandas(part, f"{types}, n long, s string, q string").groupBy(*key).applyInPandas(final, f"{types}, n long, mean double, std double")


def kahan(values: Column) -> Column:
    """Compensated sum of an array, in ascending order of the values so that it doesn't depend on the tasks."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("c"))

    def add(a: Column, v: Column) -> Column:
        y = v - a.c
        t = a.s + y
        return F.struct(t.alias("s"), ((t - a.s) - y).alias("c"))

    return F.aggregate(F.array_sort(values), zero, add, lambda a: a.s)


def expansion(values: list[float]) -> list[float]:
    """A few numbers whose exact sum is that of the values, the largest first: each is the rest's correctly rounded sum. Values that aren't finite give their plain sum."""
    out: list[float] = []
    try:
        while True:
            rest = math.fsum([*values, *(-x for x in out)])
            if rest == 0:
                return out
            if not math.isfinite(rest):
                return [rest]
            out.append(rest)
    except (OverflowError, ValueError):
        return [float(sum(values))]


def expansions(df: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """key and, for each column of doubles, numbers whose exact sum is the column's; nulls are left out.

    A task holds an expansion for each key and column, a few numbers whose sum is exact; what the tasks send is merged by the same rule.
    Without a key all rows are one group, and an empty table gives one row."""
    own = df.select(*key, *(F.col(v).cast("double").alias(v) for v in values))
    typed = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[: len(key)]), *(f"`{v}` array<double>" for v in values)])

    def parts(batches):
        import pyarrow as pa

        held: dict[tuple, list[list[float]]] = {}

        def rows():
            columns = [pa.array([k[n] for k in held], own_types[n]) for n in range(len(key))]
            columns += [pa.array([v[n] for v in held.values()], pa.list_(pa.float64())) for n in range(len(values))]
            return pa.RecordBatch.from_arrays(columns, names=[*key, *values])

        own_types: list = []
        for batch in batches:
            own_types = own_types or [batch.schema.field(c).type for c in key]
            keys = list(zip(*(batch.column(c).to_pylist() for c in key), strict=True)) if key else [()] * batch.num_rows
            groups: dict[tuple, list[int]] = {}
            for n, k in enumerate(keys):
                groups.setdefault(k, []).append(n)
            columns = [batch.column(v).to_pylist() for v in values]
            for k, at in groups.items():
                was = held.setdefault(k, [[] for _ in values])
                for n, c in enumerate(columns):
                    was[n] = expansion([*was[n], *(c[i] for i in at if c[i] is not None)])
            if len(held) > 50_000:
                yield rows()
                held.clear()
        if held:
            yield rows()

    sent = own.mapInArrow(parts, typed)
    return sent.groupBy(*key).agg(*(F.flatten(F.collect_list(v)).alias(v) for v in values))  # a few numbers from each task


def compensated_sums(df: DataFrame, key: list[str], values: list[str]) -> DataFrame:
    """key and the correctly rounded sum of each column of doubles, whatever the order of the rows and the tasks; a group without values has 0."""
    found = expansions(df, key, values)
    typed = ", ".join(f"`{f.name}` {'double' if f.name in values else f.dataType.simpleString()}" for f in found.schema.fields)

    def summed(batches):
        import pyarrow as pa

        for batch in batches:
            sums = [pa.array([(expansion(v) or [0.0])[0] for v in batch.column(c).to_pylist()], pa.float64()) for c in values]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in key), *sums], names=[*key, *values])

    return found.mapInArrow(summed, typed)


def compensated_mean_std(stats: DataFrame, key: list[str] | None = None) -> DataFrame:
    """n, mean and std over images from exact sums, finished in decimals of 100 digits; for each key or for all. Sums are finite."""
    import pandas as pd

    key = key or []
    names = ["n_valid_pixels", "sum_pixel_values", "sum_pixel_values_squared"]
    sums = expansions(stats, key, names)
    typed = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in sums.schema.fields[: len(key)])

    def finished(batches):
        for pdf in batches:
            rows = []
            with localcontext() as c:
                c.prec = 100
                for *own, n, s, q in pdf[[*key, *names]].itertuples(index=False):
                    n, s, q = (sum(map(Decimal, map(float, v)), Decimal(0)) for v in (n, s, q))
                    mean, std = (s / n, max((q - s * s / n) / n, Decimal(0)).sqrt()) if n else (None, None)
                    rows.append((*own, int(n), mean if mean is None else float(mean), std if std is None else float(std)))
            yield pd.DataFrame(rows, columns=[*key, "n", "mean", "std"])

    return sums.mapInPandas(finished, f"{typed}n long, mean double, std double")


def describe(pixels: DataFrame, key: list[str]) -> DataFrame:
    v = F.col("v")
    moments = pixels.groupBy(*key).agg(F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"), F.var_pop(v).alias("var"), F.skewness(v).alias("skew"), F.kurtosis(v).alias("kurtosis"))
    middle = percentiles(pixels, key, [0.5]).select(*key, F.get("p", F.lit(0)).alias("median"))
    return moments.join(middle, key, "left").select(*key, "mean", "median", "std", "var", "skew", "kurtosis")


def percentiles(pixels: DataFrame, key: list[str], shares: list[float], accuracy: int = 10_000, spread: int = 16) -> DataFrame:
    """Exact percentiles with linear interpolation over the pixels that aren't missing, in bounded memory.

    A sketch of fixed size brackets each percentile between two values with a share of 4 / accuracy of the pixels; what
    lies below is counted, and only the distinct values of the brackets come together. Reads pixels twice. A column of key that is null makes no row.

    Where the sketches are too many to broadcast, the pixels of an image meet theirs in `spread` tasks and not in one: rows are dealt by a hash of all
    their columns (so give pixels their place: rows alike in all columns stay together)."""
    good = pixels.where(F.col("v").isNotNull() & ~F.isnan("v")).select(*key, "v", F.pmod(F.xxhash64(*pixels.columns), F.lit(spread)).cast("int").alias("_s"))
    at = lambda move: F.array(*(F.lit(min(max(float(x) + move, 0.0), 1.0)) for x in shares))
    sketch = good.groupBy(*key).agg(F.count("v").alias("n"), F.percentile_approx("v", at(-2 / accuracy), accuracy).alias("lo"), F.percentile_approx("v", at(2 / accuracy), accuracy).alias("hi"))
    met = good.join(sketch.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))), [*key, "_s"])
    each = [(F.get("lo", F.lit(k)), F.get("hi", F.lit(k))) for k in range(len(shares))]
    v = F.col("v")
    # The neighbours of a bracket stand for ranks just outside of it.
    sums = met.groupBy(*key).agg(F.first("n").alias("n"), *(x for k, (lo, hi) in enumerate(each) for x in (F.count_if(v < lo).alias(f"b{k}"), F.max(F.when(v < lo, v)).alias(f"d{k}"), F.min(F.when(v > hi, v)).alias(f"u{k}"))))
    inside = F.explode(F.array_compact(F.array(*(F.when((v >= lo) & (v <= hi), F.lit(k)) for k, (lo, hi) in enumerate(each)))))
    counted = met.select(*key, "v", inside.alias("k")).groupBy(*key, "k", "v").agg(F.count(F.lit(1)).alias("c"))
    lists = counted.groupBy(*key).agg(*(F.array_sort(F.collect_list(F.when(F.col("k") == k, F.struct("v", "c")))).alias(f"l{k}") for k in range(len(shares))))
    both = sums.join(lists, key)

    def ranked(k: int, rank: Column) -> Column:
        """The value at a rank from 0."""
        step = lambda a, x: F.struct((a.left - x.c).alias("left"), F.when(a.v.isNull() & (a.left < x.c), x.v).otherwise(a.v).alias("v"))
        left = rank - F.col(f"b{k}")
        found = F.aggregate(f"l{k}", F.struct(left.alias("left"), F.lit(None).cast("double").alias("v")), step, lambda a: a.v)
        return F.when(left < 0, F.col(f"d{k}")).otherwise(F.coalesce(found, F.col(f"u{k}")))

    out = []
    for k, share in enumerate(shares):
        place = (F.col("n") - 1) * float(share)
        low = F.floor(place)
        below, above = ranked(k, low), ranked(k, F.least(low + 1, F.col("n") - 1))
        out.append(F.when(place == low, below).otherwise(below * (low + 1 - place) + above * (place - low)))
    return both.select(*key, F.array(*out).alias("p"))


def percentile_for(pixels: DataFrame, key: list[str], target: float, step: float = 0.01) -> DataFrame:
    """The first percentile from 100 downward, 0 excluded, whose value is at most target, else 100.

    Values up to the target are counted; only the percentiles between the last of them and the next value need that value. No group is held."""
    v, n = F.col("v"), round(100 / step)
    known = pixels.where(v.isNotNull() & ~F.isnan("v")).groupBy(*key).agg(F.count(v).alias("n"), F.count_if(v <= target).alias("c"), F.max(F.when(v <= target, v)).alias("lo"), F.min(F.when(v > target, v)).alias("hi"))
    place = lambda k: (F.col("n") - 1) * (k / F.lit(n))
    over = lambda k: place(k) - (F.col("c") - 1)
    fits = lambda k: (over(k) <= 0) | ((over(k) < 1) & (F.col("lo") * (1 - over(k)) + F.col("hi") * over(k) <= target))
    best = F.array_max(F.filter(F.sequence(F.lit(1), F.lit(n)), lambda k: (F.col("c") > 0) & F.coalesce(fits(k), F.lit(True))))
    return known.select(*key, F.coalesce(F.lit(100.0) - (n - best) * step, F.lit(100.0)).alias("percentile"))


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int) -> DataFrame:
    """bin (1 to bins, the last one closed) and n."""
    v = F.col(value)
    b = F.when(v == high, F.lit(bins)).otherwise(F.width_bucket(v, F.lit(low), F.lit(high), F.lit(bins)))
    return df.where((v >= low) & (v <= high)).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
