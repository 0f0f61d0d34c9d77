"""Distribution of KPI window averages over the last ``capacity`` emitted windows.

Each window's average order value is rounded HALF_UP to a whole number. The report gives the
lifetime number of windows, the retained size, min, max, mean, population stddev (0 below two
values) and nearest-rank quantiles (``percentile_disc``); every statistic is 0 when empty.

The retained set is a top-k (``orderBy(window_start desc).limit(capacity)``): each task keeps at
most ``capacity`` rows, so the final merge is bounded by tasks x capacity. The lifetime count is a
separate distributed count over the same columns, so both read one exchange of the KPI aggregate;
the two single-row results are merged by a union + aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.config import DEFAULT_HISTOGRAM_CAPACITY

# The quantiles reported by default.
DEFAULT_QUANTILES = (0.5, 0.75, 0.95, 0.98, 0.99, 0.999)


def quantile_name(q: float) -> str:
    return "p" + f"{q:.3f}".split(".")[1].rstrip("0").ljust(2, "0")


def kpi_value_distribution(kpis: DataFrame, capacity: int = DEFAULT_HISTOGRAM_CAPACITY,
                           quantiles: tuple[float, ...] = DEFAULT_QUANTILES) -> DataFrame:
    values = kpis.select("window_start",
                         F.round(F.col("average_order_value"), 0).cast("long").alias("v"))
    retained = values.orderBy(F.col("window_start").desc()).limit(capacity)
    n = F.count("v")
    stats = retained.agg(
        n.alias("size"),
        F.min("v").alias("min"), F.max("v").alias("max"),
        F.avg("v").alias("mean"),
        F.when(n >= 2, F.stddev_pop("v")).alias("stddev"),
        *[F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY v)").alias(quantile_name(q)) for q in quantiles])
    # counts through `v`, so that it needs the same columns as `retained`
    lifetime = values.agg((F.count("v") + F.count_if(F.col("v").isNull())).alias("count"))
    merged = lifetime.unionByName(stats, allowMissingColumns=True)
    cols = ["count", "size", "min", "max", "mean", "stddev"] + [quantile_name(q) for q in quantiles]
    out = merged.agg(*[F.max(c).alias(c) for c in cols])
    zero_long = {"count", "size", "min", "max"}
    return out.select(*[F.coalesce(F.col(c), F.lit(0)).cast("long" if c in zero_long else "double").alias(c)
                        for c in cols])
