"""Figures of rounds: nearest-rank percentiles, stage metrics, their roll-up, progress over a trailing window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .ranking import ranked

#: Seconds of the window over which progress is measured.
TRAILING = 900


def nearest_rank(values: DataFrame, by: list[str], value: str, fractions: dict[str, float]) -> DataFrame:
    """by columns and, for each name, the value at index bround((n - 1) * fraction) of the group in order: exact, for groups of any size."""
    own = values.where(F.col(value).isNotNull())
    r = ranked(own.select(*by, value), by, [value], "__rank")
    n = own.groupBy(*by).agg(F.count("*").alias("__n"))
    both = r.join(n, by) if by else r.crossJoin(F.broadcast(n))
    at = lambda f: F.bround((F.col("__n") - 1) * F.lit(f)).cast("long") + 1
    return both.groupBy(*by).agg(*(F.max(F.when(F.col("__rank") == at(f), F.col(value).cast("double"))).alias(k) for k, f in fractions.items()))


def stage_metrics(rows: DataFrame, by: list[str]) -> DataFrame:
    """Figures of rows(by, latency_seconds, input_tokens, output_tokens, queue_depth, duration_seconds, startup_seconds).

    The last two are the same for all rows of a stage. Rates are 0 without a duration; all are rounded to 3 places.
    """
    r = lambda c: F.round(c, 3)
    sums = rows.groupBy(*by).agg(
        F.count("*").alias("requests"), F.max("duration_seconds").alias("duration_seconds"), F.max("startup_seconds").alias("model_startup_seconds"),
        F.coalesce(F.sum(F.col("input_tokens").cast("long")), F.lit(0)).alias("input_tokens"), F.coalesce(F.sum(F.col("output_tokens").cast("long")), F.lit(0)).alias("output_tokens"),
        F.coalesce(F.max("queue_depth"), F.lit(0)).alias("max_worker_queue_depth"),
    )
    per = lambda c: r(F.coalesce(F.try_divide(c, F.nullif(F.col("duration_seconds"), F.lit(0.0))), F.lit(0.0)))
    ranks = nearest_rank(rows, by, "latency_seconds", {"p50": 0.5, "p95": 0.95})
    out = sums.join(ranks, by, "left")
    return out.select(
        *by, "requests", r("duration_seconds").alias("duration_seconds"), r("model_startup_seconds").alias("model_startup_seconds"), per(F.col("requests") * 60).alias("requests_per_minute"),
        "input_tokens", "output_tokens", per((F.col("input_tokens") + F.col("output_tokens")).cast("double")).alias("tokens_per_second"),
        r(F.coalesce("p50", F.lit(0.0))).alias("latency_p50_seconds"), r(F.coalesce("p95", F.lit(0.0))).alias("latency_p95_seconds"), "max_worker_queue_depth",
    )


def rollup(stages: DataFrame) -> DataFrame:
    """One row for rows of :func:`stage_metrics`: sums, rates over all, p50 weighed by requests, largest p95 and depth."""
    r = lambda c: F.round(c, 3)
    s = stages.agg(
        F.sum("requests").alias("requests"), F.sum("duration_seconds").alias("d"), F.sum("model_startup_seconds").alias("m"), F.sum("input_tokens").alias("input_tokens"), F.sum("output_tokens").alias("output_tokens"),
        F.sum(F.col("latency_p50_seconds") * F.col("requests")).alias("w"), F.max("latency_p95_seconds").alias("latency_p95_seconds"), F.max("max_worker_queue_depth").alias("max_worker_queue_depth"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    per = lambda c: r(zero(F.try_divide(c, F.nullif(F.col("d"), F.lit(0.0)))))
    return s.select(
        F.coalesce("requests", F.lit(0)).alias("requests"), r(zero(F.col("d"))).alias("duration_seconds"), r(zero(F.col("m"))).alias("model_startup_seconds"), per(F.col("requests") * 60).alias("requests_per_minute"),
        F.coalesce("input_tokens", F.lit(0)).alias("input_tokens"), F.coalesce("output_tokens", F.lit(0)).alias("output_tokens"), per((F.col("input_tokens") + F.col("output_tokens")).cast("double")).alias("tokens_per_second"),
        r(zero(F.try_divide("w", F.nullif(F.col("requests"), F.lit(0))))).alias("latency_p50_seconds"), zero(F.col("latency_p95_seconds")).alias("latency_p95_seconds"), F.coalesce("max_worker_queue_depth", F.lit(0)).alias("max_worker_queue_depth"),
    )


def machine_load(samples: DataFrame) -> DataFrame:
    """One row for samples(utilization, memory_mb) of a device monitor: their number, mean utilisation, peak memory."""
    return samples.agg(F.count("*").alias("sample_count"), F.round(F.avg("utilization"), 2).alias("average_utilization_percent"), F.round(F.max("memory_mb"), 2).alias("peak_memory_used_mb"))


def progress(points: DataFrame, by: list[str], target: int, attempts: int, trailing: int = TRAILING) -> DataFrame:
    """points(by, at in seconds, accepted, attempted: running totals) with percentages, rates a minute and eta_seconds.

    A rate is the gain since the oldest point of the last ``trailing`` seconds; for the first point of a window, the
    total over the seconds since the start. ``by`` names the runs, each of which is one window's partition.
    """
    own = Window.partitionBy(*by).orderBy("at")
    near = own.rangeBetween(-trailing, 0)
    start = F.min("at").over(Window.partitionBy(*by))
    out = points.withColumns({"__t": F.min("at").over(near), "__a": F.min_by("accepted", "at").over(near), "__m": F.min_by("attempted", "at").over(near), "__n": F.count("*").over(near), "__s": start})
    span, whole = F.greatest(F.lit(0.001), F.col("at") - F.col("__t")), F.greatest(F.lit(0.001), F.col("at") - F.col("__s"))
    rate = lambda c, first: F.when(F.col("__n") > 1, (F.col(c) - F.col(first)) / span).otherwise(F.col(c) / whole)
    a, m = rate("accepted", "__a"), rate("attempted", "__m")
    left = F.greatest(F.lit(0), F.lit(target) - F.col("accepted"))
    share = lambda c, n: F.round(F.col(c) * 100 / F.lit(float(max(1, n))), 3)
    return out.select(
        *points.columns, share("accepted", target).alias("accepted_percent"), share("attempted", attempts).alias("attempts_percent"),
        F.round(a * 60, 3).alias("accepted_per_minute"), F.round(m * 60, 3).alias("attempts_per_minute"), F.round(F.when(a > 0, left / a), 3).alias("eta_seconds"),
    )


def share_of(part: Column, whole: Column, empty: float = 0.0) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(empty))
