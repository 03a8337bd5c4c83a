"""Service-level indicators and objectives over metric series.

Raw samples are reduced to one row per series and evaluation step before any window runs, so the
longest sort per series is its number of steps, however often it was sampled. Times are epoch
microseconds; a step is named by its end and covers (end - step, end]. Rates are sums of
non-negative increases over a trailing window divided by the window; a drop counts as a restart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayspark.functions.columns import ceil_micros
from stayspark.functions.skew import segmented_lag, segmented_running_sum

SECOND = 1_000_000
# Fixed values of the model: the service alerts (side of the bound that is bad, bound, hold seconds,
# severity) and the bounds of the gauges behind three of them.
SERVICE_ALERTS = {
    "latency": ("below", 0.99, 120, "warning"),
    "cpu": ("below", 0.95, 60, "warning"),
    "heap": ("below", 0.99, 120, "warning"),
    "kafka_lag": ("below", 0.99, 60, "warning"),
    "eviction": ("below", 0.99, 60, "warning"),
    "deadlock": ("above", 0.0, 30, "info"),
}
GAUGE_BOUNDS = {"cpu": 0.80, "heap": 0.85, "kafka_lag": 100.0}
FAST_MS = 500
CLAMP = 1e-9


def on_grid(ts: Column, step_s: int) -> Column:
    """End of the evaluation step an instant falls in."""
    return ceil_micros(F.unix_micros(ts), step_s * SECOND)


def trailing(df: DataFrame, keys: list[str], step_s: int, window_s: int, **sums: Column) -> DataFrame:
    """Sums over the trailing window at every step present; ``df`` has one row per (keys, step)."""
    w = Window.partitionBy(*keys).orderBy("step").rangeBetween(-(window_s - step_s) * SECOND, 0)
    return df.select(*keys, "step", *[F.sum(c).over(w).alias(n) for n, c in sums.items()])


def increases(
    samples: DataFrame, keys: list[str], order: list[Column], value: str = "value"
) -> DataFrame:
    """Samples plus ``increase`` over the previous sample of the series (0 for its first).

    A series is cut by hour for the look-back, so one very busy series is read in parts.
    """
    hour = F.date_trunc("hour", F.col("ts"))
    lagged = segmented_lag(samples, keys, order, hour, value, "_before")
    v, before = F.col(value), F.col("_before")
    up = F.when(before.isNull(), F.lit(0)).when(v >= before, v - before).otherwise(v)
    return lagged.withColumn("increase", up.cast("double")).drop("_before")


def rate(
    samples: DataFrame, keys: list[str], order: list[Column], window_s: int = 300, step_s: int = 15,
    value: str = "value",
) -> DataFrame:
    """(keys, step, rate): increase per second over the trailing window."""
    stepped = (
        increases(samples, keys, order, value)
        .groupBy(*keys, on_grid(F.col("ts"), step_s).alias("step"))
        .agg(F.sum("increase").alias("increase"))
    )
    summed = trailing(stepped, keys, step_s, window_s, total=F.col("increase"))
    return summed.select(*keys, "step", (F.col("total") / F.lit(window_s)).alias("rate"))


def ratio(good: Column, total: Column, clamp: float = CLAMP) -> Column:
    return good / F.greatest(total, F.lit(clamp))


def request_ratios(
    requests: DataFrame, keys: list[str], window_s: int = 300, step_s: int = 15, fast_ms: float = FAST_MS
) -> DataFrame:
    """Latency share under the bound and non-5xx share per step, from raw requests, in one pass."""
    stepped = requests.groupBy(*keys, on_grid(F.col("ts"), step_s).alias("step")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("latency_ms") < fast_ms).alias("fast"),
        F.count_if(F.col("status") >= 500).alias("failed"),
    )
    t = trailing(
        stepped, keys, step_s, window_s, n=F.col("n"), fast=F.col("fast"), failed=F.col("failed")
    )
    return t.select(
        *keys, "step",
        ratio(F.col("fast"), F.col("n")).alias("latency_sli"),
        ratio(F.col("n") - F.col("failed"), F.col("n")).alias("availability_sli"),
    )


def bucket_ratio(bucket_rates: DataFrame, keys: list[str], le: str) -> DataFrame:
    """Share of requests inside the ``le`` bucket: its rate over the +Inf rate, clamped."""
    good = F.sum(F.when(F.col("le") == le, F.col("rate")))
    total = F.sum(F.when(F.col("le") == "+Inf", F.col("rate")))
    return bucket_rates.groupBy(*keys, "step").agg(
        ratio(F.coalesce(good, F.lit(0.0)), F.coalesce(total, F.lit(0.0))).alias("latency_sli")
    )


def resample(samples: DataFrame, keys: list[str], step_s: int, tie: str | None = None) -> DataFrame:
    """Latest value per series and step."""
    order = F.struct("ts", tie) if tie else F.col("ts")
    return samples.groupBy(*keys, on_grid(F.col("ts"), step_s).alias("step")).agg(
        F.max_by("value", order).alias("value")
    )


def share_of_time(
    steps: DataFrame, keys: list[str], good: Column, window_s: int = 300, step_s: int = 15
) -> DataFrame:
    """(keys, step, good_share): mean of a condition over the steps of the trailing window."""
    flagged = steps.withColumn("_good", F.when(good, 1.0).otherwise(0.0))
    t = trailing(flagged, keys, step_s, window_s, good=F.col("_good"), n=F.lit(1))
    return t.select(*keys, "step", (F.col("good") / F.col("n")).alias("good_share"))


def gauge_share(
    samples: DataFrame, keys: list[str], bound: float, window_s: int = 300, step_s: int = 15,
    tie: str | None = None,
) -> DataFrame:
    """Fraction of time a gauge is below its bound."""
    steps = resample(samples, keys, step_s, tie)
    return share_of_time(steps, keys, F.col("value") < bound, window_s, step_s)


def quiet_share(
    samples: DataFrame, keys: list[str], order: list[Column], rate_window_s: int = 60,
    window_s: int = 300, step_s: int = 15,
) -> DataFrame:
    """Fraction of time a counter does not move."""
    rates = rate(samples, keys, order, rate_window_s, step_s)
    return share_of_time(rates, keys, F.col("rate") <= 0, window_s, step_s)


def by_name(name: str, values: dict) -> Column:
    """The value that belongs to a name, null for other names."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), F.col(name))


def rule_columns(rules: dict[str, tuple]) -> tuple[Column, Column, Column]:
    """(in alert, seconds to hold, severity) of rows with ``sli`` and ``value``."""
    side, bound, hold, severity = (by_name("sli", {k: r[i] for k, r in rules.items()}) for i in range(4))
    bad = F.when(side == "above", F.col("value") > bound).otherwise(F.col("value") < bound)
    return bad, hold, severity


def service_alerts(
    indicators: DataFrame, keys: list[str], step_s: int = 15, rules: dict[str, tuple] = SERVICE_ALERTS
) -> DataFrame:
    """(keys, sli, step, since, state, severity) of every rule from (keys, sli, step, value), in one pass.

    An indicator without a rule or without a value is never in alert.
    """
    bad, hold, severity = rule_columns(rules)
    return alerts(indicators, [*keys, "sli"], bad, hold, step_s).withColumn("severity", severity)


def alerts(
    steps: DataFrame, keys: list[str], condition: Column, hold_s: int | Column, step_s: int = 15
) -> DataFrame:
    """(keys, step, since, state) while a condition holds: pending, then firing after ``hold_s``.

    A step without data ends the episode.
    """
    w = Window.partitionBy(*keys).orderBy("step")
    flagged = steps.withColumn("_on", F.coalesce(condition, F.lit(False)))
    gap = F.col("step") - F.lag("step").over(w) > step_s * SECOND
    begins = F.col("_on") & F.coalesce(~F.lag("_on").over(w) | gap, F.lit(True))
    marked = flagged.withColumn("_begin", F.when(begins, F.col("step")))
    since = F.last("_begin", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return (
        marked.withColumn("since", since)
        .filter("_on")
        .select(
            *keys, "step", "since",
            F.when(F.col("step") - F.col("since") >= hold_s * SECOND, "firing")
            .otherwise("pending").alias("state"),
        )
    )


def histogram_quantile(bucket_rates: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Quantile by linear interpolation inside the bucket that holds the rank.

    ``bucket_rates``: keys, step, le (text, ``+Inf`` included), rate - cumulative over le. A rank in
    the +Inf bucket answers the highest finite bound.
    """
    bound = F.when(F.col("le") == "+Inf", F.lit(float("inf"))).otherwise(F.col("le").cast("double"))
    group = [*keys, "step"]
    w = Window.partitionBy(*group).orderBy("_le")
    whole = Window.partitionBy(*group)
    ranked = (
        bucket_rates.withColumn("_le", bound)
        .withColumn("_total", F.max("rate").over(whole))
        .withColumn("_low", F.coalesce(F.lag("_le").over(w), F.lit(0.0)))
        .withColumn("_below", F.coalesce(F.lag("rate").over(w), F.lit(0.0)))
    )
    rank = F.lit(q) * F.col("_total")
    inside = F.col("_low") + (F.col("_le") - F.col("_low")) * (rank - F.col("_below")) / (
        F.col("rate") - F.col("_below")
    )
    value = F.when(F.col("_le") == float("inf"), F.col("_low")).when(
        F.col("rate") > F.col("_below"), inside
    ).otherwise(F.col("_le"))
    return (
        ranked.filter((F.col("_total") > 0) & (F.col("rate") >= rank))
        .groupBy(*group)
        .agg(F.min_by(value, F.col("_le")).alias("quantile"))
    )


def exact_quantiles(
    df: DataFrame, keys: list[str], value: str, qs: list[float], segment_width: float = 1.0
) -> DataFrame:
    """(keys, q, value): exact interpolated percentiles without gathering a group.

    Equal values collapse to counts; running counts are scanned per value range; the two order
    statistics around each rank come out as minima.
    """
    counted = df.groupBy(*keys, F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    seg = F.floor(F.col("_v") / F.lit(segment_width))
    running = segmented_running_sum(counted, keys, [F.asc("_v")], seg, {"_cum": F.col("_n")})
    sizes = counted.groupBy(*keys).agg(F.sum("_n").alias("_total"))
    ranks = sizes.select(*keys, F.explode(F.array(*[F.lit(q) for q in qs])).alias("q"), "_total")
    pos = F.col("q") * (F.col("_total") - 1)
    joined = running.join(ranks, keys)
    found = joined.groupBy(*keys, "q").agg(
        F.min(F.when(F.col("_cum") > F.floor(pos), F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("_cum") > F.ceil(pos), F.col("_v"))).alias("_hi"),
        F.first(pos - F.floor(pos)).alias("_f"),
    )
    return found.select(
        *keys, "q", (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_f")).alias("value")
    )


def gauge_ratio(
    samples: DataFrame, keys: list[str], part: str, rest: list[str], clamp: float = 1.0
) -> DataFrame:
    """part / max(sum of ``rest``, clamp) at equal step and labels; one grouping, no self-join."""
    top = F.sum(F.when(F.col("metric") == part, F.col("value")))
    bottom = F.sum(F.when(F.col("metric").isin(*rest), F.col("value")))
    return (
        samples.filter(F.col("metric").isin(part, *rest))
        .groupBy(*keys, "step")
        .agg(F.coalesce(top, F.lit(0.0)).alias("_t"), F.coalesce(bottom, F.lit(0.0)).alias("_b"))
        .select(*keys, "step", ratio(F.col("_t"), F.col("_b"), clamp).alias("ratio"))
    )


def grouped_sum(steps: DataFrame, by: list[str], value: str = "rate") -> DataFrame:
    return steps.groupBy(*by, "step").agg(F.sum(value).alias("total"))
