"""Service-level queries: the event log read as requests, counters and gauges.

Events are sparse (about fourteen an hour at the checked scale), so steps are an hour and windows
six hours.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from stayspark.functions.skew import segmented_running_sum
from stayspark.operators import sli
from stayspark.plans.registry import Registry
from stayspark.sources.views import Views

STEP, WINDOW = 3600, 21600
#: Readings of three gauges as shares of the latency.
GAUGE_SCALES = {"cpu": 0.01, "heap": 0.02, "kafka_lag": 1.0}
BOUNDS = (5.0, 20.0, 50.0, 100.0)


def _grid(ts: str) -> str:
    return f"(epoch_us({ts}) + {STEP * 1_000_000 - 1}) // {STEP * 1_000_000} * {STEP * 1_000_000}"


def _trailing(keys: str, table: str, sums: str, window: int = WINDOW) -> str:
    on = " and ".join(f"b.{k} = a.{k}" for k in keys.split(", "))
    cols = ", ".join(f"a.{k}" for k in keys.split(", "))
    return f"""
        select {cols}, a.step, {sums} from {table} a join {table} b on {on}
          and b.step <= a.step and b.step > a.step - {window * 1_000_000}
        group by {cols}, a.step"""


_LE = ", ".join(f"('{b}', {b}e0)" for b in BOUNDS) + ", ('+Inf', 1e300)"

REG = Registry(
    {
        "counter_log": """
            select uri, ts, event_id, count(*) over (partition by cast(ts as date), uri order by ts, event_id) "value"
            from requests""",
        "increase_log": """
            select uri, ts, case when before is null then 0 when "value" >= before then "value" - before
                   else "value" end up
            from (select *, lag("value") over (partition by uri order by ts, event_id) before from counter_log) x""",
        "increase_steps": f"select uri, {_grid('ts')} step, sum(up) up from increase_log group by 1, 2",
        "rates": _trailing("uri", "increase_steps", f"sum(b.up) / {WINDOW}.0 rate"),
        "short_rates": _trailing("uri", "increase_steps", f"sum(b.up) / {2 * STEP}.0 rate", 2 * STEP),
        "request_steps": f"""
            select uri, {_grid('ts')} step, count(*) n, count(*) filter (where latency_ms < 20) fast,
                   count(*) filter (where status >= 500) failed from requests group by 1, 2""",
        "slis": _trailing(
            "uri", "request_steps",
            "sum(b.fast) / greatest(sum(b.n), 1e-9) latency_sli, "
            "(sum(b.n) - sum(b.failed)) / greatest(sum(b.n), 1e-9) availability_sli",
        ),
        "gauge_steps": f"""
            select uri, step, case when "value" < 20 then 1.0 else 0.0 end good from (
              select uri, {_grid('ts')} step, arg_max(latency_ms, (ts, event_id)) "value"
              from requests group by 1, 2) g""",
        "service_gauges": f"""
            select uri, sli, step, case when "value" * scale < bound then 1.0 else 0.0 end good from (
              select uri, {_grid('ts')} step, arg_max(latency_ms, (ts, event_id)) "value" from requests group by 1, 2) g,
              (values ('cpu', 0.01e0, 0.8e0), ('heap', 0.02e0, 0.85e0), ('kafka_lag', 1e0, 100e0)) s(sli, scale, bound)""",
        "service_gauge_sums": _trailing("uri, sli", "service_gauges", "sum(b.good) g, count(*) n"),
        "indicators": """
            select uri, 'latency' sli, step, latency_sli "value" from slis
            union all select uri, sli, step, g / n from service_gauge_sums
            union all
            select a.uri, 'eviction', a.step, avg(case when b.rate <= 0 then 1.0 else 0.0 end)
            from short_rates a join short_rates b on b.uri = a.uri and b.step <= a.step
              and b.step > a.step - 21600000000 group by a.uri, a.step
            union all select uri, 'deadlock', step, rate from rates""",
        "bucket_log": f"""
            select uri, le, ts, event_id, sum(case when latency_ms <= bound then 1 else 0 end)
              over (partition by cast(ts as date), uri, le order by ts, event_id) "value"
            from requests, (values {_LE}) b(le, bound)""",
        "bucket_steps": f"""
            select uri, le, {_grid('ts')} step, sum(case when before is null then 0
                     when "value" >= before then "value" - before else "value" end) up
            from (select *, lag("value") over (partition by uri, le order by ts, event_id) before from bucket_log) x
            group by 1, 2, 3""",
        "bucket_rates": _trailing("uri, le", "bucket_steps", f"sum(b.up) / {WINDOW}.0 rate"),
    }
)
query = REG.query


def counters(v: Views):
    """A request counter per address that restarts every day."""
    day = v.requests().withColumn("day", F.col("ts").cast("date"))
    counted = segmented_running_sum(
        day, ["day", "uri"], [F.asc("ts"), F.asc("event_id")], F.date_trunc("hour", F.col("ts")),
        {"value": F.lit(1).cast("long")},
    )
    return counted.select("uri", "ts", "event_id", "value")


def bucket_counters(v: Views):
    """Cumulative latency buckets of the same requests, as counters that restart every day."""
    bounds = F.array(
        *[F.struct(F.lit(str(b)).alias("le"), F.lit(b).alias("bound")) for b in BOUNDS],
        F.struct(F.lit("+Inf").alias("le"), F.lit(float("inf")).alias("bound")),
    )
    hit = v.requests().select(
        "uri", "ts", "event_id", "latency_ms", F.col("ts").cast("date").alias("day"),
        F.explode(bounds).alias("b"),
    ).select(
        "uri", "ts", "event_id", "day", F.col("b.le").alias("le"),
        F.when(F.col("latency_ms") <= F.col("b.bound"), 1).otherwise(0).cast("long").alias("hit"),
    )
    counted = segmented_running_sum(
        hit, ["day", "uri", "le"], [F.asc("ts"), F.asc("event_id")],
        F.date_trunc("hour", F.col("ts")), {"value": F.col("hit")},
    )
    return counted.select("uri", "le", "ts", "event_id", "value")


def order():
    return [F.col("ts"), F.col("event_id")]


def bucket_rates(v: Views):
    return sli.rate(
        bucket_counters(v), ["uri", "le"], order(), WINDOW, STEP
    )


@query("sli1_counter_rate", "select uri, step, round(rate, 6) rate from rates")
def _(v: Views):
    return sli.rate(counters(v), ["uri"], order(), WINDOW, STEP)


@query("sli2_latency_from_requests", "select uri, step, round(latency_sli, 6) latency_sli from slis")
def _(v: Views):
    return sli.request_ratios(v.requests(), ["uri"], WINDOW, STEP, 20).drop("availability_sli")


@query("sli2_latency_from_buckets", """
    select uri, step, round(coalesce(sum(rate) filter (where le = '20.0'), 0)
           / greatest(coalesce(sum(rate) filter (where le = '+Inf'), 0), 1e-9), 6) latency_sli
    from bucket_rates group by uri, step""")
def _(v: Views):
    return sli.bucket_ratio(bucket_rates(v), ["uri"], "20.0")


@query("sli3_availability", """
    select service, step, round((n - failed) / greatest(n, 1e-9), 6) availability_sli from (
      select 'all' service, a.step, sum(b.n) n, sum(b.failed) failed
      from (select step, sum(n) n, sum(failed) failed from request_steps group by 1) a
      join (select step, sum(n) n, sum(failed) failed from request_steps group by 1) b
        on b.step <= a.step and b.step > a.step - 21600000000 group by a.step) x""")
def _(v: Views):
    """Over all addresses of the service."""
    whole = v.requests().withColumn("service", F.lit("all"))
    return sli.request_ratios(whole, ["service"], WINDOW, STEP, 20).drop("latency_sli")


@query("sli4_gauge_share", f"""
    select uri, step, round(g / n, 6) good_share from (
      {_trailing("uri", "gauge_steps", "sum(b.good) g, count(*) n")}) x""")
def _(v: Views):
    gauge = v.requests().withColumnRenamed("latency_ms", "value")
    return sli.gauge_share(gauge, ["uri"], 20.0, WINDOW, STEP, tie="event_id")


@query("sli5_quiet_share", """
    select a.uri, a.step, round(avg(case when b.rate <= 0 then 1.0 else 0.0 end), 6) good_share
    from short_rates a join short_rates b on b.uri = a.uri and b.step <= a.step
      and b.step > a.step - 21600000000 group by a.uri, a.step""")
def _(v: Views):
    return sli.quiet_share(counters(v), ["uri"], order(), 2 * STEP, WINDOW, STEP)


@query("sli6_alerts", f"""
    select uri, step, since, case when step - since >= {2 * STEP * 1_000_000} then 'firing' else 'pending' end state
    from (select uri, step, min(step) over (partition by uri, island) since from (
      select uri, step, bad, sum(begins) over (partition by uri order by step) island from (
        select uri, step, latency_sli < 0.5 bad,
               case when latency_sli < 0.5 and coalesce(lag(latency_sli < 0.5) over w, false)
                         and step - lag(step) over w <= {STEP * 1_000_000} then 0 else 1 end begins
        from slis window w as (partition by uri order by step)) f) g where bad) h""")
def _(v: Views):
    """Fewer than half of the requests fast, held for two hours."""
    ratios = sli.request_ratios(v.requests(), ["uri"], WINDOW, STEP, 20)
    return sli.alerts(ratios, ["uri"], F.col("latency_sli") < 0.5, 2 * STEP, STEP)


SERVICE_ALERTS_SQL = f"""
    select uri, sli, step, since, case when step - since >= hold * 1000000 then 'firing' else 'pending' end state, severity
    from (select *, min(step) over (partition by uri, sli, island) since from (
      select *, sum(begins) over (partition by uri, sli order by step) island from (
        select *, case when bad and coalesce(lag(bad) over w, false)
                            and step - lag(step) over w <= {STEP * 1_000_000} then 0 else 1 end begins
        from (select i.*, hold, severity, case when upper then "value" > bound else "value" < bound end bad
              from indicators i join (values ('latency', false, 0.99e0, 120, 'warning'), ('cpu', false, 0.95e0, 60, 'warning'),
                ('heap', false, 0.99e0, 120, 'warning'), ('kafka_lag', false, 0.99e0, 60, 'warning'),
                ('eviction', false, 0.99e0, 60, 'warning'), ('deadlock', true, 0e0, 30, 'info'))
                r(sli, upper, bound, hold, severity) on r.sli = i.sli) x
        window w as (partition by uri, sli order by step)) f) g where bad) h"""


def indicators(v: Views):
    """(uri, sli, step, value) of the six service alerts."""
    latency = sli.request_ratios(v.requests(), ["uri"], WINDOW, STEP, 20)
    last = sli.resample(v.requests().withColumnRenamed("latency_ms", "value"), ["uri"], STEP, "event_id")
    each = F.explode(F.array(*[F.struct(F.lit(g).alias("sli"), (F.col("value") * s).alias("value")) for g, s in GAUGE_SCALES.items()]))
    gauges = last.select("uri", "step", each.alias("g")).select("uri", "step", "g.*")
    gauges = sli.share_of_time(gauges, ["uri", "sli"], F.col("value") < sli.by_name("sli", sli.GAUGE_BOUNDS), WINDOW, STEP)
    quiet = sli.quiet_share(counters(v), ["uri"], order(), 2 * STEP, WINDOW, STEP)
    moving = sli.rate(counters(v), ["uri"], order(), WINDOW, STEP)
    found = latency.select("uri", F.lit("latency").alias("sli"), "step", F.col("latency_sli").alias("value"))
    found = found.unionByName(gauges.withColumnRenamed("good_share", "value"))
    found = found.unionByName(quiet.select("uri", F.lit("eviction").alias("sli"), "step", F.col("good_share").alias("value")))
    found = found.unionByName(moving.select("uri", F.lit("deadlock").alias("sli"), "step", F.col("rate").alias("value")))
    return found


@query("sli6_service_alerts", SERVICE_ALERTS_SQL)
def _(v: Views):
    """The six service alerts per address."""
    return sli.service_alerts(indicators(v), ["uri"], STEP)


@query("sli7_histogram_quantile", """
    select uri, step, round(case when bound = 'Infinity'::double then low
             when rate > below then low + (bound - low) * (0.99 * total - below) / (rate - below)
             else bound end, 6) quantile
    from (select *, row_number() over (partition by uri, step order by bound) rn from (
      select uri, step, bound, rate, max(rate) over g total, coalesce(lag(bound) over w, 0.0) low,
             coalesce(lag(rate) over w, 0.0) below
      from (select *, case when le = '+Inf' then 'Infinity'::double else cast(le as double) end bound from bucket_rates) r
      window w as (partition by uri, step order by bound), g as (partition by uri, step)) x
      where total > 0 and rate >= 0.99 * total) y where rn = 1""")
def _(v: Views):
    return sli.histogram_quantile(bucket_rates(v), ["uri"], 0.99)


@query("sli7_exact_percentiles", """
    select uri, q, round(quantile, 6) "value" from (
      select uri, unnest([0.5e0, 0.95e0, 0.99e0]) q,
             unnest(quantile_cont(latency_ms, [0.5, 0.95, 0.99])) quantile from requests group by uri) x""")
def _(v: Views):
    return sli.exact_quantiles(v.requests(), ["uri"], "latency_ms", [0.5, 0.95, 0.99])


@query("sli8_gauge_ratio", f"""
    select uri, step, round(coalesce(sum(latency_ms) filter (where status < 500), 0)
           / greatest(sum(latency_ms), 1.0), 6) ratio
    from (select *, {_grid('ts')} step from requests) r group by uri, step""")
def _(v: Views):
    """Time spent in served requests over all time spent, per address and step."""
    s = v.requests().select(
        "uri", sli.on_grid(F.col("ts"), STEP).alias("step"), F.col("latency_ms").alias("value"),
        F.when(F.col("status") < 500, "served").otherwise("failed").alias("metric"),
    )
    return sli.gauge_ratio(s, ["uri"], "served", ["served", "failed"])


@query("sli8_grouped_sum", """
    select status, step, round(sum(rate), 6) total
    from (select *, case when uri = 'error' then 500 else 200 end status from rates) r group by status, step""")
def _(v: Views):
    """Rates summed by status."""
    rates = sli.rate(counters(v), ["uri"], order(), WINDOW, STEP)
    by_status = rates.withColumn("status", F.when(F.col("uri") == "error", 500).otherwise(200))
    return sli.grouped_sum(by_status, ["status"])
