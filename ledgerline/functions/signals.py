"""Live signals of a running pipeline: pure expressions and small aggregates over sample tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F


def parity_badge(source: Column, lake: Column, quarantined: Column, rate: Column, p95: Column, drained: Column) -> Column:
    """Struct of diff, allowed and state. In flight rows may differ: rate * p95 * 1.5, rounded up. Any null input: unknown."""
    diff = source - lake - quarantined
    allowed = F.ceil(F.greatest(rate, F.lit(0.0)) * F.greatest(p95, F.lit(0.0)) * 1.5)
    missing = source.isNull() | lake.isNull() | quarantined.isNull() | rate.isNull() | p95.isNull() | drained.isNull()
    state = (
        F.when(missing, "unknown")
        .when(drained & (diff != 0), "mismatch")
        .when(F.abs(diff) <= allowed, "in_sync")
        .otherwise("catching_up")
    )
    return F.struct(diff.alias("diff"), allowed.alias("allowed"), state.alias("state"))


def drained(lag: Column, now: Column, last_batch: Column, end_changed: Column, source_changed: Column, quiet: int = 15) -> Column:
    """Nothing is left to process, and for `quiet` seconds no batch ended and neither end offsets nor source count changed."""
    still = lambda since: since.isNotNull() & (now - since >= quiet)
    return F.coalesce((lag == 0) & (last_batch.isNull() | (now - last_batch >= quiet)) & still(end_changed) & still(source_changed), F.lit(False))


def consumer_lag(ends: DataFrame, events: DataFrame, gauges: DataFrame) -> DataFrame:
    """partition, end_offset, processed, lag. Progress events win over gauges; a partition known to neither is all lag."""
    e = events.select("partition", F.col("processed").alias("_event"))
    g = gauges.select("partition", F.col("processed").alias("_gauge"))
    processed = F.coalesce("_event", "_gauge", F.lit(0))
    joined = ends.join(e, "partition", "left").join(g, "partition", "left")
    return joined.select("partition", "end_offset", processed.alias("processed"), F.greatest(F.col("end_offset") - processed, F.lit(0)).alias("lag"))


def end_offsets(batch: DataFrame) -> DataFrame:
    """The exclusive end offset of each partition; rows without a value count too."""
    return batch.groupBy("partition").agg((F.max("offset") + 1).alias("end_offset"))


def nearest_rank(values: DataFrame | GroupedData, column: str, ranks: dict[str, float], *more: Column) -> DataFrame:
    """A nearest-rank percentile for each alias, in one row or one of each group; 0 without samples."""
    return values.agg(*more, *(F.coalesce(F.expr(f"percentile_disc({q}) within group (order by {column})"), F.lit(0.0)).alias(a) for a, q in ranks.items()))


def rate(samples: DataFrame, window: int) -> DataFrame:
    """series, t, rate: at each sample the counter's growth per second since the first sample of its last `window` seconds; 0 if it fell or if there is one sample."""
    w = Window.partitionBy("series").orderBy("t").rangeBetween(-window, 0)
    first_t, first_v = F.first("t").over(w), F.first("v").over(w)
    grown = (F.col("v") - first_v) / F.when(F.col("t") > first_t, F.col("t") - first_t)
    return samples.select("series", "t", F.greatest(F.coalesce(grown, F.lit(0.0)), F.lit(0.0)).alias("rate"))


def growth(samples: DataFrame, window: int) -> DataFrame:
    """series, t, growth: each sample less the oldest of its last `window` seconds."""
    w = Window.partitionBy("series").orderBy("t").rangeBetween(-window, 0)
    return samples.select("series", "t", (F.col("v") - F.first("v").over(w)).alias("growth"))


def moving_sum(samples: DataFrame, window: int) -> DataFrame:
    """series, t, per_second: the sum of the last `window` seconds' values, by the second."""
    w = Window.partitionBy("series").orderBy("t").rangeBetween(-window, 0)
    return samples.select("series", "t", (F.sum("v").over(w) / F.lit(float(window))).alias("per_second"))


def connector_state(status: DataFrame) -> DataFrame:
    """id, http_status, body: the connector's state, or that of its first task that isn't running."""
    parsed = F.from_json("body", "connector struct<state: string>, tasks array<struct<state: string>>")
    bad = F.get(F.filter(F.transform(parsed["tasks"], lambda t: t["state"]), lambda s: s != "RUNNING"), F.lit(0))
    own = parsed["connector"]["state"]
    state = (
        F.when(F.col("http_status") == 404, "NOT_REGISTERED")
        .when(F.col("http_status").isNull() | (F.col("http_status") != 200) | own.isNull(), "UNREACHABLE")
        .when(own != "RUNNING", own)
        .otherwise(F.coalesce(bad, F.lit("RUNNING")))
    )
    return status.select("id", state.alias("state"))


def metrics_text(lines: DataFrame, metric: str) -> DataFrame:
    """partition, value from lines of a text exposition; other metrics and malformed lines are skipped."""
    pattern = rf'^{metric}\{{[^}}]*partition="(\d+)"[^}}]*\}}\s+([0-9.eE+-]+)'
    found = lines.select(
        F.expr("try_cast(nullif(regexp_extract(line, r'%s', 1), '') as int)" % pattern).alias("partition"),
        F.expr("try_cast(regexp_extract(line, r'%s', 2) as double)" % pattern).alias("_v"),
    )
    return found.filter("partition is not null and _v is not null").select("partition", F.expr("cast(_v as bigint)").alias("value"))


def progress_offsets(progress: DataFrame, topic: str) -> DataFrame:
    """id, partition, offset from the end offsets of progress documents: {topic: {partition: offset}}, or the one topic there is."""
    raw = F.coalesce(F.get_json_object("body", "$.sources[0].endOffset"), F.get_json_object("body", "$.sources[0].startOffset"))
    topics = F.from_json(raw, "map<string, map<string, string>>")
    own = F.coalesce(F.try_element_at(topics, F.lit(topic)), F.when(F.size(topics) == 1, F.get(F.map_values(topics), F.lit(0))))
    rows = progress.select("id", F.explode(own).alias("partition", "_o"))
    return rows.select("id", "partition", F.expr("try_cast(_o as bigint)").alias("offset")).filter("offset is not null")


def alert_intervals(samples: DataFrame) -> DataFrame:
    """samples: rule, t, active, hold. Alerts of conditions that last for `hold` seconds, each rule its own: rule, fired_at, resolved_at (null: live).

    Gaps and islands: runs of active samples between inactive ones; a run fires at its first sample at least `hold` seconds after
    its start, is one alert until the next inactive sample, and resolves there. Each frame is read once: an inactive sample opens
    a run, so the next run's opening ends this one.
    """
    off = ~F.col("active")
    told = samples.withColumn("_run", F.count(F.when(off, 1)).over(Window.partitionBy("rule").orderBy("t")))
    began = F.min(F.when(F.col("active"), F.col("t"))).over(Window.partitionBy("rule", "_run"))
    held = told.withColumn("_held", F.col("active") & (F.col("t") - began >= F.col("hold")))
    runs = held.groupBy("rule", "_run").agg(F.min(F.when(F.col("_held"), F.col("t"))).alias("fired_at"), F.min(F.when(off, F.col("t"))).alias("_opened"))
    ended = runs.withColumn("resolved_at", F.lead("_opened").over(Window.partitionBy("rule").orderBy("_run")))
    return ended.filter("fired_at is not null").select("rule", "fired_at", "resolved_at")


def state_changes(alerts: DataFrame) -> DataFrame:
    """seq, rule, t, state: what happened to alerts, numbered in order of time (then rule and state), so that a client can ask for what it missed.

    Alerts are few beside the samples they come from; their numbering is one sequence by nature.
    """
    moves = F.array(F.struct(F.col("fired_at").alias("t"), F.lit("firing").alias("state")), F.struct(F.col("resolved_at").alias("t"), F.lit("resolved").alias("state")))
    each = alerts.select("rule", F.inline(moves)).filter("t is not null")
    return each.select(F.row_number().over(Window.orderBy("t", "rule", "state")).cast("long").alias("seq"), "rule", "t", "state")


def acknowledged(alerts: DataFrame, acks: DataFrame) -> DataFrame:
    """alerts with acked_at, acked_by and state. acks: rule, t, actor. Only a live alert can be acknowledged, and only once: later acks and those of resolved alerts count for nothing.

    Alerts of a rule don't overlap, so an ack can only be of the last one that fired before it: one window over both, no pairs.
    """
    none = F.lit(None)
    fired = alerts.select("rule", F.col("fired_at").alias("t"), F.lit(0).alias("_ack"), none.cast("string").alias("actor"), F.struct("fired_at", "resolved_at").alias("_own"))
    told = acks.select("rule", "t", F.lit(1).alias("_ack"), "actor", none.cast(fired.schema["_own"].dataType).alias("_own"))
    w = Window.partitionBy("rule").orderBy("t", "_ack").rowsBetween(Window.unboundedPreceding, 0)
    both = fired.union(told).withColumn("_of", F.last("_own", ignorenulls=True).over(w)).filter("_of is not null")
    live = (F.col("_ack") == 1) & (F.col("_of.resolved_at").isNull() | (F.col("t") < F.col("_of.resolved_at")))
    first = both.groupBy("rule", F.col("_of.fired_at").alias("fired_at"), F.col("_of.resolved_at").alias("resolved_at")).agg(F.min(F.when(live, F.struct("t", "actor"))).alias("_a"))
    at = F.col("_a.t")
    state = F.when(F.col("resolved_at").isNotNull(), "resolved").when(at.isNotNull(), "acknowledged").otherwise("firing")
    return first.select("rule", "fired_at", "resolved_at", at.alias("acked_at"), F.col("_a.actor").alias("acked_by"), state.alias("state"))


def freshness_samples(samples: DataFrame, active_for: int = 60) -> DataFrame:
    """samples: t, freshness, last_batch, caught_up. Those that tell of latency: a batch ended in the last `active_for` seconds, and records were waiting."""
    recent = F.coalesce(F.col("t") - F.col("last_batch") <= active_for, F.lit(False))
    return samples.filter(recent & ~F.coalesce(F.col("caught_up"), F.lit(False)))


def latest_batch(events: DataFrame, by: list[str]) -> DataFrame:
    """Of progress events (batch_id, committed_at, others) that with the greatest batch_id, the last of equal ones; for each `by`."""
    rest = [c for c in events.columns if c not in by]
    best = events.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct("batch_id", "committed_at")).alias("_e"))
    return best.select(*by, *(F.col("_e")[c].alias(c) for c in rest))


def source_health(polls: DataFrame, now: int) -> DataFrame:
    """polls: source, t, error (null or empty: it answered). source, ok (its last poll), error, age_s (since it last answered; null: never)."""
    fine = F.coalesce(F.col("error"), F.lit("")) == ""
    last = F.max_by(F.coalesce(F.col("error"), F.lit("")), "t")
    told = polls.groupBy("source").agg(last.alias("error"), F.max(F.when(fine, F.col("t"))).alias("_t"))
    return told.select("source", (F.col("error") == "").alias("ok"), "error", (F.lit(now) - F.col("_t")).alias("age_s"))


def exposition(gauges: dict[str, float], offsets: dict[str, int], prefix: str = "ledger") -> str:
    """Gauges and each partition's processed offset as text lines, in the form that metrics_text reads."""
    lines = [f"{prefix}_{name} {value:g}" for name, value in sorted(gauges.items())]
    lines += [f'{prefix}_processed_offset{{partition="{p}"}} {o}' for p, o in sorted(offsets.items())]
    return "\n".join(lines) + "\n"
