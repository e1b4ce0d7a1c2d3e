"""Windowed run metrics over event rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import ROWS_PER_BUCKET, running_total
from millrace.session import stable

# Class patterns of failed answers.
SERVER_ERROR = r"^5..$"
CLIENT_ERROR = r"^4..$"


def _windows(minutes: int, slide: int) -> Column:
    """Starts of all windows that cover the slide-wide slot ``_slot``."""
    steps = F.sequence(F.lit(0), F.lit(minutes // slide - 1))
    slot = F.col("_slot")
    return F.transform(steps, lambda k: slot - F.make_dt_interval(mins=k * slide))


def slot_start(ts: Column, minutes: int) -> Column:
    """Start of the ``minutes``-wide slot of a timestamp, aligned to the epoch."""
    return F.window(ts, f"{minutes} minutes").getField("start")


def rate_per_minute(
    events: DataFrame, minutes: int = 5, slide: int = 1, tag: str | None = "tag", ts: str = "ts"
) -> DataFrame:
    """Events per minute over sliding windows, in total or per tag.

    Rows are first counted per slot of one slide, which is where a hot tag shrinks to one row per
    task and slot; only slot counts are spread over the windows they belong to.
    """
    if minutes % slide:
        raise ValueError("the window must be a multiple of the slide")
    keys = [tag] if tag else []
    slots = events.groupBy(*keys, slot_start(F.col(ts), slide).alias("_slot")).agg(
        F.count("*").alias("_n")
    )
    spread = slots.select(*keys, F.explode(_windows(minutes, slide)).alias("window_start"), "_n")
    return spread.groupBy(*keys, "window_start").agg(F.sum("_n").alias("events")).withColumn(
        "per_minute", F.col("events") / F.lit(minutes)
    )


def error_rate(
    events: DataFrame,
    pattern: str,
    status: str = "status_code",
    minutes: int = 5,
    slide: int = 1,
    tag: str | None = "tag",
) -> DataFrame:
    """Rate of the events whose status class fits the pattern."""
    return rate_per_minute(events.filter(F.col(status).rlike(pattern)), minutes, slide, tag)


def p95(
    events: DataFrame,
    minutes: int = 5,
    tag: str = "tag",
    value: str = "duration",
    q: float = 0.95,
    ts: str = "ts",
    approximate: bool = False,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Quantile of the values per tag and window, interpolated between neighbours.

    The exact form ranks distinct values with their counts through ``running_total`` and keeps the
    two neighbours, so no group's values meet in one task. The approximate form is a mergeable
    sketch, for dashboards.
    """
    slotted = events.select(tag, slot_start(F.col(ts), minutes).alias("window_start"), value)
    keys = [tag, "window_start"]
    if approximate:
        return slotted.groupBy(*keys).agg(F.percentile_approx(value, q).cast("double").alias("quantile"))
    weights = stable(
        slotted.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    )
    ranked = running_total(
        weights, [value], keys, "_n", name="_start", total="_total", rows_per_bucket=rows_per_bucket
    )
    at = (F.col("_total") - 1) * F.lit(q)
    end = F.col("_start") + F.col("_n")

    def holds(rank: Column) -> Column:
        return (F.col("_start") <= rank) & (rank < end)

    low, high = F.floor(at), F.ceil(at)
    neighbours = ranked.filter(holds(low) | holds(high)).groupBy(*keys).agg(
        F.max(F.when(holds(low), F.col(value))).alias("_low"),
        F.max(F.when(holds(high), F.col(value))).alias("_high"),
        F.max(at - low).alias("_part"),
    )
    return neighbours.select(
        *keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias("quantile")
    )


#: Size of a quantile sketch: ranks are off by about 1.3 % of the values at 200, the less the larger it is.
SKETCH_K = 200


def sliding_quantile(
    events: DataFrame,
    minutes: int = 5,
    slide: int = 1,
    tag: str = "tag",
    value: str = "duration",
    q: float = 0.95,
    ts: str = "ts",
    k: int = SKETCH_K,
) -> DataFrame:
    """Quantile of the values per tag over sliding windows, from mergeable KLL sketches.

    A value goes into the sketch of its tag and slot of one slide, and into no other; sketches of some KB are merged to
    the windows they belong to. So the windows' overlap costs nothing per value, and a hot tag is a sketch per task and
    slot. The quantile is a value whose rank is off by the sketch's error; sets of at most ``k`` values are exact.
    """
    if minutes % slide:
        raise ValueError("the window must be a multiple of the slide")
    slots = (
        events.filter(F.col(value).isNotNull())
        .groupBy(tag, slot_start(F.col(ts), slide).alias("_slot"))
        .agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("_sketch"), F.count("*").alias("_n"))
    )
    spread = slots.select(tag, F.explode(_windows(minutes, slide)).alias("window_start"), "_sketch", "_n")
    merged = spread.groupBy(tag, "window_start").agg(
        F.kll_merge_agg_double("_sketch", F.lit(k)).alias("_sketch"), F.sum("_n").alias("n")
    )
    quantile = F.kll_sketch_get_quantile_double("_sketch", F.lit(q))
    return merged.select(tag, "window_start", "n", quantile.alias("quantile"))


def rank_error(
    events: DataFrame,
    estimates: DataFrame,
    q: float = 0.95,
    minutes: int = 5,
    slide: int = 1,
    tag: str = "tag",
    value: str = "duration",
    ts: str = "ts",
) -> DataFrame:
    """Distance of each estimate's true ranks to ``q``, as a share of its window's values; 0 if ``q`` lies between the
    rank of the values below it and of those up to it. For tests: every value meets all its windows."""
    slot = events.filter(F.col(value).isNotNull()).select(tag, slot_start(F.col(ts), slide).alias("_slot"), value)
    spread = slot.select(tag, value, F.explode(_windows(minutes, slide)).alias("window_start"))
    ranks = spread.join(estimates, [tag, "window_start"]).groupBy(tag, "window_start").agg(
        F.avg((F.col(value) < F.col("quantile")).cast("double")).alias("_low"),
        F.avg((F.col(value) <= F.col("quantile")).cast("double")).alias("_high"),
    )
    error = F.greatest(F.col("_low") - q, q - F.col("_high"), F.lit(0.0))
    return ranks.select(tag, "window_start", error.alias("rank_error"))


def mean_ratio(
    events: DataFrame, minutes: int = 5, tag: str = "tag", value: str = "duration", ts: str = "ts"
) -> DataFrame:
    """Mean duration per tag and window: rate of the sum over rate of the count."""
    exact = F.sum(F.col(value).cast("decimal(18,6)"))
    return events.groupBy(tag, slot_start(F.col(ts), minutes).alias("window_start")).agg(
        F.try_divide(exact.cast("double"), F.count(value)).alias("mean")
    )


def percent_of(used: Column, limit: Column) -> Column:
    """``used / limit * 100``; NULL for a limit of zero."""
    return F.try_divide(used.cast("double"), limit.cast("double")) * 100
