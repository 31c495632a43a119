"""Dashboard views, queries and measures.

``predictions`` is the scored table (machine_id, timestamp, is_anomaly,
anomaly_score, confidence, event_date), ``readings`` the sensor table. Every
function takes the clock as ``as_of``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.functions.clock import minutes_between, recent, shift
from telemill.functions.levels import alert_status, score_severity, temperature_status
from telemill.functions.numbers import one_if, percent, ratio, ratio_or_zero, sum_if
from telemill.operators.intervaljoin import SECOND, TOLERANCE_S, interval_join, nearby_sums, nearest_join
from telemill.operators.ordered import micros
from telemill.sources.schema import DASHBOARD_COLUMNS, LABEL, PARTITION, SENSORS


def _anomaly() -> Column:
    return F.col("is_anomaly")


# --- views ------------------------------------------------------------------

def events_24h(processed: DataFrame, as_of: Column, strict: bool = False) -> DataFrame:
    """Processed events since yesterday's date (so up to 48 h of them).

    ``strict`` keeps the last 24 hours only.
    """
    start = shift(as_of, -24, "HOUR")
    kept = F.col("event_date") >= F.to_date(start)
    if strict:
        kept = kept & (F.col("timestamp") >= start)
    return processed.filter(kept).select(
        "event_id", "machine_id", F.col("timestamp").alias("event_time"), *SENSORS,
        "temperature_zscore", "vibration_zscore", "pressure_zscore", "event_date", "hour_of_day", "day_of_week",
    )


def prediction_view(
    predictions: DataFrame, readings: DataFrame, how_many: str = "all", tie: str = "event_id", **tuning
) -> DataFrame:
    """Predictions with the readings within five seconds, all of them or the nearest."""
    if how_many == "nearest":
        joined = nearest_join(predictions, readings, list(SENSORS), tie)
    else:
        joined = interval_join(predictions, readings, list(SENSORS), **tuning)
    return joined.select(
        "machine_id", F.col("timestamp").alias("prediction_time"), "is_anomaly", "anomaly_score", "confidence", *SENSORS,
        F.to_date("timestamp").alias("prediction_date"), F.hour("timestamp").alias("prediction_hour"),
    )


def dashboard_table(view: DataFrame) -> DataFrame:
    return view.select(*DASHBOARD_COLUMNS)


# --- one-table queries --------------------------------------------------------

def _counts(digits: int) -> list[Column]:
    return [
        F.count("*").alias("total_events"), sum_if(_anomaly()).alias("anomaly_count"),
        percent(sum_if(_anomaly()), F.count("*"), digits).alias("anomaly_rate_pct"),
    ]


def hourly_by_machine(predictions: DataFrame, as_of: Column) -> DataFrame:
    return (
        predictions.filter(recent("timestamp", as_of, 7, "DAY"))
        .groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket"), "machine_id").agg(*_counts(2))
        .orderBy(F.desc("hour_bucket"), "machine_id")
    )


def last_hour_kpi(predictions: DataFrame, as_of: Column) -> DataFrame:
    n, a, rate = _counts(2)
    return predictions.filter(recent("timestamp", as_of, 1, "HOUR")).agg(
        n.alias("events_last_hour"), a.alias("anomalies_last_hour"), rate.alias("anomaly_rate_pct")
    ).select("*", as_of.alias("as_of_utc"))


def daily_trend(predictions: DataFrame, as_of: Column) -> DataFrame:
    return (
        predictions.filter(recent("timestamp", as_of, 30, "DAY"))
        .groupBy(F.to_date("timestamp").alias("event_date")).agg(*_counts(2)).orderBy("event_date")
    )


def events_per_minute(predictions: DataFrame, as_of: Column) -> DataFrame:
    return (
        predictions.filter(recent("timestamp", as_of, 1, "HOUR"))
        .groupBy(F.date_trunc("minute", "timestamp").alias("minute_bucket"))
        .agg(F.count("*").alias("events_per_minute")).orderBy(F.desc("minute_bucket"))
    )


def top_machines(predictions: DataFrame, as_of: Column, k: int = 10) -> DataFrame:
    n, a, rate = _counts(1)
    return (
        predictions.filter(recent("timestamp", as_of, 24, "HOUR")).groupBy("machine_id")
        .agg(n.alias("total_readings"), a, rate, F.round(F.max("anomaly_score"), 4).alias("max_anomaly_score"),
             F.round(F.avg("anomaly_score"), 4).alias("avg_anomaly_score"))
        .orderBy(F.desc("anomaly_count"), "machine_id").limit(k)
    )


# --- queries over the joined view ---------------------------------------------
# The row-level ones cut the predictions to the newest k before they join. The
# aggregates weigh each side's rows by what lies near them on the other side.

def _newest_joined(predictions: DataFrame, readings: DataFrame, k: int) -> DataFrame:
    """The newest k rows of the view, in a total order.

    Every prediction yields at least one row of the view, so the newest k rows
    come from the newest k predictions. Those are at most k rows: broadcast them,
    and read the readings once without a shuffle.
    """
    order = [F.desc("prediction_time"), "machine_id", "anomaly_score", "confidence", "is_anomaly"]
    ties = ["_id", *[F.asc_nulls_last(c) for c in SENSORS]]
    wanted = ["machine_id", "prediction_time", "is_anomaly", "anomaly_score", "confidence"]
    top = (
        predictions.withColumn("prediction_time", F.col("timestamp")).select(*wanted, micros(predictions, "timestamp").alias("_us"))
        .orderBy(*order).limit(k)
        .select(F.struct("*").alias("p")).agg(F.sort_array(F.collect_list("p")).alias("ps"))
        .select(F.posexplode("ps").alias("_id", "p")).select("_id", "p.*")
    )
    tol, width = TOLERANCE_S * SECOND, 2 * TOLERANCE_S * SECOND
    reach = F.array_distinct(F.array(F.floor((F.col("_us") - tol) / width), F.floor((F.col("_us") + tol) / width)))
    probes = top.select("_id", *wanted, "_us", F.explode(reach).alias("_bk"))
    # A bucket lies within one date. The filter holds for every probe; it tells the optimizer that
    # the probes are few, which makes it prune the readings' dates by them.
    probes = probes.withColumn("_date", F.to_date(F.timestamp_micros((F.col("_bk") * width).cast("long")))).filter(F.col("_id") < k)
    dated = PARTITION in readings.columns
    near = readings.select(
        F.col("machine_id").alias("_rk"), micros(readings, "timestamp").alias("_rus"), *SENSORS,
        *[F.col(PARTITION).alias("_rdate")] * dated,
    ).withColumn("_rbk", F.floor(F.col("_rus") / width))
    meets = (
        (F.col("machine_id") == F.col("_rk")) & (F.col("_bk") == F.col("_rbk"))
        & F.col("_us").between(F.col("_rus") - tol, F.col("_rus") + tol)
    )
    matched = near.join(
        F.broadcast(probes), meets & (F.col("_date") == F.col("_rdate")) if dated else meets
    ).select("_id", *wanted, *SENSORS).orderBy(*order, *ties).limit(k)
    return top.select("_id", *wanted).join(F.broadcast(matched.select("_id", *SENSORS)), "_id", "left").orderBy(
        *order, *ties
    ).limit(k)


def scatter(predictions: DataFrame, readings: DataFrame, k: int = 1000) -> DataFrame:
    return _newest_joined(predictions, readings, k).select(
        "machine_id", "temperature", "vibration", "pressure", "is_anomaly", "anomaly_score", "prediction_time"
    )


def alert_feed(predictions: DataFrame, readings: DataFrame, as_of: Column, k: int = 100) -> DataFrame:
    return _newest_joined(predictions.filter(_anomaly()), readings, k).select(
        "machine_id", "prediction_time", "anomaly_score", "confidence", *SENSORS,
        score_severity(F.col("anomaly_score")).alias("alert_severity"),
        minutes_between(F.col("prediction_time"), as_of.cast(predictions.schema["timestamp"].dataType)).alias("minutes_ago"),
    )


def _side(df: DataFrame, groups: dict[str, Column], sums: dict[str, Column]) -> DataFrame:
    """One side of the join, reduced to its distinct (machine, time, groups)."""
    keyed = df.select(
        "machine_id", micros(df, "timestamp").alias("us"), *[c.alias(n) for n, c in groups.items()],
        *[c.alias(n) for n, c in sums.items()],
    ).filter("us IS NOT NULL")
    return keyed


def _weigh(left: DataFrame, right: DataFrame, left_sums: Sequence[str], right_sums: Sequence[str]) -> DataFrame:
    """Both sides in one table with ``near_*`` totals of the other side."""
    both = left.withColumn("is_prediction", F.lit(True)).unionByName(
        right.withColumn("is_prediction", F.lit(False)), allowMissingColumns=True
    )
    sums = [*left_sums, *right_sums]
    both = both.withColumns({s: F.coalesce(F.col(s), F.lit(0)) for s in sums})
    return nearby_sums(both, sums)


def _prediction_side(predictions: DataFrame, groups: dict[str, Column]) -> DataFrame:
    keys = ["machine_id", "us", *groups]
    return _side(predictions, groups, {"a": one_if(_anomaly()), "b": one_if(~_anomaly())}).groupBy(*keys).agg(
        F.count("*").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b")
    )


def _reading_counts(readings: DataFrame, groups: dict[str, Column]) -> DataFrame:
    return _side(readings, groups, {}).groupBy("machine_id", "us", *groups).agg(F.count("*").alias("r"))


def _joinable(readings: DataFrame, start: Column) -> DataFrame:
    """Readings that a prediction from ``start`` on can reach; one without a machine meets none."""
    earliest = shift(start, -TOLERANCE_S, "SECOND")
    kept = (F.col("timestamp") >= earliest) & F.col("machine_id").isNotNull()
    if "event_date" in readings.columns:
        kept = kept & (F.col("event_date") >= F.to_date(earliest))
    return readings.filter(kept)


def _since_date(predictions: DataFrame, as_of: Column, days: int) -> tuple[DataFrame, Column]:
    start = F.date_trunc("day", as_of) - F.expr(f"INTERVAL '{days}' DAY")
    return predictions.filter((F.col("timestamp") >= start) & (F.col("event_date") >= F.to_date(start))), start


def temperature_histogram(predictions: DataFrame, readings: DataFrame, as_of: Column, step: float = 5.0) -> DataFrame:
    """Pairs per temperature bin; unmatched predictions fall into the NULL bin."""
    recent_predictions, start = _since_date(predictions, as_of, 7)
    left = _prediction_side(recent_predictions, {})
    bin_start = (F.floor(F.col("temperature") / step) * step).cast("double")
    right = _reading_counts(_joinable(readings, start), {"temp_bin_start": bin_start})
    both = _weigh(left, right, ["n", "a"], ["r"])
    lonely = F.col("is_prediction") & (F.col("near_r") == 0)
    pairs = F.when(lonely, F.col("n")).when(~F.col("is_prediction"), F.col("r") * F.col("near_n"))
    hits = F.when(lonely, F.col("a")).when(~F.col("is_prediction"), F.col("r") * F.col("near_a"))
    return (
        both.select("temp_bin_start", pairs.alias("pairs"), hits.alias("hits")).filter("pairs > 0")
        .groupBy("temp_bin_start")
        .agg(F.sum("pairs").alias("reading_count"), F.sum("hits").alias("anomaly_in_bin"))
        .select("temp_bin_start", (F.col("temp_bin_start") + step).alias("temp_bin_end"), "reading_count", "anomaly_in_bin")
        .orderBy("temp_bin_start")
    )


# Sums are taken around a fixed value near the data (the sensor's usual mean),
# which keeps the variance accurate. Column -> centre.
_CENTRES = {"temperature": 75.0, "vibration": 0.5, "pressure": 101.3, "current": 12.0}


def machine_statistics(predictions: DataFrame, readings: DataFrame, as_of: Column) -> DataFrame:
    recent_predictions, start = _since_date(predictions, as_of, 7)
    left = _prediction_side(recent_predictions, {})
    near = _joinable(readings, start)
    off = {c: F.col(c) - F.lit(m) for c, m in _CENTRES.items()}
    parts = [F.count("*").alias("r"), F.min("temperature").alias("t_lo"), F.max("temperature").alias("t_hi"),
             F.max("vibration").alias("v_hi"), F.sum(off["temperature"] * off["temperature"]).alias("temperature_sq")]
    for c in _CENTRES:
        parts += [F.sum(off[c]).alias(f"{c}_sum"), F.count(c).alias(f"{c}_n")]
    right = near.withColumn("us", micros(near, "timestamp")).filter("us IS NOT NULL").groupBy("machine_id", "us").agg(*parts)
    both = _weigh(left, right, ["n", "a"], ["r"])
    lonely = F.col("is_prediction") & (F.col("near_r") == 0)
    met = ~F.col("is_prediction") & (F.col("near_n") > 0)

    def weighted(name: str) -> Column:
        return F.sum(F.when(met, F.col("near_n") * F.col(name)))

    grouped = both.filter(lonely | met).groupBy("machine_id").agg(
        F.sum(F.when(lonely, F.col("n")).otherwise(F.col("near_n") * F.col("r"))).alias("total_readings"),
        F.sum(F.when(lonely, F.col("a")).otherwise(F.col("near_a") * F.col("r"))).alias("total_anomalies"),
        F.min(F.when(met, F.col("t_lo"))).alias("t_lo"), F.max(F.when(met, F.col("t_hi"))).alias("t_hi"),
        F.max(F.when(met, F.col("v_hi"))).alias("v_hi"), weighted("temperature_sq").alias("temperature_sq"),
        *[weighted(f"{c}_{k}").alias(f"{c}_{k}") for c in _CENTRES for k in ("sum", "n")],
    )

    def mean(c: str) -> Column:
        return ratio(F.col(f"{c}_sum"), F.col(f"{c}_n")) + _CENTRES[c]

    n, s, sq = F.col("temperature_n"), F.col("temperature_sum"), F.col("temperature_sq")
    deviation = F.when(n > 1, F.sqrt(F.greatest(ratio(sq - ratio(s * s, n), n - 1), F.lit(0.0))))
    return grouped.select(
        "machine_id", "total_readings", F.round(mean("temperature"), 2).alias("avg_temperature"),
        F.round(deviation, 2).alias("std_temperature"), F.round("t_lo", 2).alias("min_temperature"),
        F.round("t_hi", 2).alias("max_temperature"), F.round(mean("vibration"), 3).alias("avg_vibration"),
        F.round("v_hi", 3).alias("max_vibration"), F.round(mean("pressure"), 2).alias("avg_pressure"),
        F.round(mean("current"), 2).alias("avg_current"), "total_anomalies",
    ).orderBy(F.desc("total_anomalies"), "machine_id")


def severity_counts(predictions: DataFrame, readings: DataFrame, as_of: Column) -> DataFrame:
    todays, start = _since_date(predictions.filter(_anomaly()), as_of, 0)
    left = _prediction_side(todays, {"severity": score_severity(F.col("anomaly_score"))})
    both = _weigh(left, _reading_counts(_joinable(readings, start), {}), ["n"], ["r"])
    return (
        both.filter("is_prediction").groupBy("severity")
        .agg(F.sum(F.col("n") * F.greatest("near_r", F.lit(1))).alias("alert_count"))
        .orderBy(F.desc("alert_count"), "severity")
    )


def model_quality(predictions: DataFrame, readings: DataFrame, as_of: Column, label: str = LABEL) -> DataFrame:
    """Daily confusion counts, precision and recall against the readings' labels."""
    recent_predictions = predictions.filter(recent("timestamp", as_of, 30, "DAY"))
    left = _prediction_side(recent_predictions, {"eval_date": F.to_date("timestamp")})
    start = shift(as_of, -30, "DAY")
    labelled = {"r1": one_if(F.col(label)), "r0": one_if(~F.col(label))}
    right = _side(_joinable(readings, start), {}, labelled).groupBy("machine_id", "us").agg(
        F.count("*").alias("r"), F.sum("r1").alias("r1"), F.sum("r0").alias("r0")
    )
    both = _weigh(left, right, ["n"], ["r", "r1", "r0"]).filter("is_prediction")
    rows, hit, miss = F.greatest("near_r", F.lit(1)), F.col("near_r1"), F.col("near_r0")
    return (
        both.groupBy("eval_date").agg(
            F.sum(F.col("n") * rows).alias("total_predictions"), F.sum(F.col("a") * hit).alias("true_positives"),
            F.sum(F.col("b") * miss).alias("true_negatives"), F.sum(F.col("a") * miss).alias("false_positives"),
            F.sum(F.col("b") * hit).alias("false_negatives"), F.sum(F.col("a") * rows).alias("flagged"),
            F.sum(F.col("n") * hit).alias("faulty"),
        ).select(
            "eval_date", "total_predictions", "true_positives", "true_negatives", "false_positives", "false_negatives",
            F.round(ratio(F.col("true_positives"), F.col("flagged")), 4).alias("precision_score"),
            F.round(ratio(F.col("true_positives"), F.col("faulty")), 4).alias("recall_score"),
        ).orderBy(F.desc("eval_date"))
    )


# --- measures -----------------------------------------------------------------

def measures(predictions: DataFrame, as_of: Column, by: Sequence[str] = ()) -> DataFrame:
    """All prediction measures in one pass, optionally per group."""
    last_hour = (F.col("timestamp") >= shift(as_of, -1, "HOUR")) & (F.col("timestamp") <= as_of)
    n, a = F.count("*"), F.count_if(_anomaly())
    hour_rate = ratio_or_zero(F.count_if(last_hour & _anomaly()), F.count_if(last_hour)) * 100
    return predictions.groupBy(*by).agg(
        n.alias("total_events"), a.alias("anomaly_count"), (ratio_or_zero(a, n) * 100).alias("anomaly_rate_pct"),
        hour_rate.alias("anomaly_rate_last_hour_pct"), F.avg(F.when(_anomaly(), F.col("anomaly_score"))).alias("avg_anomaly_score"),
        alert_status(hour_rate).alias("alert_status"),
    )


def highest_risk_machines(predictions: DataFrame, as_of: Column) -> DataFrame:
    """The machine with most anomalies in 24 hours; ties are all kept."""
    inside = recent("timestamp", as_of, 24, "HOUR") & (F.col("timestamp") <= as_of)
    counted = predictions.filter(inside).groupBy("machine_id").agg(F.count_if(_anomaly()).alias("anomaly_count"))
    most = counted.agg(F.max("anomaly_count")).scalar()
    return counted.filter(F.col("anomaly_count") == most)


def temperature_state(readings: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    peak = F.max("temperature")
    return readings.groupBy(*by).agg(peak.alias("max_temperature"), temperature_status(peak).alias("temperature_status"))
