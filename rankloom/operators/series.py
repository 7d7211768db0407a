"""Per-station yearly summaries of readings (the secondary-sort job as Spark aggregates).

A control-break program would sort every reading of a station into one task and walk the
years.  Here the same numbers come from a two-level aggregation: readings ->
(station, year) sums and counts (partially aggregated map-side, so even a station holding
a third of all readings leaves each task as one row per year) -> one ordered series per
station (bounded by its number of years).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankloom.functions.fixed import MEASURE_MAX, MEASURE_MIN, MISSING_MEAN
from rankloom.functions.text import java_double_text, lenient_double, year_prefix
from rankloom.operators.ordered import dense_index


def measure_readings(readings: DataFrame) -> DataFrame:
    """Keep TMIN/TMAX rows (exact case); year = first 4 date chars, value parsed leniently."""
    kept = (F.col("mtype") == MEASURE_MAX) | (F.col("mtype") == MEASURE_MIN)
    return readings.where(kept).select(
        "station",
        year_prefix("date").alias("year"),
        "mtype",
        lenient_double("value").alias("value"),
    )


def secondary_sort(readings: DataFrame) -> DataFrame:
    """Readings ordered by (station, year) - the composite-key order.

    A range shuffle on the full key plus tie-breakers: a station with a huge share of the
    readings is split over several tasks instead of being hashed into one.
    """
    return readings.orderBy("station", "year", "mtype", "value")


def sorted_positions(readings: DataFrame) -> DataFrame:
    """The readings with their position 1..n in (station, year, mtype, value) order: one range
    shuffle, per-partition counts, no window over all rows."""
    return dense_index(readings, ["station", "year", "mtype", "value"], "pos")


def yearly_sums(readings: DataFrame) -> DataFrame:
    """(station, year, sum/count of TMIN, sum/count of TMAX); unparsable values skipped."""
    r = measure_readings(readings)
    is_min = (F.col("mtype") == MEASURE_MIN) & F.col("value").isNotNull()
    is_max = (F.col("mtype") == MEASURE_MAX) & F.col("value").isNotNull()
    return r.groupBy("station", "year").agg(
        F.sum(F.when(is_min, F.col("value"))).alias("sum_tmin"),
        F.count(F.when(is_min, F.lit(1))).alias("n_tmin"),
        F.sum(F.when(is_max, F.col("value"))).alias("sum_tmax"),
        F.count(F.when(is_max, F.lit(1))).alias("n_tmax"),
    )


def yearly_means(readings: DataFrame) -> DataFrame:
    """(station, year, mean_tmin, mean_tmax) with -9999.0 for a measure without readings.

    When a year has neither measure, mean_tmin is -9999.0 and mean_tmax is NaN (0/0), as in
    the original output.  NaN is produced explicitly because ANSI mode rejects 0/0.
    """
    s = yearly_sums(readings)
    no_min = F.col("n_tmin") == 0
    no_max = F.col("n_tmax") == 0
    mean_tmin = F.when(no_min, F.lit(MISSING_MEAN)).otherwise(F.col("sum_tmin") / F.col("n_tmin"))
    mean_tmax = (
        F.when(no_min & no_max, F.lit(float("nan")))
        .when(no_max, F.lit(MISSING_MEAN))
        .otherwise(F.col("sum_tmax") / F.col("n_tmax"))
    )
    return s.select("station", "year", mean_tmin.alias("mean_tmin"), mean_tmax.alias("mean_tmax"))


def year_breaks(readings: DataFrame) -> DataFrame:
    """One row per control break: (station, year, prev_year), prev_year NULL at a station's start.

    The window runs over distinct (station, year) pairs, so its partitions hold one row per
    year of a station, never the raw readings.
    """
    years = measure_readings(readings).select("station", "year").distinct()
    w = Window.partitionBy("station").orderBy("year")
    return years.select("station", "year", F.lag("year").over(w).alias("prev_year"))


def station_series(readings: DataFrame) -> DataFrame:
    """(station, series ARRAY<STRUCT<year, mean_tmin, mean_tmax>>) in ascending year order."""
    means = yearly_means(readings)
    return means.groupBy("station").agg(
        F.array_sort(F.collect_list(F.struct("year", "mean_tmin", "mean_tmax"))).alias("series")
    )


def flatten_series(series: DataFrame) -> DataFrame:
    """(station, pos, year, mean_tmin, mean_tmax): the nested series as ordered rows."""
    return series.select("station", F.posexplode("series").alias("pos", "s")).select(
        "station", "pos", "s.year", "s.mean_tmin", "s.mean_tmax"
    )


def render_series(series: DataFrame) -> DataFrame:
    """``station,[(1800,-148.0,-25.0)(1801,...)]`` lines, doubles printed as the JVM does."""
    item = lambda s: F.concat(
        F.lit("("),
        s["year"].cast("string"),
        F.lit(","),
        java_double_text(s["mean_tmin"]),
        F.lit(","),
        java_double_text(s["mean_tmax"]),
        F.lit(")"),
    )
    return series.select(
        F.concat(
            F.col("station"), F.lit(",["), F.array_join(F.transform("series", item), ""), F.lit("]")
        ).alias("value")
    )
