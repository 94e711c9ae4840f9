"""Weekly series per region, fiscal horizon, monthly roll-up and the published forecast rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimloom.functions.dates import future_sundays, month_end, week_ending, weeks_to_year_end


def weekly_series(
    df: DataFrame, by: Sequence[str], day: str, value: str, after: str | None = None, out: str = "ds"
) -> DataFrame:
    """Sum per series and week (weeks end on Sunday), empty weeks as 0.

    Rows without day or value are dropped; ``after`` is exclusive. The sum is combined per task
    before the shuffle, so a region with most of the rows costs no more than a small one.
    """
    kept = df.select(*by, day, value).na.drop(subset=[day, value])
    if after is not None:
        kept = kept.filter(F.col(day) > F.lit(after).cast("date"))
    weeks = kept.groupBy(*by, week_ending(F.col(day)).alias(out)).agg(F.sum(value).alias(value))
    return fill_weeks(weeks, by, out, value)


def fill_weeks(weeks: DataFrame, by: Sequence[str], day: str = "ds", value: str = "y") -> DataFrame:
    """Add the missing weeks between the first and the last one of each series with value 0.

    Each row fills the gap up to its successor, so the aggregate is computed once and not joined to
    itself. The window runs over one row per week, a number the calendar bounds.
    """
    following = F.lead(day).over(Window.partitionBy(*by).orderBy(day))
    until = F.coalesce(F.date_sub(F.col("_next"), 7), F.col(day))
    spread = weeks.withColumn("_next", following).withColumn(
        "_week", F.explode(F.sequence(F.col(day), until, F.expr("interval 7 days")))
    )
    zero = F.lit(0).cast(weeks.schema[value].dataType)
    return spread.select(
        *by, F.col("_week").alias(day), F.when(F.col("_week") == F.col(day), F.col(value)).otherwise(zero).alias(value)
    )


def fiscal_horizon(series: DataFrame, by: Sequence[str], day: str = "ds") -> DataFrame:
    """Last week of each series and the whole weeks left until its fiscal year ends."""
    last = series.groupBy(*by).agg(F.max(day).alias("last_week"))
    return last.withColumn("periods", weeks_to_year_end(F.col("last_week")))


def future_weeks(horizon: DataFrame, by: Sequence[str], history: DataFrame | None = None, day: str = "ds") -> DataFrame:
    """The Sundays after the last week, one row each; with the observed weeks if ``history`` is given."""
    ahead = horizon.select(*by, F.explode(future_sundays(F.col("last_week"), F.col("periods"))).alias(day))
    return ahead if history is None else history.select(*by, day).unionByName(ahead)


def monthly_rollup(df: DataFrame, by: Sequence[str], day: str = "ds", value: str = "yhat") -> DataFrame:
    """Sum per month, labelled with the last day of the month."""
    return df.groupBy(*by, month_end(F.col(day)).alias("month_end")).agg(F.sum(value).alias(value))


def with_run_columns(df: DataFrame, load_date: str, source: str = "Forecast") -> DataFrame:
    return df.withColumns({"Source": F.lit(source), "Load_date": F.lit(load_date).cast("date")})


def publish_forecast(months: DataFrame, region: str, value: str, load_date: str) -> DataFrame:
    """Monthly forecast in the shape of the warehouse table."""
    named = months.select(
        F.col("month_end").alias("forecast_date"), F.col(value).alias("Amount"), F.col(region).alias("Region")
    )
    return with_run_columns(named, load_date).select("forecast_date", "Amount", "Source", "Region", "Load_date")


def demand_features(daily: DataFrame, item: str, day: str, value: str, holidays: Sequence[str] = ()) -> DataFrame:
    """Weekend and holiday flags and the previous day's demand of each item.

    Expects one row per item and day, so that a window partition is bounded by the calendar.
    """
    previous = F.lag(value, 1).over(Window.partitionBy(item).orderBy(day))
    weekend = F.dayofweek(day).isin(1, 7).cast("bigint")
    holiday = F.date_format(day, "MM-dd").isin(*holidays).cast("int") if holidays else F.lit(0)
    return daily.withColumns({"weekend": weekend, "holiday": holiday, "previous_days_demand": previous})
