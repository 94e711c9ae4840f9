"""Calendar expressions: weeks that end on Sunday, a fiscal year that ends on 31 March."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_FIRST = "d-M-yyyy"
YEAR_FIRST = "yyyy-M-d"
MONTH_FIRST = "MM/dd/yyyy"


def week_ending(day: Column) -> Column:
    """First Sunday on or after the day."""
    return F.next_day(F.date_sub(day, 1), "SU")


def fiscal_year_end(day: Column) -> Column:
    year = F.when(F.month(day) <= 3, F.year(day)).otherwise(F.year(day) + 1)
    return F.make_date(year, F.lit(3), F.lit(31))


def weeks_to_year_end(day: Column) -> Column:
    """Whole weeks left until the fiscal year ends."""
    return F.floor(F.datediff(fiscal_year_end(day), day) / 7).cast("int")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def future_sundays(last_week: Column, periods: Column) -> Column:
    """Array of the next ``periods`` Sundays after ``last_week``; empty for zero periods."""
    first = F.date_add(last_week, 7)
    last = F.date_add(last_week, periods * 7)
    step = F.expr("interval 7 days")
    return F.when(periods > 0, F.sequence(first, last, step)).otherwise(F.array().cast("array<date>"))


def parse_dates(df: DataFrame, columns: Sequence[str], fmt: str, on_error: str = "fail") -> DataFrame:
    """Parse text columns in place; ``on_error`` is ``fail`` or ``null``."""
    parse = F.to_date if on_error == "fail" else F.try_to_date
    return df.withColumns({c: parse(F.col(c), fmt) for c in columns})


def parse_date_columns(df: DataFrame, columns: Sequence[str], formats: Sequence[str] = (DAY_FIRST, YEAR_FIRST)) -> DataFrame:
    """Parse each column with the first format that fits *every* row of it.

    The choices of all columns are one scalar sub-query (one scan, a single aggregate row), so formats
    are never mixed between rows. If none fits, the last one is applied strictly and fails on the bad row.
    """
    choices, parsed = [], {}
    for column in columns:
        text = F.col(column).cast("string")
        failures = [F.count_if(text.isNotNull() & F.try_to_date(text, fmt).isNull()) for fmt in formats[:-1]]
        chosen = F.lit(len(formats) - 1)
        for i in reversed(range(len(failures))):
            chosen = F.when(failures[i] == 0, F.lit(i)).otherwise(chosen)
        choices.append(chosen)
    picks = df.agg(F.array(*choices).alias("picks")).scalar()
    for place, column in enumerate(columns):
        text = F.col(column).cast("string")
        value = F.to_date(text, formats[-1])
        for i in reversed(range(len(formats) - 1)):
            value = F.when(picks[place] == i, F.try_to_date(text, formats[i])).otherwise(value)
        parsed[column] = value
    return df.withColumns(parsed)


def parse_date_column(df: DataFrame, column: str, formats: Sequence[str] = (DAY_FIRST, YEAR_FIRST)) -> DataFrame:
    return parse_date_columns(df, [column], formats)
