"""Exchange rates: today's rates if they are there, else the newest stored ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.dates import MONTH_FIRST

RATE = "decimal(15,8)"


def _leg(rates: DataFrame, day: Column, source: str, target: str, value: str, out: str) -> DataFrame:
    same_pair = (F.trim("from_cur") == source) & (F.trim("to_cur") == target)
    return rates.filter(same_pair & (F.col("effdt") == day)).select(
        F.col("effdt").alias("day"), F.col(value).cast(RATE).alias(out)
    )


def fx_latest(rates: DataFrame, history: DataFrame, as_of: str) -> DataFrame:
    """One row ``(effdt, aud_usd_div, usd_eur_mul)`` dated the day before ``as_of``.

    Fresh rates win, the second leg may be missing. Otherwise the newest row of the history is
    stamped with that day. Every choice is an aggregate, so nothing is sorted globally.
    """
    day = F.date_sub(F.lit(as_of).cast("date"), 1)
    aud = _leg(rates, day, "AUD", "USD", "rate_div", "aud_usd_div")
    eur = _leg(rates, day, "USD", "EUR", "rate_mult", "usd_eur_mul")
    columns = ["aud_usd_div", "usd_eur_mul"]
    fresh = aud.join(eur, "day", "left").select(F.lit(0).alias("priority"), *columns)

    stored = history.select(
        F.to_date("effdt", MONTH_FIRST).alias("day"), *[F.col(c).cast(RATE).alias(c) for c in columns]
    )
    newest = stored.agg(F.max(F.struct("day", *columns)).alias("row")).filter(F.col("row").isNotNull())
    known = newest.select(F.lit(1).alias("priority"), *[F.col(f"row.{c}").alias(c) for c in columns])

    best = fresh.unionByName(known).agg(F.min(F.struct("priority", *columns)).alias("row"))
    return best.filter(F.col("row").isNotNull()).select(
        F.date_format(day, MONTH_FIRST).alias("effdt"), *[F.col(f"row.{c}").alias(c) for c in columns]
    )
