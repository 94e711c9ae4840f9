"""Streaming queries: the given tables arrive as files, a stream drains them, the result is read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.plans import views
from claimloom.plans.invoices import AFTER, HORIZON_SQL, LOAD_DATE, weekly_sql
from claimloom.session import work_path
from claimloom.streaming.flows import compact, delta_stream, drain, log_stream, merged, retrain_stream
from claimloom.streaming.ledger import drain_each, read_ledger

EVENT = "event_id bigint, user_id bigint, event_type string, value double"
CHANGE = "event_id bigint, user_id bigint, event_type string, value double, ts timestamp_ntz"


def logged(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Events as lines of JSON, clicks below a body, purchases below a body of text, and lines that
    cannot be read: errors cut short, and sign-ups of users divisible by 7 as a list."""
    source, out, rejects, state = (work_path(spark, n) for n in ("events", "log", "rejects", "state"))
    event = F.to_json(F.struct("event_id", "user_id", "event_type", "value"))
    kind = F.col("event_type")
    line = F.when(kind == "click", F.concat(F.lit('{"body": '), event, F.lit("}")))
    line = line.when(kind == "purchase", F.to_json(F.struct(event.alias("body"))))
    line = line.when(kind == "error", F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string")))
    line = line.when((kind == "signup") & (F.col("user_id") % 7 == 0), F.concat(F.lit('{"body": ['), event, F.lit("]}")))
    views.table(spark, sf_dir, "events").select(line.otherwise(event).alias("value")).write.text(source)
    log_stream(spark, source, EVENT, out, rejects, state).awaitTermination()
    return out, rejects


def stream_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of all body forms, stored as parquet."""
    return spark.read.schema(EVENT).parquet(logged(spark, sf_dir)[0]).drop("batch")


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines that hold no event, kept as text."""
    raw = spark.read.schema("raw string").parquet(logged(spark, sf_dir)[1]).select("raw")
    return raw.select(
        F.regexp_extract("raw", r'"event_id": ?(\d+)', 1).cast("bigint").alias("event_id"),
        F.when(~F.col("raw").startswith('{"body"'), F.length("raw")).alias("size"),
    )


def stream_drain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages taken in batches; every batch is stored under its number, so a retry replaces it."""
    source, out, state = (work_path(spark, n) for n in ("messages", "drained", "state"))
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    events.write.option("maxRecordsPerFile", 2_000).json(source)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    drain(spark, source, EVENT, store, state).awaitTermination()
    return spark.read.schema(EVENT).parquet(out).drop("batch")


def stream_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every attempt at every event: errors fail each time, some purchases the first time only."""
    source, ledger, state = (work_path(spark, n) for n in ("messages", "ledger", "state"))
    events = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    events.write.option("maxRecordsPerFile", 2_000).json(source)

    def work(message: dict, attempt: int) -> str:
        if message["event_type"] == "error":
            raise ValueError(f"event {message['event_id']}")
        if message["event_type"] == "purchase" and message["user_id"] % 10 == 0 and attempt == 1:
            raise TimeoutError("busy")
        return f"{message['user_id']}:{message['event_type']}"

    drain_each(spark, source, EVENT, work, ledger, state).awaitTermination()
    return read_ledger(spark, ledger, EVENT).select("event_id", "attempt", "status", "result", "error")


def stream_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest event per user from a stream of changes, compacted once."""
    source, out, state = (work_path(spark, n) for n in ("changes", "newest", "state"))
    changes = views.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    changes.write.option("maxRecordsPerFile", 10_000).parquet(source)
    arrivals = spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 3).parquet(source)
    delta_stream(arrivals, ["user_id"], "ts", out, state, tie=["event_id"]).awaitTermination()
    compact(spark, out, CHANGE, ["user_id"], "ts", ["event_id"])
    return merged(spark, out, CHANGE, ["user_id"], "ts", ["event_id"]).drop("ts")


def stream_retrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice lines arrive per region; the forecast of each arriving region is refreshed."""
    source, out, sums, state = (work_path(spark, n) for n in ("invoices", "forecasts", "weeks", "state"))
    lines = views.payable_lines(spark, sf_dir, AFTER).select(
        F.col("country_code").alias("region"), F.col("payment_date").alias("day"), F.col("invoice_fee").alias("y")
    )
    lines.write.partitionBy("region").parquet(source)
    retrain_stream(spark, source, "day date, y decimal(18,2)", out, sums, state, LOAD_DATE, AFTER).awaitTermination()
    return spark.read.parquet(out)


def stream_retrain_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months that the refreshed forecasts have."""
    return stream_retrain(spark, sf_dir).select("forecast_date", "Region", "Load_date", "Source")


QUERIES = {
    "stream_log": stream_log,
    "stream_rejects": stream_rejects,
    "stream_drain": stream_drain,
    "stream_ledger": stream_ledger,
    "stream_delta": stream_delta,
    "stream_retrain": stream_retrain,
    "stream_retrain_months": stream_retrain_months,
}

ORACLE = {
    "stream_retrain_months": f"""with {weekly_sql("country_code")}, {HORIZON_SQL}, steps as (select country_code, last_week,
        unnest(generate_series(1, periods)) as i from horizon)
        select distinct last_day(cast(last_week + cast(7 * i as integer) as date)) as forecast_date, country_code as "Region",
          date '{LOAD_DATE}' as "Load_date", 'Forecast' as "Source" from steps""",
    "stream_log": """select event_id, user_id, event_type, value from events
        where event_type <> 'error' and not (event_type = 'signup' and user_id % 7 = 0)""",
    "stream_rejects": """select event_id, case when event_type = 'error' then length('{"event_id": ' || event_id) end as size
        from events where event_type = 'error' or (event_type = 'signup' and user_id % 7 = 0)""",
    "stream_ledger": """with tries as (select *, unnest(case when event_type = 'error' then [1, 2, 3]
          when event_type = 'purchase' and user_id % 10 = 0 then [1, 2] else [1] end) as attempt from events),
        known as (select *, event_type = 'error' as bad, event_type = 'purchase' and user_id % 10 = 0 and attempt = 1 as busy from tries)
        select event_id, attempt, case when bad and attempt = 3 then 'dead' when bad or busy then 'failed' else 'done' end as status,
          case when not bad and not busy then user_id || ':' || event_type end as result,
          case when bad then 'ValueError: event ' || event_id when busy then 'TimeoutError: busy' end as error from known""",
    "stream_drain": "select event_id, user_id, event_type, value from events",
    "stream_delta": """select event_id, user_id, event_type, value from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
}
