"""Incremental load, sink and run-tracking queries. Files go to new folders below the shared one."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.config.tables import DELTA, SNAPSHOT, TableSpec
from claimloom.functions.casts import cast_columns
from claimloom.operators import incremental
from claimloom.operators.incremental import all_counts, latest_per_group, load_source, run_isolated, run_loads
from claimloom.operators.metrics import best_run as best_of
from claimloom.operators.metrics import pivot_runs as pivoted
from claimloom.plans import views
from claimloom.operators.series import monthly_rollup, publish_forecast
from claimloom.plans.invoices import LINES_SQL, LOAD_DATE, forecast_by_country, payable_monthly
from claimloom.plans.invoices import ORACLE as INVOICE_SQL
from claimloom.session import stored, work_path
from claimloom.sources import manifest, sinks
from claimloom.sources.readers import parse_runs, read_csv_strings, read_forecasts, read_runs, view_frame
from claimloom.sources.versions import read_current
from claimloom.sources.versions import snapshot_replace as replace_snapshot

LOW, HIGH = "2024-01-10 00:00:00", "2024-01-20 12:00:00"

SPECS = [
    TableSpec("events", DELTA, "event_id", "ts"),
    TableSpec("orders", DELTA, "o_orderkey", "o_orderdate"),
    TableSpec("customer", SNAPSHOT),
    TableSpec("supplier", SNAPSHOT),
    TableSpec("part", SNAPSHOT),
]


PUBLISHED_KEYS = ["forecast_date", "Region", "Load_date"]


def reader(spark: SparkSession, sf_dir: str):
    return lambda spec: views.table(spark, sf_dir, spec.name)


def event_columns(df: DataFrame) -> DataFrame:
    return df.select("event_id", "user_id", "event_type", "value")


def delta_closed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(incremental.delta(views.table(spark, sf_dir, "events"), "ts", LOW, HIGH))


def delta_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(incremental.delta(views.table(spark, sf_dir, "events"), "ts", LOW))


def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = incremental.latest_per_key(views.table(spark, sf_dir, "events"), ["user_id"], "ts", ["event_id"])
    return event_columns(newest)


def snapshot_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two snapshots in turn; only the second one is seen."""
    path = work_path(spark, "snapshot")
    customer = views.table(spark, sf_dir, "customer")
    replace_snapshot(customer.withColumn("c_acctbal", F.lit(0.0)), path, "20240101")
    replace_snapshot(customer, path, "20240102")
    return read_current(spark, path)


def replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by status with price 0, then two of the three partitions replaced."""
    path = work_path(spark, "partitions")
    orders = views.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.replace_partition(orders.withColumn("o_totalprice", F.lit(0.0)), path, ["o_orderstatus"])
    sinks.replace_partition(orders.filter(F.col("o_orderstatus") != "P"), path, ["o_orderstatus"])
    return spark.read.schema("o_orderkey bigint, o_totalprice double, o_orderstatus string").parquet(path)


def hub_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A SQL view published to the hub: text amounts cast, stored by country."""
    path = work_path(spark, "hub")
    views.raw_invoices(spark, sf_dir).createOrReplaceTempView("invoice_view")
    rows = view_frame(spark, "invoice_view").select(
        "document_num", "invoice_amt", "payment_amt", F.col("country_code").alias("c_code")
    )
    spark.catalog.dropTempView("invoice_view")  # the frame is resolved and no longer needs the name
    typed = cast_columns(rows, {"invoice_amt": "double", "payment_amt": "double"}, on_error="null")
    sinks.replace_partition(typed, path, ["c_code"])
    return spark.read.schema(typed.schema).parquet(path)


def export_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders exported as CSV per country, read back as text and cast."""
    path = work_path(spark, "export")
    orders = views.order_countries(spark, sf_dir).select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "o_orderpriority",
        views.country().alias("country_code"),
    )
    sinks.export_csv_by(orders, "country_code", path)
    return cast_columns(read_csv_strings(spark, path), {"o_orderkey": "bigint", "o_totalprice": "decimal(18,2)"})


def load_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per table: two deltas, three snapshots."""
    out = work_path(spark, "raw")
    status = run_loads(spark, SPECS, reader(spark, sf_dir), out, "1998-01-01", "2024-01-20 12:00:00", "1")
    return status.select("source", "ok", "rows")


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source counts up to the mark against what was loaded after the low mark."""
    out = work_path(spark, "raw")
    run_loads(spark, SPECS, reader(spark, sf_dir), out, "1998-01-01", HIGH, "1")
    upper = {
        s.name: views.table(spark, sf_dir, s.name).filter(F.col(s.changed_at) <= HIGH)
        if s.mode == DELTA
        else views.table(spark, sf_dir, s.name)
        for s in SPECS
    }
    loaded = {
        s.name: spark.read.parquet(f"{out}/{s.name}") if s.mode == DELTA else read_current(spark, f"{out}/{s.name}")
        for s in SPECS
    }
    return incremental.reconcile(all_counts(spark, upper), all_counts(spark, loaded))


def mark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs with a mark in between: each row is loaded by exactly one of them."""
    out, marks = work_path(spark, "raw"), work_path(spark, "marks")
    specs = [s for s in SPECS if s.name == "events"]
    first = load_source(spark, "claims", specs, reader(spark, sf_dir), out, marks, "2024-01-15 06:00:00")
    second = load_source(spark, "claims", specs, reader(spark, sf_dir), out, marks, "2024-02-01 00:00:00")
    runs = [df.select(F.lit(i).alias("run"), "source", "rows") for i, df in ((1, first), (2, second))]
    mark = F.lit(incremental.read_mark(spark, marks, "claims", "1900-01-01"))
    return reduce(DataFrame.unionByName, runs).withColumn("mark", mark)


def isolated_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tables are loaded although one source does not exist."""
    out = work_path(spark, "isolated")

    def copy(name: str):
        return lambda: incremental.counted_write(
            views.table(spark, sf_dir, name), lambda df: sinks.write_zone(df, f"{out}/{name}")
        )

    status = run_isolated(spark, {name: copy(name) for name in [*views.TABLES, "not_there"]})
    kind = F.regexp_extract("error", r"^(\w+): \[?(\w+)", 1)
    cause = F.regexp_extract("error", r"^(\w+): \[?(\w+)", 2)
    return status.select("source", "ok", "rows", kind.alias("error"), cause.alias("cause"))


def upsert_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows of all months, replaced by new amounts for the months from 1999 on."""
    path = work_path(spark, "warehouse")
    replace_snapshot(payable_monthly(spark, sf_dir), path, "1")
    published = read_current(spark, path)
    updates = published.filter(F.col("forecast_date") >= "1999-01-01").withColumn("Amount", -F.col("Amount"))
    table = work_path(spark, "published")
    for rows in (published, updates):
        manifest.upsert_table(table, rows, PUBLISHED_KEYS)
    return manifest.read_table(spark, table)


def forecast_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecasts fitted, summed by month, published and upserted into the months paid so far, twice."""
    path = work_path(spark, "history")
    manifest.upsert_table(path, payable_monthly(spark, sf_dir).withColumn("Amount", F.col("Amount").cast("double")), PUBLISHED_KEYS)
    months = monthly_rollup(forecast_by_country(spark, sf_dir), ["region"], "ds", "yhat")
    fitted = stored(publish_forecast(months, "region", "yhat", LOAD_DATE), "fitted")
    for _ in range(2):
        manifest.upsert_table(path, fitted.unionByName(fitted), PUBLISHED_KEYS)
    return manifest.read_table(spark, path).select("forecast_date", "Region", "Load_date", "Source")


def forecast_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows written as CSV per region and read back with dates."""
    path = work_path(spark, "forecasts")
    payable_monthly(spark, sf_dir).select(
        "forecast_date", F.col("Amount").cast("double").alias("Amount"), "Source", "Region", "Load_date"
    ).write.options(header=True).csv(path)
    return read_forecasts(spark, path)


def latest_file_per_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    suffix = F.when(F.col("o_orderstatus") == "P", ".tmp").otherwise(".csv")
    parts = [F.lit("out/forecasts/"), views.country(), F.lit("/forecast-"), day, suffix]
    return latest_per_group(views.order_countries(spark, sf_dir).select(F.concat(*parts).alias("path")))


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events stored in two zones; both hold every row."""
    zones = {name: work_path(spark, name) for name in ("raw", "second")}
    sinks.fan_out(views.table(spark, sf_dir, "events"), "1", list(zones.values()))
    copies = [spark.read.parquet(path).withColumn("zone", F.lit(name)) for name, path in zones.items()]
    return reduce(DataFrame.unionByName, copies).groupBy("zone", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).alias("total")
    )


def runs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_runs(views.run_files(spark, sf_dir)).drop("ts")


def runs_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of tracked runs, one small file per metric and parameter, scanned into a long table."""
    path = work_path(spark, "runs")
    sinks.write_files(views.run_histories(spark, sf_dir), path)
    return read_runs(spark, path).drop("ts")


def best_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_of(parse_runs(views.run_files(spark, sf_dir)), "eval_rmse")


def pivot_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = parse_runs(views.run_files(spark, sf_dir))
    return pivoted(runs.filter(F.col("kind") == "params"), ["lr", "momentum"])


QUERIES = {
    "delta_closed": delta_closed,
    "delta_open": delta_open,
    "latest_per_key": latest_per_key,
    "snapshot_replace": snapshot_replace,
    "replace_partition": replace_partition,
    "hub_invoices": hub_invoices,
    "export_by_country": export_by_country,
    "load_router": load_router,
    "reconcile_counts": reconcile_counts,
    "mark_advance": mark_advance,
    "isolated_loads": isolated_loads,
    "upsert_forecasts": upsert_forecasts,
    "forecast_history": forecast_history,
    "forecast_files": forecast_files,
    "latest_file_per_country": latest_file_per_country,
    "fan_out": fan_out,
    "runs_long": runs_long,
    "runs_folder": runs_folder,
    "best_run": best_run,
    "pivot_runs": pivot_runs,
}

MONTHLY_SQL = f"""{LINES_SQL}, published as (select last_day(payment_date) as forecast_date,
  cast(sum(invoice_fee) as decimal(28,2)) as "Amount", 'Forecast' as "Source", country_code as "Region",
  date '{LOAD_DATE}' as "Load_date" from inv group by 1, country_code)"""

# customers as runs: experiment = nation, parent = segment, the last metric step counts
RUNS_SQL = """runs as (select cast(c_nationkey as varchar) as experiment, 'r' || c_custkey as run,
  cast(c_acctbal as decimal(18,2)) as number, c_custkey, c_mktsegment from customer)"""

ORDERED_COUNTS = {
    "events": "select count(*) from events where ts <= timestamp '2024-01-20 12:00:00'",
    "orders": "select count(*) from orders where o_orderdate <= timestamp '2024-01-20 12:00:00'",
    "loaded orders": "select count(*) from orders where o_orderdate > timestamp '1998-01-01'",
    "customer": "select count(*) from customer",
    "supplier": "select count(*) from supplier",
    "part": "select count(*) from part",
}


def counts_sql(row: str, tables: list[str]) -> str:
    return " union all ".join(row.format(name=t, rows=f"({ORDERED_COUNTS[t]})") for t in tables)


ORACLE = {
    "delta_closed": f"""select event_id, user_id, event_type, value from events
        where ts > timestamp '{LOW}' and ts <= timestamp '{HIGH}'""",
    "delta_open": f"select event_id, user_id, event_type, value from events where ts > timestamp '{LOW}'",
    "latest_per_key": """select event_id, user_id, event_type, value from events
        qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1""",
    "snapshot_replace": "select * from customer",
    "replace_partition": """select o_orderkey, case when o_orderstatus = 'P' then 0.0 else o_totalprice end as o_totalprice,
        o_orderstatus from orders""",
    "hub_invoices": f"""with raw as ({views.raw_invoices_sql()}) select document_num, cast(invoice_amt as double) as invoice_amt,
        cast(payment_amt as double) as payment_amt, country_code as c_code from raw""",
    "export_by_country": """select o_orderkey, cast(o_totalprice as decimal(18,2)) as o_totalprice, o_orderpriority,
        case n_regionkey when 0 then 'UK' when 1 then 'US' when 2 then 'AU' when 3 then 'DE' else 'IT' end as country_code
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "load_router": counts_sql("select '{name}' as source, true as ok, {rows} as rows", ["events", "customer", "supplier", "part"])
    + f" union all select 'orders', true, ({ORDERED_COUNTS['loaded orders']})",
    "reconcile_counts": counts_sql(
        "select '{name}' as \"TableName\", cast({rows} as integer) as source_rows, cast({rows} as integer) as loaded_rows, 0 as diff",
        ["events", "customer", "supplier", "part"],
    )
    + f""" union all select 'orders', cast(n as integer), cast(m as integer), cast(n - m as integer)
        from (select ({ORDERED_COUNTS["orders"]}) as n, ({ORDERED_COUNTS["loaded orders"]}) as m)""",
    "mark_advance": """select 1 as run, 'events' as source, (select count(*) from events where ts <= timestamp '2024-01-15 06:00:00')
        as rows, '2024-02-01 00:00:00' as mark union all select 2, 'events', (select count(*) from events
        where ts > timestamp '2024-01-15 06:00:00' and ts <= timestamp '2024-02-01'), '2024-02-01 00:00:00'""",
    "isolated_loads": " union all ".join(
        f"select '{t}' as source, true as ok, (select count(*) from {t}) as rows, cast(null as varchar) as error, cast(null as varchar) as cause" for t in views.TABLES
    )
    + " union all select 'not_there', false, null, 'AnalysisException', 'PATH_NOT_FOUND'",
    "upsert_forecasts": f"""with {MONTHLY_SQL} select forecast_date,
        case when forecast_date >= date '1999-01-01' then -"Amount" else "Amount" end as "Amount", "Source", "Region", "Load_date"
        from published""",
    "forecast_history": f"""with {MONTHLY_SQL}, ahead as ({INVOICE_SQL["future_weeks"]})
        select forecast_date, "Region", "Load_date", "Source" from published
        union select last_day(week_end), country_code, date '{LOAD_DATE}', 'Forecast' from ahead""",
    "forecast_files": f"""with {MONTHLY_SQL} select forecast_date, cast("Amount" as double) as "Amount", "Source", "Region",
        "Load_date" from published""",
    "latest_file_per_country": """with files as (select case n_regionkey when 0 then 'UK' when 1 then 'US' when 2 then 'AU'
        when 3 then 'DE' else 'IT' end as folder, strftime(o_orderdate, '%Y-%m-%d') as day, o_orderstatus
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)
        select folder, 'out/forecasts/' || folder || '/forecast-' || max(day) || '.csv' as path from files
        where o_orderstatus <> 'P' group by folder""",
    "fan_out": """select zone, event_type, count(*) as n, cast(sum(cast(value as decimal(18,2))) as decimal(28,2)) as total
        from events,
        (values ('raw'), ('second')) z(zone) group by all""",
    "runs_long": f"""with {RUNS_SQL}
        select experiment, run, 'metrics' as kind, 'eval_rmse' as name, cast(number + 1 as varchar) as value, cast(0 as bigint) as step from runs
        union all select experiment, run, 'metrics', 'eval_rmse', cast(number as varchar), 1 from runs
        union all select experiment, run, 'params', 'lr', cast(c_custkey as varchar), null from runs
        union all select experiment, run, 'params', 'momentum', c_mktsegment, null from runs
        union all select experiment, run, 'tags', 'mlflow.parentRunId', 'parent ' || c_mktsegment, null from runs""",
    "runs_folder": """with runs as (select cast(c_nationkey as varchar) as experiment, 'b' || c_custkey // 1000 as run, c_acctbal, c_custkey from customer)
        select experiment, run, 'metrics' as kind, 'account balance' as name, cast(cast(c_acctbal as decimal(18,2)) as varchar) as value, c_custkey as step from runs
        union all select experiment, run, 'params', 'a+b', cast(count(*) as varchar), null from runs group by experiment, run""",
    "best_run": f"""with {RUNS_SQL} select experiment, 'parent ' || c_mktsegment as parent, run, cast(number as double) as eval_rmse
        from runs qualify row_number() over (partition by experiment, c_mktsegment order by number, run) = 1""",
    "pivot_runs": f"with {RUNS_SQL} select experiment, run, cast(c_custkey as varchar) as lr, c_mktsegment as momentum from runs",
}
