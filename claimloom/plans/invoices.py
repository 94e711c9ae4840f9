"""Invoice, series, rate and branch queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimloom.config.rules import BRANCH_DIVISIONS, SERVICE_LINES
from claimloom.functions.casts import cast_cells, cast_columns
from claimloom.functions.dates import parse_date_columns
from claimloom.functions.records import parse_json, to_json_col
from claimloom.functions.text import clean_columns, file_stem, path_part
from claimloom.operators.classify import branch_lines, classify
from claimloom.operators.curate import UNSIGNED_COLUMNS, curate_invoices
from claimloom.operators.curate import invoice_countries as countries_of
from claimloom.operators.forecast import forecast
from claimloom.operators.fx import fx_latest
from claimloom.operators.series import (
    fiscal_horizon as horizon_of,
)
from claimloom.operators.series import future_weeks as weeks_after
from claimloom.operators.series import monthly_rollup as months_of
from claimloom.operators.series import publish_forecast as published
from claimloom.operators.series import weekly_series
from claimloom.plans import views
from claimloom.sources.readers import warehouse_query

AFTER = "1996-01-01"
LOAD_DATE = "2002-01-15"


def weekly_invoice_fee(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.payable_lines(spark, sf_dir, AFTER)
    series = weekly_series(lines, ["country_code"], "payment_date", "invoice_fee", AFTER, "week_end")
    return series.withColumn("invoice_fee", F.col("invoice_fee").cast("decimal(28,2)"))


def weekly_invoice_fee_sparse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A series per nation, brand and product, so that many weeks are empty."""
    lines = views.payable_lines(spark, sf_dir, AFTER)
    series = weekly_series(lines, ["n_name", "p_brand", "p_type"], "payment_date", "invoice_fee", AFTER, "week_end")
    return series.withColumn("invoice_fee", F.col("invoice_fee").cast("decimal(28,2)"))


def curated_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate_invoices(views.raw_invoices(spark, sf_dir))


def invoice_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return countries_of(views.raw_invoices(spark, sf_dir))


def fiscal_horizon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return horizon_of(weekly_invoice_fee(spark, sf_dir), ["country_code"], "week_end")


def future_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weeks_after(fiscal_horizon(spark, sf_dir), ["country_code"], day="week_end")


def monthly_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months_of(weekly_invoice_fee(spark, sf_dir), ["country_code"], "week_end", "invoice_fee").select(
        "country_code", "month_end", F.col("invoice_fee").cast("decimal(28,2)").alias("invoice_fee")
    )


def publish_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(monthly_rollup(spark, sf_dir), "country_code", "invoice_fee", LOAD_DATE)


def payable_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published rows per country and month of payment, summed straight from the invoice lines."""
    lines = views.payable_lines(spark, sf_dir, AFTER)
    months = months_of(lines, ["country_code"], "payment_date", "invoice_fee")
    return published(
        months.withColumn("invoice_fee", F.col("invoice_fee").cast("decimal(28,2)")), "country_code", "invoice_fee", LOAD_DATE
    )


def forecast_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    series = weekly_invoice_fee(spark, sf_dir)
    return forecast(
        series.select(F.col("country_code").alias("region"), F.col("week_end").alias("ds"), F.col("invoice_fee").alias("y"))
    )


def forecast_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions and weeks that the forecast has, each with a band around its value."""
    weeks = forecast_by_country(spark, sf_dir)
    ordered = F.col("yhat_lower").isNotNull() & (F.col("yhat_lower") <= F.col("yhat")) & (F.col("yhat") <= F.col("yhat_upper"))
    return weeks.select(F.col("region").alias("country_code"), F.col("ds").alias("week_end"), ordered.alias("in_band"))


def fx_latest_fresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_latest(views.rates(spark, sf_dir), views.rate_history(spark, sf_dir), "1998-06-16")


def fx_latest_stale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx_latest(views.rates(spark, sf_dir), views.rate_history(spark, sf_dir), "2010-01-01")


def branch_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    branches = views.branch_claims(spark, sf_dir).distinct()
    return classify(branches, "branch_id", BRANCH_DIVISIONS, "division")


def branch_service_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return branch_lines(views.branch_claims(spark, sf_dir), "branch_id")


def amount_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts and ids as text, some malformed."""
    amount = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    return views.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(amount).alias("INVOICE_AMT"),
        F.when(F.col("l_linestatus") == "O", "none").otherwise(F.col("l_suppkey").cast("string")).alias("CLIENT_PGM_ID"),
    )


AMOUNT_TYPES = {"INVOICE_AMT": "double", "CLIENT_PGM_ID": "bigint"}


def cast_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts and ids as text, back to double and long."""
    return cast_columns(amount_texts(spark, sf_dir), AMOUNT_TYPES, on_error="null")


def cast_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells of these texts that do not convert."""
    return cast_cells(amount_texts(spark, sf_dir), AMOUNT_TYPES, ["l_orderkey", "l_partkey"], "curate")[1]


def cast_reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, converted cells and rejects of each column, the rejects as observed by the pass that casts."""
    rows, _, counts = cast_cells(amount_texts(spark, sf_dir), AMOUNT_TYPES, ["l_orderkey", "l_partkey"], "curate")
    names = F.array(*[F.struct(F.lit(c).alias("column"), F.count(c).alias("converted"), F.lit(counts[c]).cast("long").alias("rejects")) for c in AMOUNT_TYPES])
    return rows.agg(F.count("*").alias("n"), names.alias("_columns")).select("n", F.explode("_columns").alias("_c")).select("n", "_c.*")


def parse_date_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One column in each text format; the format is found for the whole column."""
    day = F.col("o_orderdate")
    text = views.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(day, "dd-MM-yyyy").alias("day_first"),
        F.date_format(day, "yyyy-MM-dd").alias("year_first"),
    )
    return parse_date_columns(text, ["day_first", "year_first"])


def clean_ledger_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["Posting Date", "Amount (LCY)", "Name\r", "Customer No"]
    rows = views.table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal", "c_name", "c_custkey")
    return clean_columns(rows.toDF(*names))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = parse_json(views.table(spark, sf_dir, "events"), "props", "k bigint")
    again = to_json_col(F.col("event_type"), F.col("props.k").alias("k"))
    return decoded.select("event_id", F.col("props.k").alias("k"), again.alias("record"))


def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return views.table(spark, sf_dir, "pages").select(
        "page_id", path_part(url, 3).alias("host"), path_part(url, 4).alias("lang"), file_stem(url).alias("stem")
    )


def revenue_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse SQL over registered tables."""
    sql = """select r.r_name, o.o_orderstatus, count(*) as n_orders, sum(cast(o.o_totalprice as decimal(18,2))) as total
             from {orders} o join {customer} c on o.o_custkey = c.c_custkey join {nation} n on c.c_nationkey = n.n_nationkey
             join {region} r on n.n_regionkey = r.r_regionkey group by r.r_name, o.o_orderstatus"""
    names = ("orders", "customer", "nation", "region")
    return warehouse_query(spark, sql, **{n: views.table(spark, sf_dir, n) for n in names})


QUERIES = {
    "weekly_invoice_fee": weekly_invoice_fee,
    "weekly_invoice_fee_sparse": weekly_invoice_fee_sparse,
    "curated_invoices": curated_invoices,
    "invoice_countries": invoice_countries,
    "fiscal_horizon": fiscal_horizon,
    "future_weeks": future_weeks,
    "monthly_rollup": monthly_rollup,
    "publish_forecast": publish_forecast,
    "forecast_by_country": forecast_by_country,
    "forecast_spine": forecast_spine,
    "fx_latest_fresh": fx_latest_fresh,
    "fx_latest_stale": fx_latest_stale,
    "branch_division": branch_division,
    "branch_service_line": branch_service_line,
    "cast_strings": cast_strings,
    "cast_rejects": cast_rejects,
    "cast_reject_counts": cast_reject_counts,
    "parse_date_fallback": parse_date_fallback,
    "clean_columns": clean_ledger_columns,
    "json_props": json_props,
    "url_parts": url_parts,
    "warehouse_query": revenue_by_region,
}


# -- SQL twins --------------------------------------------------------------------------------

LINES_SQL = """inv as (
  select case n.n_regionkey when 0 then 'UK' when 1 then 'US' when 2 then 'AU' when 3 then 'DE' else 'IT' end as country_code,
    n.n_name, p.p_brand, p.p_type, cast(l.l_shipdate as date) as payment_date,
    abs(cast(l.l_extendedprice as decimal(18,2))) as invoice_fee
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey
    join nation n on c.c_nationkey = n.n_nationkey join part p on l.l_partkey = p.p_partkey
  where trim(p.p_type) <> 'PROMO' and l.l_shipdate is not null and cast(l.l_shipdate as date) > date '1996-01-01')"""


def weekly_sql(*by: str) -> str:
    keys = ", ".join(by)
    return f"""{LINES_SQL},
wk as (select {keys}, cast(date_trunc('week', payment_date) + interval 6 day as date) as week_end, sum(invoice_fee) as fee
  from inv group by all),
spine as (select {keys}, cast(unnest(generate_series(min(week_end), max(week_end), interval 7 day)) as date) as week_end
  from wk group by {keys}),
weekly as (select {", ".join("s." + k for k in by)}, s.week_end, cast(coalesce(w.fee, 0) as decimal(28,2)) as invoice_fee
  from spine s left join wk w on {" and ".join(f"s.{k} = w.{k}" for k in by)} and s.week_end = w.week_end)"""


HORIZON_SQL = """horizon as (select country_code, max(week_end) as last_week,
  cast(floor(date_diff('day', max(week_end), make_date(cast(case when month(max(week_end)) <= 3 then year(max(week_end))
    else year(max(week_end)) + 1 end as integer), 3, 31)) / 7) as integer) as periods from weekly group by country_code)"""
MONTHS_SQL = """months as (select country_code, last_day(week_end) as month_end,
  cast(sum(invoice_fee) as decimal(28,2)) as invoice_fee from weekly group by all)"""


def curated_sql() -> str:
    dates = {c: f"cast(strptime({c}, '%d-%m-%Y') as date) as {c}" for c in
             ("accounting_date", "invoice_date", "payment_date", "creation_date")}
    unsigned = ", ".join(f"abs(cast({c} as decimal(38,6))) as {c}" for c in UNSIGNED_COLUMNS)
    return f"""with raw as ({views.raw_invoices_sql()})
select document_num, customer_id, case when country_code = 'UK' then sell_to_name else customer_name end as customer_name,
  cast(accounting_year as integer) as accounting_year, cast(accounting_month as integer) as accounting_month,
  {", ".join(dates.values())}, country_code, client_category, client_group, currency_code, claim_number,
  cast(invoice_amt as decimal(38,6)) as invoice_amt, cast(payment_amt as decimal(38,6)) as payment_amt, company,
  sell_to_customer_no, sell_to_name, document_type, {unsigned},
  regexp_replace(case
    when country_code = 'AU' and trim(product_name) in ('Commercial - Retail', 'Commercial - Wholesale') then 'Property Commercial'
    when country_code = 'AU' and trim(product_name) = 'Domestic' then 'Property Residential'
    when country_code = 'UK' then 'Property Commercial' else trim(product_name) end, '\\s', '', 'g') as product_name,
  service_line, product_description, invoice, assessment_type, peril, local_to_eur_exchange_rate
from raw where trim(product_name) <> 'Liability' and payment_date is not null"""


def rules_sql(col: str) -> str:
    cases = []
    for kind, values, division in BRANCH_DIVISIONS:
        ids = ", ".join(f"'{v}'" for v in values)
        cases.append(f"when {col} {f'in ({ids})' if kind == 'in' else f'like {ids}'} then '{division}'")
    return f"case {' '.join(cases)} else 'Other' end"


def lines_sql(division: str, branch: str) -> str:
    cases = [f"when lower({division}) = {member.lower()!r} then '{line}'" for member, line in SERVICE_LINES.items()]
    return f"case {' '.join(cases)} when {division} = 'Other' then {branch} else {division} end"


BRANCHES_SQL = f"""branches as (select list_extract(list_value({", ".join(repr(b) for b in views.SAMPLE_BRANCHES)}),
  cast(l_quantity as integer)) as branch_id, count(*) as frequency from lineitem group by 1)"""


def fx_sql(as_of: str) -> str:
    return f"""with daily as (select cast(o_orderdate as date) as effdt, o_orderstatus,
  cast(max(o_totalprice) / 100000.0 as decimal(15,8)) as rate from orders where o_orderstatus in ('O', 'F') group by all),
d as (select cast(date '{as_of}' - interval 1 day as date) as day),
fresh as (select 0 as priority, d.day, a.rate as aud_usd_div, b.rate as usd_eur_mul from d
  join daily a on a.effdt = d.day and a.o_orderstatus = 'O'
  left join daily b on b.effdt = a.effdt and b.o_orderstatus = 'F'),
stored as (select cast(o_orderdate as date) as effdt, cast(max(o_totalprice) / 100000.0 as decimal(15,8)) as aud_usd_div,
  cast(min(o_totalprice) / 100000.0 as decimal(15,8)) as usd_eur_mul from orders where o_orderstatus = 'P' group by 1),
known as (select 1 as priority, d.day, s.aud_usd_div, s.usd_eur_mul from d, stored s order by s.effdt desc limit 1)
select strftime(day, '%m/%d/%Y') as effdt, aud_usd_div, usd_eur_mul
from (select * from fresh union all select * from known) order by priority limit 1"""


ORACLE = {
    "weekly_invoice_fee": f"with {weekly_sql('country_code')} select * from weekly",
    "weekly_invoice_fee_sparse": f"with {weekly_sql('n_name', 'p_brand', 'p_type')} select * from weekly",
    "curated_invoices": curated_sql(),
    "invoice_countries": f"""with raw as ({views.raw_invoices_sql()}) select distinct country_code from raw
        where trim(product_name) <> 'Liability' and payment_date is not null""",
    "fiscal_horizon": f"with {weekly_sql('country_code')}, {HORIZON_SQL} select * from horizon",
    "future_weeks": f"""with {weekly_sql("country_code")}, {HORIZON_SQL}, steps as (select country_code, last_week,
        unnest(generate_series(1, periods)) as i from horizon)
        select country_code, cast(last_week + cast(7 * i as integer) as date) as week_end from steps""",
    "forecast_spine": f"""with {weekly_sql("country_code")}, {HORIZON_SQL}, steps as (select country_code, last_week,
        unnest(generate_series(1, periods)) as i from horizon)
        select country_code, cast(last_week + cast(7 * i as integer) as date) as week_end, true as in_band from steps""",
    "monthly_rollup": f"with {weekly_sql('country_code')}, {MONTHS_SQL} select * from months",
    "publish_forecast": f"""with {weekly_sql("country_code")}, {MONTHS_SQL} select month_end as forecast_date,
        invoice_fee as "Amount", 'Forecast' as "Source", country_code as "Region", date '{LOAD_DATE}' as "Load_date" from months""",
    "fx_latest_fresh": fx_sql("1998-06-16"),
    "fx_latest_stale": fx_sql("2010-01-01"),
    "branch_division": f"with {BRANCHES_SQL} select branch_id, {rules_sql('branch_id')} as division from branches",
    "branch_service_line": f"""with {BRANCHES_SQL}, divided as (select branch_id, {rules_sql("branch_id")} as division, frequency
        from branches) select branch_id, division, {lines_sql("division", "branch_id")} as service_line, frequency from divided""",
    "cast_strings": """select l_orderkey, l_partkey,
        try_cast(case when l_returnflag = 'R' then 'n/a' else cast(cast(l_extendedprice as decimal(18,2)) as varchar) end as double)
          as "INVOICE_AMT",
        try_cast(case when l_linestatus = 'O' then 'none' else cast(l_suppkey as varchar) end as bigint) as "CLIENT_PGM_ID"
        from lineitem""",
    "cast_rejects": """select 'curate' as stage, l_orderkey, l_partkey, 'INVOICE_AMT' as "column", 'n/a' as text from lineitem where l_returnflag = 'R'
        union all select 'curate', l_orderkey, l_partkey, 'CLIENT_PGM_ID', 'none' from lineitem where l_linestatus = 'O'""",
    "cast_reject_counts": """select count(*) as n, 'INVOICE_AMT' as "column", count(*) filter (l_returnflag <> 'R') as converted,
          count(*) filter (l_returnflag = 'R') as rejects from lineitem
        union all select count(*), 'CLIENT_PGM_ID', count(*) filter (l_linestatus <> 'O'), count(*) filter (l_linestatus = 'O') from lineitem""",
    "parse_date_fallback": """select o_orderkey, cast(o_orderdate as date) as day_first, cast(o_orderdate as date) as year_first
        from orders""",
    "clean_columns": """select c_nationkey as "Posting_Date", c_acctbal as "Amount__LCY", c_name as "Name",
        c_custkey as "Customer_No" from customer""",
    "json_props": """select event_id, cast(json_extract(props, '$.k') as bigint) as k,
        '{"event_type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' as record from events""",
    "url_parts": r"""select page_id, string_split(url, '/')[3] as host, string_split(url, '/')[4] as lang,
        regexp_replace(string_split(url, '/')[-1], '\.[^.]*$', '') as stem from pages""",
    "warehouse_query": """select r_name, o_orderstatus, count(*) as n_orders,
        cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(28,2)) as total from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey group by all""",
}
