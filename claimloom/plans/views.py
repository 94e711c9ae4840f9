"""The business shapes, derived from the given tables row by row (no grouping, no row limits)."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@cache
def table_schema(path: str) -> StructType:
    """Schema of a stored table; inferring it is a job of its own, so it is done once per path."""
    return SparkSession.active().read.parquet(path).schema


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return spark.read.schema(table_schema(path)).parquet(path)


# -- invoices ---------------------------------------------------------------------------------

COUNTRIES = {0: "UK", 1: "US", 2: "AU", 3: "DE"}
LAST_COUNTRY = "IT"


def country(key: str = "n_regionkey"):
    case = F.lit(LAST_COUNTRY)
    for k, name in COUNTRIES.items():
        case = F.when(F.col(key) == k, name).otherwise(case)
    return case


def order_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the country of their customer."""
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    located = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return orders.join(located, F.col("o_custkey") == F.col("c_custkey"))


def line_invoices(spark: SparkSession, sf_dir: str, where: Column) -> DataFrame:
    """Typed invoice lines: country, nation, product, payment date, fee and quantity."""
    lines = table(spark, sf_dir, "lineitem").filter(where).join(
        table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    located = order_countries(spark, sf_dir).select("o_orderkey", "n_name", country().alias("country_code"))
    return lines.join(located, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "country_code",
        "n_name",
        "p_type",
        "p_brand",
        F.col("l_shipdate").cast("date").alias("payment_date"),
        F.abs(F.col("l_extendedprice").cast("decimal(18,2)")).alias("invoice_fee"),
        "l_quantity",
    )


def payable_lines(spark: SparkSession, sf_dir: str, after: str) -> DataFrame:
    """Lines paid after a day; the bound is on the stored column, so that it reaches the scan."""
    lines = line_invoices(spark, sf_dir, F.col("l_shipdate") >= F.date_add(F.lit(after).cast("date"), 1))
    return lines.filter((F.trim("p_type") != "PROMO") & F.col("payment_date").isNotNull())


RAW_INVOICES = """
select concat_ws('-', cast(l.l_orderkey as string), cast(l.l_linenumber as string), cast(l.l_partkey as string)) as document_num,
  cast(o.o_custkey as string) as customer_id, c.c_name as customer_name, concat('Sold to ', c.c_name) as sell_to_name,
  concat('S', cast(l.l_suppkey as string)) as sell_to_customer_no,
  cast(year(o.o_orderdate) as string) as accounting_year, cast(month(o.o_orderdate) as string) as accounting_month,
  {date_text(o.o_orderdate)} as accounting_date, {date_text(o.o_orderdate)} as invoice_date,
  case when l.l_returnflag = 'N' and l.l_linestatus = 'O' then null else {date_text(l.l_shipdate)} end as payment_date,
  {date_text(l.l_shipdate)} as creation_date,
  case n.n_regionkey when 0 then 'UK' when 1 then 'US' when 2 then 'AU' when 3 then 'DE' else 'IT' end as country_code,
  c.c_mktsegment as client_category, o.o_orderpriority as client_group, 'EUR' as currency_code,
  concat('CL', cast(l.l_orderkey as string)) as claim_number,
  cast(cast(case when l.l_returnflag = 'R' then -l.l_extendedprice else l.l_extendedprice end as decimal(18,2)) as string) as invoice_amt,
  cast(cast(cast(l.l_extendedprice as decimal(14,2)) * cast(1 - l.l_discount as decimal(4,2)) as decimal(18,4)) as string) as payment_amt,
  cast(cast(case when l.l_returnflag = 'R' then -l.l_extendedprice else l.l_extendedprice end as decimal(18,2)) as string) as net_amount,
  cast(cast(cast(-l.l_extendedprice as decimal(14,2)) * cast(l.l_tax as decimal(4,2)) as decimal(18,4)) as string) as vat_amount,
  cast(cast(-l.l_extendedprice as decimal(18,2)) as string) as invoice_fee,
  cast(cast(l.l_quantity as decimal(18,2)) as string) as invoice_cost,
  n.n_name as company, l.l_returnflag as document_type,
  case p.p_type when 'PROMO' then ' Liability ' when 'ECONOMY' then ' Domestic ' when 'LARGE' then 'Commercial - Retail'
    when 'MEDIUM' then 'Commercial - Wholesale ' when 'SMALL' then ' Motor Own Damage' else null end as product_name,
  p.p_brand as service_line, p.p_name as product_description, o.o_orderstatus as invoice, l.l_linestatus as assessment_type,
  cast(p.p_size as string) as peril, l.l_discount as local_to_eur_exchange_rate
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey join {customer} c on o.o_custkey = c.c_custkey
  join {nation} n on c.c_nationkey = n.n_nationkey join {part} p on l.l_partkey = p.p_partkey
"""


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Invoice source rows, all text, with padded products, missing payment dates and negative amounts."""
    text = RAW_INVOICES
    for c in ("o.o_orderdate", "l.l_shipdate"):
        text = text.replace(f"{{date_text({c})}}", f"date_format({c}, 'dd-MM-yyyy')")
    names = ("lineitem", "orders", "customer", "nation", "part")
    return spark.sql(text, **{n: table(spark, sf_dir, n) for n in names})


def raw_invoices_sql() -> str:
    text = RAW_INVOICES
    for c in ("o.o_orderdate", "l.l_shipdate"):
        text = text.replace(f"{{date_text({c})}}", f"strftime({c}, '%d-%m-%Y')")
    for n in ("lineitem", "orders", "customer", "nation", "part"):
        text = text.replace(f"{{{n}}}", n)
    return text


# -- rates ------------------------------------------------------------------------------------


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate rows from orders: status O gives AUD to USD, F gives USD to EUR, one per day."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus").isin("O", "F"))
    is_aud = F.col("o_orderstatus") == "O"
    daily = orders.groupBy(F.col("o_orderdate").cast("date").alias("effdt"), "o_orderstatus").agg(
        (F.max("o_totalprice") / 100000.0).cast("decimal(15,8)").alias("rate")
    )
    return daily.select(
        "effdt",
        F.when(is_aud, " AUD").otherwise("USD ").alias("from_cur"),
        F.when(is_aud, "USD").otherwise(" EUR").alias("to_cur"),
        F.col("rate").alias("rate_mult"),
        F.col("rate").alias("rate_div"),
    )


def rate_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored daily rates from status P orders."""
    orders = table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "P")
    return orders.groupBy(F.date_format("o_orderdate", "MM/dd/yyyy").alias("effdt")).agg(
        (F.max("o_totalprice") / 100000.0).cast("decimal(15,8)").alias("aud_usd_div"),
        (F.min("o_totalprice") / 100000.0).cast("decimal(15,8)").alias("usd_eur_mul"),
    )


# -- branches ---------------------------------------------------------------------------------

# Sample branch ids, one per quantity.
SAMPLE_BRANCHES = (
    "2CAT 34CAT AD5X HB7E ML3X 9CAT MOT2A FFAT1 CEO CONENG TPA1 IT DRONE WG2M GBSC PRIZE RPA2 0000 BTS FIN HR XSTRATA "
    "10MCKY ARNET1 1CFAS2 BVL1 CEG7 COP2 CPT3 POW1 TRI9 XAPI1 1BLD 2VIR 3BVL 4NSW 5QLD 6TAS 7VIC 8COM 9MAR 1FRS2 AVRB "
    "1GT2 2WA3 CCX 1RACQ2 XYL XYE ZZZ9"
).split()


def branch_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A claim per order line, its branch chosen by the quantity (1 to 50)."""
    codes = F.array(*[F.lit(b) for b in SAMPLE_BRANCHES])
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(F.try_element_at(codes, F.col("l_quantity").cast("int")).alias("branch_id"))


# -- triage claims ----------------------------------------------------------------------------

CLAIMS = """
select o.o_orderkey as claim_id,
  element_at({array}('active leak, currently wet', 'livable, still in dwelling / building', 'livable temporarily displaced',
    'no longer leaking, wet <1 day', 'no longer leaking, wet >1 day', 'no, no opening', 'unlivable displaced',
    'yes, covered/tarped', 'yes, uncovered/not tarped', 'not in the list'), 1 + cast({day}(o.o_orderdate) % 10 as int)) as Status,
  case o.o_orderstatus when 'O' then '1 floor' when 'F' then '2 floors or more' else 'no' end as Levels,
  case o.o_orderpriority when '1-URGENT' then '1-2 rooms' when '2-HIGH' then '3 rooms' when '3-MEDIUM' then '4 rooms'
    when '4-NOT SPECIFIED' then '5 or more rooms' else 'no' end as Rooms,
  element_at({array}('cabinets', 'ceiling', 'contents (personal belongings)',
    'exterior contents (grill, patio furniture, etc.)', 'exterior structure', 'fixtures', 'floors', 'hardscapes & fence',
    'no', 'roof', 'siding', 'windows'), cast(month(o.o_orderdate) as int)) as Materials,
  case c.c_mktsegment when 'MACHINERY' then 'attorney' when 'BUILDING' then 'contractor' when 'AUTOMOBILE' then 'no'
    when 'FURNITURE' then 'public adjuster' else null end as Engagement,
  case when o.o_totalprice < 50000 then 'water' when o.o_totalprice < 100000 then 'wind'
    when o.o_totalprice < 150000 then 'wildfire' when o.o_totalprice < 200000 then 'electrical' else 'other' end as source,
  case when {day}(o.o_orderdate) % 10 in (0, 6) then 'EMERGENCY' when o.o_totalprice < 50000 then 'DRYING'
    when o.o_orderstatus = 'F' then 'ADJUSTER' when c.c_mktsegment = 'MACHINERY' then 'LEGAL' else 'DESK' end as labels
from {orders} o join {customer} c on o.o_custkey = c.c_custkey
"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A claim per order in text form, with an unknown status, a missing engagement and five labels."""
    text = CLAIMS.replace("{array}", "array").replace("{day}", "day")
    return spark.sql(text, orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


def claims_sql() -> str:
    text = CLAIMS.replace("element_at({array}(", "list_extract(list_value(").replace("{day}", "day")
    return text.replace("{orders}", "orders").replace("{customer}", "customer")


CODED_CLAIMS = """
select event_id,
  case event_type when 'click' then 'HAIL' when 'view' then 'PTFR' when 'signup' then 'DRAIN BCK' when 'error' then null
    else 'UNSEEN' end as PerilTypeID,
  case when value < 5 then 'CSLS' when value < 10 then 'CSLT' when value < 20 then 'CSUD' else null end as Status,
  case when user_id % 3 = 0 then 'LSOF' when user_id % 3 = 1 then 'LSTM' else null end as Levels,
  case when user_id % 7 = 0 then 'RANA,RAOT' when user_id % 7 = 1 then 'RAOT,RATF' when user_id % 7 = 2 then 'RAMF'
    when user_id % 7 = 3 then 'RATE' else null end as `Rooms affected`,
  case when event_id % 5 = 0 then 'MDFL,MDFL' when event_id % 5 = 1 then 'MDWA' when event_id % 5 = 2 then 'MDCB'
    else null end as materials,
  case when event_type = 'click' then 'ETAT' when event_type = 'view' then 'TPNO' else null end as Engagement
from {events}
"""


def coded_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A claim per event in coded form, with missing answers, double answers and an unknown peril."""
    return spark.sql(CODED_CLAIMS, events=table(spark, sf_dir, "events"))


def coded_claims_sql() -> str:
    return CODED_CLAIMS.replace("{events}", "events").replace("`", '"')


# -- documents --------------------------------------------------------------------------------

DOCUMENTS = """
select concat('d', cast(doc_id as string)) as ID,
  case lang when 'en' then 'Base Policy' when 'fr' then 'Policy ENDOrsement' when 'de' then 'Declaration page'
    else null end as DocumentType,
  case when source = 'src0' then null else concat('Carrier ', source) end as CarrierName, concat('u', source) as UserID,
  concat('Document ', cast(doc_id as string)) as DocumentName,
  concat(source, '/', cast(doc_id as string), '.pdf') as DocumentPath,
  case when n_chars > 1000 then 'Processed' else 'Failed' end as Status,
  concat('extract/', cast(doc_id as string)) as AdobeExtractPath,
  case when n_chars > 1000 then null else 'too short' end as FailureReason,
  case when n_chars > 500 then concat('F-', cast(n_chars as string)) else null end as FormNumber,
  case when n_chars > 500 then concat('F', cast(n_chars as string)) else null end as NormalizedFormNumber,
  cast(null as timestamp) as UploadedAt, cast(null as timestamp) as ProcessedAt,
  cast(case when n_chars > 2000 then 1 else null end as int) as RetryCount,
  {no_codes} as FailureStatusCode,
  case when lang = 'es' then concat(chr(123), chr(125)) else text end as JsonData, cast(null as {string}) as PolicyName
from {documents}
"""


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source documents; the type follows the language, Spanish ones have no type and an empty payload."""
    text = DOCUMENTS.replace("{no_codes}", "cast(null as array<string>)").replace("{string}", "string")
    return spark.sql(text, documents=table(spark, sf_dir, "documents"))


def documents_sql() -> str:
    text = DOCUMENTS.replace("{no_codes}", "cast(null as varchar[])").replace("{string}", "varchar")
    return text.replace("{documents}", "documents").replace("as string)", "as varchar)")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of conversations as parts, ``d<conv>_<turn>``; the base is the document of that number."""
    turns = table(spark, sf_dir, "conversations")
    typed = documents(spark, sf_dir).schema
    columns = {
        "ID": F.concat(F.lit("d"), F.col("conv_id").cast("string"), F.lit("_"), F.col("turn").cast("string")),
        "DocumentType": F.col("role"),
        "DocumentPath": F.concat(F.lit("parts/"), F.col("conv_id").cast("string"), F.lit("/"), F.col("turn").cast("string")),
        "Status": F.when(F.length("text") > 100, "Processed").otherwise("Failed"),
        "FormNumber": F.concat(F.lit("T"), F.col("turn").cast("string")),
    }
    return turns.select(
        *[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in typed], F.col("turn")
    )


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A client per supplier, named by its nation, so most names occur several times."""
    return table(spark, sf_dir, "supplier").select(
        F.format_string("c%08d", "s_suppkey").alias("_id"),
        F.concat(F.lit("Carrier src"), F.col("s_nationkey").cast("string")).alias("ClientName"),
    )


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prompt per nation; the policy name is null for the first regions only."""
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("Carrier src"), F.col("n_nationkey").cast("string")).alias("CarrierName"),
        F.when(F.col("n_regionkey") > 2, F.col("n_name")).alias("PolicyName"),
        F.concat(F.lit("prompt "), F.col("n_name")).alias("PromptID"),
    )


PROMPTS_SQL = """select 'Carrier src' || n_nationkey as CarrierName, case when n_regionkey > 2 then n_name end as PolicyName,
  'prompt ' || n_name as PromptID from nation"""
CLIENTS_SQL = """select format('c{:08d}', s_suppkey) as _id, 'Carrier src' || s_nationkey as ClientName from supplier"""

POLICIES = """
select {padded}('p%010d', o_orderkey) as _id, concat('Carrier ', o_orderpriority) as CarrierName,
  concat('Policy ', cast(o_custkey as string)) as PolicyName, concat('d', cast(o_orderkey as string)) as BasePolicyDocumentID,
  {array}(concat('d', cast(o_orderkey + 1 as string)), concat('d', cast(o_custkey as string))) as EndorsementDocumentID
from {orders}
"""
DECLARATIONS = """
select {padded}('x%010d', c_custkey) as _id, concat('N', cast(c_custkey as string)) as DeclarationNumber, c_name as HolderName,
  'Carrier 1-URGENT' as CarrierName, concat('Policy ', cast(c_custkey as string)) as PolicyName, c_mktsegment as ProcessedFormat,
  cast(c_nationkey as string) as StartDate, cast(null as {string}) as ExpiryDate, 'v1' as Version,
  case when c_mktsegment = 'HOUSEHOLD' then null
    else {array}(concat('d', cast(c_custkey as string)), concat('d', cast(c_custkey + 7 as string))) end as DeclarationDocumentID,
  case when c_acctbal < 0 then null else {array}(concat('d', cast(c_custkey * 2 as string)),
    concat('d', cast(c_nationkey as string)), concat('d', cast(c_custkey + 1 as string))) end as AppliedEndorsement
from {customer}
"""


def policies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A policy per order with a base document and two endorsements, some of them not there."""
    text = POLICIES.replace("{array}", "array").replace("{padded}", "format_string")
    return spark.sql(text, orders=table(spark, sf_dir, "orders"))


def declarations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A declaration per customer; neighbours share documents, some have no documents or endorsements."""
    text = DECLARATIONS.replace("{array}", "array").replace("{padded}", "format_string").replace("{string}", "string")
    return spark.sql(text, customer=table(spark, sf_dir, "customer"))


def policies_sql() -> str:
    text = POLICIES.replace("{array}", "list_value").replace("{padded}", "printf").replace("as string)", "as varchar)")
    return text.replace("{orders}", "orders")


def declarations_sql() -> str:
    text = DECLARATIONS.replace("{array}", "list_value").replace("{padded}", "printf").replace("{string}", "varchar")
    return text.replace("{customer}", "customer").replace("as string)", "as varchar)")


# -- runs and demand --------------------------------------------------------------------------


def run_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked-run files ``(path, value)``: a run per customer, its market segment is the parent."""
    base = F.concat(F.lit("runs/"), F.col("c_nationkey").cast("string"), F.lit("/r"), F.col("c_custkey").cast("string"))
    number = F.col("c_acctbal").cast("decimal(18,2)")
    metric = F.concat(
        F.lit("1700000000000 "), (number + 1).cast("string"), F.lit(" 0\n1700000001000 "), number.cast("string"), F.lit(" 1\n")
    )
    files = {
        "/metrics/eval_rmse": metric,
        "/params/lr": F.col("c_custkey").cast("string"),
        "/params/momentum": F.col("c_mktsegment"),
        "/tags/mlflow.parentRunId": F.concat(F.lit("parent "), F.col("c_mktsegment")),
        "/meta.yaml": F.lit("not read"),
    }
    rows = F.array(*[F.struct(F.concat(base, F.lit(p)).alias("path"), v.alias("value")) for p, v in files.items()])
    return table(spark, sf_dir, "customer").select(F.explode(rows).alias("f")).select("f.*")


def run_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tracked-run files ``(path, value)``: a run per nation and 1,000 customer keys, a metric step per customer."""
    step = F.struct("c_custkey", F.concat_ws(" ", F.lit("1700000000000"), F.col("c_acctbal").cast("decimal(18,2)"), "c_custkey").alias("line"))
    runs = table(spark, sf_dir, "customer").groupBy(
        F.concat_ws("/", "c_nationkey", F.concat(F.lit("b"), F.floor(F.col("c_custkey") / 1000).cast("string"))).alias("base")
    ).agg(F.sort_array(F.collect_list(step)).alias("steps"))
    files = {
        "/metrics/account balance": F.array_join(F.transform("steps", lambda s: s["line"]), "\n"),
        "/params/a+b": F.size("steps").cast("string"),
        "/meta.yaml": F.lit("not read"),
    }
    rows = F.array(*[F.struct(F.concat("base", F.lit(p)).alias("path"), v.alias("value")) for p, v in files.items()])
    return runs.select(F.explode(rows).alias("f")).select("f.*")


def daily_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity, price and promotion per brand and day."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey")
    )
    return lines.groupBy(F.col("p_brand").alias("item"), F.col("l_shipdate").cast("date").alias("day")).agg(
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("demand"),
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("sales"),
        F.sum(F.col("l_discount").cast("decimal(18,2)")).alias("discounts"),
        F.sum(F.col("l_tax").cast("decimal(18,2)")).alias("taxes"),
        F.max((F.col("p_type") == "PROMO").cast("int")).alias("promo"),
    )
