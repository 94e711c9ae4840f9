"""Invoice curation: types, dates, names and product groups of the raw invoice rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions.casts import AMOUNT, abs_amount, to_type
from claimloom.functions.text import strip_whitespace

LIABILITY = "Liability"
DATE_FORMAT = "dd-MM-yyyy"

# Product groups.
RETAIL_PRODUCTS = ["Commercial - Retail", "Commercial - Wholesale"]
HOME_PRODUCT = "Domestic"
COMMERCIAL_GROUP = "Property Commercial"
RESIDENTIAL_GROUP = "Property Residential"

YEAR_COLUMNS = ["accounting_year", "accounting_month"]
DATE_COLUMNS = ["accounting_date", "invoice_date", "payment_date", "creation_date"]
SIGNED_COLUMNS = ["invoice_amt", "payment_amt"]
UNSIGNED_COLUMNS = ["net_amount", "vat_amount", "invoice_fee", "invoice_cost"]
CURATED_COLUMNS = [
    "document_num", "customer_id", "customer_name", "accounting_year", "accounting_month", "accounting_date",
    "invoice_date", "country_code", "client_category", "client_group", "currency_code", "claim_number",
    "invoice_amt", "payment_amt", "company", "sell_to_customer_no", "sell_to_name", "document_type",
    "payment_date", "net_amount", "vat_amount", "product_name", "service_line", "product_description", "invoice",
    "invoice_fee", "invoice_cost", "assessment_type", "peril", "creation_date", "local_to_eur_exchange_rate",
]


def payable(product: Column, payment_date: Column) -> Column:
    """Rows that are kept: a known product that is not liability, and a payment date."""
    return (F.trim(product) != LIABILITY) & payment_date.isNotNull()


def product_group(product: Column, country: Column) -> Column:
    """Product name per country rules, white space removed."""
    name = F.trim(product)
    local = F.when(name.isin(*RETAIL_PRODUCTS), COMMERCIAL_GROUP).when(name == HOME_PRODUCT, RESIDENTIAL_GROUP)
    group = F.when(country == "AU", local.otherwise(name)).when(country == "UK", F.lit(COMMERCIAL_GROUP))
    return strip_whitespace(group.otherwise(name))


def curate_invoices(raw: DataFrame, countries: Sequence[str] | None = None, on_error: str = "fail") -> DataFrame:
    """Typed invoices of all countries (or some) in one plan; ``on_error="null"`` tolerates bad text."""
    kept = raw.filter(payable(F.col("product_name"), F.col("payment_date")))
    if countries is not None:
        kept = kept.filter(F.col("country_code").isin(*countries))
    parse = F.to_date if on_error == "fail" else F.try_to_date
    country = F.col("country_code")
    typed = {
        "customer_name": F.when(country == "UK", F.col("sell_to_name")).otherwise(F.col("customer_name")),
        "product_name": product_group(F.col("product_name"), country),
    }
    typed |= {c: to_type(F.col(c), "int", on_error) for c in YEAR_COLUMNS}
    typed |= {c: parse(F.col(c), DATE_FORMAT) for c in DATE_COLUMNS}
    typed |= {c: to_type(F.col(c), AMOUNT, on_error) for c in SIGNED_COLUMNS}
    typed |= {c: abs_amount(F.col(c), AMOUNT, on_error) for c in UNSIGNED_COLUMNS}
    return kept.withColumns(typed).select(*CURATED_COLUMNS)


def invoice_countries(raw: DataFrame) -> DataFrame:
    """Countries that have payable invoices."""
    return raw.filter(payable(F.col("product_name"), F.col("payment_date"))).select("country_code").distinct()


def split_valid(df: DataFrame, stage: str, key: str, checks: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and one reject row ``(stage, id, reason)`` per failed row.

    The reason is the name of the first check that does not hold; a null outcome fails.
    """
    reason = F.lit(None).cast("string")
    for name, holds in reversed(checks.items()):
        reason = F.when(F.coalesce(holds, F.lit(False)), reason).otherwise(F.lit(name))
    valid = df.filter(reason.isNull())
    rejects = df.filter(reason.isNotNull()).select(
        F.lit(stage).alias("stage"), F.col(key).cast("string").alias("id"), reason.alias("reason")
    )
    return valid, rejects
