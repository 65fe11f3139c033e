"""Registered queries: each runs one operator over the whole generated tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame without
running it. Entities come from ``TestdataTables`` (see its mapping); the
as-of date is the last order date of the generated data, and for events the
day after their last. For comparison with
the DuckDB oracle the result is *presented* with decimals as doubles (the
operators themselves keep decimals; the cast is the last projection).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll import operators as op
from tillroll.testdata import AS_OF, EVENTS_AS_OF, TestdataTables

# The generated nations are NATION_0..NATION_24; this plays the role of the
# reference's 'United %' pattern (10 of 25 nations match).
COUNTRY_LIKE = "NATION_1%"

Query = Callable[[SparkSession, str], DataFrame]


def present(df: DataFrame) -> DataFrame:
    """Decimals as doubles (values are exact decimals first, then converted)."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


def _tables(spark: SparkSession, sf_dir: str, **kw) -> TestdataTables:
    return TestdataTables(spark, sf_dir, **kw)


# -- cleaning and quality -----------------------------------------------------

def q_clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.clean_customers(_tables(spark, sf_dir).customers())


def q_clean_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.clean_orders(t.orders(), op.clean_customer_ids(t.customers()), AS_OF))


def silver_tables(t: TestdataTables) -> dict[str, tuple[DataFrame, str | None]]:
    """The nine silver tables of the cleaning stage with their key columns."""
    return {
        "customers": (op.clean_customers(t.customers()), "customer_id"),
        "orders": (op.clean_orders(t.orders(), op.clean_customer_ids(t.customers()), AS_OF), "order_id"),
        "order_items": (t.order_items(), "order_id"),
        "products": (t.products(), "product_id"),
        "loginhistory": (t.loginhistory(), "customer_id"),
        "usage_history": (t.usage_history(), "user_id"),
        "customersupport": (t.customersupport(), "TicketID"),
        "enterprisecampaigns": (t.enterprisecampaigns(), "CustomerID"),
        "historical_customer_sales": (t.historical_customer_sales(), "order_id"),
    }


def q_dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.dq_report(silver_tables(_tables(spark, sf_dir)))


# -- churn and fraud ---------------------------------------------------------

def q_churn_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.churn_risk(_tables(spark, sf_dir).orders(), AS_OF)


def q_suspicious_logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.suspicious_logins(_tables(spark, sf_dir).loginhistory(), EVENTS_AS_OF)


def q_high_risk_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.high_risk_orders(_tables(spark, sf_dir).orders(), AS_OF))


def q_high_risk_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return op.high_risk_customers(t.orders(), t.loginhistory(), AS_OF, logins_as_of=EVENTS_AS_OF)


# -- ranking -------------------------------------------------------------------

def q_customer_spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.customer_spending(_tables(spark, sf_dir).orders(), AS_OF))


def q_top_customers_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.top_customers_by_country(t.orders(), t.customers(), AS_OF, country_like=COUNTRY_LIKE))


def q_top_customers_by_country_all_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference's DataFrame form of the ranking: every customer column."""
    t = _tables(spark, sf_dir)
    return present(op.top_customers_by_country(
        t.orders(), t.customers(), AS_OF, country_like=COUNTRY_LIKE, all_customer_columns=True
    ))


# -- omni-channel --------------------------------------------------------------

def q_flatten_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.flatten_interactions(_tables(spark, sf_dir).enterprisecampaigns())


def _engagement(t: TestdataTables) -> DataFrame:
    return op.flatten_interactions(t.enterprisecampaigns(), EVENTS_AS_OF)


def _tickets(t: TestdataTables) -> DataFrame:
    return op.support_view(t.customersupport())


def q_channel_engagement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.channel_engagement(_engagement(_tables(spark, sf_dir)), EVENTS_AS_OF)


def q_purchase_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.purchase_activity(_tables(spark, sf_dir).orders(), AS_OF))


def q_support_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.support_activity(_tickets(_tables(spark, sf_dir)), EVENTS_AS_OF)


def q_omni_profile_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.omni_profile_reference(_engagement(t), t.orders(), _tickets(t), AS_OF, events_as_of=EVENTS_AS_OF))


def q_omni_profile_dataframe_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.omni_profile_reference(_engagement(t), t.orders(), _tickets(t), AS_OF, dataframe_form=True, events_as_of=EVENTS_AS_OF))


def q_omni_profile_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.omni_profile_unified(_engagement(t), t.orders(), _tickets(t), AS_OF, events_as_of=EVENTS_AS_OF))


# -- sales trends --------------------------------------------------------------

def current_fact(t: TestdataTables) -> DataFrame:
    return op.sales_fact(t.sales_orders(), t.order_items(), t.products())


def full_fact(t: TestdataTables) -> DataFrame:
    """The fact as the sales job stores it, for the trend queries."""
    return t.sales_lines()


def q_sales_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(current_fact(_tables(spark, sf_dir)))


def q_sales_fact_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.sales_fact_all(current_fact(t), t.historical_customer_sales()))


def q_peak_sales_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.peak_sales_months(full_fact(_tables(spark, sf_dir))))


def q_top_customer_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.top_customer_products(full_fact(t), t.products()))


def q_customer_purchase_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.customer_purchase_trend(full_fact(_tables(spark, sf_dir))))


def q_retention_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.retention_rate(full_fact(_tables(spark, sf_dir))))


def q_product_mom_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.product_mom_growth(full_fact(t), t.products()))


def q_yoy_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return present(op.yoy_comparison(full_fact(t), t.products()))


def q_yoy_comparison_product_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same query over product families, so that (customer, product, month)
    recurs across years; all lines and parts take part."""
    t = _tables(spark, sf_dir, product_families=True)
    return present(op.yoy_comparison(full_fact(t), t.products()))


def q_customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.customer_segments(current_fact(_tables(spark, sf_dir))))


QUERIES: dict[str, Query] = {
    "clean_customers": q_clean_customers,
    "clean_orders": q_clean_orders,
    "dq_gate": q_dq_gate,
    "churn_risk": q_churn_risk,
    "suspicious_logins": q_suspicious_logins,
    "high_risk_orders": q_high_risk_orders,
    "high_risk_customers": q_high_risk_customers,
    "customer_spending": q_customer_spending,
    "top_customers_by_country": q_top_customers_by_country,
    "top_customers_by_country_all_columns": q_top_customers_by_country_all_columns,
    "flatten_interactions": q_flatten_interactions,
    "channel_engagement": q_channel_engagement,
    "purchase_activity": q_purchase_activity,
    "support_activity": q_support_activity,
    "omni_profile_reference": q_omni_profile_reference,
    "omni_profile_dataframe_form": q_omni_profile_dataframe_form,
    "omni_profile_unified": q_omni_profile_unified,
    "sales_fact": q_sales_fact,
    "sales_fact_all": q_sales_fact_all,
    "peak_sales_months": q_peak_sales_months,
    "top_customer_products": q_top_customer_products,
    "customer_purchase_trend": q_customer_purchase_trend,
    "retention_rate": q_retention_rate,
    "product_mom_growth": q_product_mom_growth,
    "yoy_comparison": q_yoy_comparison,
    "yoy_comparison_product_families": q_yoy_comparison_product_families,
    "customer_segments": q_customer_segments,
}
