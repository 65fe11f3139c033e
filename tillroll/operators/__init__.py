"""``DataFrame -> DataFrame`` analytics. No operator triggers an action."""

from tillroll.operators.engagement import (
    channel_engagement,
    flatten_interactions,
    omni_profile_reference,
    omni_profile_unified,
    purchase_activity,
    support_activity,
    support_view,
)
from tillroll.operators.generic import previous_value, top_k, top_k_per_group
from tillroll.operators.quality import (
    DataQualityError,
    clean_customer_ids,
    clean_customers,
    clean_orders,
    dq_gate,
    dq_metrics,
    dq_report,
    rejected_orders,
)
from tillroll.operators.ranking import customer_spending, top_customers_by_country
from tillroll.operators.risk import (
    churn_of_customers,
    churn_risk,
    customer_orders,
    high_risk_customers,
    high_risk_orders,
    merge_customer_orders,
    suspicious_logins,
)
from tillroll.operators.sales import (
    align_history,
    checked_fact_all,
    checked_history,
    customer_months,
    customer_purchase_trend,
    customer_segments,
    mom_growth_of_months,
    month_sums,
    peak_months_of_sums,
    peak_sales_months,
    product_mom_growth,
    product_months,
    purchase_trend_of_months,
    retention_rate,
    sales_fact,
    sales_fact_all,
    top_customer_products,
    top_customers,
    yoy_comparison,
)

__all__ = [
    "DataQualityError",
    "align_history",
    "channel_engagement",
    "checked_fact_all",
    "checked_history",
    "churn_of_customers",
    "churn_risk",
    "clean_customer_ids",
    "clean_customers",
    "clean_orders",
    "customer_months",
    "customer_orders",
    "customer_purchase_trend",
    "customer_segments",
    "customer_spending",
    "dq_gate",
    "dq_metrics",
    "dq_report",
    "flatten_interactions",
    "high_risk_customers",
    "high_risk_orders",
    "merge_customer_orders",
    "mom_growth_of_months",
    "month_sums",
    "omni_profile_reference",
    "omni_profile_unified",
    "peak_months_of_sums",
    "peak_sales_months",
    "previous_value",
    "product_mom_growth",
    "product_months",
    "purchase_activity",
    "purchase_trend_of_months",
    "rejected_orders",
    "retention_rate",
    "sales_fact",
    "sales_fact_all",
    "support_activity",
    "support_view",
    "suspicious_logins",
    "top_customer_products",
    "top_customers",
    "top_customers_by_country",
    "top_k",
    "top_k_per_group",
    "yoy_comparison",
]
