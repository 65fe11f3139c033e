"""Registered queries of what the jobs keep between runs: stored state brought
up to date in two steps, tables counted by their own write, rows set apart, and
a copy that follows its source's files. Each works on whole tables and has to
give what the plain query gives.

What they store lies under ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import operators as op
from tillroll.plans.jobs import GATE_KEYS, stage_silver
from tillroll.plans.oracle import HISTORY_END, ORACLE_SQL, _with
from tillroll.plans.registry import Query, full_fact, present
from tillroll.plans.state import MonthlySums, touched_months
from tillroll.session import scratch_path
from tillroll.sources.incremental import follow_table
from tillroll.sources.publish import published_counts
from tillroll.testdata import AS_OF, TestdataTables

DATABASE = "tillroll_state"   # of the tables that these queries stage
LATER = "2001-01-01"          # orders from here on come as the second step


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder for one query."""
    if not spark.conf.get("spark.checkpoint.dir", None) and re.match(r"local(\[|$)", spark.sparkContext.master):
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tillroll-"))   # as in tests
    return scratch_path(spark, "state", f"{name}-{uuid.uuid4().hex}")


def q_churn_risk_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and dates per customer of the earlier orders, stored, and the
    later orders merged into them."""
    orders, path = TestdataTables(spark, sf_dir).orders(), _scratch(spark, "churn")
    op.customer_orders(orders.filter(F.col("order_date") < LATER)).write.parquet(path)
    newer = op.customer_orders(orders.filter((F.col("order_date") >= LATER) | F.col("order_date").isNull()))
    return op.churn_of_customers(op.merge_customer_orders(spark.read.parquet(path), newer), AS_OF)


def _sums(spark: SparkSession, sf_dir: str) -> tuple[MonthlySums, TestdataTables]:
    """Sums of the earlier months, then of the months that later lines touch.
    Both steps read the fact as stored: its joins run once, not for each sum."""
    t, path = TestdataTables(spark, sf_dir), _scratch(spark, "fact")
    fact, state = full_fact(t), MonthlySums(spark, _scratch(spark, "sums"))
    fact.write.parquet(path)
    lines = spark.read.schema(fact.schema).parquet(path)
    state.update(lines.filter(F.col("order_date") < LATER))
    state.update(lines, touched_months(lines.filter(F.col("order_date") >= LATER)))
    return state, t


def q_peak_sales_months_from_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.peak_months_of_sums(_sums(spark, sf_dir)[0].read("months")))


def q_customer_purchase_trend_from_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return present(op.purchase_trend_of_months(_sums(spark, sf_dir)[0].read("customers")))


def q_product_mom_growth_from_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, t = _sums(spark, sf_dir)
    return present(op.mom_growth_of_months(state.read("products"), t.products()))


def q_dq_gate_from_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's report by the counts that the nine staged writes saw."""
    staged = stage_silver(spark, TestdataTables(spark, sf_dir), _scratch(spark, "silver"), DATABASE, AS_OF,
                          gate_keys=GATE_KEYS | {"usage_history": "user_id"})
    try:
        return spark.createDataFrame(published_counts(staged), "table_name string, record_count long, null_key_count long, passed boolean")
    finally:
        for table in staged.values():
            table.discard()


def malformed_history(t: TestdataTables) -> DataFrame:
    """The history as text, with values that do not fit in some lines."""
    history = t.historical_customer_sales()
    order, product = F.col("order_id"), F.col("product_id")
    text = {c: F.col(c).cast("string") for c in history.columns}
    text["quantity"] = F.when(order % 97 == 0, "n/a").otherwise(text["quantity"])
    text["order_date"] = F.when(order % 101 == 0, "unknown").otherwise(text["order_date"])
    text["unit_price"] = F.when(product % 211 == 0, "123456789012.00").otherwise(text["unit_price"])
    return history.select(*(x.alias(c) for c, x in text.items()))


def q_history_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the sales job sets apart of a history with malformed lines, beside
    how many lines of the same order stay."""
    checked = op.checked_history(malformed_history(TestdataTables(spark, sf_dir)))
    return checked.groupBy("order_id").agg(
        F.count_if(F.col("reason").isNotNull()).alias("rejected"),
        F.count_if(F.col("reason").isNull()).alias("kept"),
        F.sum(F.coalesce("quantity", F.lit(0))).alias("quantity"),
        F.max("reason").alias("reason"),
    ).filter(F.col("rejected") > 0)


def q_orders_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy by changed files, brought up to date twice: the second time
    nothing has changed, so nothing is written."""
    source = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    path, table = _scratch(spark, "orders"), f"orders_{uuid.uuid4().hex}"
    follow_table(source, path, DATABASE, table, key="o_orderkey")
    if follow_table(source, path, DATABASE, table, key="o_orderkey").files_written:
        raise RuntimeError("files were copied again that had not changed")
    return present(spark.read.table(f"{DATABASE}.{table}").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"))


STATE_QUERIES: dict[str, Query] = {
    "churn_risk_from_state": q_churn_risk_from_state,
    "peak_sales_months_from_sums": q_peak_sales_months_from_sums,
    "customer_purchase_trend_from_sums": q_customer_purchase_trend_from_sums,
    "product_mom_growth_from_sums": q_product_mom_growth_from_sums,
    "dq_gate_from_writes": q_dq_gate_from_writes,
    "history_quarantine": q_history_quarantine,
    "orders_followed": q_orders_followed,
}

_QUARANTINE = f"""
judged AS (
  SELECT l.order_id, l.quantity,
    CASE WHEN l.order_id % 101 = 0 THEN 'order_date' END AS d,
    CASE WHEN l.order_id % 97 = 0 THEN 'quantity' END AS q,
    CASE WHEN l.product_id % 211 = 0 THEN 'unit_price' END AS u
  FROM e_lines l WHERE l.order_date < {HISTORY_END}
)"""

STATE_ORACLE: dict[str, str] = {
    "churn_risk_from_state": ORACLE_SQL["churn_risk"],
    "peak_sales_months_from_sums": ORACLE_SQL["peak_sales_months"],
    "customer_purchase_trend_from_sums": ORACLE_SQL["customer_purchase_trend"],
    "product_mom_growth_from_sums": ORACLE_SQL["product_mom_growth"],
    "dq_gate_from_writes": ORACLE_SQL["dq_gate"],
    "history_quarantine": _with(_QUARANTINE, """
SELECT order_id,
  count(*) FILTER (WHERE d IS NOT NULL OR q IS NOT NULL OR u IS NOT NULL) AS rejected,
  count(*) FILTER (WHERE d IS NULL AND q IS NULL AND u IS NULL) AS kept,
  CAST(sum(CASE WHEN q IS NULL THEN quantity ELSE 0 END) AS BIGINT) AS quantity,
  max(CASE WHEN d IS NOT NULL OR q IS NOT NULL OR u IS NOT NULL THEN concat_ws(',', d, q, u) END) AS reason
FROM judged GROUP BY order_id HAVING rejected > 0"""),
    "orders_followed": "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice FROM orders",
}
