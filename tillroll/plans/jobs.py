"""Jobs: operators wired to sources and sinks.

Each job reads entities from a ``Tables`` source, builds its outputs with
the operators and writes each output once (row counts come from the write
itself). ``as_of`` is explicit. A job writes its audit row after success and
a FAILURE row before re-raising.

Jobs that reuse one large intermediate (the sales fact feeds seven outputs)
write it once as a parquet table partitioned by year and month under the
shared checkpoint folder and read it back: executors lost later re-read
those files instead of recomputing the joins, and month filters prune
partitions. The files go when the outputs are written.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll import operators as op
from tillroll.plans.state import ChurnState, MonthlySums
from tillroll.session import scratch_path
from tillroll.sources.audit import append_audit
from tillroll.sources.files import read_csv_with_header
from tillroll.sources.incremental import follow_table
from tillroll.sources.publish import Staged, delete_folder, new_version, stage_table
from tillroll.sources.sinks import write_output, write_outputs
from tillroll.sources.tables import CatalogTables, Tables

# Tables the cleaning stage copies from bronze to silver unchanged.
PASSTHROUGH_TABLES = [
    "order_items",
    "products",
    "loginhistory",
    "usage_history",
    "customersupport",
    "enterprisecampaigns",
    "historical_customer_sales",
]

# Keys that the quality gate of the cleaning stage wants without nulls; tables
# that are not named here only must not be empty.
GATE_KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "order_id",
    "products": "product_id",
    "loginhistory": "customer_id",
    "customersupport": "TicketID",
    "enterprisecampaigns": "CustomerID",
    "historical_customer_sales": "order_id",
}


@dataclass
class JobResult:
    job_name: str
    status: str
    rows: dict[str, int] = field(default_factory=dict)
    start_time: dt.datetime | None = None
    end_time: dt.datetime | None = None
    run_id: str | None = None
    rejected: dict[str, int] = field(default_factory=dict)


@contextmanager
def materialized(df: DataFrame, name: str, partition_by: list[str] | None = None) -> Iterator[DataFrame]:
    """``df`` written under the shared checkpoint folder and read back, for
    the length of a ``with`` block; the files are deleted after it.

    Cuts the lineage: later stages and retries after executor loss read the
    files. The folder comes from ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "materialized", f"{name}-{uuid.uuid4().hex}")
    # REBALANCE lets AQE coalesce small partitions and split skewed ones
    # before the write: a few files per (year, month) folder, and a month
    # holding a third of the rows is spread over several tasks.
    writer = df.hint("rebalance", *(partition_by or [])).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete_folder(spark, path)


def _run(
    spark: SparkSession,
    job_name: str,
    audit_base: str | None,
    body: Callable[[], dict[str, int]],
    audit_count_key: str | None = None,
    run_id: str | None = None,
) -> JobResult:
    """``run_id`` names the run in the audit log; a retry that passes the same
    one adds no second row of the same status."""
    start, run_id = dt.datetime.now(), run_id or new_version()
    try:
        rows = body()
    except Exception:
        if audit_base:
            append_audit(spark, audit_base, job_name, "FAILURE", 0, start, dt.datetime.now(), run_id)
        raise
    end = dt.datetime.now()
    if audit_base:
        count = rows.get(audit_count_key, 0) if audit_count_key else sum(rows.values())
        append_audit(spark, audit_base, job_name, "SUCCESS", count, start, end, run_id)
    return JobResult(job_name, "SUCCESS", rows, start, end, run_id)


def stage_silver(
    spark: SparkSession,
    bronze: Tables,
    target_root: str,
    database: str,
    as_of: dt.date,
    strict_email: bool = False,
    order_buckets: int | None = None,
    concurrency: int = 4,
    gate_keys: Mapping[str, str] | None = GATE_KEYS,
    passthrough: Sequence[str] = PASSTHROUGH_TABLES,
) -> dict[str, Staged]:
    """Write new versions of the silver tables, each checked by the counts of
    its own write, and publish none: an empty table or a null key raises, and
    what was staged goes. ``gate_keys=None`` checks nothing."""
    root = target_root.rstrip("/")
    by_order = (order_buckets, ["order_id"]) if order_buckets else None
    staged: dict[str, Staged] = {}

    def stage(name: str, df: DataFrame) -> None:
        bucket = by_order if name in ("orders", "order_items") else None
        staged[name] = stage_table(df, f"{root}/{name}", database, name, bucket_by=bucket,
                                   key=(gate_keys or {}).get(name), gate=gate_keys is not None)

    try:
        stage("customers", op.clean_customers(bronze.table("customers"), strict_email))
        # Orders are checked against the staged customers: the cleaned set is
        # read back instead of being recomputed.
        stage("orders", op.clean_orders(bronze.table("orders"), staged["customers"].read(), as_of))
        # The copies are independent: submitted from several driver threads,
        # their small stages share the cores.
        with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
            for done in [pool.submit(stage, name, bronze.table(name)) for name in passthrough]:
                done.result()
    except Exception:
        for table in staged.values():
            table.discard()
        raise
    return staged


def run_cleaning(
    spark: SparkSession,
    bronze: Tables,
    target_root: str,
    database: str,
    as_of: dt.date,
    job_name: str = "cleaning",
    strict_email: bool = False,
    audit: bool = True,
    order_buckets: int | None = None,
    concurrency: int = 4,
    gate_keys: Mapping[str, str] | None = GATE_KEYS,
    run_id: str | None = None,
    incremental: bool = False,
) -> JobResult:
    """Bronze -> silver: clean customers and orders, copy seven tables, publish
    all nine as external tables under ``target_root/<name>``, audit with
    the clean customer count.

    All nine are written and checked before the first is published, so a failed
    write, an empty table or a null key leaves the silver tables of the last
    run as they were. Orders whose amount does not fit go to
    ``target_root/rejected_orders``.

    ``incremental=True`` copies the seven tables by changed source files
    (``follow_table``) instead of in full. Each is then a view that changes at
    once; customers and orders change after all seven have. ``bronze`` has to
    give plain scans of files.

    ``order_buckets=n`` publishes orders and order_items bucketed by
    ``order_id`` into ``n`` buckets, so the sales fact's largest join
    (orders ⋈ order_items) reads co-partitioned buckets instead of shuffling
    both tables on every run. Size ``n`` so that a bucket is a few hundred MB.
    Off by default: a bucketed join has no shuffle for AQE to split, so turn
    it on only when no single order holds a large share of the lines (the
    default path shuffles and lets AQE split a skewed order's partition).
    With ``incremental`` only orders are bucketed.
    """
    root = target_root.rstrip("/")

    def follow(name: str) -> int:
        return follow_table(bronze.table(name), f"{root}/{name}", database, name,
                            key=(gate_keys or {}).get(name), gate=gate_keys is not None).rows

    def body() -> dict[str, int]:
        staged = stage_silver(spark, bronze, root, database, as_of, strict_email, order_buckets, concurrency, gate_keys,
                              () if incremental else PASSTHROUGH_TABLES)
        followed: dict[str, int] = {}
        try:
            # Amounts that do not fit decimal(10,2) are kept apart for a look.
            rejected = write_output(op.rejected_orders(bronze.table("orders"), as_of), f"{root}/rejected_orders")
            if incremental:
                with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
                    followed = dict(zip(PASSTHROUGH_TABLES, pool.map(follow, PASSTHROUGH_TABLES)))
        except Exception:
            for table in staged.values():
                table.discard()
            raise
        return {name: table.publish() for name, table in staged.items()} | followed | {"rejected_orders": rejected}

    return _run(spark, job_name, f"{root}/{job_name}" if audit else None, body, "customers", run_id)


def run_churn(spark: SparkSession, tables: Tables, output_path: str, as_of: dt.date) -> JobResult:
    return _run(spark, "churn", None, lambda: {
        "churn_risk": write_output(op.churn_risk(tables.table("orders"), as_of), output_path)
    })


def run_churn_update(
    spark: SparkSession,
    new_orders: DataFrame,
    state: ChurnState,
    through: str,
    output_path: str,
    as_of: dt.date,
) -> JobResult:
    """Churn from stored counts and dates per customer: reads the orders that
    came since the last update, merges them, and writes the customers at risk.
    ``through`` marks how far the orders go (see ``ChurnState``)."""
    def body() -> dict[str, int]:
        state.merge(new_orders, through)
        return {"churn_risk": write_output(op.churn_of_customers(state.read(), as_of), output_path)}

    return _run(spark, "churn_update", None, body)


def run_fraud(
    spark: SparkSession, tables: Tables, output_path: str, as_of: dt.date, events_as_of: dt.date | None = None
) -> JobResult:
    return _run(spark, "fraud", None, lambda: {
        "high_risk_customers": write_output(
            op.high_risk_customers(
                tables.table("orders"), tables.table("loginhistory"), as_of, logins_as_of=events_as_of
            ), output_path
        )
    })


def run_top_customers(
    spark: SparkSession,
    tables: Tables,
    output_path: str,
    as_of: dt.date,
    country_like: str = "United %",
    audit_base: str | None = None,
) -> JobResult:
    """Purchase behaviour: top-10 spenders per matching country."""
    return _run(spark, "top_customers", audit_base, lambda: {
        "top_customers": write_output(
            op.top_customers_by_country(
                tables.table("orders"), tables.table("customers"), as_of, country_like=country_like
            ),
            output_path,
        )
    }, "top_customers")


def run_omni(
    spark: SparkSession,
    tables: Tables,
    output_path: str,
    as_of: dt.date,
    unified: bool = False,
    events_as_of: dt.date | None = None,
) -> JobResult:
    """Omni-channel profile; ``unified=False`` reproduces the reference's joins."""
    engagement = op.flatten_interactions(tables.table("enterprisecampaigns"), events_as_of or as_of)
    tickets = op.support_view(tables.table("customersupport"))
    build = op.omni_profile_unified if unified else op.omni_profile_reference
    return _run(spark, "omni_channel", None, lambda: {
        "profile": write_output(
            build(engagement, tables.table("orders"), tickets, as_of, events_as_of=events_as_of), output_path)
    })


def sales_outputs(fact: DataFrame, products: DataFrame) -> dict[str, DataFrame]:
    """The six written sales-trend results over a (materialised) fact."""
    return {
        "peak_sales_months": op.peak_sales_months(fact),
        "top_customers": op.top_customer_products(fact, products),
        "customer_purchase_trend": op.customer_purchase_trend(fact),
        "retention_rate_pct": op.retention_rate(fact),
        "month_over_month_growth_pct": op.product_mom_growth(fact, products),
        "yoy_comparison": op.yoy_comparison(fact, products),
    }


def run_sales_trends(
    spark: SparkSession,
    tables: Tables,
    output_path: str,
    orders_table: str = "orders",
    concurrency: int = 4,
) -> JobResult:
    """Sales trends: the fact (current and history lines) is built
    and written once, partitioned by year and month; six results are written
    under ``output_path/<name>`` (``concurrency`` writes at a time), and the
    customer segments (current lines only) are registered as the temp view
    ``customer_segmented``.

    Lines of the history with a value that does not fit its type do not stop
    the job: the same write sets them apart, and they go to
    ``output_path/rejected_history`` (reason, raw); ``rejected`` of the result
    counts them.
    """
    root = output_path.rstrip("/")
    rejected: dict[str, int] = {}

    def body() -> dict[str, int]:
        products = tables.table("products")
        current = op.sales_fact(tables.table(orders_table), tables.table("order_items"), products)
        history = tables.table("historical_customer_sales")
        # The view outlives the stored fact, so it stands on the tables.
        op.customer_segments(current).createOrReplaceTempView("customer_segmented")
        lines = op.checked_fact_all(current, history)
        with materialized(lines, "sales_fact_all", ["rejected", "order_year", "order_month"]) as stored:
            fact = stored.filter(~F.col("rejected")).drop("rejected", "reason", "raw")
            apart = stored.filter("rejected").select("reason", "raw")
            rejected["historical_customer_sales"] = write_output(apart, f"{root}/rejected_history")
            return write_outputs(sales_outputs(fact, products), root, concurrency=concurrency)

    result = _run(spark, "sales_trends", None, body)
    result.rejected = rejected
    return result


def run_monthly_trends(
    spark: SparkSession,
    fact: DataFrame,
    products: DataFrame,
    state_path: str,
    output_path: str,
    months: list[tuple[int, int]] | None = None,
    concurrency: int = 3,
) -> JobResult:
    """The three monthly sales trends from stored sums: only ``months`` (year,
    month; None for all) of the partitioned ``fact`` are read and summed anew,
    the others' sums stay."""
    state = MonthlySums(spark, state_path)

    def body() -> dict[str, int]:
        state.update(fact, months)
        return write_outputs({
            "peak_sales_months": op.peak_months_of_sums(state.read("months")),
            "customer_purchase_trend": op.purchase_trend_of_months(state.read("customers")),
            "month_over_month_growth_pct": op.mom_growth_of_months(state.read("products"), products),
        }, output_path, concurrency=concurrency)

    return _run(spark, "monthly_trends", None, body)


def run_csv_to_parquet(
    spark: SparkSession,
    source_path: str,
    target_path: str,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    schema: str | None = None,
) -> JobResult:
    """Header CSV (strings unless a schema is given) -> optional transform ->
    Parquet, overwrite."""

    def body() -> dict[str, int]:
        df = read_csv_with_header(spark, source_path, schema)
        if transform is not None:
            df = transform(df)
        return {"rows": write_output(df, target_path)}

    return _run(spark, "csv_to_parquet", None, body)


def run_all_jobs(
    spark: SparkSession,
    bronze: Tables,
    root: str,
    database: str,
    as_of: dt.date,
    country_like: str = "United %",
    order_buckets: int | None = None,
    events_as_of: dt.date | None = None,
) -> dict[str, JobResult]:
    """Bronze -> silver -> gold in dependency order.

    The cleaning stage publishes the nine silver tables; every analytic job
    then reads the published silver tables from the catalog (files written
    once, so a failure later in the run does not recompute the cleaning).
    Gold outputs go to ``root/gold/<job>``. A failing job stops the run.
    """
    root = root.rstrip("/")
    results = {"cleaning": run_cleaning(
        spark, bronze, f"{root}/silver", database, as_of, order_buckets=order_buckets
    )}
    silver = CatalogTables(spark, database)
    gold = f"{root}/gold"
    results["churn"] = run_churn(spark, silver, f"{gold}/churn", as_of)
    results["fraud"] = run_fraud(spark, silver, f"{gold}/fraud", as_of, events_as_of)
    results["top_customers"] = run_top_customers(
        spark, silver, f"{gold}/top_customers", as_of, country_like, audit_base=gold
    )
    results["omni_channel"] = run_omni(spark, silver, f"{gold}/omni_channel", as_of, events_as_of=events_as_of)
    results["sales_trends"] = run_sales_trends(spark, silver, f"{gold}/sales_trends")
    return results
