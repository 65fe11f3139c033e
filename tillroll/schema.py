"""Declared schemas of the nested and written tables.

Ids are 64-bit: at the target scale order and line keys pass 2**31.
Money is ``decimal(10,2)`` at the source; line amounts are
``quantity * unit_price`` = ``decimal(21,2)``. Event times are wall-clock
timestamps without zone (``timestamp_ntz``).
"""

from __future__ import annotations

from pyspark.sql import types as T

ID = T.LongType()
MONEY = T.DecimalType(10, 2)
LINE_AMOUNT = T.DecimalType(21, 2)

# Line-level sales fact (current lines and aligned history share it).
SALES_FACT = T.StructType([
    T.StructField("order_id", ID),
    T.StructField("customer_id", ID),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("product_id", ID),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", MONEY),
    T.StructField("sales_amount", LINE_AMOUNT),
    T.StructField("order_year", T.IntegerType()),
    T.StructField("order_month", T.IntegerType()),
])

INTERACTION = T.StructType([
    T.StructField("InteractionID", T.StringType()),
    T.StructField("Timestamp", T.TimestampNTZType()),
    T.StructField("Channel", T.StringType()),
    T.StructField("Action", T.StringType()),
])

CAMPAIGNS = T.StructType([
    T.StructField("CustomerID", ID),
    T.StructField("CampaignID", T.StringType()),
    T.StructField("Engagement", T.StructType([
        T.StructField("Opens", T.LongType()),
        T.StructField("Clicks", T.LongType()),
    ])),
    T.StructField("Interactions", T.ArrayType(INTERACTION)),
])

SUPPORT = T.StructType([
    T.StructField("CustomerID", ID),
    T.StructField("TicketID", ID),
    T.StructField("Timestamp", T.TimestampNTZType()),
    T.StructField("Issue", T.StructType([T.StructField("Status", T.StringType())])),
])

AUDIT_LOG = T.StructType([
    T.StructField("job_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("record_count", T.LongType()),
    T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()),
    T.StructField("log_ts", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
])
