"""Omni-channel engagement: campaigns, purchases and support per customer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.functions.dates import trailing_window

# Channel and action vocabulary of the engagement data.
EMAIL_CHANNELS = ["Email"]
AD_CHANNELS = ["Web", "App"]
OPENED = "Opened"
CLICKED = "Clicked"
TICKET_OPEN = "Open"
TICKET_RESOLVED = "Resolved"

# Names of the counts per source and in the profile.
_SOURCE_COUNTS = [
    "EmailsOpened", "EmailsClicked", "AdClicks", "AdViews",
    "purchases", "total_spent", "TotalTickets", "OpenTickets", "ResolvedTickets",
]
COUNT_COLUMNS = [
    "emails_opened", "emails_clicked", "ad_clicks", "ad_views",
    "purchases", "total_spent", "total_ticket", "open_ticket", "resolved_ticket",
]


def flatten_interactions(campaigns: DataFrame, as_of: dt.date | str | None = None, days: int = 90) -> DataFrame:
    """One row per interaction (explode drops NULL and empty arrays), with the
    campaign id and the campaign's Opens/Clicks repeated. With ``as_of`` only
    interactions of the trailing window: the arrays are filtered before they
    are exploded, so old interactions never become rows.

    Output: CustomerID, CampaignID, Opens, Clicks, InteractionID, Timestamp,
    Channel, Action. Narrow: no shuffle.
    """
    interactions = F.col("Interactions")
    if as_of is not None:
        interactions = F.filter(interactions, lambda x: trailing_window(x["Timestamp"], as_of, days))
    return campaigns.select(
        "CustomerID",
        "CampaignID",
        F.col("Engagement.Opens").alias("Opens"),
        F.col("Engagement.Clicks").alias("Clicks"),
        F.explode(interactions).alias("Interaction"),
    ).select(
        "CustomerID", "CampaignID", "Opens", "Clicks",
        F.col("Interaction.InteractionID").alias("InteractionID"),
        F.col("Interaction.Timestamp").alias("Timestamp"),
        F.col("Interaction.Channel").alias("Channel"),
        F.col("Interaction.Action").alias("Action"),
    )


def support_view(support: DataFrame) -> DataFrame:
    """All ticket columns plus the lifted ``Issue.Status`` as ``Status``."""
    return support.select("*", F.col("Issue.Status").alias("Status"))


def _is(action: str, channels: list[str]) -> Column:
    return (F.col("Action") == action) & F.col("Channel").isin(*channels)


def channel_engagement(engagement: DataFrame, as_of: dt.date | str, days: int = 90) -> DataFrame:
    """E-mail and ad engagement per customer over the trailing window, in one
    aggregate (the reference scans twice with the same filter and key).

    Output: CustomerID, EmailsOpened, EmailsClicked, AdClicks, AdViews.
    """
    return (
        engagement.filter(trailing_window("Timestamp", as_of, days))
        .groupBy("CustomerID")
        .agg(
            F.count_if(_is(OPENED, EMAIL_CHANNELS)).alias("EmailsOpened"),
            F.count_if(_is(CLICKED, EMAIL_CHANNELS)).alias("EmailsClicked"),
            F.count_if(_is(CLICKED, AD_CHANNELS)).alias("AdClicks"),
            F.count_if(_is(OPENED, AD_CHANNELS)).alias("AdViews"),
        )
    )


def purchase_activity(orders: DataFrame, as_of: dt.date | str, days: int = 90) -> DataFrame:
    """Output: customer_id, purchases, total_spent (trailing window)."""
    return (
        orders.filter(trailing_window("order_date", as_of, days))
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("purchases"), F.sum("total_amount").alias("total_spent"))
    )


def support_activity(tickets: DataFrame, as_of: dt.date | str, days: int = 90) -> DataFrame:
    """Output: CustomerID, TotalTickets, OpenTickets, ResolvedTickets.

    ``tickets`` is ``support_view`` output (or any frame with ``Status``)."""
    return (
        tickets.filter(trailing_window("Timestamp", as_of, days))
        .groupBy("CustomerID")
        .agg(
            F.count("TicketID").alias("TotalTickets"),
            F.count_if(F.col("Status") == TICKET_OPEN).alias("OpenTickets"),
            F.count_if(F.col("Status") == TICKET_RESOLVED).alias("ResolvedTickets"),
        )
    )


def _zero(c: str, dtype: str | None = None) -> Column:
    value = F.coalesce(F.col(c), F.lit(0))
    return value.cast(dtype) if dtype else value


def omni_profile_reference(
    engagement: DataFrame,
    orders: DataFrame,
    tickets: DataFrame,
    as_of: dt.date | str,
    days: int = 90,
    ordered: bool = True,
    dataframe_form: bool = False,
    events_as_of: dt.date | str | None = None,
) -> DataFrame:
    """The profile exactly as the reference's SQL form joins it.

    ``dataframe_form=True`` gives the reference's DataFrame form instead:
    the same joins, but the id is the first non-NULL id of the four sides and
    counts are *not* replaced by 0 (a missing side stays NULL).

    email FULL JOIN ad ON email.id = ad.id, then purchases and support are
    both FULL JOINed on the *ad* side's id, and the output id is the purchase
    side's ``customer_id``. Consequences kept on purpose: customers without
    purchases get a NULL id, and a buyer with tickets but no engagement comes
    out as two rows. Counts are COALESCEd to 0.

    E-mail and ad counts come from one aggregate. Their full join on equal
    key sets matches every non-NULL id 1:1; only a NULL id group fails to
    match itself and yields two rows (e-mail half, ad half), reproduced here
    with a two-element explode on that group alone.

    ``events_as_of`` is the date for interactions and tickets where it differs
    from the orders'. Equal amounts are ordered by the ids of the three sides,
    so the range shuffle of the sort can cut between customers who spent the
    same (most profiles spent nothing).

    Output: customer_id, emails_opened, emails_clicked, ad_clicks, ad_views,
    purchases, total_spent, total_ticket, open_ticket, resolved_ticket.
    """
    events_as_of = events_as_of or as_of
    ea = channel_engagement(engagement, events_as_of, days)
    halves = F.when(F.col("CustomerID").isNull(), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0)))
    ea = ea.select("*", F.explode(halves).alias("_half")).select(
        F.col("CustomerID").alias("_ad_id"),
        F.when(F.col("_half") != 2, F.col("EmailsOpened")).alias("EmailsOpened"),
        F.when(F.col("_half") != 2, F.col("EmailsClicked")).alias("EmailsClicked"),
        F.when(F.col("_half") != 1, F.col("AdClicks")).alias("AdClicks"),
        F.when(F.col("_half") != 1, F.col("AdViews")).alias("AdViews"),
    )
    p = purchase_activity(orders, as_of, days)
    s = support_activity(tickets, events_as_of, days).withColumnRenamed("CustomerID", "_support_id")
    ea_p = ea.join(p, ea["_ad_id"] == p["customer_id"], "full_outer")
    # The support side joins on the ad side's id, which is NULL for every
    # buyer without engagement. NULL never matches, but all those rows would
    # hash to one partition of the next shuffle (a full outer join cannot be
    # split by AQE). Keying them by (no-ad flag, buyer id) keeps them
    # unmatched -- the support side's flag is always false -- and spreads them.
    left = ea_p.select(
        "*",
        F.col("_ad_id").isNull().alias("_no_ad"),
        F.coalesce(F.col("_ad_id"), F.col("customer_id")).alias("_spread_id"),
    )
    right = s.withColumn("_no_ad_support", F.lit(False))
    joined = left.join(
        right,
        (F.col("_no_ad") == F.col("_no_ad_support")) & (F.col("_spread_id") == F.col("_support_id")),
        "full_outer",
    )
    if dataframe_form:
        joined = joined.withColumns({dst: F.col(src) for src, dst in zip(_SOURCE_COUNTS, COUNT_COLUMNS) if src != dst})
        profile_id = F.coalesce("_ad_id", "customer_id", "_support_id")
    else:
        joined = joined.withColumns({dst: _zero(src) for src, dst in zip(_SOURCE_COUNTS, COUNT_COLUMNS)})
        profile_id = F.col("customer_id")
    if ordered:
        joined = joined.orderBy(F.desc("total_spent"), "customer_id", "_ad_id", "_support_id")
    return joined.select(profile_id.alias("customer_id"), *COUNT_COLUMNS)


def _common_id_type(*types: T.DataType) -> T.DataType:
    """One type for the customer ids of all sources: their own where they
    agree, bigint for integers, else string."""
    if all(t == types[0] for t in types):
        return types[0]
    return T.LongType() if all(isinstance(t, T.IntegralType) for t in types) else T.StringType()


def omni_profile_unified(
    engagement: DataFrame,
    orders: DataFrame,
    tickets: DataFrame,
    as_of: dt.date | str,
    days: int = 90,
    ordered: bool = True,
    events_as_of: dt.date | str | None = None,
) -> DataFrame:
    """One row per customer id seen in any of the three sources, counts
    COALESCEd to 0 (the profile the reference's DataFrame form aims at).

    Plan: the three filtered sources are projected to one shape, unioned,
    and aggregated once by customer id. Partial aggregation runs per input
    partition before the single shuffle, instead of three aggregates and
    three full outer joins. NULL ids from all sources form one group. Ids keep
    their type; orders and tickets are counted by flags, so their ids of any
    type never leave the scan.

    Output columns as ``omni_profile_reference``.
    """
    events_as_of = events_as_of or as_of
    id_type = _common_id_type(
        engagement.schema["CustomerID"].dataType, orders.schema["customer_id"].dataType, tickets.schema["CustomerID"].dataType
    )
    flags = {
        "emails_opened": _is(OPENED, EMAIL_CHANNELS), "emails_clicked": _is(CLICKED, EMAIL_CHANNELS),
        "ad_clicks": _is(CLICKED, AD_CHANNELS), "ad_views": _is(OPENED, AD_CHANNELS),
        "purchases": F.col("order_id").isNotNull(),
        "total_ticket": F.col("TicketID").isNotNull(),
        "open_ticket": F.col("Status") == TICKET_OPEN, "resolved_ticket": F.col("Status") == TICKET_RESOLVED,
    }

    def shaped(df: DataFrame, id_column: str, own: list[str], amount: Column) -> DataFrame:
        return df.select(
            F.col(id_column).cast(id_type).alias("customer_id"),
            *[(flags[c] if c in own else F.lit(False)).alias(c) for c in flags],
            amount.cast(orders.schema["total_amount"].dataType).alias("total_spent"),
        )

    names = list(flags)
    everything = (
        shaped(engagement.filter(trailing_window("Timestamp", events_as_of, days)), "CustomerID", names[:4], F.lit(None))
        .unionByName(shaped(orders.filter(trailing_window("order_date", as_of, days)), "customer_id", names[4:5],
                            F.col("total_amount")))
        .unionByName(shaped(tickets.filter(trailing_window("Timestamp", events_as_of, days)), "CustomerID", names[5:],
                            F.lit(None)))
    )
    out = everything.groupBy("customer_id").agg(*[
        _zero_sum(c).alias(c) if c == "total_spent" else F.count_if(c).alias(c) for c in COUNT_COLUMNS
    ])
    return out.orderBy(F.desc("total_spent"), "customer_id") if ordered else out


def _zero_sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))
