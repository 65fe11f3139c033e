import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import AS_OF, rows, sort_rows
from tillroll import operators as op
from tillroll.schema import CAMPAIGNS, SUPPORT

T = dt.datetime(2024, 6, 1, 12, 0)
OLD = dt.datetime(2024, 1, 1)        # outside the 90-day window


def campaigns(spark):
    def it(i, ts, ch, act):
        return (str(i), ts, ch, act)
    data = [
        (1, "C1", (2, 1), [it(1, T, "Email", "Opened"), it(2, T, "Email", "Clicked"), it(3, T, "Web", "Opened")]),
        (1, "C2", (0, 1), [it(4, T, "App", "Clicked"), it(5, OLD, "Email", "Opened")]),
        (2, "C3", (1, 0), [it(6, T, "Web", "Opened")]),
        (3, "C4", (0, 0), []),            # empty: no rows
        (4, "C5", (0, 0), None),          # NULL: no rows
        (None, "C6", (1, 1), [it(7, T, "Email", "Opened"), it(8, T, "Web", "Clicked")]),
    ]
    return spark.createDataFrame(data, CAMPAIGNS)


def support(spark):
    return spark.createDataFrame([
        (1, 100, T, ("Open",)), (1, 101, T, ("Resolved",)), (5, 102, T, ("Open",)),
        (6, 103, OLD, ("Open",)), (7, 104, T, ("Resolved",)),
    ], SUPPORT)


ORD = "order_id bigint, customer_id bigint, order_date date, total_amount decimal(10,2)"


def orders(spark):
    day = dt.date(2024, 6, 1)
    return spark.createDataFrame([
        (1, 1, day, Decimal("10.00")), (2, 1, day, Decimal("5.50")),
        (3, 5, day, Decimal("7.00")),     # buyer with tickets, no engagement
        (4, 8, day, Decimal("1.00")),     # buyer only
    ], ORD)


def test_flatten(spark):
    flat = op.flatten_interactions(campaigns(spark))
    assert flat.columns == ["CustomerID", "CampaignID", "Opens", "Clicks", "InteractionID",
                            "Timestamp", "Channel", "Action"]
    assert flat.count() == 8
    assert rows(flat.filter("CampaignID = 'C2'"), "InteractionID", "Opens", "Clicks") == [("4", 0, 1), ("5", 0, 1)]


def test_channel_and_support(spark):
    eng = op.channel_engagement(op.flatten_interactions(campaigns(spark)), AS_OF)
    assert rows(eng) == [(None, 1, 0, 1, 0), (1, 1, 1, 1, 1), (2, 0, 0, 0, 1)]
    sup = op.support_activity(op.support_view(support(spark)), AS_OF)
    assert rows(sup) == [(1, 2, 1, 1), (5, 1, 1, 0), (7, 1, 0, 1)]
    assert "Status" in op.support_view(support(spark)).columns


def test_profile_reference_quirks(spark):
    flat = op.flatten_interactions(campaigns(spark))
    prof = op.omni_profile_reference(flat, orders(spark), op.support_view(support(spark)), AS_OF)
    got = rows(prof, "customer_id", "emails_opened", "ad_clicks", "purchases", "total_ticket")
    # customer 1: all sources; customer 2: engagement only -> NULL id (no purchase side);
    # customer 5 bought and has tickets but no engagement -> two rows (purchase row, ticket row);
    # NULL engagement id -> two rows (e-mail half and ad half); 7: tickets only; 8: buyer only.
    assert got == sort_rows([
        (1, 1, 1, 2, 2),
        (None, 0, 0, 0, 0),   # customer 2
        (5, 0, 0, 1, 0),
        (None, 0, 0, 0, 1),   # customer 5's tickets
        (None, 0, 0, 0, 1),   # customer 7's tickets
        (8, 0, 0, 1, 0),
        (None, 1, 0, 0, 0),   # NULL id, e-mail half
        (None, 0, 1, 0, 0),   # NULL id, ad half
    ])


def test_profile_unified_one_row_per_customer(spark):
    flat = op.flatten_interactions(campaigns(spark))
    prof = op.omni_profile_unified(flat, orders(spark), op.support_view(support(spark)), AS_OF)
    got = {r.customer_id: r for r in prof.collect()}
    assert set(got) == {None, 1, 2, 5, 7, 8}
    assert got[5].purchases == 1 and got[5].total_ticket == 1 and got[5].emails_opened == 0
    assert got[1].total_spent == Decimal("15.50") and got[2].total_spent == 0
    assert (got[None].emails_opened, got[None].ad_clicks) == (1, 1)


def test_profile_dataframe_form(spark):
    flat = op.flatten_interactions(campaigns(spark))
    prof = op.omni_profile_reference(flat, orders(spark), op.support_view(support(spark)), AS_OF,
                                     dataframe_form=True)
    got = {r.customer_id: r for r in prof.collect() if r.customer_id is not None}
    # ids are coalesced over the four sides; missing sides stay NULL (not 0)
    assert set(got) == {1, 2, 5, 7, 8}
    assert got[2].purchases is None and got[2].total_ticket is None and got[2].ad_views == 1
    assert got[8].emails_opened is None and got[8].purchases == 1
    assert prof.count() == 8        # same rows as the SQL form, incl. customer 5 twice


def test_flatten_filters_arrays(spark):
    flat = op.flatten_interactions(campaigns(spark), AS_OF)
    assert rows(flat) == rows(op.flatten_interactions(campaigns(spark)).filter(F.col("Timestamp") > OLD))


def test_profiles_take_string_ids(spark):
    """The same profiles whatever the ids' type; mixed types meet as strings."""
    def named(df, *cols):
        return df.withColumns({c: F.concat(F.lit("id-"), F.col(c).cast("string")) for c in cols})

    plain = (op.flatten_interactions(campaigns(spark)), orders(spark), op.support_view(support(spark)))
    texts = (named(plain[0], "CustomerID"), named(plain[1], "customer_id", "order_id"), named(plain[2], "CustomerID", "TicketID"))
    for build in (op.omni_profile_unified, op.omni_profile_reference,
                  lambda *a: op.omni_profile_reference(*a, dataframe_form=True)):
        want = named(build(*plain, AS_OF), "customer_id")
        assert rows(build(*texts, AS_OF)) == rows(want)
    mixed = op.omni_profile_unified(plain[0], plain[1].withColumn("customer_id", F.col("customer_id").cast("string")), plain[2], AS_OF)
    assert dict(mixed.dtypes)["customer_id"] == "string"
    assert sorted(r.customer_id or "" for r in mixed.collect()) == ["", "1", "2", "5", "7", "8"]


def test_profile_order_and_tickets_without_engagement(spark):
    """Largest amount first, equal amounts by id; customer 5 bought and asked
    but was never engaged."""
    tables = (op.flatten_interactions(campaigns(spark)), orders(spark), op.support_view(support(spark)))
    got = [(r.total_spent, r.customer_id) for r in op.omni_profile_unified(*tables, AS_OF).collect()]
    assert got == [(Decimal("15.50"), 1), (Decimal("7.00"), 5), (Decimal("1.00"), 8), (0, None), (0, 2), (0, 7)]
    ref = [(r.total_spent, r.customer_id) for r in op.omni_profile_reference(*tables, AS_OF).collect()]
    assert ref[:3] == got[:3] and all(r == (0, None) for r in ref[3:])


def test_events_have_a_date_of_their_own(spark):
    tables = (op.flatten_interactions(campaigns(spark)), orders(spark), op.support_view(support(spark)))
    late = AS_OF + dt.timedelta(days=365)
    for build in (op.omni_profile_unified, op.omni_profile_reference):
        got = build(*tables, AS_OF, events_as_of=late).collect()
        assert sorted(r.customer_id for r in got) == [1, 5, 8] and all(r.total_ticket == 0 for r in got)
