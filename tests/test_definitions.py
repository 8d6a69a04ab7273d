"""Cases the sample does not hold: operators against their SQL definitions on small staging tables."""

import decimal
from datetime import date

import duckdb
import pytest

from billscope.plans import oracle
from billscope.plans.layer import Layer
from billscope.plans.periods import JUNE_2024, Periods
from tests.fixtures import at, staging
from tests.test_mrr import event

# The relations the definitions read, from the staging tables.
RELATIONS = {
    "invoices": """SELECT invoice_id, customer_id, invoice_amount_paid_cents AS paid_cents, invoice_created AS created,
      invoice_paid AS is_paid, invoice_collection_method = 'charge_automatically' AS auto_charged, invoice_status AS status
      FROM stg_invoices""",
    "ledger": """SELECT balance_transaction_id AS entry_id, invoice_id, customer_id, balance_reporting_category AS category,
      balance_amount_cents AS amount, balance_net_cents AS net, balance_available_on AS available_on
      FROM stg_balance_transactions""",
    "charges": "SELECT charge_id, invoice_id, charge_status AS status, charge_captured AS captured FROM stg_charges",
    "disputes": "SELECT dispute_id, dispute_reason AS reason FROM stg_disputes",
    "plan_events": """SELECT subscription_event_id AS event_id, subscription_id, customer_id, subscription_event_type AS kind,
      event_effective_at AS effective_at, previous_plan_amount_cents AS amount_before, new_plan_amount_cents AS amount_after
      FROM stg_subscription_events""",
    "subscriptions": "SELECT subscription_id, plan_interval FROM stg_subscriptions",
}


def plain(value):
    return float(value) if isinstance(value, decimal.Decimal) else value


def both(tables, name, periods=JUNE_2024):
    """Rows of the operator, which must be those of its definition."""
    connection = duckdb.connect()
    for table, df in tables.tables().items():
        arrow = df.toArrow()
        connection.register(f"stg_{table}", arrow)
    for relation, sql in RELATIONS.items():
        connection.sql(f"CREATE VIEW {relation} AS {sql}")
    df = getattr(Layer(tables, periods), name)
    columns = sorted(df.columns)
    expected = connection.sql(f"SELECT {', '.join(columns)} FROM ({oracle.query_sql(name, periods, staging='')})").fetchall()
    actual = [tuple(plain(v) for v in row) for row in df.select(*columns).collect()]
    assert sorted(actual, key=repr) == sorted(expected, key=repr)
    return [dict(zip(columns, row, strict=True)) for row in actual]


def monthly(*subscriptions):
    return [{"subscription_id": s, "plan_interval": "month"} for s in subscriptions]


def test_previous_month_is_the_preceding_one_with_rows(spark):
    """Nothing is in force from March to May, so June's change is against February."""
    events = [event("a", 1, "created", "2023-05-01", None, 100), event("a", 2, "canceled", "2024-02-10", 100, 0), event("a", 3, "reactivated", "2024-06-10", 0, 300)]
    rows = both(staging(spark, subscription_events=events, subscriptions=monthly("a")), "mrr_rate_of_change")
    june = next(r for r in rows if r["mrr_month"] == date(2024, 6, 1))
    assert (june["prev_mrr_cents"], june["net_mrr_change_cents"]) == (100, 200)


def test_a_first_year_has_a_best_month_and_no_violation(spark):
    events = [event("a", 1, "created", "2024-01-10", None, 100), event("a", 2, "upgraded", "2024-02-10", 100, 200), event("a", 3, "upgraded", "2024-03-10", 200, 300)]
    tables = staging(spark, subscription_events=events, subscriptions=monthly("a"))
    (summary,) = both(tables, "mrr_growth_summary")
    assert (summary["best_month"], summary["best_gain_cents"]) == (date(2024, 2, 1), 100)
    (check,) = both(tables, "movement_identity_check")
    assert (check["total_violations"], check["months_without_predecessor"]) == (0, 1)


def test_negative_mrr(spark):
    """A credit after MRR is no contraction, and MRR after a credit no expansion."""
    events = [
        event("a", 1, "created", "2023-05-01", None, 100),
        event("a", 2, "upgraded", "2024-02-10", 100, -40),
        event("a", 3, "upgraded", "2024-04-10", -40, 70),
        event("b", 4, "created", "2023-05-01", None, -5),
        event("b", 5, "upgraded", "2024-03-01", -5, 0),
    ]
    tables = staging(spark, subscription_events=events, subscriptions=monthly("a", "b"))
    drivers = {(r["subscription_id"], r["mrr_month"].month): r["mrr_movement_driver"] for r in both(tables, "mrr_movements")}
    assert (drivers["a", 2], drivers["a", 4], drivers["b", 3]) == ("no_mrr", "no_mrr", "no_mrr")


def test_negative_ending(spark):
    """A negative ending is neither a contraction nor churn."""
    events = [event("a", 1, "created", "2023-05-01", None, 100), event("a", 2, "upgraded", "2024-09-10", 100, -40)]
    invoice = {"invoice_id": "i", "customer_id": "cus_a", "invoice_paid": True, "invoice_status": "paid", "invoice_created": at("2023-02-03")}
    tables = staging(spark, subscription_events=events, subscriptions=monthly("a"), invoices=[invoice])
    (row,) = both(tables, "customer_nrr_movement")
    assert (row["customer_movement_type"], row["contraction_mrr_cents"], row["churn_mrr_cents"]) == ("unchanged", 0, 0)


def test_unknown_billed_amount_is_no_gap(spark):
    invoice = {"invoice_id": "i", "customer_id": "c", "invoice_paid": True, "invoice_created": at("2024-06-03"), "invoice_collection_method": "charge_automatically"}
    tables = staging(spark, invoices=[invoice, {**invoice, "invoice_id": "j", "invoice_amount_paid_cents": 7}])
    assert [r["invoice_id"] for r in both(tables, "invoice_recon")] == ["j"]


def test_a_charge_without_an_outcome_is_no_attempt(spark):
    invoice = {"customer_id": "c", "invoice_paid": True, "invoice_created": at("2024-06-03"), "invoice_collection_method": "charge_automatically"}
    invoices = [{**invoice, "invoice_id": i, "invoice_amount_paid_cents": 5} for i in "abc"]
    charges = [
        {"charge_id": "1", "invoice_id": "a", "charge_status": "succeeded"},
        {"charge_id": "2", "invoice_id": "b", "charge_captured": True},
        {"charge_id": "3", "invoice_id": "c", "charge_status": "failed"},
    ]
    tables = staging(spark, invoices=invoices, charges=charges)
    assert [r["invoice_id"] for r in both(tables, "processor_side")] == ["c"]
    assert [r["invoice_id"] for r in both(tables, "charge_outcomes")] == ["c"]


def test_an_event_without_an_id_is_the_last_of_its_moment(spark):
    events = [event("a", 1, "created", "2024-01-10", None, 100), event("a", None, "upgraded", "2024-01-10", 100, 300)]
    tables = staging(spark, subscription_events=events, subscriptions=monthly("a"))
    assert {r["mrr_cents"] for r in both(tables, "mrr_state")} == {300}
    assert [r["new_plan_amount_cents"] for r in both(tables, "closing_events")] == [300]


def test_january_restates_the_year_before(spark):
    tables = staging(
        spark,
        invoices=[{"invoice_id": "i", "invoice_period_end": at("2023-11-30"), "invoice_created": at("2023-11-30")}],
        disputes=[{"dispute_id": "d", "dispute_reason": "fraudulent"}],
        balance_transactions=[
            {
                "balance_source_id": "d",
                "invoice_id": "i",
                "balance_reporting_category": "dispute",
                "balance_net_cents": -700,
                "balance_available_on": at("2024-01-20"),
            }
        ],
    )
    rows = Layer(tables, Periods.for_month(2024, 1)).chargeback_restatement.collect()
    assert [(r.dispute_reason, r.invoice_count, r.total_lost_net_cents) for r in rows] == [("fraudulent", 1, 700)]


def test_periods():
    assert Periods.for_month(2024, 1).closed == (date(2023, 1, 1), date(2024, 1, 1))
    assert Periods.for_month(2024, 6, closed_from=date(2022, 3, 1)).closed == (date(2022, 3, 1), date(2024, 6, 1))
    assert Periods.for_month(2024, 6, n_months=25).last_month == date(2025, 12, 1)
    with pytest.raises(ValueError, match="closed"):
        Periods.for_month(2024, 6, closed_from=date(2024, 6, 1))
    with pytest.raises(ValueError, match="calendar"):
        Periods.for_month(2024, 6, n_months=0)
