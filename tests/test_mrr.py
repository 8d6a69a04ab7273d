from datetime import date

import pytest

from billscope.operators import mrr
from tests.fixtures import at, by_key, day, staging

FIRST = date(2023, 12, 1)


def event(sub, number, kind, on, before=None, after=None, customer=None):
    return {
        "subscription_event_id": number if number is None else f"ev_{number:04d}",
        "subscription_id": sub,
        "customer_id": customer or f"cus_{sub}",
        "subscription_event_type": kind,
        "event_effective_at": at(on) if on else None,
        "previous_plan_amount_cents": before,
        "new_plan_amount_cents": after,
    }


EVENTS = [
    event("created", 1, "created", "2024-03-15", None, 1000),
    event("upgraded", 2, "created", "2023-01-05", None, 1000),
    event("upgraded", 3, "upgraded", "2024-04-20", 1000, 1500),
    event("downgraded", 4, "created", "2023-01-05", None, 1000),
    event("downgraded", 5, "downgraded", "2024-04-20", 1000, 400),
    event("canceled", 6, "created", "2023-01-05", None, 1000),
    event("canceled", 7, "canceled", "2024-05-20", 1000, 0),
    event("gone_before", 8, "created", "2022-01-05", None, 1000),
    event("gone_before", 9, "canceled", "2023-10-20", 1000, 0),
    event("same_month_return", 10, "created", "2023-01-05", None, 1000),
    event("same_month_return", 11, "canceled", "2024-06-03", 1000, 0),
    event("same_month_return", 12, "reactivated", "2024-06-20", 0, 1200),
    event("returned", 13, "created", "2023-01-05", None, 1000),
    event("returned", 14, "canceled", "2024-02-03", 1000, 0),
    event("returned", 15, "reactivated", "2024-05-20", 0, 700),
    event("returned_and_upgraded", 16, "created", "2023-01-05", None, 1000),
    event("returned_and_upgraded", 17, "canceled", "2024-02-03", 1000, 0),
    event("returned_and_upgraded", 18, "reactivated", "2024-05-10", 0, 700),
    event("returned_and_upgraded", 19, "upgraded", "2024-05-20", 700, 900),
    event("month_start", 20, "created", "2024-02-01", None, 1000),
    event("month_start", 21, "upgraded", "2024-04-01", 1000, 2000),
    event("tied", 22, "created", "2024-01-10", None, 500),
    event("tied", 23, "upgraded", "2024-01-10", 500, 800),
    event("cancel_after_downgrade", 24, "created", "2023-01-05", None, 1000),
    event("cancel_after_downgrade", 25, "downgraded", "2024-03-05", 1000, 400),
    event("cancel_after_downgrade", 26, "canceled", "2024-03-25", 400, 0),
    event("yearly", 27, "created", "2023-01-05", None, 10000),
    event("yearly_half", 28, "created", "2023-01-05", None, 6),
    event("yearly_refund", 29, "created", "2023-01-05", None, -6),
    event("weekly", 30, "created", "2024-02-05", None, 10000),
    event("unlisted", 31, "created", "2024-02-05", None, 10000),
    event("null_amount", 32, "created", "2024-02-05", None, None),
    event("unknown_type", 33, None, "2024-02-05", 100, 300),
    event("no_date", 34, "created", None, None, 1000),
    event("future", 35, "created", "2025-01-01", None, 1000),
    event("null_id_wins", 36, "created", "2024-02-05", None, 100),
    event("null_id_wins", None, "upgraded", "2024-02-05", 100, 250),
    event(None, 37, "created", "2024-02-05", None, 77),
]
INTERVALS = {"yearly": "year", "yearly_half": "year", "yearly_refund": "year", "weekly": "week", "unlisted": None}


@pytest.fixture(scope="module")
def state(spark):
    subs = {e["subscription_id"] for e in EVENTS} - {None}
    tables = staging(
        spark,
        subscription_events=EVENTS,
        subscriptions=[
            {"subscription_id": s, "plan_interval": INTERVALS.get(s, "month")} for s in subs if s != "unlisted"
        ],
    )
    return mrr.mrr_state(tables.subscription_events, tables.subscriptions, FIRST, 13).cache()


@pytest.fixture(scope="module")
def amounts(state):
    found = {}
    for (sub, month), row in by_key(state, "subscription_id", "mrr_month").items():
        found.setdefault(sub, {})[f"{month:%y-%m}"] = row["mrr_cents"]
    return found


@pytest.fixture(scope="module")
def moves(state):
    found = {}
    for (sub, month), row in by_key(
        mrr.mrr_movements(state, 2024).filter("subscription_id is not null"), "subscription_id", "mrr_month"
    ).items():
        found.setdefault(sub, {})[f"{month:%m}"] = (row["mrr_movement_driver"], row["net_mrr_change_cents"])
    return found


def months(first, last, cents):
    """{'yy-mm': cents} for the months first..last, counted from December 2023 as 0."""
    return {f"{(2023 * 12 + 11 + i) // 12 % 100}-{(11 + i) % 12 + 1:02d}": cents for i in range(first, last + 1)}


@pytest.mark.parametrize(
    "sub, expected",
    [
        ("created", months(3, 12, 1000)),
        ("upgraded", months(0, 3, 1000) | months(4, 12, 1500)),
        ("downgraded", months(0, 4, 1000) | months(5, 12, 400)),
        ("canceled", months(0, 5, 1000)),
        ("same_month_return", months(0, 5, 1000) | months(6, 12, 1200)),
        ("returned", months(0, 2, 1000) | months(5, 12, 700)),
        ("returned_and_upgraded", months(0, 2, 1000) | months(5, 12, 900)),
        ("month_start", months(2, 3, 1000) | months(4, 12, 2000)),
        ("tied", months(1, 12, 800)),
        ("cancel_after_downgrade", months(0, 2, 1000) | months(3, 3, 400)),
        ("yearly", months(0, 12, 833)),
        ("yearly_half", months(0, 12, 1)),
        ("yearly_refund", months(0, 12, -1)),
        ("weekly", months(2, 12, 0)),
        ("unlisted", months(2, 12, 0)),
        ("null_amount", months(2, 12, 0)),
        ("unknown_type", months(2, 2, 300)),
        ("null_id_wins", months(2, 12, 250)),
        (None, months(2, 12, 0)),
    ],
)
def test_state_by_subscription(amounts, sub, expected):
    assert amounts[sub] == expected


def test_subscriptions_without_any_live_month_have_no_rows(amounts):
    assert {"gone_before", "no_date", "future"}.isdisjoint(amounts)


def test_state_columns(state):
    assert state.columns == [
        "subscription_id",
        "subscription_event_id",
        "customer_id",
        "subscription_event_type",
        "prev_mrr_month",
        "mrr_month",
        "mrr_cutoff",
        "plan_interval",
        "mrr_cents",
    ]
    row = state.filter("subscription_id = 'created'").orderBy("mrr_month").first()
    assert (row.prev_mrr_month, row.mrr_month, row.mrr_cutoff) == (
        day("2024-02-01"),
        day("2024-03-01"),
        day("2024-04-01"),
    )


@pytest.mark.parametrize(
    "sub, month, expected",
    [
        ("created", "03", ("new", 1000)),
        ("created", "04", ("flat", 0)),
        ("upgraded", "04", ("expansion", 500)),
        ("downgraded", "04", ("flat", 0)),
        ("downgraded", "05", ("contraction", -600)),
        ("canceled", "05", ("flat", 0)),
        ("canceled", "06", ("churn", -1000)),
        ("same_month_return", "06", ("expansion", 200)),
        ("returned", "03", ("churn", -1000)),
        ("returned", "05", ("reactivation", 700)),
        ("returned_and_upgraded", "05", ("new", 900)),
        ("weekly", "02", ("no_mrr", 0)),
        ("unlisted", "02", ("no_mrr", 0)),
        ("unknown_type", "03", ("churn", -300)),
    ],
)
def test_movement_drivers(moves, sub, month, expected):
    assert moves[sub][month] == expected


def test_no_rows_after_churn(moves):
    assert max(moves["canceled"]) == "06"


def test_rows_without_a_subscription_never_match(spark):
    state = spark.createDataFrame(
        [(None, "c", "created", date(2024, m, 1), 100) for m in (1, 2)],
        "subscription_id string, customer_id string, subscription_event_type string, mrr_month date, mrr_cents bigint",
    )
    rows = sorted((r.mrr_month.month, r.prev_mrr_cents, r.mrr_cents) for r in mrr.month_pairs(state).collect())
    assert rows == [(1, 0, 100), (2, 0, 100), (2, 100, 0), (3, 100, 0)]


def test_repeated_subscription_months_are_refused(spark):
    state = spark.createDataFrame(
        [("s", "c", "created", date(2024, 1, 1), 100)] * 2,
        "subscription_id string, customer_id string, subscription_event_type string, mrr_month date, mrr_cents bigint",
    )
    with pytest.raises(Exception, match="more than one state row"):
        mrr.mrr_movement_drivers(state, 2024).collect()


STATE = "subscription_id string, customer_id string, mrr_month date, mrr_cents bigint"


def test_totals_count_repeated_subscriptions_and_customers_once(spark):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    rows = [("s", "c", jan, 100), ("s", "c", jan, 100), ("s", "d", jan, 5), ("t", "c", jan, 7), (None, "c", jan, 1), ("u", None, jan, 2), ("s", "c", feb, 3)]
    totals = by_key(mrr.mrr_totals(spark.createDataFrame(rows, STATE)), "mrr_month")
    assert {m: (r["customer_count"], r["subscription_count"], r["mrr_cents"]) for m, r in totals.items()} == {jan: (2, 3, 215), feb: (1, 1, 3)}


def test_totals_of_a_state_without_repeats_need_no_marks(spark):
    jan, feb = date(2024, 1, 1), date(2024, 2, 1)
    rows = [(f"s{k}", f"c{k % 7}", month, k) for k in range(40) for month in (jan, feb)]
    rows += [(None, "c1", jan, 1), (None, "c1", jan, 1), (None, None, feb, 9), ("alone", None, feb, 2)]
    state = spark.createDataFrame(rows, STATE)
    marked, counted = mrr.mrr_totals(state), mrr.mrr_totals(state, one_row_each=True)
    assert sorted(map(tuple, marked.collect())) == sorted(map(tuple, counted.collect())) and marked.schema == counted.schema
    assert mrr.mrr_totals(state.limit(0), one_row_each=True).count() == 0


def test_movements_add_up_to_the_change_in_total(state):
    totals = by_key(mrr.mrr_rate_of_change(state, 2024), "mrr_month")
    drivers = by_key(mrr.mrr_movement_drivers(state, 2024), "mrr_month")
    assert len(totals) == len(drivers) == 12
    for month, row in drivers.items():
        assert row["net_mrr_change_cents"] == totals[month]["net_mrr_change_cents"]


def test_rate_is_null_after_a_month_without_mrr(spark):
    state = spark.createDataFrame(
        [("s", "c", date(2023, 11 + i, 1), date(2023, 12, 1), date(2024, 1, 1), cents) for i, cents in enumerate([0])]
        + [("s", "c", date(2023, 12, 1), date(2024, 1, 1), date(2024, 2, 1), 50)]
        + [("s", "c", date(2024, 1, 1), date(2024, 2, 1), date(2024, 3, 1), 75)],
        "subscription_id string, customer_id string, prev_mrr_month date, mrr_month date, mrr_cutoff date, mrr_cents bigint",
    )
    found = by_key(mrr.mrr_rate_of_change(state, 2024), "mrr_month")
    assert set(found) == {date(2024, 1, 1), date(2024, 2, 1)}
    assert found[date(2024, 1, 1)]["mrr_change_rate"] is None
    assert found[date(2024, 1, 1)]["prev_mrr_cents"] == 0
    assert float(found[date(2024, 2, 1)]["mrr_change_rate"]) == 0.5


def test_hot_subscriptions_and_long_calendars_give_the_same(spark, monkeypatch):
    """Whichever subscriptions are reduced before the shuffle, NULL ones and ties included, and over 240 months."""
    import random

    draw = random.Random(8)
    rows = [
        event(draw.choice([None, "hot", "hot", "hot", *"abcdef"]), draw.choice([None, *range(40)]), "upgraded", f"20{draw.randrange(5, 25):02d}-{draw.randrange(1, 13):02d}-{draw.choice((3, 3, 17))}".replace("-3", "-03"), 1, draw.randrange(1000))
        for _ in range(400)
    ]
    events = staging(spark, subscription_events=rows).subscription_events.dropDuplicates(["subscription_id", "event_effective_at", "subscription_event_id"])
    first, n_months = date(2004, 12, 1), 240
    kept = [r.asDict() for r in events.collect()]

    def expected():
        latest = {}
        for r in kept:
            if r["event_effective_at"] < at("2024-12-01"):
                month = max(date(2004, 11, 1), r["event_effective_at"].date().replace(day=1))
                key = (r["subscription_id"], month)
                order = (r["event_effective_at"], r["subscription_event_id"] is None, r["subscription_event_id"] or "")
                latest[key] = max(latest.get(key, (order, r["new_plan_amount_cents"])), (order, r["new_plan_amount_cents"]))
        return {k: (v[1], min((m for s, m in latest if s == k[0] and m > k[1]), default=None)) for k, v in latest.items()}

    for share in (1 / 1000, 1 / 4, 1.0):
        monkeypatch.setattr(mrr, "HOT_SHARE", share)
        found = {(r.subscription_id, r.event_month): (r.new_plan_amount_cents, r.next_event_month) for r in mrr.closing_events(events, first, n_months).collect()}
        assert found == expected()
