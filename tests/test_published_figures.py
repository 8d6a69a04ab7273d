"""The reports reproduce published monthly and cohort figures from their published inputs."""

from datetime import date

import pytest

from billscope.functions.months import later_month
from billscope.operators import chargebacks, mrr, quality, reconciliation, reports, retention
from tests.fixtures import by_key

DECEMBER = date(2023, 12, 1)

# Total MRR in cents, December 2023 to December 2024.
TOTAL_MRR = [
    622346475, 644747492, 664409869, 688560117, 708195446, 729096926, 764009885,
    782101674, 795498050, 815936803, 832698030, 852402556, 871350396,
]
# Month-over-month rate, January to December 2024.
RATES = [
    0.035994, 0.030496, 0.036348, 0.028517, 0.029514, 0.047885,
    0.023680, 0.017129, 0.025693, 0.020542, 0.023663, 0.022229,
]
# Expansion and churn in cents, January to December 2024.
EXPANSION = [
    6448332, 5861665, 7623337, 7728335, 8229999, 20763328,
    8568335, 8434999, 9863329, 9645000, 13501669, 14166668,
]
CHURN = [
    3282200, 6553902, 6328816, 8832685, 9305232, 7857555,
    9859201, 15891665, 7355502, 8760584, 10663783, 9354672,
]
# The other drivers and the net change in cents, January to December 2024.
NEW = [
    21051550, 22862945, 24710093, 22086410, 22920043, 23947049,
    23859217, 22240708, 21505758, 18801811, 20709974, 18987508,
]
REACTIVATION = [0, 0, 1197300, 1266600, 1565000, 986800, 2155100, 2224000, 458500, 0, 0, 0]
CONTRACTION = [
    1816665, 2508331, 3051666, 2613331, 2508330, 2926663,
    6631662, 3611666, 4033332, 2925000, 3843334, 4851664,
]
NET_CHANGE = [
    22401017, 19662377, 24150248, 19635329, 20901480, 34912959,
    18091789, 13396376, 20438753, 16761227, 19704526, 18947840,
]
# Starting and ending MRR in cents of the cohorts January 2022 to December 2023.
COHORT_STARTING = [
    30465007, 31007853, 33889574, 30721238, 30098095, 27752509, 29805135, 25763426,
    24203074, 26124719, 24793922, 25482339, 23552905, 27476543, 26627396, 27458386,
    25569036, 25647860, 23273244, 20257808, 20577994, 21525474, 18418569, 21854369,
]
COHORT_ENDING = [
    29179090, 28391338, 42901507, 28522657, 28348071, 25146639, 26630419, 23552505,
    23778174, 25439254, 23301118, 24943643, 24292821, 27191243, 22716503, 27961890,
    25869741, 26567046, 24731396, 21484645, 22356840, 22155340, 20502256, 22894918,
]
# Expansion, contraction and churn in cents of the same cohorts.
COHORT_EXPANSION = [
    3180502, 2094484, 13412385, 2797733, 2771997, 1892198, 2649066, 2057366, 3014866, 3708251, 2387367, 2197502,
    3533947, 3739766, 3633588, 4016236, 4741435, 4889031, 4584618, 4133001, 4712380, 4115133, 4719635, 3891682,
]
COHORT_CONTRACTION = [
    1022667, 1139466, 701250, 1162898, 1076583, 1419500, 1031100, 1099652, 613132, 1112867, 1076483, 809898,
    1168231, 1571566, 4662781, 1628132, 1348230, 1446445, 1111466, 1181564, 1108334, 971767, 711648, 766733,
]
COHORT_CHURN = [
    3443752, 3571533, 3699202, 3833416, 3445438, 3078568, 4792682, 3168635, 2826634, 3280849, 2803688, 1926300,
    1625800, 2453500, 2881700, 1884600, 3092500, 2523400, 2015000, 1724600, 1825200, 2513500, 1924300, 2084400,
]
# NRR of the same cohorts.
COHORT_NRR = [
    0.9578, 0.9156, 1.2659, 0.9284, 0.9419, 0.9061, 0.8935, 0.9142, 0.9824, 0.9738, 0.9398, 0.9789,
    1.0314, 0.9896, 0.8531, 1.0183, 1.0118, 1.0358, 1.0627, 1.0606, 1.0864, 1.0293, 1.1131, 1.0476,
]
# Cohort -> expansion, contraction, churn, unchanged in cents; then the five rates in percent.
MOVEMENTS = {
    date(2022, 3, 1): ((13412385, 701250, 3699202, 20817002), (39.58, 2.07, 10.92, 87.02, 126.59)),
    date(2023, 3, 1): ((3633588, 4662781, 2881700, 14028162), (13.65, 17.51, 10.82, 71.67, 85.31)),
    date(2022, 7, 1): ((2649066, 1031100, 4792682, 21594618), (8.89, 3.46, 16.08, 80.46, 89.35)),
}


@pytest.fixture(scope="module")
def rates(spark):
    """One subscription per month carries that month's total."""
    rows = [
        ("s", "c", later_month(DECEMBER, i - 1), later_month(DECEMBER, i), later_month(DECEMBER, i + 1), cents)
        for i, cents in enumerate(TOTAL_MRR)
    ]
    state = spark.createDataFrame(
        rows,
        "subscription_id string, customer_id string, prev_mrr_month date, mrr_month date, mrr_cutoff date, mrr_cents bigint",
    )
    return mrr.mrr_rate_of_change(state, 2024).cache()


@pytest.fixture(scope="module")
def base(spark):
    """One customer per cohort carries the cohort's MRR."""
    rows = [
        (f"c{i}", later_month(date(2022, 1, 1), i), start, end)
        for i, (start, end) in enumerate(zip(COHORT_STARTING, COHORT_ENDING))
    ]
    return spark.createDataFrame(
        rows, "customer_id string, paid_signup_cohort_month date, starting_mrr_cents bigint, ending_mrr_cents bigint"
    )


@pytest.fixture(scope="module")
def nrr(base):
    return retention.cohort_nrr(base).cache()


def test_monthly_rates(rates):
    found = by_key(rates, "mrr_month")
    assert [float(found[later_month(DECEMBER, i + 1)]["mrr_change_rate"]) for i in range(12)] == RATES


def test_growth_summary(rates):
    row = reports.mrr_growth_summary(rates).first()
    assert (row.growth_cents, float(row.growth_rate)) == (226602904, 0.3515)
    assert (row.best_month, row.best_gain_cents, row.declining_months) == (date(2024, 6, 1), 34912959, 0)


@pytest.fixture(scope="module")
def drivers(spark):
    months = [later_month(DECEMBER, i + 1) for i in range(12)]
    rows = list(zip(months, NET_CHANGE, NEW, REACTIVATION, EXPANSION, CONTRACTION, CHURN, strict=True))
    names = ("net_mrr_change", "new_mrr", "reactivation_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr")
    return spark.createDataFrame(rows, "mrr_month date, " + ", ".join(f"{n}_cents bigint" for n in names))


def test_driver_peaks(drivers):
    found = by_key(reports.mrr_driver_peaks(drivers), "driver")
    assert (found["expansion"]["peak_month"], found["expansion"]["peak_cents"]) == (date(2024, 6, 1), 20763328)
    assert (found["churn"]["peak_month"], found["churn"]["peak_cents"]) == (date(2024, 8, 1), 15891665)
    totals = {d: r["total_cents"] for d, r in found.items()}
    assert totals == {
        "new": 263683066,
        "reactivation": 9853300,
        "expansion": 120834996,
        "contraction": 41321644,
        "churn": 104045797,
    }


def test_drivers_explain_every_month(rates, drivers):
    assert tuple(quality.movement_identity_check(rates, drivers).first()) == (12, 0, 0, 0)


def test_evidence_split(spark):
    """239 gaps: 199 explained by a refund, 40 by a lost dispute; sums and means as published."""
    groups = [(1, 0, "PARTIAL", 199, 1693390), (0, 1, "PARTIAL", 40, 3023840)]
    rows = [
        (refund, dispute, severity, total // n + (k < total % n))
        for refund, dispute, severity, n, total in groups
        for k in range(n)
    ]
    gaps = spark.createDataFrame(rows, "has_refund int, has_dispute int, balance_reduction_severity string, recon_gap_cents bigint")
    found = by_key(reconciliation.recon_summary(gaps), "has_refund")
    assert {k: (r["invoice_count"], r["total_gap_cents"], float(r["mean_gap_cents"])) for k, r in found.items()} == {
        1: (199, 1693390, 8509.5),
        0: (40, 3023840, 75596.0),
    }


def test_cohort_nrr_and_ranks(nrr):
    rows = nrr.orderBy("paid_signup_cohort_month").collect()
    assert [float(r.nrr_pct) for r in rows] == COHORT_NRR
    ranked = {r.nrr_rank_highest: r.paid_signup_cohort_month for r in rows}
    assert (ranked[1], ranked[2], ranked[24]) == (date(2022, 3, 1), date(2023, 11, 1), date(2023, 3, 1))
    assert all(r.nrr_rank_highest + r.nrr_rank_lowest == 25 for r in rows)


def test_nrr_headlines(nrr):
    row = reports.nrr_extremes(nrr).first()
    assert float(row.overall_nrr) == 0.9944
    assert (row.strongest_cohort, float(row.strongest_nrr)) == (date(2022, 3, 1), 1.2659)
    assert (row.weakest_cohort, float(row.weakest_nrr)) == (date(2023, 3, 1), 0.8531)
    split = reports.nrr_above_below(nrr).first()
    assert (split.below_count, split.at_or_above_count) == (13, 11)
    by_year = {y: float(r["mean_nrr"]) for y, r in by_key(reports.nrr_by_cohort_year(nrr), "cohort_year").items()}
    assert by_year == {2022: 0.9665, 2023: 1.0283}


def test_cohort_rates(spark):
    """Four customers per cohort: one grows from 1 cent, one shrinks to 1 cent, one leaves, one stays."""
    rows = []
    for cohort, ((expansion, contraction, churn, unchanged), _) in MOVEMENTS.items():
        start = dict(zip([later_month(date(2022, 1, 1), i) for i in range(24)], COHORT_STARTING))[cohort]
        grower = start - (contraction + 1) - churn - unchanged
        rows += [
            (f"{cohort}g", cohort, grower, grower + expansion),
            (f"{cohort}s", cohort, contraction + 1, 1),
            (f"{cohort}l", cohort, churn, None),
            (f"{cohort}h", cohort, unchanged, unchanged),
        ]
    base = spark.createDataFrame(
        rows, "customer_id string, paid_signup_cohort_month date, starting_mrr_cents bigint, ending_mrr_cents bigint"
    )
    movement = retention.cohort_nrr_movement(retention.customer_nrr_movement(base))
    found = by_key(movement, "paid_signup_cohort_month")
    names = ("expansion_rate_pct", "contraction_rate_pct", "churn_rate_pct", "grr_pct", "nrr_pct")
    assert {c: tuple(float(r[n]) for n in names) for c, r in found.items()} == {
        c: rates for c, (_, rates) in MOVEMENTS.items()
    }
    dominant = by_key(reports.dominant_negative_driver(movement), "dominant_driver")
    assert {d: r["cohort_count"] for d, r in dominant.items()} == {"churn": 2, "contraction": 1}


def test_cohort_movements_explain_every_cohort(spark, nrr):
    """All 24 cohorts, four customers each: the movements add up and agree with the NRR report."""
    rows = []
    cohorts = zip(COHORT_STARTING, COHORT_EXPANSION, COHORT_CONTRACTION, COHORT_CHURN, strict=True)
    for i, (start, expansion, contraction, churn) in enumerate(cohorts):
        month, rest = later_month(date(2022, 1, 1), i), start - contraction - 1 - churn
        rows += [
            (f"{i}g", month, 1, 1 + expansion),
            (f"{i}s", month, contraction + 1, 1),
            (f"{i}l", month, churn, None),
            (f"{i}h", month, rest - 1, rest - 1),
        ]
    base = spark.createDataFrame(
        rows, "customer_id string, paid_signup_cohort_month date, starting_mrr_cents bigint, ending_mrr_cents bigint"
    )
    movement = retention.cohort_nrr_movement(retention.customer_nrr_movement(base))
    report = retention.cohort_nrr(base)
    assert tuple(quality.nrr_identity_check(report, movement).first()) == (24, 0, 0, 0)
    found = movement.orderBy("paid_signup_cohort_month").collect()
    assert [r.ending_mrr_cents for r in found] == COHORT_ENDING
    assert [round(float(r.nrr_pct) / 100, 4) for r in found] == COHORT_NRR
    dominant = by_key(reports.dominant_negative_driver(movement), "dominant_driver")
    assert {d: r["cohort_count"] for d, r in dominant.items()} == {"churn": 23, "contraction": 1}


def test_chargeback_share(spark):
    # Reason, invoices and lost cents of the June 2024 chargebacks.
    restated = spark.createDataFrame(
        [("subscription_canceled", 4, 104145), ("product_not_received", 3, 50240), ("fraudulent", 1, 19440)],
        "dispute_reason string, invoice_count bigint, total_lost_net_cents bigint",
    )
    found = by_key(chargebacks.chargeback_share(restated), "dispute_reason")
    assert float(found["subscription_canceled"]["lost_share_pct"]) == 59.91
    assert (found["fraudulent"]["all_lost_net_cents"], found["fraudulent"]["all_invoice_count"]) == (173825, 8)
