"""Independent ANSI SQL for every catalog query, for DuckDB over the sample tables.

The SQL states each result by its definition (latest event before a cutoff by row number,
previous month by self-join, ratios in whole numbers) and not in the shape the Spark plans use.
"""

import re

from billscope.functions.months import later_month
from billscope.plans.periods import SAMPLE_1999, Periods

STAGING = """
priced AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, day(o_orderdate) AS dom FROM orders
),
invoices AS (
  SELECT o_orderkey AS invoice_id, o_custkey AS customer_id, cents AS paid_cents, o_orderdate AS created,
    o_orderstatus <> 'P' AS is_paid, o_orderpriority <> '5-LOW' AS auto_charged,
    CASE WHEN o_orderstatus = 'P' THEN 'open'
         WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN 'uncollectible'
         ELSE 'paid' END AS status
  FROM priced
),
flagged AS (
  SELECT *, o_orderstatus = 'F' AND dom BETWEEN 5 AND 14 AS disputed FROM priced
),
ledger AS (
  SELECT o_orderkey * 10 + 1 AS entry_id, o_orderkey AS invoice_id, o_custkey AS customer_id, 'charge' AS category,
    cents AS amount, cents - cents // 34 AS net, o_orderdate + INTERVAL 2 DAY AS available_on
  FROM flagged WHERE dom <> 13
  UNION ALL
  SELECT o_orderkey * 10 + 2, o_orderkey, o_custkey, 'charge', cents, cents - cents // 34, o_orderdate + INTERVAL 3 DAY
  FROM flagged WHERE dom = 21 AND o_orderpriority = '1-URGENT'
  UNION ALL
  SELECT o_orderkey * 10 + 3, o_orderkey, o_custkey, 'refund', -cents, -cents, o_orderdate + INTERVAL 35 DAY
  FROM flagged WHERE dom = 28
  UNION ALL
  SELECT o_orderkey * 10 + 3, o_orderkey, o_custkey, 'refund', -(cents // 5), -(cents // 5), o_orderdate + INTERVAL 35 DAY
  FROM flagged WHERE dom <= 10 AND o_orderpriority = '3-MEDIUM'
  UNION ALL
  SELECT o_orderkey * 10 + 4, o_orderkey, o_custkey, 'dispute', -cents, -cents - 1500, o_orderdate + INTERVAL 60 DAY
  FROM flagged WHERE disputed
  UNION ALL
  SELECT o_orderkey * 10 + 5, o_orderkey, o_custkey, 'dispute_reversal', cents, cents, o_orderdate + INTERVAL 90 DAY
  FROM flagged WHERE disputed AND dom BETWEEN 8 AND 11 AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  UNION ALL
  SELECT o_orderkey * 10 + 6, o_orderkey, o_custkey, 'fee', -(cents // 34), 0, o_orderdate + INTERVAL 2 DAY
  FROM flagged
),
disputes AS (
  SELECT o_orderkey AS dispute_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'fraudulent' WHEN '2-HIGH' THEN 'product_not_received'
      WHEN '3-MEDIUM' THEN 'subscription_canceled' WHEN '4-NOT SPECIFIED' THEN 'duplicate'
      ELSE 'general' END AS reason
  FROM flagged WHERE disputed AND dom <> 14
),
charges AS (
  SELECT l_orderkey * 100 + l_linenumber AS charge_id, l_orderkey AS invoice_id,
    CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_quantity >= 46 THEN NULL
         WHEN l_returnflag = 'A' THEN 'failed' ELSE 'succeeded' END AS status,
    NOT (l_returnflag = 'R' AND l_linestatus = 'O') AS captured
  FROM lineitem
),
plan_events AS MATERIALIZED (
  SELECT o_orderkey AS event_id, o_custkey AS customer_id, o_orderdate AS effective_at,
    o_custkey * 2 + CASE WHEN o_totalprice >= 250000 THEN 1 ELSE 0 END AS subscription_id,
    CASE WHEN dom = 30 AND o_orderstatus = 'P' THEN NULL
         WHEN o_orderpriority = '1-URGENT' THEN 'created' WHEN o_orderpriority = '2-HIGH' THEN 'upgraded'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'downgraded'
         WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'reactivated' ELSE 'canceled' END AS kind,
    CASE o_orderpriority WHEN '2-HIGH' THEN cents - cents // 5 WHEN '3-MEDIUM' THEN cents + cents // 5
         WHEN '5-LOW' THEN cents END AS amount_before,
    CASE WHEN o_orderpriority <> '5-LOW' THEN cents END AS amount_after
  FROM priced
),
plan_numbers AS (SELECT 0 AS number UNION ALL SELECT 1),
subscriptions AS (
  SELECT c_custkey * 2 + number AS subscription_id,
    CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'year'
         WHEN c_mktsegment IN ('MACHINERY', 'HOUSEHOLD') THEN 'month' ELSE 'week' END AS plan_interval
  FROM customer CROSS JOIN plan_numbers WHERE number = 0 OR c_acctbal >= 0
)"""


def half_up(numerator: str, denominator: str, scale: int) -> str:
    """numerator * scale / denominator as a whole number, halves away from zero; NULL for x/0."""
    n, d = f"CAST({numerator} AS HUGEINT)", f"nullif(CAST({denominator} AS HUGEINT), 0)"
    return f"(sign({n}) * ((2 * abs({n}) * {scale} + {d}) // (2 * {d})))"


def ratio(numerator: str, denominator: str, places: int, displayed: float | None = None) -> str:
    """A seven-place quotient rounded to `places`, as DOUBLE."""
    cut = 10 ** (7 - places)
    seven = half_up(numerator, denominator, 10**7)
    return f"CAST({half_up(seven, str(cut), 1)} AS DOUBLE) / {displayed or 10**places}"


def percentage(numerator: str, denominator: str) -> str:
    return ratio(numerator, denominator, 4, 100)


def layer(p: Periods) -> str:
    movement_rate = {
        "expansion_rate_pct": "expansion_mrr_cents",
        "contraction_rate_pct": "contraction_mrr_cents",
        "churn_rate_pct": "churn_mrr_cents",
        "grr_pct": "starting_mrr_cents - contraction_mrr_cents - churn_mrr_cents",
        "nrr_pct": "starting_mrr_cents - contraction_mrr_cents - churn_mrr_cents + expansion_mrr_cents",
    }
    rates = ", ".join(f"{percentage(n, 'starting_mrr_cents')} AS {name}" for name, n in movement_rate.items())
    losses = {"contraction": -1, "churn": -1}
    drivers = ", ".join(
        f"CAST({losses.get(d, 1)} * coalesce(sum(net_mrr_change_cents) FILTER (WHERE mrr_movement_driver = '{d}'), 0)"
        f" AS BIGINT) AS {d}_mrr_cents"
        for d in ("new", "reactivation", "expansion", "contraction", "churn")
    )
    return f"""
cohort AS (
  SELECT invoice_id, customer_id, paid_cents AS invoice_amount_paid_cents FROM invoices
  WHERE is_paid AND auto_charged AND created >= DATE '{p.invoices[0]}' AND created < DATE '{p.invoices[1]}'
),
money AS (
  SELECT invoice_id, sum(amount) AS balance,
    max(CAST(category = 'refund' AS INTEGER)) AS refund,
    sum(amount) FILTER (WHERE category LIKE 'dispute%') AS dispute_net,
    max(CAST(category = 'dispute' AS INTEGER)) AS raised,
    max(CAST(category = 'dispute_reversal' AS INTEGER)) AS reversal,
    count(*) FILTER (WHERE category = 'charge') AS charge_rows,
    min(CAST(available_on AS DATE)) FILTER (WHERE category = 'charge') AS first_date,
    max(CAST(available_on AS DATE)) FILTER (WHERE category = 'charge') AS last_date
  FROM ledger WHERE category <> 'fee' GROUP BY invoice_id
),
attempts AS (
  SELECT invoice_id,
    count(DISTINCT CASE WHEN status = 'succeeded' AND captured THEN charge_id END) AS n_captured,
    count(DISTINCT CASE WHEN status = 'succeeded' AND NOT captured THEN charge_id END) AS n_uncaptured,
    count(DISTINCT CASE WHEN status <> 'succeeded' THEN charge_id END) AS n_failed
  FROM charges WHERE status <> 'succeeded' OR (status = 'succeeded' AND captured IS NOT NULL) GROUP BY invoice_id
),
processor AS (
  SELECT c.invoice_id,
    CAST(coalesce(m.balance, 0) AS BIGINT) AS processor_balance_amount_cents,
    coalesce(a.n_captured, 0) AS processor_captured_charge_count,
    coalesce(a.n_uncaptured, 0) AS processor_uncaptured_charge_count,
    coalesce(a.n_failed, 0) AS processor_failed_charge_count,
    coalesce(m.refund, 0) AS has_refund_activity,
    CASE WHEN m.dispute_net < 0 THEN 1 ELSE 0 END AS has_dispute_activity,
    coalesce(m.raised, 0) AS has_dispute_raised,
    coalesce(m.reversal, 0) AS has_dispute_reversal,
    CASE WHEN a.n_captured > 0 AND coalesce(m.charge_rows, 0) = 0 THEN 1 ELSE 0 END AS has_charge_without_balance,
    CASE WHEN m.charge_rows > 0 AND coalesce(a.n_captured, 0) = 0 THEN 1 ELSE 0 END AS has_balance_without_charge,
    m.first_date AS first_charge_available_date,
    m.last_date AS last_charge_available_date
  FROM cohort c LEFT JOIN money m ON m.invoice_id = c.invoice_id LEFT JOIN attempts a ON a.invoice_id = c.invoice_id
  WHERE m.invoice_id IS NOT NULL OR a.invoice_id IS NOT NULL
),
side_by_side AS (
  SELECT c.*,
    coalesce(processor_balance_amount_cents, 0) AS processor_balance_amount_cents,
    coalesce(processor_captured_charge_count, 0) AS processor_captured_charge_count,
    coalesce(processor_uncaptured_charge_count, 0) AS processor_uncaptured_charge_count,
    coalesce(processor_failed_charge_count, 0) AS processor_failed_charge_count,
    coalesce(has_refund_activity, 0) AS has_refund_activity,
    coalesce(has_dispute_activity, 0) AS has_dispute_activity,
    coalesce(has_dispute_raised, 0) AS has_dispute_raised,
    coalesce(has_dispute_reversal, 0) AS has_dispute_reversal,
    coalesce(has_charge_without_balance, 0) AS has_charge_without_balance,
    coalesce(has_balance_without_charge, 0) AS has_balance_without_charge
  FROM cohort c LEFT JOIN processor USING (invoice_id)
),
gaps AS (
  SELECT invoice_id, customer_id, invoice_amount_paid_cents, processor_balance_amount_cents,
    invoice_amount_paid_cents - processor_balance_amount_cents AS recon_gap_cents,
    CAST(processor_captured_charge_count = 0 AS INTEGER) AS has_no_processor_charge,
    CAST(processor_captured_charge_count >= 2 AS INTEGER) AS has_multiple_processor_charges,
    processor_uncaptured_charge_count, processor_failed_charge_count,
    has_refund_activity AS has_refund, has_dispute_activity AS has_dispute,
    has_dispute_raised, has_dispute_reversal, has_charge_without_balance, has_balance_without_charge,
    CASE WHEN processor_balance_amount_cents = 0 THEN 'FULL'
         WHEN processor_balance_amount_cents BETWEEN 1 AND invoice_amount_paid_cents - 1 THEN 'PARTIAL'
         ELSE 'NONE' END AS balance_reduction_severity,
    CASE WHEN processor_balance_amount_cents > invoice_amount_paid_cents THEN 'PROCESSOR_HIGHER'
         ELSE 'BILLING_HIGHER' END AS gap_direction
  FROM side_by_side WHERE invoice_amount_paid_cents <> processor_balance_amount_cents
),
taken_back AS (
  SELECT invoice_id AS dispute_id, invoice_id, customer_id, available_on AS balance_available_on,
    net AS balance_net_cents
  FROM ledger WHERE category = 'dispute'
    AND available_on >= DATE '{p.chargebacks[0]}' AND available_on < DATE '{p.chargebacks[1]}'
),
lost AS (
  SELECT d.dispute_id, l.invoice_id, l.customer_id, i.created AS invoice_period_end,
    l.available_on AS balance_available_on, l.net AS balance_net_cents, d.reason AS dispute_reason
  FROM ledger l, disputes d, invoices i
  WHERE l.category = 'dispute' AND d.dispute_id = l.invoice_id AND i.invoice_id = l.invoice_id
    AND l.available_on >= DATE '{p.chargebacks[0]}' AND l.available_on < DATE '{p.chargebacks[1]}'
    AND i.created >= DATE '{p.closed[0]}' AND i.created < DATE '{p.closed[1]}'
),
restated AS (
  SELECT dispute_reason, count(DISTINCT invoice_id) AS invoice_count,
    CAST(abs(sum(balance_net_cents)) AS BIGINT) AS total_lost_net_cents
  FROM lost GROUP BY dispute_reason
),
closing AS (
  SELECT subscription_id, event_month, effective_at AS event_effective_at, event_id AS subscription_event_id,
    customer_id, kind AS subscription_event_type, amount_before AS previous_plan_amount_cents,
    amount_after AS new_plan_amount_cents,
    (SELECT CAST(min(date_trunc('month', later.effective_at)) AS DATE) FROM plan_events later
      WHERE later.subscription_id = b.subscription_id AND later.effective_at < DATE '{later_month(p.last_month, 1)}'
        AND later.effective_at >= event_month + INTERVAL 1 MONTH) AS next_event_month
  FROM (
    SELECT *, CAST(greatest(date_trunc('month', effective_at), DATE '{later_month(p.anchor_month, -1)}') AS DATE)
      AS event_month
    FROM plan_events WHERE effective_at < DATE '{later_month(p.last_month, 1)}'
  ) b
  QUALIFY row_number() OVER (PARTITION BY subscription_id, event_month
    ORDER BY effective_at DESC, event_id DESC NULLS FIRST) = 1
),
calendar AS (
  SELECT CAST(DATE '{p.anchor_month}' + to_months(CAST(i AS INTEGER)) AS DATE) AS month
  FROM range({p.n_months}) AS steps(i)
),
in_force AS (
  SELECT month, e.*,
    row_number() OVER (PARTITION BY month, subscription_id ORDER BY effective_at DESC, event_id DESC NULLS FIRST) AS recency
  FROM calendar JOIN plan_events e ON e.effective_at < month + INTERVAL 1 MONTH
),
state AS MATERIALIZED (
  SELECT subscription_id, event_id AS subscription_event_id, customer_id, kind AS subscription_event_type,
    CAST(month - INTERVAL 1 MONTH AS DATE) AS prev_mrr_month, month AS mrr_month,
    CAST(month + INTERVAL 1 MONTH AS DATE) AS mrr_cutoff, plan_interval,
    CASE plan_interval WHEN 'month' THEN amount WHEN 'year' THEN (amount + 6) // 12 ELSE 0 END AS mrr_cents
  FROM (
    SELECT *, coalesce(CASE WHEN kind IN ('canceled', 'downgraded') AND effective_at >= month
                            THEN amount_before ELSE amount_after END, 0) AS amount
    FROM in_force WHERE recency = 1 AND (effective_at >= month OR kind <> 'canceled')
  ) LEFT JOIN subscriptions USING (subscription_id)
),
totals AS (
  SELECT prev_mrr_month, mrr_month, mrr_cutoff, count(DISTINCT customer_id) AS customer_count,
    count(DISTINCT subscription_id) AS subscription_count, CAST(sum(mrr_cents) AS BIGINT) AS mrr_cents
  FROM state GROUP BY ALL
),
rate_of_change AS (
  SELECT prev_mrr_month, mrr_month, mrr_cutoff, prev_mrr_cents, mrr_cents,
    mrr_cents - prev_mrr_cents AS net_mrr_change_cents,
    CAST({half_up("mrr_cents - prev_mrr_cents", "prev_mrr_cents", 10**6)} AS DOUBLE) / 1000000 AS mrr_change_rate,
    customer_count, subscription_count
  FROM (SELECT *, (SELECT max_by(b.mrr_cents, b.mrr_month) FROM totals b WHERE b.mrr_month < t.mrr_month) AS prev_mrr_cents
        FROM totals t)
  WHERE year(mrr_month) = {p.year}
),
pairs AS (
  SELECT n.subscription_id, coalesce(n.customer_id, b.customer_id) AS customer_id,
    coalesce(n.subscription_event_type, b.subscription_event_type) AS subscription_event_type,
    n.mrr_month, coalesce(b.mrr_cents, 0) AS prev_mrr_cents, coalesce(n.mrr_cents, 0) AS mrr_cents
  FROM state n LEFT JOIN state b ON b.subscription_id = n.subscription_id AND b.mrr_cutoff = n.mrr_month
  UNION ALL
  SELECT subscription_id, customer_id, subscription_event_type, mrr_cutoff, coalesce(mrr_cents, 0), 0
  FROM state ANTI JOIN (SELECT subscription_id, mrr_month AS mrr_cutoff FROM state) USING (subscription_id, mrr_cutoff)
),
movements AS (
  SELECT subscription_id, customer_id, subscription_event_type, mrr_month, prev_mrr_cents, mrr_cents,
    mrr_cents - prev_mrr_cents AS net_mrr_change_cents,
    CASE WHEN mrr_cents < 0 OR prev_mrr_cents < 0 AND mrr_cents = 0 OR mrr_cents = 0 AND prev_mrr_cents = 0 THEN 'no_mrr'
         WHEN mrr_cents = 0 THEN 'churn'
         WHEN prev_mrr_cents = 0 THEN CASE subscription_event_type WHEN 'reactivated' THEN 'reactivation' ELSE 'new' END
         WHEN mrr_cents = prev_mrr_cents THEN 'flat'
         WHEN prev_mrr_cents > 0 AND mrr_cents > prev_mrr_cents THEN 'expansion'
         WHEN mrr_cents < prev_mrr_cents THEN 'contraction'
         ELSE 'no_mrr' END AS mrr_movement_driver
  FROM pairs WHERE year(mrr_month) = {p.year}
),
drivers AS (
  SELECT mrr_month, CAST(sum(net_mrr_change_cents) AS BIGINT) AS net_mrr_change_cents, {drivers}
  FROM movements GROUP BY mrr_month
),
exhausted AS (
  SELECT i.invoice_id, i.customer_id, i.created AS invoice_created, a.n_failed AS failed_count
  FROM invoices i JOIN attempts a USING (invoice_id) WHERE a.n_failed > 0 AND a.n_captured = 0
),
first_paid AS (
  SELECT customer_id, min(created) AS first_paid_invoice_date FROM invoices
  WHERE is_paid AND status = 'paid' GROUP BY customer_id
),
signup AS (
  SELECT *, CAST(date_trunc('month', first_paid_invoice_date) AS DATE) AS paid_signup_cohort_month
  FROM first_paid WHERE first_paid_invoice_date < DATE '{p.year_start}'
),
nrr_base AS (
  SELECT g.customer_id, g.paid_signup_cohort_month,
    (SELECT CAST(sum(mrr_cents) AS BIGINT) FROM state s
      WHERE s.customer_id = g.customer_id AND s.mrr_month = DATE '{p.anchor_month}') AS starting_mrr_cents,
    (SELECT CAST(sum(mrr_cents) AS BIGINT) FROM state s
      WHERE s.customer_id = g.customer_id AND s.mrr_month = DATE '{p.last_month}') AS ending_mrr_cents
  FROM signup g
),
base AS (SELECT * FROM nrr_base WHERE starting_mrr_cents > 0),
cohort_sums AS (
  SELECT paid_signup_cohort_month, count(*) AS customer_count,
    CAST(sum(starting_mrr_cents) AS BIGINT) AS starting_mrr_cents,
    CAST(coalesce(sum(ending_mrr_cents), 0) AS BIGINT) AS ending_mrr_cents
  FROM base GROUP BY paid_signup_cohort_month
),
nrr AS (
  SELECT *, {ratio("ending_mrr_cents", "starting_mrr_cents", 4)} AS nrr_pct FROM cohort_sums
),
nrr_ranked AS (
  SELECT n.*,
    (SELECT CAST(count(*) + 1 AS INTEGER) FROM nrr o WHERE o.nrr_pct > n.nrr_pct) AS nrr_rank_highest,
    (SELECT CAST(count(*) + 1 AS INTEGER) FROM nrr o WHERE o.nrr_pct < n.nrr_pct) AS nrr_rank_lowest
  FROM nrr n
),
customer_moves AS (
  SELECT *,
    CASE customer_movement_type WHEN 'expanded' THEN kept - starting_mrr_cents ELSE 0 END AS expansion_mrr_cents,
    CASE customer_movement_type WHEN 'contracted' THEN starting_mrr_cents - kept ELSE 0 END AS contraction_mrr_cents,
    CASE customer_movement_type WHEN 'churned' THEN starting_mrr_cents ELSE 0 END AS churn_mrr_cents,
    CASE WHEN kept = starting_mrr_cents THEN kept ELSE 0 END AS unchanged_mrr_cents,
    kept - starting_mrr_cents AS net_mrr_change_cents
  FROM (
    SELECT *, coalesce(ending_mrr_cents, 0) AS kept,
      CASE WHEN coalesce(ending_mrr_cents, 0) = 0 THEN 'churned' WHEN ending_mrr_cents > starting_mrr_cents THEN 'expanded'
           WHEN ending_mrr_cents > 0 AND ending_mrr_cents < starting_mrr_cents THEN 'contracted'
           ELSE 'unchanged' END AS customer_movement_type
    FROM base)
),
cohort_moves AS (
  SELECT *, {rates} FROM (
    SELECT paid_signup_cohort_month, count(*) AS customer_count,
      count(*) FILTER (WHERE customer_movement_type = 'expanded') AS expanded_customer_count,
      count(*) FILTER (WHERE customer_movement_type = 'contracted') AS contracted_customer_count,
      count(*) FILTER (WHERE customer_movement_type = 'churned') AS churned_customer_count,
      count(*) FILTER (WHERE customer_movement_type = 'unchanged') AS unchanged_customer_count,
      CAST(sum(starting_mrr_cents) AS BIGINT) AS starting_mrr_cents,
      CAST(sum(kept) AS BIGINT) AS ending_mrr_cents,
      CAST(sum(expansion_mrr_cents) AS BIGINT) AS expansion_mrr_cents,
      CAST(sum(contraction_mrr_cents) AS BIGINT) AS contraction_mrr_cents,
      CAST(sum(churn_mrr_cents) AS BIGINT) AS churn_mrr_cents,
      CAST(sum(unchanged_mrr_cents) AS BIGINT) AS unchanged_mrr_cents,
      CAST(sum(net_mrr_change_cents) AS BIGINT) AS net_mrr_change_cents
    FROM customer_moves GROUP BY paid_signup_cohort_month)
)"""


GRAINS = {
    "invoices": ("invoices", "invoice_id"),
    "balance_transactions": ("ledger", "entry_id"),
    "charges": ("charges", "charge_id"),
    "disputes": ("disputes", "dispute_id"),
    "subscription_events": ("plan_events", "event_id"),
    "subscriptions": ("subscriptions", "subscription_id"),
    "invoice_cohort": ("cohort", "invoice_id"),
    "processor_side": ("processor", "invoice_id"),
    "mrr_state": ("state", "subscription_id, mrr_month"),
    "paid_signup_cohort": ("signup", "customer_id"),
    "customer_nrr_base": ("base", "customer_id"),
}
STAGING_NAMES = {
    "balance_transactions": "balance_transaction_id",
    "subscription_events": "subscription_event_id",
}


def _grain_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, '{STAGING_NAMES.get(name, keys)}' AS grain,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count, count(*) AS key_count,
  count(*) FILTER (WHERE n > 1) AS repeated_key_count
FROM (SELECT count(*) AS n FROM {table} GROUP BY {keys})"""
        for name, (table, keys) in GRAINS.items()
    )


def _listing_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS table_name,
  concat_ws(', ', {", ".join(f"coalesce(CAST({k} AS VARCHAR), 'NULL')" for k in keys.split(", "))}) AS key, count(*) AS row_count
FROM {table} GROUP BY {keys} HAVING count(*) > 1"""
        for name, (table, keys) in GRAINS.items()
    )


def _peaks_sql() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{d}' AS driver,
  (SELECT mrr_month FROM drivers ORDER BY {d}_mrr_cents DESC, mrr_month LIMIT 1) AS peak_month,
  max({d}_mrr_cents) AS peak_cents, CAST(sum({d}_mrr_cents) AS BIGINT) AS total_cents FROM drivers"""
        for d in ("new", "reactivation", "expansion", "contraction", "churn")
    )


FINAL = {
    "invoice_cohort": "SELECT * FROM cohort",
    "ledger_movements": """SELECT invoice_id, category, amount AS amount_cents,
  CAST(available_on AS DATE) AS available_date FROM ledger WHERE category <> 'fee'""",
    "charge_outcomes": """SELECT invoice_id, charge_id,
  max(CAST(status = 'succeeded' AND captured AS INTEGER)) AS captured,
  max(CAST(status = 'succeeded' AND NOT captured AS INTEGER)) AS uncaptured,
  max(CAST(status <> 'succeeded' AS INTEGER)) AS failed
FROM charges WHERE status <> 'succeeded' OR (status = 'succeeded' AND captured IS NOT NULL) GROUP BY invoice_id, charge_id""",
    "processor_side": "SELECT * FROM processor",
    "billed_and_processed": "SELECT * FROM side_by_side",
    "invoice_recon": "SELECT * FROM gaps",
    "recon_summary": f"""SELECT has_refund, has_dispute, balance_reduction_severity, count(*) AS invoice_count,
  CAST(sum(recon_gap_cents) AS BIGINT) AS total_gap_cents,
  CAST({half_up("sum(recon_gap_cents)", "count(*)", 100)} AS DOUBLE) / 100 AS mean_gap_cents
FROM gaps GROUP BY has_refund, has_dispute, balance_reduction_severity""",
    "chargebacks": "SELECT * FROM taken_back",
    "old_invoice_chargebacks": "SELECT * FROM lost",
    "chargeback_restatement": "SELECT * FROM restated",
    "chargeback_share": f"""SELECT r.*, all_invoice_count, all_lost_net_cents,
  {percentage("total_lost_net_cents", "all_lost_net_cents")} AS lost_share_pct
FROM restated r, (SELECT CAST(sum(invoice_count) AS BIGINT) AS all_invoice_count,
  CAST(sum(total_lost_net_cents) AS BIGINT) AS all_lost_net_cents FROM restated)""",
    "closing_events": "SELECT * FROM closing",
    "mrr_state": "SELECT * FROM state",
    "mrr_state_refreshed": "SELECT * FROM state",
    "mrr_totals": "SELECT * FROM totals",
    "mrr_rate_of_change": "SELECT * FROM rate_of_change",
    "mrr_growth_summary": f"""SELECT f.mrr_month AS first_month, l.mrr_month AS last_month,
  f.mrr_cents AS first_mrr_cents, l.mrr_cents AS last_mrr_cents, l.mrr_cents - f.mrr_cents AS growth_cents,
  {ratio("l.mrr_cents - f.mrr_cents", "f.mrr_cents", 4)} AS growth_rate,
  b.mrr_month AS best_month, b.net_mrr_change_cents AS best_gain_cents,
  (SELECT count(*) FROM rate_of_change WHERE net_mrr_change_cents < 0) AS declining_months
FROM (SELECT * FROM rate_of_change ORDER BY mrr_month LIMIT 1) f,
  (SELECT * FROM rate_of_change ORDER BY mrr_month DESC LIMIT 1) l,
  (SELECT * FROM rate_of_change ORDER BY net_mrr_change_cents DESC NULLS LAST, mrr_month LIMIT 1) b""",
    "month_pairs": "SELECT * FROM pairs",
    "mrr_movements": "SELECT * FROM movements",
    "mrr_movement_drivers": "SELECT * FROM drivers",
    "mrr_driver_peaks": _peaks_sql(),
    "exhausted_invoices": "SELECT * FROM exhausted",
    "retry_exhausted_revenue_lost": """SELECT mrr_month, count(DISTINCT subscription_id) AS subscriptions_lost,
  CAST(sum(prev_mrr_cents) AS BIGINT) AS retry_exhausted_mrr_lost_cents
FROM movements m WHERE mrr_movement_driver = 'churn' AND EXISTS (
  SELECT 1 FROM exhausted x WHERE x.customer_id = m.customer_id
    AND date_trunc('month', x.invoice_created) + INTERVAL 1 MONTH = m.mrr_month)
GROUP BY mrr_month""",
    "first_paid_invoices": "SELECT * FROM first_paid",
    "paid_signup_cohort": "SELECT * FROM signup",
    "customer_nrr_base": "SELECT * FROM base",
    "cohort_nrr": "SELECT * FROM nrr_ranked",
    "nrr_extremes": f"""SELECT * FROM
  (SELECT CAST(sum(customer_count) AS BIGINT) AS customer_count,
    {ratio("sum(ending_mrr_cents)", "sum(starting_mrr_cents)", 4)} AS overall_nrr FROM nrr),
  (SELECT paid_signup_cohort_month AS strongest_cohort, nrr_pct AS strongest_nrr FROM nrr
    ORDER BY nrr_pct DESC, paid_signup_cohort_month LIMIT 1),
  (SELECT paid_signup_cohort_month AS weakest_cohort, nrr_pct AS weakest_nrr FROM nrr
    ORDER BY nrr_pct, paid_signup_cohort_month LIMIT 1)""",
    "nrr_above_below": """SELECT count(*) AS cohort_count, count(*) FILTER (WHERE nrr_pct < 1) AS below_count,
  count(*) FILTER (WHERE nrr_pct >= 1) AS at_or_above_count FROM nrr""",
    "nrr_by_cohort_year": f"""SELECT CAST(year(paid_signup_cohort_month) AS INTEGER) AS cohort_year,
  count(*) AS cohort_count,
  CAST({half_up("sum(CAST(round(nrr_pct * 10000) AS BIGINT))", "count(*)", 1)} AS DOUBLE) / 10000 AS mean_nrr
FROM nrr GROUP BY year(paid_signup_cohort_month)""",
    "customer_nrr_movement": "SELECT * EXCLUDE (kept) FROM customer_moves",
    "cohort_nrr_movement": "SELECT * FROM cohort_moves",
    "dominant_negative_driver": """SELECT CASE sign(churn_mrr_cents - contraction_mrr_cents)
    WHEN 1 THEN 'churn' WHEN -1 THEN 'contraction' ELSE 'even' END AS dominant_driver,
  count(*) AS cohort_count, CAST(sum(churn_mrr_cents) AS BIGINT) AS churn_mrr_cents,
  CAST(sum(contraction_mrr_cents) AS BIGINT) AS contraction_mrr_cents
FROM cohort_moves GROUP BY 1""",
    "grain_report": _grain_sql(),
    "grain_violations": _listing_sql(),
    "movement_identity_check": """SELECT count(*) AS months_checked,
  count(*) FILTER (WHERE d.net_mrr_change_cents IS DISTINCT FROM new_mrr_cents + reactivation_mrr_cents
    + expansion_mrr_cents - contraction_mrr_cents - churn_mrr_cents) AS split_violations,
  count(*) FILTER (WHERE d.net_mrr_change_cents IS DISTINCT FROM r.net_mrr_change_cents AND r.mrr_month IS NOT NULL
    AND r.net_mrr_change_cents IS NOT NULL OR r.mrr_month IS NULL) AS total_violations,
  count(*) FILTER (WHERE r.mrr_month IS NOT NULL AND r.net_mrr_change_cents IS NULL) AS months_without_predecessor
FROM drivers d FULL JOIN rate_of_change r USING (mrr_month)""",
    "nrr_identity_check": """SELECT count(*) AS cohorts_checked,
  count(*) FILTER (WHERE m.ending_mrr_cents IS DISTINCT FROM m.starting_mrr_cents + expansion_mrr_cents
    - contraction_mrr_cents - churn_mrr_cents) AS ending_violations,
  count(*) FILTER (WHERE m.customer_count IS DISTINCT FROM expanded_customer_count + contracted_customer_count
    + churned_customer_count + unchanged_customer_count) AS count_violations,
  count(*) FILTER (WHERE m.customer_count IS DISTINCT FROM n.customer_count
    OR m.starting_mrr_cents IS DISTINCT FROM n.starting_mrr_cents
    OR m.ending_mrr_cents IS DISTINCT FROM n.ending_mrr_cents
    OR round(m.nrr_pct * 100) IS DISTINCT FROM round(n.nrr_pct * 10000)) AS report_violations
FROM cohort_moves m FULL JOIN nrr n USING (paid_signup_cohort_month)""",
}


_CTE = re.compile(r"^(\w+) AS (?:MATERIALIZED )?\(", re.MULTILINE)


def _needed(parts: dict[str, str], text: str) -> list[str]:
    """The named parts that a text needs, in their order."""
    wanted: set[str] = set()
    texts = [text]
    while texts:
        names = set(re.findall(r"\w+", texts.pop())) & parts.keys() - wanted
        wanted |= names
        texts += [parts[name] for name in names]
    return [name for name in parts if name in wanted]


def _named(text: str) -> dict[str, str]:
    """Parts of a prelude by name; each starts a line."""
    starts = [*_CTE.finditer(text)]
    ends = [m.start() for m in starts[1:]] + [len(text)]
    return {m[1]: text[m.start() : end].strip().rstrip(",") for m, end in zip(starts, ends, strict=True)}


def query_sql(name: str, periods: Periods = SAMPLE_1999, staging: str = STAGING) -> str:
    """One query with the parts it needs; without staging it reads staging relations that are there."""
    parts = _named(f"{staging.strip()},{layer(periods)}" if staging else layer(periods))
    prelude = ",\n".join(parts[part] for part in _needed(parts, FINAL[name]))
    return f"WITH {prelude}\n{FINAL[name]}" if prelude else FINAL[name]


def oracle_sql(periods: Periods = SAMPLE_1999) -> dict[str, str]:
    return {name: query_sql(name, periods) for name in FINAL}
