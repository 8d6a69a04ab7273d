"""Words that appear in billing data and in the reports."""

# Invoice collection and status words.
CHARGE_AUTOMATICALLY = "charge_automatically"
INVOICE_PAID = "paid"

# Reporting categories of the processor ledger that move invoice money.
CHARGE = "charge"
REFUND = "refund"
DISPUTE = "dispute"
DISPUTE_REVERSAL = "dispute_reversal"
LEDGER_CATEGORIES = (CHARGE, REFUND, DISPUTE, DISPUTE_REVERSAL)

# Charge attempt status of an approved charge.
SUCCEEDED = "succeeded"

# Subscription event types that the operators tell apart.
DOWNGRADED = "downgraded"
CANCELED = "canceled"
REACTIVATED = "reactivated"

# Plan intervals that carry MRR.
MONTHLY = "month"
YEARLY = "year"

# Labels written by the reports.
FULL, PARTIAL, NONE = "FULL", "PARTIAL", "NONE"
BILLING_HIGHER, PROCESSOR_HIGHER, MATCHED = "BILLING_HIGHER", "PROCESSOR_HIGHER", "MATCHED"
DRIVERS = ("new", "reactivation", "expansion", "contraction", "churn")
FLAT, NO_MRR = "flat", "no_mrr"
EXPANDED, CONTRACTED, CHURNED, UNCHANGED = "expanded", "contracted", "churned", "unchanged"
