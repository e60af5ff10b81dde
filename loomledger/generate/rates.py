"""Fixed values that shape generated data: markets, segments, pairs, dirt rates."""

# Fixed values: (country, currency).
MARKETS = [
    ("GB", "GBP"), ("DE", "EUR"), ("CH", "CHF"), ("NL", "EUR"), ("SE", "SEK"), ("NO", "NOK"), ("FI", "EUR"),
    ("DK", "DKK"), ("EE", "EUR"), ("ES", "EUR"), ("BE", "EUR"), ("LT", "EUR"), ("IE", "EUR"), ("AT", "EUR"),
    ("IS", "ISK"),
]
# Segment -> cumulative share, ARR range, limit range, drawdown range, growth range.
SEGMENTS = {
    "seed": (0.25, (200000, 1000000), (50000, 500000), (1, 3), (0.8, 1.5)),
    "growth": (0.80, (1000000, 20000000), (500000, 5000000), (3, 7), (1.5, 3.0)),
    "scale": (1.00, (20000000, 80000000), (5000000, 20000000), (5, 12), (0.4, 1.0)),
}
# Fixed value: the largest limit as a share of recurring revenue.
MAX_LIMIT_TO_ARR = 0.70

PLANS = ["Solo", "Team", "Studio", "Regional", "Global", "Tailored"]
PURPOSES = ["stock", "new_branch", "campaign", "payroll", None]

# Fixed values: (base, quote) -> mean rate.
FX_RATES = {
    ("EUR", "GBP"): 0.85, ("EUR", "USD"): 1.08, ("EUR", "CHF"): 0.94, ("EUR", "SEK"): 11.5, ("EUR", "NOK"): 11.8,
    ("EUR", "DKK"): 7.45, ("GBP", "EUR"): 1.18, ("GBP", "USD"): 1.27, ("CHF", "EUR"): 1.06, ("USD", "EUR"): 0.93,
    ("SEK", "EUR"): 0.087, ("NOK", "EUR"): 0.085, ("ISK", "EUR"): 0.0067, ("EUR", "ISK"): 149.0,
    ("EUR", "CAD"): 1.47, ("CAD", "EUR"): 0.68,
}
# Spread around the mean rate, and the smallest rate.
FX_DEVIATION = 0.02
FX_FLOOR = 0.001

# Dirt.
BAD_CURRENCIES = ["EURO", "usd", "Pounds", "euro", "SEKr", ""]
BAD_CURRENCY_RATE = 0.08
DIRTY_DATE_FORMATS = ["MM/dd/yyyy", "yyyy-MM-dd", "dd-MM-yyyy", "dd/MM/yyyy"]
IMPOSSIBLE_DATE_RATE, DIRTY_DATE_RATE, EPOCH_DATE_RATE, US_DATE_RATE = 0.01, 0.06, 0.03, 0.02
BAD_SCORES = [999, -50, 0, 1000]
RENAME_RATE = 0.30
TYPE_DRIFT_RATE = 0.15
COLLATERAL_RATE, REFERRAL_RATE, BIC_DROP_RATE = 0.25, 0.25, 0.20
DUPLICATE_RATE = 0.04
STALE_RATE, STALE_DAYS, STALE_JITTER = 0.05, 45, 14
ORPHAN_RATE = 0.02

# Spellings a payload key may arrive in.
KEY_VARIANTS = {
    "customer_id": ["customerId", "Customer_ID"],
    "subscription_id": ["subscriptionId", "SubscriptionID"],
    "invoice_id": ["invoiceId", "Invoice_ID"],
    "application_id": ["applicationId", "ApplicationID"],
    "facility_id": ["facilityId", "Facility_ID"],
    "drawdown_id": ["drawdownId", "Drawdown_ID"],
    "repayment_id": ["repaymentId", "Repayment_ID"],
    "transaction_id": ["transactionId", "Transaction_ID"],
    "snapshot_id": ["snapshotId", "Snapshot_ID"],
    "metric_id": ["metricId", "Metric_ID"],
    "mrr_amount": ["mrrAmount", "MRR_Amount"],
    "facility_limit": ["facilityLimit", "Facility_Limit"],
    "created_at": ["createdAt", "Created_At"],
    "company_name": ["companyName", "Company_Name"],
    "country_code": ["countryCode", "Country_Code"],
    "arr_reported": ["arrReported", "ARR_Reported"],
    "valuation": ["Valuation", "valuation_amt"],
}
