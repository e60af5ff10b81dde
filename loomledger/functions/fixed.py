"""Code lists, rates and ranges that results depend on."""

# Currencies kept by the currency cleanser.
CURRENCIES = ["GBP", "EUR", "CHF", "SEK", "NOK", "DKK", "ISK", "USD", "CAD"]

# Country codes kept by the country allow-list.
COUNTRIES = [
    "GB", "US", "CA", "CH", "SE", "NO", "DK", "IS", "DE", "FR", "IT", "ES",
    "NL", "BE", "AT", "PT", "IE", "FI", "LU", "EE", "LV", "LT", "SI", "SK",
    "MT", "CY", "GR", "HR", "PL", "CZ", "HU", "RO", "BG", "LI",
]

# Inclusive credit score range.
CREDIT_SCORE_MIN = 300
CREDIT_SCORE_MAX = 850

# Status-like enumerations per entity.
SUBSCRIPTION_STATUSES = ["active", "cancelled", "paused"]
INVOICE_STATUSES = ["paid", "open", "void", "uncollectible"]
APPLICATION_STATUSES = ["approved", "rejected", "pending", "cancelled"]
FACILITY_STATUSES = ["active", "closed", "suspended"]
DRAWDOWN_STATUSES = ["completed", "pending", "failed"]
REPAYMENT_STATUSES = ["paid", "scheduled", "overdue", "forgiven"]
ACCOUNT_TYPES = ["operating", "reserve", "fx"]
RATE_TYPES = ["spot", "forward"]
RISK_RATINGS = ["low", "medium", "high"]

# A rate above this is read as quoted the other way round.
INVERSE_RATE_ABOVE = 10

# ARR look-back in days and months per year.
ARR_LOOKBACK_DAYS = 30
MONTHS_PER_YEAR = 12

# Repayment lateness ladder (upper bound in days, label).
LATENESS_LADDER = [(0, "on time / early"), (7, "1-7 days late"), (30, "8-30 days late")]
LATENESS_REST = "30+ days late"

# A source older than this many hours is stale.
FRESHNESS_HOURS = 24

# Tolerated gap between reported and computed ARR, in percent.
ARR_VARIANCE_LIMIT_PCT = 10
