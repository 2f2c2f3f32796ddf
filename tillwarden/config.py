"""Rule thresholds and the fixed lookup values of the payment domain."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RuleConfig:
    """Every threshold a rule compares with; the defaults are the standard rules."""

    high_amount: float = 5000.0
    critical_amount: float = 10000.0
    unknown_location: str = "Unknown Location"
    odd_hour_from: int = 2
    odd_hour_to: int = 5
    odd_hour_amount: float = 1000.0
    rapid_limit: int = 3
    rapid_window: str = "1 minute"
    unusual_factor: float = 5.0
    feature_high_amount: float = 1000.0
    night_from: int = 22
    night_to: int = 6


# Merchant names and the category each belongs to.
MERCHANT_CATEGORIES = {
    "Amazon": "retail",
    "Walmart": "retail",
    "Target": "retail",
    "Starbucks": "food",
    "McDonalds": "food",
    "Shell": "gas",
    "Exxon": "gas",
    "Home Depot": "retail",
    "Best Buy": "electronics",
    "Costco": "retail",
    "ATM_Withdrawal": "cash",
    "Online_Transfer": "transfer",
    "Gas_Station": "gas",
    "Grocery_Store": "grocery",
}
DEFAULT_CATEGORY = "other"

# Notification channels switched on for each alert severity.
SEVERITY_CHANNELS = {
    "CRITICAL": ("email", "sms", "slack"),
    "HIGH": ("email", "slack"),
    "MEDIUM": ("email",),
    "LOW": (),
}

# Alert types.
HIGH_AMOUNT = "HIGH_AMOUNT"
UNUSUAL_LOCATION = "UNUSUAL_LOCATION"
UNUSUAL_HOUR = "UNUSUAL_HOUR"
RAPID_TRANSACTIONS = "RAPID_TRANSACTIONS"
