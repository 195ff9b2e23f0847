"""Risk tiers of a churn probability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper (inclusive) bound of each tier, in rising order.
TIER_BOUNDS = (
    ("Low", 0.3),
    ("Medium", 0.6),
    ("High", 0.8),
    ("Critical", 1.0),
)
TIERS = tuple(name for name, _ in TIER_BOUNDS)
AT_RISK_TIERS = ("High", "Critical")


def risk_tier(probability: Column) -> Column:
    """Right-closed bins over [0, 1]; anything outside (or null) has no tier."""
    tier = F.when(probability < 0, None)
    for name, bound in TIER_BOUNDS:
        tier = tier.when(probability <= bound, name)
    return tier


def is_at_risk(tier: Column) -> Column:
    return tier.isin(*AT_RISK_TIERS)
