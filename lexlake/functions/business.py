"""Domain rules shared by staging, reports and enrichment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexlake.functions.text import col

# Filing form -> document category.
FORM_CATEGORIES = {
    "10-K": "ANNUAL_REPORT",
    "10-K/A": "ANNUAL_REPORT",
    "10-Q": "QUARTERLY_REPORT",
    "10-Q/A": "QUARTERLY_REPORT",
    "8-K": "MATERIAL_EVENT",
    "8-K/A": "MATERIAL_EVENT",
    "DEF 14A": "PROXY",
    "S-1": "REGISTRATION",
    "S-1/A": "REGISTRATION",
    "S-3": "REGISTRATION",
    "S-4": "REGISTRATION",
    "20-F": "FOREIGN_ANNUAL",
    "6-K": "FOREIGN_INTERIM",
    "424B": "PROSPECTUS",
    "SC 13D": "OWNERSHIP_DISCLOSURE",
    "SC 13G": "OWNERSHIP_DISCLOSURE",
    "4": "INSIDER_TRANSACTION",
    "3": "INSIDER_TRANSACTION",
    "5": "INSIDER_TRANSACTION",
    "N-CSR": "FUND_REPORT",
    "13F-HR": "FUND_HOLDINGS",
}
OTHER_FORM = "OTHER_FILING"

# Upper bounds (exclusive) of the risk tiers.
RISK_TIERS = ((25, "LOW"), (50, "MODERATE"), (75, "HIGH"))
TOP_TIER = "CRITICAL"
NO_SCORE_TIER = "UNKNOWN"

# Types that count as revenue movements.
REVENUE_TYPES = ("INVOICE", "PAYMENT", "REFUND")

MONEY = "decimal(18,2)"


def risk_tier(score: Column | str) -> Column:
    score = col(score)
    tier = F.when(score.isNull(), F.lit(NO_SCORE_TIER))
    for bound, name in RISK_TIERS:
        tier = tier.when(score < bound, F.lit(name))
    return tier.otherwise(F.lit(TOP_TIER))


def source_origin(external_id: Column | str, registry: str = "GLEIF", seed: str = "SEED", other: str = "OTHER") -> Column:
    key = col(external_id)
    return (
        F.when(key.startswith("LEI-"), F.lit(registry))
        .when(key.startswith("CP-"), F.lit(seed))
        .otherwise(F.lit(other))
    )


def form_category(form: Column | str) -> Column:
    pairs = F.create_map(*[F.lit(x) for pair in FORM_CATEGORIES.items() for x in pair])
    return F.coalesce(F.try_element_at(pairs, col(form)), F.lit(OTHER_FORM))


def month_start(day: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(col(day), "month")


def month_label(day: Column | str) -> Column:
    return F.date_format(col(day), "yyyy_MM")


def money(c: Column | str) -> Column:
    return col(c).cast(MONEY)


def mean_money(total: Column, n: Column) -> Column:
    """Average from a sum and a count, half away from zero.

    ``avg`` would round twice. The quotient here has 12 digits after the point, so
    for fewer than 10^10 rows in a group it cannot be mistaken for a tie it is not.
    """
    return F.try_divide(total.cast("decimal(28,2)"), n.cast("decimal(20,0)")).cast(MONEY)
