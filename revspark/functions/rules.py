"""Business rules as Column -> Column functions (SCA-*).

Thresholds and vocabularies are parameters whose defaults are the modelled
project's values; they are fixed values and are listed together below.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from revspark.functions.numeric import as_amount, as_rate, round_half_up

# Vocabularies, thresholds and labels of the modelled project.
PRODUCT_SPELLING_FIX = {"GTXPro": "GTX Pro"}
WON_STAGE = "Won"
LOST_STAGE = "Lost"
HIGH_PRIORITY = "High"
POSITIVE_OUTCOME = "positive"
ACCOUNT_TIERS = [(500000000, "Enterprise"), (100000000, "Mid-Market")]
ACCOUNT_TIER_DEFAULT = "SMB"
MARGIN_TIERS = [(40, "High Margin"), (25, "Medium Margin")]
MARGIN_TIER_DEFAULT = "Low Margin"
PERFORMANCE_TIERS = [(120, "Star Performer"), (100, "On Target"), (80, "Needs Improvement")]
PERFORMANCE_TIER_UNDER = "Underperforming"
PERFORMANCE_TIER_NONE = "No Quota"
NPS_CATEGORIES = [(9, "promoter"), (7, "passive")]
NPS_CATEGORY_DEFAULT = "detractor"
HEALTH_NPS_DEFAULT, HEALTH_CSAT_DEFAULT = 50, 50
HEALTH_NPS_WEIGHT, HEALTH_CSAT_WEIGHT = 0.4, 0.3
HEALTH_NPS_SCALE, HEALTH_CSAT_SCALE = 10, 20
HEALTH_HIGH_TICKET_PENALTY, HEALTH_BUYER_BONUS = 5, 15
CHURN_NPS_DEFAULT, CHURN_CSAT_DEFAULT = 5, 3
CHURN_HIGH_NPS_MAX, CHURN_HIGH_TICKETS_MIN = 3, 2
CHURN_MEDIUM_NPS_MAX, CHURN_MEDIUM_CSAT_BELOW = 5, 3


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tiered(value: Column | str, tiers: list[tuple[float, str]], default: str) -> Column:
    """First tier whose lower bound ``value >=``; NULL falls to ``default``."""
    v = _c(value)
    out = None
    for bound, label in tiers:
        out = F.when(v >= bound, F.lit(label)) if out is None else out.when(v >= bound, F.lit(label))
    return out.otherwise(F.lit(default))


# SCA-01
def standardize_product(product: Column | str, fixes: dict[str, str] = PRODUCT_SPELLING_FIX) -> Column:
    p = _c(product)
    out = None
    for bad, good in fixes.items():
        out = F.when(p == bad, F.lit(good)) if out is None else out.when(p == bad, F.lit(good))
    return out.otherwise(p) if out is not None else p


# SCA-02
def net_profit(stage: Column | str, value: Column | str, cogs: Column | str, shipping: Column | str,
               support: Column | str, commission: Column | str, won: str = WON_STAGE) -> Column:
    """Won deals only: value - cogs - shipping - support - value * commission, to cents.

    Operands are fixed-point so the result is the exact half-away rounding of
    the exact difference; any NULL operand gives NULL, non-won stages NULL.
    """
    v = as_amount(value)
    amount = v - as_amount(cogs) - as_amount(shipping) - as_amount(support) - v * as_rate(commission)
    return F.when(_c(stage) == won, F.round(amount, 2).cast("double"))


# SCA-03
def days_between(end: Column | str, start: Column | str) -> Column:
    return F.datediff(_c(end), _c(start)).cast("bigint")


# SCA-04
def stage_flag(stage: Column | str, value: str) -> Column:
    """Equality flag where a NULL stage is false, not NULL."""
    return F.coalesce(_c(stage) == value, F.lit(False))


# SCA-05
def month_key(d: Column | str) -> Column:
    return F.date_format(_c(d), "yyyy-MM")


# SCA-08
def quota_attainment(revenue: Column | str, quota: Column | str) -> Column:
    q = _c(quota)
    return F.when(q > 0, round_half_up(F.coalesce(_c(revenue), F.lit(0.0)) / q * 100, 1))


# SCA-10
def health_score(avg_nps: Column | str, avg_csat: Column | str, high_tickets: Column | str,
                 deals_won: Column | str) -> Column:
    raw = (F.coalesce(_c(avg_nps) * HEALTH_NPS_SCALE, F.lit(HEALTH_NPS_DEFAULT)) * HEALTH_NPS_WEIGHT
           + F.coalesce(_c(avg_csat) * HEALTH_CSAT_SCALE, F.lit(HEALTH_CSAT_DEFAULT)) * HEALTH_CSAT_WEIGHT
           - F.coalesce(_c(high_tickets) * HEALTH_HIGH_TICKET_PENALTY, F.lit(0))
           + F.when(_c(deals_won) > 0, F.lit(HEALTH_BUYER_BONUS)).otherwise(F.lit(0)))
    return round_half_up(raw, 1)


# SCA-11
def churn_risk(avg_nps: Column | str, high_tickets: Column | str, avg_csat: Column | str) -> Column:
    nps = F.coalesce(_c(avg_nps), F.lit(CHURN_NPS_DEFAULT))
    high = F.coalesce(_c(high_tickets), F.lit(0))
    csat = F.coalesce(_c(avg_csat), F.lit(CHURN_CSAT_DEFAULT))
    return (F.when((nps <= CHURN_HIGH_NPS_MAX) & (high >= CHURN_HIGH_TICKETS_MIN), F.lit("High"))
             .when((nps <= CHURN_MEDIUM_NPS_MAX) | (csat < CHURN_MEDIUM_CSAT_BELOW), F.lit("Medium"))
             .otherwise(F.lit("Low")))


# SCA-12
def account_tier(revenue: Column | str, tiers: list[tuple[float, str]] = ACCOUNT_TIERS,
                 default: str = ACCOUNT_TIER_DEFAULT) -> Column:
    return tiered(revenue, tiers, default)


# SCA-13
def margin_tier(margin_pct: Column | str, tiers: list[tuple[float, str]] = MARGIN_TIERS,
                default: str = MARGIN_TIER_DEFAULT) -> Column:
    return tiered(margin_pct, tiers, default)


# SCA-14
def performance_tier(attainment: Column | str,
                     tiers: list[tuple[float, str]] = PERFORMANCE_TIERS) -> Column:
    a = _c(attainment)
    out = None
    for bound, label in tiers:
        out = F.when(a >= bound, F.lit(label)) if out is None else out.when(a >= bound, F.lit(label))
    return out.when(a.isNotNull(), F.lit(PERFORMANCE_TIER_UNDER)).otherwise(F.lit(PERFORMANCE_TIER_NONE))


# SCA-15
def nps_category(score: Column | str) -> Column:
    return tiered(score, NPS_CATEGORIES, NPS_CATEGORY_DEFAULT)


# SCA-17
def quota_id(agent: Column | str, month: Column | str) -> Column:
    """'Q-' + upper(first 3 chars of agent) + '-' + month; NULL if either is NULL."""
    return F.concat(F.lit("Q-"), F.upper(F.substring(_c(agent), 1, 3)), F.lit("-"), _c(month))


# SCA-18
def padded_id(prefix: str, n: Column | str, width: int) -> Column:
    return F.format_string(f"{prefix}%0{width}d", _c(n))
