"""Calendar fields and classification labels.

Every rule set is an ordered table: the first row that holds gives the label, and a null input reaches the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: labels and limits of the reports -----------------------------------------------------------------

PRICE_BELOW = ((5, "Budget"), (15, "Standard"), (50, "Premium"))
PRICE_DEFAULT = "Luxury"

YEARS_FROM = ((10, "Senior"), (5, "Mid-level"))
YEARS_DEFAULT = "Junior"

PURCHASES_FROM = ((50, "High Value"), (20, "Medium Value"))
PURCHASES_DEFAULT = "Low Value"

IDLE_DAYS_UP_TO = ((30, "Active"), (90, "At Risk"))
IDLE_DAYS_DEFAULT = "Dormant"

QUINTILE_TIERS = ((1, "Most Valuable"), (2, "High Value"), (3, "Mid Value"), (4, "Low Value"))
QUINTILE_DEFAULT = "Emerging"

REVENUE_FROM = ((100000, "Top Performer"), (50000, "Strong Performer"), (10000, "Average Performer"))
REVENUE_DEFAULT = "Development Needed"

RANK_UP_TO = ((1, "High Priority"), (3, "Medium Priority"))
RANK_DEFAULT = "Low Priority"

WEEKDAYS = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")

SEASONS = (((12, 1, 2), "Q1"), ((3, 4, 5), "Q2"), ((6, 7, 8), "Q3"))
SEASON_DEFAULT = "Q4"

PRICE_LADDER = ("Budget", "Standard", "Premium", "Luxury")

# label, recency, frequency and monetary score (lowest, highest)
ANY = (1, 5)
MART_SEGMENTS = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (4, 5), (3, 5), ANY),
    ("New Customers", (5, 5), (1, 2), ANY),
    ("Potential Loyalists", (3, 4), ANY, (4, 5)),
    ("At Risk High Value", (1, 2), (4, 5), (4, 5)),
    ("Hibernating", (1, 2), (1, 2), ANY),
)
MODEL_SEGMENTS = tuple(row for row in MART_SEGMENTS if row[0] != "Potential Loyalists")
SEGMENT_DEFAULT = "Needs Attention"

MARKETING_ACTIONS = (
    ("Win-back premium offers", (1, 2), ANY, (4, 5)),
    ("VIP retention and loyalty rewards", (4, 5), (4, 5), ANY),
    ("Welcome and first-repeat incentives", (5, 5), (1, 2), ANY),
    ("Bundle and cross-sell campaigns", ANY, (4, 5), (2, 3)),
)
MARKETING_DEFAULT = "General nurture campaigns"

SEGMENT_NUMBERS = (
    ("Champions", 5),
    ("Loyal Customers", 4),
    ("New Customers", 3),
    ("Needs Attention", 2),
    ("At Risk High Value", 1),
)
SEGMENT_NUMBER_DEFAULT = 0

# ---------------------------------------------------------------------------------------------------------------------


def first_match(rules: Sequence[tuple[Column, object]], default: object) -> Column:
    chain = F
    for condition, value in rules:
        chain = chain.when(condition, F.lit(value))
    return chain.otherwise(F.lit(default))


def price_category(price: Column) -> Column:
    return first_match([(price < limit, label) for limit, label in PRICE_BELOW], PRICE_DEFAULT)


def experience_level(years: Column) -> Column:
    return first_match([(years >= limit, label) for limit, label in YEARS_FROM], YEARS_DEFAULT)


def value_segment(purchases: Column) -> Column:
    return first_match([(purchases >= limit, label) for limit, label in PURCHASES_FROM], PURCHASES_DEFAULT)


def engagement_status(idle_days: Column) -> Column:
    return first_match([(idle_days <= limit, label) for limit, label in IDLE_DAYS_UP_TO], IDLE_DAYS_DEFAULT)


def value_tier(quintile: Column) -> Column:
    return first_match([(quintile == n, label) for n, label in QUINTILE_TIERS], QUINTILE_DEFAULT)


def performance_tier(revenue: Column) -> Column:
    return first_match([(revenue >= limit, label) for limit, label in REVENUE_FROM], REVENUE_DEFAULT)


def recommendation_priority(rank: Column) -> Column:
    return first_match([(rank <= limit, label) for limit, label in RANK_UP_TO], RANK_DEFAULT)


def day_name(day_of_week: Column) -> Column:
    """1 is Sunday; anything outside 1..7 has no name."""
    return first_match([(day_of_week == n, name) for n, name in enumerate(WEEKDAYS, start=1)], None)


def season(month: Column) -> Column:
    """Seasonal quarter: December belongs to the first one."""
    return first_match([(month.isin(*months), label) for months, label in SEASONS], SEASON_DEFAULT)


def recommendation_type(category: Column, other_category: Column, klass: Column, other_class: Column) -> Column:
    return first_match(
        [(category == other_category, "Same Category"), (klass == other_class, "Same Class")], "Cross Category"
    )


def price_movement(tier: Column, other_tier: Column) -> Column:
    """A missing tier counts as a downsell."""
    upsell = [
        ((tier == step) & other_tier.isin(*PRICE_LADDER[at + 1 :]), "Upsell")
        for at, step in enumerate(PRICE_LADDER[:-1])
    ]
    return first_match([(tier == other_tier, "Same Price Tier"), *upsell], "Downsell")


def _score_rules(table, recency: Column, frequency: Column, monetary: Column) -> list[tuple[Column, str]]:
    rules = []
    for label, *ranges in table:
        condition = F.lit(True)
        for score, allowed in zip((recency, frequency, monetary), ranges):
            if allowed != ANY:
                condition = condition & score.between(*allowed)
        rules.append((condition, label))
    return rules


def mart_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    return first_match(_score_rules(MART_SEGMENTS, recency, frequency, monetary), SEGMENT_DEFAULT)


def model_segment(recency: Column, frequency: Column, monetary: Column) -> Column:
    """Six labels: this set has no 'Potential Loyalists'."""
    return first_match(_score_rules(MODEL_SEGMENTS, recency, frequency, monetary), SEGMENT_DEFAULT)


def marketing_action(recency: Column, frequency: Column, monetary: Column) -> Column:
    return first_match(_score_rules(MARKETING_ACTIONS, recency, frequency, monetary), MARKETING_DEFAULT)


def segment_number(label: Column) -> Column:
    return first_match([(label == name, n) for name, n in SEGMENT_NUMBERS], SEGMENT_NUMBER_DEFAULT)


def score_text(*scores: Column) -> Column:
    return F.concat(*[s.cast("string") for s in scores])


def year_month(year: Column, month: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
