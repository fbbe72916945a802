"""Ratios, flags, buckets and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Sums of money are narrowed before a division: the narrower the operands, the
# more fraction digits a decimal quotient keeps (12 and 14 here).
_SUM = "decimal(26,2)"


def safe_ratio_pct(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    ratio = part.cast(_SUM) / F.nullif(whole.cast(_SUM), F.lit(0).cast(_SUM))
    return (F.round(ratio, digits + 2) * 100).cast(f"decimal(26,{digits})")


def average(total: Column, rows: Column) -> Column:
    """Mean of money from a sum and a count; null without rows."""
    return total.cast(_SUM) / F.nullif(rows, F.lit(0)).cast("decimal(14,0)")


def risk_bucket(days_past_due: str | Column) -> Column:
    """Ladder of days past due. Bounds and labels are fixed values of the schema."""
    days = F.col(days_past_due) if isinstance(days_past_due, str) else days_past_due
    return (
        F.when(days <= 0, "CURRENT")
        .when(days <= 30, "1-30 DPD")
        .when(days <= 60, "31-60 DPD")
        .when(days <= 90, "61-90 DPD")
        .when(days > 90, "NPL")
    )


def customer_segment(*counts: Column) -> Column:
    """``3-Product`` for all three products, ``2-Product`` for two, else ``1-Product``."""
    used = sum((F.coalesce(c, F.lit(0)) > 0).cast("int") for c in counts)
    return F.when(used == 3, "3-Product").when(used == 2, "2-Product").otherwise("1-Product")


# Numeric codes of the transaction types known to the fraud model.
TXN_TYPE_CODES = {"PAYMENT": 0, "TRANSFER": 0, "WITHDRAWAL": 1, "TOP_UP": 2}
OTHER_TXN_TYPE = 0


def txn_type_code(txn_type: str | Column, ignore_case: bool = False) -> Column:
    """Code of a type, 0 for any other value. Scoring ignores case, training does not."""
    value = F.col(txn_type) if isinstance(txn_type, str) else txn_type
    if ignore_case:
        value = F.upper(value)
    codes = F.create_map(*[F.lit(x) for pair in TXN_TYPE_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, value), F.lit(OTHER_TXN_TYPE))


# Fixed values of the scoring rule that stands in while no model is saved.
RULE_LIMIT = 3000
RULE_HIGH = 0.8
RULE_LOW = 0.1
FRAUD_CUTOFF = 0.5


def rule_score(amount: str | Column) -> Column:
    amount = F.col(amount) if isinstance(amount, str) else amount
    return F.when(amount > RULE_LIMIT, F.lit(RULE_HIGH)).otherwise(F.lit(RULE_LOW))


def score_pct(score: str | Column) -> Column:
    score = F.col(score) if isinstance(score, str) else score
    return F.round(score * 100, 1)
