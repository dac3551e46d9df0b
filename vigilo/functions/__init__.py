"""Column-level building blocks (pure ``Column -> Column`` helpers)."""

from vigilo.functions.numeric import rint_round, clip, safe_ratio
from vigilo.functions.tiers import (
    risk_tier,
    fee_tier,
    overall_status,
    attendance_band,
    risk_band,
    prob_band,
    decode_status,
)
from vigilo.functions.encoders import (
    encode_ordinal,
    INCOME_CODES,
    default_target,
    is_low_income,
    has_many_siblings,
    was_late_or_worse,
    days_x_outstanding,
)
from vigilo.functions.text import initials, contains_literal, name_from_id, class_from_id
from vigilo.functions.hashing import unit_hash, hash_bits

__all__ = [
    "rint_round", "clip", "safe_ratio",
    "risk_tier", "fee_tier", "overall_status", "attendance_band", "risk_band", "prob_band",
    "decode_status", "encode_ordinal", "INCOME_CODES", "default_target", "is_low_income",
    "has_many_siblings", "was_late_or_worse", "days_x_outstanding", "initials",
    "contains_literal", "name_from_id", "class_from_id", "unit_hash", "hash_bits",
]
