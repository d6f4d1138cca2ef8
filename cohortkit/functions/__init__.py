"""Column-expression helpers: rule tables, bands, flags and month arithmetic."""

from cohortkit.functions.dates import in_month, month_key_from_text, month_key_of, tenure_years
from cohortkit.functions.rules import (
    any_flag,
    any_null,
    band,
    classify,
    first_reason,
    least_in,
    lower_equals_flag,
    present_flag,
    typed_null,
    yn,
)

__all__ = [
    "any_flag", "any_null", "band", "classify", "first_reason", "in_month", "least_in",
    "lower_equals_flag", "month_key_from_text", "month_key_of", "present_flag",
    "tenure_years", "typed_null", "yn",
]
