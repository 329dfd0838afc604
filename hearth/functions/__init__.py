"""Column-expression helpers."""

from hearth.functions.columns import (
    bin_label,
    cap_upper,
    currency,
    half_even,
    isclose,
    nan_to_null,
    normalise_nan,
    numeric_columns,
    require_columns,
    safe_ratio,
)

__all__ = [
    "bin_label",
    "cap_upper",
    "currency",
    "half_even",
    "isclose",
    "nan_to_null",
    "normalise_nan",
    "numeric_columns",
    "require_columns",
    "safe_ratio",
]
