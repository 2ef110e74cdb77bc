from trilayer.functions.cleansing import (
    bucket,
    fixed_length,
    guarded_pct,
    money,
    null_if_nonpositive,
    null_outside,
    one_of,
    proper_case,
)

__all__ = [
    "bucket", "fixed_length", "guarded_pct", "money", "null_if_nonpositive",
    "null_outside", "one_of", "proper_case",
]
