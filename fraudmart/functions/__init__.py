"""Scalar column helpers.  All are built-in Spark expressions (codegen, no UDF)."""

from fraudmart.functions.oracle import (
    change_time,
    check_max_length,
    empty_as_null,
    enforce_varchar,
    full_name,
    parse_amount,
    parse_oracle_timestamp,
)
from fraudmart.functions.stamps import as_ntz, current_second, ntz_literal, to_stamp_text

__all__ = [
    "as_ntz",
    "change_time",
    "check_max_length",
    "current_second",
    "empty_as_null",
    "enforce_varchar",
    "full_name",
    "ntz_literal",
    "parse_amount",
    "parse_oracle_timestamp",
    "to_stamp_text",
]
