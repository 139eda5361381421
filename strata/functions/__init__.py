"""Column-expression helpers. All return ``Column`` objects built from
``pyspark.sql.functions`` so they stay JVM-side inside whole-stage codegen."""

from strata.functions.exprs import (
    TS_TEXT_PATTERN,
    band_key,
    blank_to_null,
    classify_prefix,
    first_failing_rule,
    half_up_ratio,
    in_window,
    row_digest,
    row_text,
    surrogate_key,
    ts_text,
    utc_date,
)

__all__ = [
    "TS_TEXT_PATTERN", "band_key", "blank_to_null", "classify_prefix",
    "first_failing_rule", "half_up_ratio", "in_window", "row_digest", "row_text",
    "surrogate_key", "ts_text", "utc_date",
]
