from lettera.functions.expressions import (
    code_of,
    guarded_percent_change,
    labelled_bucket,
    murmur_bucket,
    normalized_id,
    normalized_state,
    percent,
    portable_bucket,
    to_double,
    to_int,
    weighted_rate,
)

__all__ = [
    "code_of", "guarded_percent_change", "labelled_bucket", "murmur_bucket",
    "normalized_id", "normalized_state", "percent", "portable_bucket", "to_double",
    "to_int", "weighted_rate",
]
