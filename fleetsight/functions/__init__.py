"""Column-expression helpers shared by the operators (all built-in, JVM-side)."""

from fleetsight.functions.columns import (
    count_true,
    hash_bucket,
    round_doubles,
    safe_ratio,
    week_start_sunday,
    zscore,
)

__all__ = ["count_true", "hash_bucket", "round_doubles", "safe_ratio", "week_start_sunday", "zscore"]
