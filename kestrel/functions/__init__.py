"""Column-level helpers shared by all operators."""

from kestrel.functions.core import (  # noqa: F401
    classify,
    composite_score,
    global_stats,
    money_sum,
    rank_unique,
    safe_div,
    zscore,
)
