"""Column-expression helpers (JVM-side, codegen friendly; no Python UDFs)."""

from featspark.functions.expr import (  # noqa: F401
    all_pair_ratios, bucket, contagious_max, contagious_min, contagious_sum,
    null_count, ratio, replace_inf, safe_sqrt, sentinel_to_null,
)
from featspark.functions.names import sanitize_names  # noqa: F401
