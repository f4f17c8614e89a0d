"""Column expressions (JVM-side, whole-stage-codegen friendly)."""

from tidemark.functions.columns import (  # noqa: F401
    hash_uniform, lenient_double, to_int, smoothed_ratio, count_equal,
    dict_map, clip, round_score, decide, status_band, safe_ratio,
    gaussian_from_uniforms,
)
