"""Column-level functions: NULL/division/rounding rules, seeded draws, distribution tails."""

from strataframe.functions.columns import (  # noqa: F401
    agg_mean, agg_sd, agg_sum, any_null, norm_ppf, normal, pair_corr, remove_first, rnd,
    safe_corr, safe_div, slope_moments, strict, text_or_na, uniform,
)
