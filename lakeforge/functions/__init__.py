"""Column-expression helpers (all built-in Spark expressions, codegen-friendly)."""

from lakeforge.functions.casts import to_int, to_long, to_double, to_date_lenient, flag
from lakeforge.functions.text import pct_from_text, list_length, title_case
from lakeforge.functions.rounding import round_half_up, exact_avg, exact_scaled, exact_sum, exact_units, stable_avg, pct_of, growth_pct
from lakeforge.functions.sketches import merge_sketches, quantile_sketch, rank_error, sketch_quantile, sketch_rank, sketch_rows
from lakeforge.functions.labels import bucketize, price_tier, host_tier, amenity_bucket
from lakeforge.functions.dates import month_start, month_start_text, days_between

__all__ = [
    "to_int", "to_long", "to_double", "to_date_lenient", "flag",
    "pct_from_text", "list_length", "title_case",
    "round_half_up", "exact_avg", "exact_scaled", "exact_sum", "exact_units", "stable_avg", "pct_of", "growth_pct",
    "merge_sketches", "quantile_sketch", "rank_error", "sketch_quantile", "sketch_rank", "sketch_rows",
    "bucketize", "price_tier", "host_tier", "amenity_bucket",
    "month_start", "month_start_text", "days_between",
]
