"""DataFrame operators: cleaning, selection, joins, scales."""

from isoloir.operators.cleaning import conform, drop_incomplete
from isoloir.operators.enrich import attach_by_key
from isoloir.operators.quantiles import (
    approximate_thresholds,
    order_statistics,
    quantile_thresholds,
)
from isoloir.operators.scales import LayerScales, apply_scales, extent, fit_scales, size_domain
from isoloir.operators.selection import (
    where_any_pair,
    where_equals,
    where_member,
    where_prefix,
    where_without_prefixes,
)

__all__ = [
    "LayerScales",
    "apply_scales",
    "approximate_thresholds",
    "attach_by_key",
    "conform",
    "drop_incomplete",
    "extent",
    "fit_scales",
    "order_statistics",
    "quantile_thresholds",
    "size_domain",
    "where_any_pair",
    "where_equals",
    "where_member",
    "where_prefix",
    "where_without_prefixes",
]
