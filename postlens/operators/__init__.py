"""Operators: functions from DataFrame to DataFrame."""

from .adhoc import adhoc_sql
from .optimality import certificate, gradient
from .classifier import feature_importance, importance_classes, top_terms, train
from .clean import cache_posts, clean_posts, dated, of_label
from .indexed_search import search_count_indexed, search_indexed
from .language import lexicon_ratio, lexicon_ratios, with_lexicon, with_lexicons
from .rollup import (
    read_rollup,
    rollup_daily_posts,
    rollup_hourly_profile,
    rollup_label_summary,
    rollup_length_quartiles,
    rollup_overview,
    update_rollup,
)
from .sampling import sample_features
from .search import keyword_search, search_count
from .stats import (
    box_summary,
    label_counts,
    label_length_stats,
    label_summary,
    length_box,
    overview,
    top_users,
    with_box,
    with_share,
)
from .temporal import (
    available_months,
    available_years,
    daily_posts,
    hour_density,
    hour_density_smooth,
    hourly_profile,
    period_slice,
    period_totals,
    year_over_year,
)
from .terms import term_stats, topic_tokens, training_tokens, vocabulary
from .topics import topic_titles, topics

__all__ = [
    "adhoc_sql",
    "available_months",
    "available_years",
    "box_summary",
    "cache_posts",
    "certificate",
    "clean_posts",
    "daily_posts",
    "dated",
    "feature_importance",
    "gradient",
    "hour_density",
    "hour_density_smooth",
    "hourly_profile",
    "importance_classes",
    "keyword_search",
    "label_counts",
    "label_length_stats",
    "label_summary",
    "length_box",
    "lexicon_ratio",
    "lexicon_ratios",
    "of_label",
    "overview",
    "period_slice",
    "period_totals",
    "read_rollup",
    "rollup_daily_posts",
    "rollup_hourly_profile",
    "rollup_label_summary",
    "rollup_length_quartiles",
    "rollup_overview",
    "sample_features",
    "search_count",
    "search_count_indexed",
    "search_indexed",
    "term_stats",
    "top_terms",
    "top_users",
    "topic_titles",
    "topic_tokens",
    "topics",
    "train",
    "training_tokens",
    "update_rollup",
    "vocabulary",
    "with_box",
    "with_lexicon",
    "with_lexicons",
    "with_share",
    "year_over_year",
]
