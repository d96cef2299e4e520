from gleanery.operators.gather import gather_by_key, gather_ordered, gather_rows, order_source
from gleanery.operators.lookup import attach_scores, compute_scores, latest_scores
from gleanery.operators.ranking import global_position
from gleanery.operators.selection import MODES, Selection, select_rows, select_sample, select_threshold
from gleanery.operators.sketches import approximate_distribution, merged_sketches, score_sketches
from gleanery.operators.stats import (
    Profile, check_match_rate, match_rate, profile, score_distribution, selection_summary, weight_totals,
)

__all__ = [
    "MODES", "Profile", "Selection", "approximate_distribution", "attach_scores", "check_match_rate", "compute_scores",
    "gather_by_key", "gather_ordered", "gather_rows", "global_position", "latest_scores", "match_rate", "merged_sketches",
    "order_source", "profile", "score_distribution", "score_sketches", "select_rows", "select_sample",
    "select_threshold", "selection_summary", "weight_totals",
]
