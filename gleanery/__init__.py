"""Score-based data curation as Spark plans."""

from gleanery.labels import (
    ALL_PROPERTIES, CATEGORICAL_LABELS, FREE_TEXT_LABELS, NORM_SCORE_MAPS, ORDINAL_LABELS,
    SCORE_MAPS, label_dimension,
)
from gleanery.plans.curate import Curated, curate
from gleanery.plans.positions import gather_positions
from gleanery.rules import DEFAULT_SCORING_CONFIG, ColumnScoring, ScoringConfig

__all__ = [
    "ALL_PROPERTIES", "CATEGORICAL_LABELS", "ColumnScoring", "Curated", "DEFAULT_SCORING_CONFIG",
    "FREE_TEXT_LABELS", "NORM_SCORE_MAPS", "ORDINAL_LABELS", "SCORE_MAPS", "ScoringConfig",
    "curate", "gather_positions", "label_dimension",
]
