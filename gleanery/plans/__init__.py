from gleanery.plans.curate import Curated, curate
from gleanery.plans.positions import gather_positions

__all__ = ["Curated", "curate", "gather_positions"]
