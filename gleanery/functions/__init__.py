from gleanery.functions.scores import category_score, composite_score
from gleanery.functions.uniform import hash52, uniform

__all__ = ["category_score", "composite_score", "hash52", "uniform"]
