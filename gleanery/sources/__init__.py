from gleanery.sources.annotations import scan_annotations
from gleanery.sources.dataset import read_dataset
from gleanery.sources.positions import with_source_pos

__all__ = ["read_dataset", "scan_annotations", "with_source_pos"]
