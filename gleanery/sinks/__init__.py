from gleanery.sinks.card import provenance, render_card
from gleanery.sinks.shards import pending, publish, rows_per_shard, write_shards

__all__ = ["pending", "provenance", "publish", "render_card", "rows_per_shard", "write_shards"]
