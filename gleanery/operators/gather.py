"""Row gather: from chosen positions to source rows, in output order.

Output order is data. It is cut into contiguous runs ("shards") of equal length, and
every source row is sent once to each shard that needs it, and meets the list of its
places there; repeats are expanded after the exchange, inside the shard's task. So a
row drawn a billion times crosses the network once per shard, and every task ends up
with the same number of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanery.operators.ranking import starts_frame
from gleanery.operators.selection import Selection
from gleanery.runtime import BROADCAST_BYTES, BUCKET_ROWS

SLOT_BYTES = 128
RANGE_BYTES = 96
BITMAP_ROWS = 32_768  # bits in one of Spark's bitmaps
PLACE_BYTES = 3  # of a position's place in its block's list of shards
SALTS = 64
# Names that the gather adds on the way; a dataset cannot have them.
RESERVED = {
    "source_pos", "out_pos", "_score", "_shard", "_places", "_salt", "_block", "_low", "_high", "_bits", "_list", "_starts", "_shards",
}


def gather_rows(source: DataFrame, selection: DataFrame) -> DataFrame:
    """Source rows at the selected positions, repeats included, in no order. The
    selection must not concentrate on few positions (see :func:`gather_ordered`)."""
    return source.join(selection, "source_pos")


def check_positions(selection: DataFrame, source_rows: int) -> None:
    """For selections that come from a caller: every position must exist."""
    ends = selection.agg(F.min("source_pos").alias("low"), F.max("source_pos").alias("high")).first()
    if ends["low"] is not None and (ends["low"] < 0 or ends["high"] >= source_rows):
        raise IndexError(
            f"Position out of range: {ends['low']}..{ends['high']}, source rows: {source_rows}"
        )


def source_order(selection: DataFrame, may_repeat: bool = True, block_rows: int = BUCKET_ROWS) -> tuple[DataFrame, int]:
    """Output places in source order as ``(source_pos, _score, first, copies)``, and
    the total. Blocks of consecutive positions hold at most ``block_rows`` rows each once
    repeats are counted, which happens map-side."""
    copies = (
        selection.groupBy("source_pos").agg(F.first("score").alias("_score"), F.count(F.lit(1)).alias("copies"))
        if may_repeat
        else selection.select("source_pos", F.col("score").alias("_score"), F.lit(1).cast("bigint").alias("copies"))
    )
    block = F.expr(f"source_pos div {block_rows}")
    counts = [
        (row["block"], row["rows"])
        for row in copies.groupBy(block.alias("block")).agg(F.sum("copies").alias("rows")).orderBy("block").collect()
    ]
    total = sum(rows for _, rows in counts)
    earlier = Window.partitionBy("_block").orderBy("source_pos").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("copies").over(earlier), F.lit(0).cast("bigint"))
    placed = copies.withColumn("_block", block).withColumn("first", ahead)
    if len(counts) > 1:
        starts = starts_frame(selection.sparkSession, counts, "_block")
        placed = placed.join(starts, "_block").withColumn("first", F.col("first") + F.col("_start"))
    return placed.select("source_pos", "_score", "first", "copies"), total


def order_source(selection: DataFrame, may_repeat: bool = True) -> DataFrame:
    """``(source_pos, out_pos)``: one row per output row, in source order."""
    placed, _ = source_order(selection, may_repeat)
    places = F.sequence("first", F.col("first") + F.col("copies") - 1)
    return placed.select("source_pos", F.explode(places).alias("out_pos"))


def _source_slots(placed: DataFrame, per_shard: int, may_repeat: bool) -> DataFrame:
    """``(source_pos, _score, _shard, _places)``: a row's place, or the first and last
    of its places in the shard where rows may repeat."""
    if not may_repeat:
        shard = F.expr(f"cast(first div {per_shard} as int)").alias("_shard")
        return placed.select("source_pos", "_score", shard, F.col("first").alias("_places"))
    last = F.col("first") + F.col("copies") - 1
    shards = F.expr(f"sequence(first div {per_shard}, (first + copies - 1) div {per_shard})")
    start = F.col("_shard") * per_shard
    within = F.struct(
        F.greatest("first", start).alias("first"), F.least(last, start + (per_shard - 1)).alias("last")
    )
    return placed.select("source_pos", "_score", "first", "copies", F.explode(shards).alias("_shard")).select(
        "source_pos", "_score", F.col("_shard").cast("int").alias("_shard"), within.alias("_places")
    )


def _draw_slots(selection: DataFrame, per_shard: int, may_repeat: bool) -> DataFrame:
    """As :func:`_source_slots`, with all places listed where rows may repeat."""
    sharded = selection.select(
        "source_pos", F.col("score").alias("_score"),
        F.expr(f"cast(draw_pos div {per_shard} as int)").alias("_shard"), F.col("draw_pos").alias("_places"),
    )
    if not may_repeat:
        return sharded
    # A group is one row's places in one shard: never more than the shard's length.
    return sharded.groupBy("source_pos", "_shard").agg(
        F.first("_score").alias("_score"), F.sort_array(F.collect_list("_places")).alias("_places")
    )


def _join_salted(source: DataFrame, slots: DataFrame, hot: Sequence[int]) -> DataFrame:
    """Join on position; the shards of a hot position are dealt to SALTS tasks, each
    with its own copy of the one source row."""
    if not hot:
        return source.join(slots, "source_pos")
    is_hot = F.col("source_pos").isin(list(hot))
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salt = F.when(is_hot, F.col("_shard") % SALTS).otherwise(F.lit(0))
    return (
        source.select("*", F.explode(copies).alias("_salt"))
        .join(slots.withColumn("_salt", salt), ["source_pos", "_salt"])
        .drop("_salt")
    )


def _bitmap_blocks(positions: DataFrame, *by: str) -> DataFrame:
    """``(_block, *by, _low, _high, _bits)``: which positions of each block of
    BITMAP_ROWS occur, one bit each. Rows are brought together by block first, so
    that no task holds a bitmap per block."""
    placed = positions.withColumn("_block", _bitmap_block()).repartition("_block")
    return placed.groupBy("_block", *by).agg(
        F.min("source_pos").alias("_low"), F.max("source_pos").alias("_high"),
        F.bitmap_construct_agg(_bit()).alias("_bits"),
    )


def _bitmap_block() -> Column:
    return F.expr(f"source_pos div {BITMAP_ROWS}")


def _bit() -> Column:
    return F.expr(f"source_pos % {BITMAP_ROWS}")


def _is_marked() -> Column:
    octet = F.substring(F.col("_bits"), F.expr(f"cast(source_pos % {BITMAP_ROWS} div 8 + 1 as int)"), F.lit(1))
    return F.getbit(F.conv(F.hex(octet), 16, 10).cast("int"), F.expr("cast(source_pos % 8 as int)")) == 1


def _near(source: DataFrame, positions: DataFrame, blocks: int, budget: int, *by: str) -> DataFrame | None:
    """Source rows that are selected, exactly, if a bitmap of the selection fits the
    budget; else those between the first and last selected row of a block, if these
    bounds fit; else None. Adds the ``by`` columns."""
    marked = _bitmap_blocks(positions, *by)
    inside = (F.col("source_pos") >= F.col("_low")) & (F.col("source_pos") <= F.col("_high"))
    if blocks * (BITMAP_ROWS // 8 + RANGE_BYTES) <= budget:
        inside = inside & _is_marked()
    elif blocks * RANGE_BYTES <= budget:
        marked = marked.drop("_bits")
    else:
        return None
    return (
        source.withColumn("_block", _bitmap_block())
        .join(F.broadcast(marked), "_block").where(inside)
        .select(*source.columns, *by)
    )


def rows_at(source: DataFrame, positions: DataFrame, at: str = "source_pos", budget: int = BROADCAST_BYTES) -> DataFrame:
    """Source rows whose ``at``, a bigint from 0, is among ``positions`` (its only column,
    repeats allowed). The rows are not shuffled while a bitmap of the positions fits the
    budget: BITMAP_ROWS / 8 bytes for each block of BITMAP_ROWS that holds one."""
    source, chosen = source.withColumnRenamed(at, "source_pos"), positions.toDF("source_pos")
    blocks = chosen.select(_bitmap_block()).distinct().count()
    near = _near(source, chosen.distinct(), blocks, budget)  # so that no block has more rows than bits
    found = source if near is None else near
    if blocks * (BITMAP_ROWS // 8 + RANGE_BYTES) > budget:
        found = found.join(chosen, "source_pos", "left_semi")
    return found.select(*source.columns).withColumnRenamed("source_pos", at)


def shard_directory(slots: DataFrame, width: int) -> DataFrame:
    """``(_block, _starts, _shards)``: the shards of all selected positions of a block,
    ``width`` bytes each, in order of position, and where each position's list starts
    (it ends where the next one's does). Both are binary strings, so a lookup is a
    substring, and a position outside the selection has an empty list."""
    at = F.expr(f"cast(source_pos % {BITMAP_ROWS} as int)").alias("at")
    placed = slots.select(F.expr(f"source_pos div {BITMAP_ROWS}").alias("_block"), F.struct(at, "_shard").alias("_list"))
    listed = placed.repartition("_block").groupBy("_block").agg(F.sort_array(F.collect_list("_list")).alias("_list"))

    def digits(number: Column, size: int) -> Column:
        return F.lpad(F.hex(number), 2 * size, "0")

    # entry j opens the list of its position and of the empty ones before it
    before = lambda j: F.coalesce(F.get("_list", j - 1)["at"], F.lit(-1))
    opened = F.transform("_list", lambda x, j: F.repeat(digits(j, PLACE_BYTES), x["at"] - before(j)))
    entries = F.size("_list")
    rest = F.repeat(digits(entries, PLACE_BYTES), F.lit(BITMAP_ROWS) - F.get("_list", entries - 1)["at"])
    return listed.select(
        "_block", F.unhex(F.concat(F.array_join(opened, ""), rest)).alias("_starts"),
        F.unhex(F.array_join(F.transform("_list", lambda x: digits(x["_shard"], width)), "")).alias("_shards"),
    )


def _dealt(source: DataFrame, slots: DataFrame, blocks: int, shards: int, rows: int, budget: int) -> DataFrame | None:
    """Selected source rows, once for each shard that needs them, with ``_shard``; None if
    the directory of ``rows`` places over ``blocks`` blocks of positions might not fit."""
    width = max(1, -(-(shards - 1).bit_length() // 8))
    size = blocks * (PLACE_BYTES * (BITMAP_ROWS + 1) + RANGE_BYTES) + rows * width
    if size > budget or min(rows, BITMAP_ROWS * shards) >= 1 << (8 * PLACE_BYTES):
        return None

    def read(octets: str, place: Column, size: int) -> Column:
        return F.conv(F.hex(F.substring(F.col(octets), place * size + 1, F.lit(size))), 16, 10).cast("int")

    at = F.expr(f"cast(source_pos % {BITMAP_ROWS} as int)")
    met = source.withColumn("_block", _bitmap_block()).join(F.broadcast(shard_directory(slots, width)), "_block")
    first, after = read("_starts", at, PLACE_BYTES), read("_starts", at + 1, PLACE_BYTES)
    own = F.transform(F.sequence(first, after - 1), lambda place: read("_shards", place, width))
    return met.where(after > first).select(*source.columns, F.explode(own).alias("_shard"))


def _co_shuffled(sent: DataFrame, slots: DataFrame, shards: int) -> DataFrame:
    """Join with a single payload exchange: the payload knows its shard (in source order
    from the range of positions that a shard covers, in draw order from the directory),
    goes straight there and meets the selection. The sort-merge join leaves each shard in
    source order."""
    here = F.col("_shard")
    return sent.repartitionById(shards, here).join(
        slots.repartitionById(shards, here).hint("merge"), ["_shard", "source_pos"]
    )


def _slots(selection: Selection, per_shard: int, order: str) -> tuple[DataFrame, int, bool]:
    """``(slots, rows, whether they are in draw order)``."""
    if order == "draw" and selection.has_draw_order:
        rows = selection.rows.count() if selection.size is None else selection.size
        return _draw_slots(selection.rows, per_shard, selection.may_repeat), rows, True
    placed, rows = source_order(selection.rows, selection.may_repeat)
    return _source_slots(placed, per_shard, selection.may_repeat), rows, False


def _out_pos(may_repeat: bool, by_draw: bool) -> Column:
    places = F.col("_places")
    if may_repeat:
        places = F.explode(places if by_draw else F.sequence(places["first"], places["last"]))
    return places.alias("out_pos")


def gather_by_key(
    table: DataFrame, places: DataFrame, keys: Sequence[str], selection: Selection, per_shard: int, order: str = "draw",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, int, int]:
    """As :func:`gather_ordered`, for a ``table`` whose rows are found by unique ``keys``;
    ``places`` has their ``source_pos``. The keys travel with the slim selection, so the
    payload needs no position: a small selection is broadcast to it, else it is shuffled
    once by key and, only what is selected, once to its shard."""
    slots, rows, by_draw = _slots(selection, per_shard, order)
    shards = max(1, -(-rows // per_shard))
    routed = slots.join(places.select("source_pos", *keys), "source_pos")
    met = table.join(F.broadcast(routed) if rows * SLOT_BYTES <= broadcast_bytes else routed, list(keys))
    met = met.repartition(1) if shards == 1 else met.repartitionById(shards, F.col("_shard"))
    columns = [*table.columns, "source_pos", "_score", _out_pos(selection.may_repeat, by_draw)]
    return met.select(*columns).sortWithinPartitions("out_pos"), shards, rows


def gather_ordered(
    source: DataFrame, selection: Selection, per_shard: int, order: str = "draw",
    source_rows: int | None = None, broadcast_bytes: int = BROADCAST_BYTES,
    bitmap_bytes: int = BROADCAST_BYTES,
) -> tuple[DataFrame, int, int]:
    """``(frame, shards, rows)``: the selected source rows plus ``_score`` and
    ``out_pos``. Partition i holds output rows ``i * per_shard`` onwards, sorted.

    A small selection is broadcast, so that only selected rows are shuffled, once.
    With a large one the payload is reduced to the selected rows before the shuffle, by a
    broadcast (if ``source_rows`` is known and it fits ``bitmap_bytes``) that also says to
    which shards a row goes: a bitmap in source order, a directory of shards in draw order.
    The payload is then shuffled once. In draw order beyond that size it is reduced by the
    bitmap alone, if that fits, and shuffled once by position and once by shard.
    """
    slots, rows, by_draw = _slots(selection, per_shard, order)
    shards = max(1, -(-rows // per_shard))
    out_pos = _out_pos(selection.may_repeat, by_draw)

    if rows * SLOT_BYTES <= broadcast_bytes:
        met = source.join(F.broadcast(slots), "source_pos")
    else:
        blocks = None if source_rows is None else source_rows // BITMAP_ROWS + 1
        if not by_draw and shards > 1 and blocks is not None:
            # Every block meets one shard more than it has shard borders.
            sent = _near(source, slots, blocks + shards, bitmap_bytes, "_shard")
            if sent is not None:
                met = _co_shuffled(sent, slots, shards).sortWithinPartitions("_shard", "source_pos")
                return met.select(*source.columns, "_score", out_pos), shards, rows
        if by_draw and shards > 1 and blocks is not None:
            sent = _dealt(source, slots, blocks, shards, rows, bitmap_bytes)
            if sent is not None:
                met = _co_shuffled(sent, slots, shards)
                return met.select(*source.columns, "_score", out_pos).sortWithinPartitions("out_pos"), shards, rows
        near = None if blocks is None else _near(source, selection.rows, blocks, bitmap_bytes)
        met = _join_salted(source if near is None else near, slots, selection.hot if by_draw else ())
    met = met.repartition(1) if shards == 1 else met.repartitionById(shards, F.col("_shard"))
    return met.select(*source.columns, "_score", out_pos).sortWithinPartitions("out_pos"), shards, rows
