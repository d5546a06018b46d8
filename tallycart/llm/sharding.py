"""Sharding through fixed virtual slots, with DataFrame operations only.

Records are hashed into ``SLOTS`` slots; the bytes of each slot are added up; a map from slot
to shard, kept with a version, decides where a record lies. Rebalancing edits the map and
moves whole slots. The law is ``bytes``: slots go, largest first, to the shard
with the fewest bytes so far, so shards differ by no more than one small slot
unless a single document outweighs a shard.

The map has ``SLOTS`` rows whatever the data, and is made in one row. A record is hashed by id, checksum of the
text and its number among equal records, so a repeated id, a null id or a group of equal rows, however
large, spreads over all slots; copies of a text under other ids do so too. A null text counts as empty. Places run from 0 in each shard: slots in order, then ids, checksums and sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import store

SLOTS = 4096
SHARDS = 8
#: Equal records are counted first and written out again in blocks of so many.
BLOCK_ROWS = 1 << 16
#: Rebalancing leaves shards alone that are within this share of the mean.
TOLERANCE = 0.01


def records(docs: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, virtual) of every document, stored, since two steps read it."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))
    key = ["doc_id", "size", "text_crc32"]
    equal = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    blocks = equal.withColumn("_block", F.explode(F.expr(f"sequence(0L, (_n - 1) div {BLOCK_ROWS})"))).repartition(*key, "_block")
    first = F.col("_block") * BLOCK_ROWS
    each = blocks.withColumn("_no", F.explode(F.sequence(first, F.least(first + BLOCK_ROWS, F.col("_n")) - 1)))
    virtual = F.pmod(F.xxhash64("doc_id", "text_crc32", "_no"), F.lit(SLOTS))
    return store(each.select(*key, virtual.cast("int").alias("virtual")), "shard-records")


def slot_bytes(rows: DataFrame) -> DataFrame:
    return rows.groupBy("virtual").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def _slots(slots: DataFrame, order: Column) -> DataFrame:
    """All slots in one row, in order."""
    return slots.agg(F.array_sort(F.collect_list(order)).alias("slots"))


def first_map(slots: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Version 0 of the map (version, virtual, shard) for ``slot_bytes`` rows."""
    lined = _slots(slots, F.struct((-F.col("bytes")).alias("less"), "virtual"))
    dealt = f"""aggregate(slots,
        named_struct('loads', transform(sequence(1, {shards}), i -> 0L), 'map', cast(array() as array<struct<virtual:int,shard:int>>)),
        (a, s) -> named_struct(
            'loads', transform(a.loads, (v, i) -> if(i = int(array_position(a.loads, array_min(a.loads))) - 1, v - s.less, v)),
            'map', concat(a.map, array(named_struct('virtual', s.virtual, 'shard', int(array_position(a.loads, array_min(a.loads))) - 1)))),
        a -> a.map)"""
    return lined.select(F.inline(F.expr(dealt))).select(F.lit(0).alias("version"), "virtual", "shard")


def rebalanced(current: DataFrame, slots: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The next version: slots of overfull shards move, largest first, where they bring the loads closer.

    New slots count as lying in the shard with the fewest bytes; all others stay.
    """
    known = slots.join(current, "virtual", "left").select("virtual", "bytes", "shard", F.coalesce(F.max("version").over(Window.partitionBy()), F.lit(0)).alias("version"))
    loads = f"transform(sequence(0, {shards - 1}), i -> aggregate(filter(slots, s -> s.shard = i), 0L, (t, s) -> t - s.less))"
    lined = known.agg(F.array_sort(F.collect_list(F.struct((-F.col("bytes")).alias("less"), "virtual", "shard"))).alias("slots"), F.max("version").alias("version"), F.sum("bytes").alias("total"))
    least = "int(array_position(a.loads, array_min(a.loads))) - 1"
    moves = f"s.shard is null or (a.loads[s.shard] > a.most and array_min(a.loads) - s.less < a.loads[s.shard])"
    dealt = f"""aggregate(slots,
        named_struct('loads', {loads}, 'most', total * (1 + {TOLERANCE}D) / {shards}, 'map', cast(array() as array<struct<virtual:int,shard:int>>)),
        (a, s) -> if({moves}, named_struct(
            'loads', transform(a.loads, (v, i) -> v - if(i = {least}, s.less, 0L) + if(i = s.shard, s.less, 0L)),
            'most', a.most, 'map', concat(a.map, array(named_struct('virtual', s.virtual, 'shard', {least})))),
          named_struct('loads', a.loads, 'most', a.most, 'map', concat(a.map, array(named_struct('virtual', s.virtual, 'shard', s.shard))))),
        a -> a.map)"""
    return lined.select((F.col("version") + 1).cast("int").alias("version"), F.inline(F.expr(dealt)))


def placed(rows: DataFrame, slots: DataFrame, map_: DataFrame) -> DataFrame:
    """Rows of ``records`` with ``shard`` and the gapless place ``slot`` in it."""
    ahead = Window.partitionBy("shard").orderBy("virtual").rowsBetween(Window.unboundedPreceding, -1)  # SLOTS rows in all
    starts = slots.join(map_, "virtual").select("virtual", "shard", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("_start"))
    own = Window.partitionBy("virtual").orderBy("doc_id", "text_crc32", "size")
    numbered = rows.withColumn("_no", F.row_number().over(own) - 1)
    return numbered.join(starts, "virtual").withColumn("slot", F.col("_start") + F.col("_no")).drop("_start", "_no")


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, virtual, shard, slot, version) of every document."""
    rows = records(docs)
    slots = slot_bytes(rows)
    map_ = store(first_map(slots, shards), "shard-map")
    return placed(rows, slots, map_.select("virtual", "shard"))
