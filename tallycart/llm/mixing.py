"""Mixing sources to target weights with DataFrame operations only.

Every source gets a number of equal blocks of ``BLOCK_WORDS`` words by Sainte-Laguë: a block
goes to the highest quotient target / (2k + 1), k being the blocks already given. The documents
of a source lie in seeded order, in ``SLOTS`` fixed shards one after another, and its words are read off
from the start: whole rounds first (they may exceed the source), then leading documents, so that
one document of a source at most is taken in part. ``slot_mix`` follows op2's SQL: a source's blocks
go to its shards by the same rule, shard sizes being the votes, and are read off within the
shard, ``MOST`` times its size at most.

Quotients far above the cut need not be listed: a party's seats differ from its share of the seats
by less than its share of the number of parties, so only seats that close to it are ranked.

Null text has size 0, null source is a source of its own (last in order). Rows are drawn one by one,
so repeated rows are each a document; ties in the seeded order go by id and size. Empty tables
give empty results, sources without words target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_CLASS, store

BLOCK_WORDS = 16
SLOTS = 1024
SEED = "mix-1"
#: A target, and a document, stop at so many times their size.
MOST = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("bigint")


def _draw(doc_id: Column, seed: str) -> Column:
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null"))).cast("binary"))


def _shard(doc_id: Column, seed: str) -> Column:
    """Shard within the source and source in one text, so that one exchange serves join and window."""
    slot = F.conv(F.substring(_draw(doc_id, seed), 1, 8), 16, 10).cast("bigint") % SLOTS
    return F.concat(slot.cast("string"), F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n")))


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, pos, source_size, target): weights 1, 2, 3, shares of all words, capped and shared again.

    One row per source, so its windows have as many rows as there are sources.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by = by.withColumn("pos", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    by = by.withColumn("w", ((F.col("pos") - 1) % 3 + 1).cast("bigint")).withColumn("cap", MOST * F.col("source_size"))
    level = Window.orderBy(F.col("cap") * (6 / F.col("w")).cast("bigint"), "pos")
    total = F.sum("source_size").over(Window.partitionBy())
    by = by.withColumn("left", total - F.coalesce(F.sum("cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    by = by.withColumn("w_left", F.sum("w").over(level.rowsBetween(0, Window.unboundedFollowing)))
    # Capped sources are the first in this order; the first other one knows what all others share.
    by = by.withColumn("full", F.col("left") * F.col("w") >= F.col("cap") * F.col("w_left"))
    rest = Window.partitionBy()
    share = F.max(F.when(~F.col("full"), F.struct(F.col("left"), F.col("w_left")))).over(rest)
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise((share["left"] * F.col("w")).cast("double") / share["w_left"])
    return by.select("source", "pos", "source_size", target.alias("target"))


def seats(parties: DataFrame, within: list[str], votes: str, order: str, house: Column) -> DataFrame:
    """Sainte-Laguë: ``parties`` with their ``seats`` of the ``house``, per group of ``within``."""
    group = Window.partitionBy(*within)
    share = F.when(F.sum(votes).over(group) > 0, F.col(votes) / F.sum(votes).over(group)).otherwise(0.0)
    listed = parties.withColumn("_house", house).withColumn("_share", share)
    listed = listed.withColumn("_near", (F.floor(F.count(F.lit(1)).over(group) * F.col("_share")) + 2).cast("bigint"))
    listed = listed.withColumn("_base", F.greatest(F.lit(0).cast("bigint"), F.floor(F.col("_house") * F.col("_share")) - F.col("_near")))
    listed = listed.withColumn("_open", F.col("_house") - F.sum("_base").over(group))
    ranked = listed.withColumn("_k", F.explode(F.expr("sequence(_base, _base + 2 * _near + 1)")))
    best = group.orderBy((F.col(votes) / (2 * F.col("_k") + 1)).desc(), order, "_k")
    ranked = ranked.withColumn("_won", F.when((F.row_number().over(best) <= F.col("_open")) & (F.col(votes) > 0), 1).otherwise(0))
    columns = [F.first(c, ignorenulls=False).alias(c) for c in parties.columns if c not in (*within, order)]
    return ranked.groupBy(*within, order).agg(*columns, (F.max("_base") + F.sum("_won")).alias("seats"))


def _shards(sizes: DataFrame, seed: str) -> DataFrame:
    """(shard, shard_size, pos, source_size, target, source_seats)"""
    sources = source_targets(sizes)
    house = F.round(F.sum("target").over(Window.partitionBy()) / BLOCK_WORDS).cast("bigint")
    sources = seats(sources, [], "target", "pos", house).withColumnRenamed("seats", "source_seats")
    shards = sizes.groupBy("source", _shard(F.col("doc_id"), seed).alias("shard")).agg(F.sum("size").alias("shard_size"))
    shards = shards.alias("a").join(sources.alias("b"), F.expr("a.source <=> b.source"))
    return shards.select("a.shard", "a.shard_size", "b.pos", "b.source_size", "b.target", "b.source_seats")


def quotas(sizes: DataFrame, seed: str = SEED) -> DataFrame:
    """(shard, shard_size, quota, source_size, target): the words each shard gives."""
    given = seats(_shards(sizes, seed), ["pos"], "shard_size", "shard", F.col("source_seats"))
    quota = F.least(F.col("seats") * BLOCK_WORDS, MOST * F.col("shard_size"))
    return given.select("shard", "shard_size", quota.alias("quota"), "source_size", "target")


def source_quotas(sizes: DataFrame, seed: str = SEED) -> DataFrame:
    """(shard, pool_size, quota, start, source_size, target): the words of a source, to be taken from its shards in order.

    A source whose target is as much as it can give gives that to the word, others whole blocks.
    """
    before = Window.partitionBy("pos").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # SLOTS rows at most
    most = MOST * F.col("source_size")
    quota = F.when(F.col("target") >= most, most).otherwise(F.least(F.col("source_seats") * BLOCK_WORDS, most))
    start = F.coalesce(F.sum("shard_size").over(before), F.lit(0))
    return _shards(sizes, seed).select(
        "shard", F.col("source_size").alias("pool_size"), quota.alias("quota"), start.alias("start"), "source_size", "target"
    )


def _taken(rows: DataFrame, given: DataFrame, seed: str) -> DataFrame:
    """``rows`` with ``source_size``, ``target`` and ``taken``: the first ``quota`` words of a pool, whole rounds first.

    A shard's documents lie in its pool behind the ``start`` words of the shards before it.
    """
    own = Window.partitionBy("_shard").orderBy(_draw(F.col("doc_id"), seed), "doc_id", "size")
    before = F.col("_start") + F.coalesce(F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    given = given.select(
        F.col("shard").alias("_shard"), F.col("pool_size").alias("_pool_size"), F.col("quota").alias("_quota"), F.col("start").alias("_start"), "source_size", "target"
    )
    joined = rows.withColumn("_shard", _shard(F.col("doc_id"), seed)).join(given, "_shard").withColumn("_before", before)
    rounds = F.when(F.col("_pool_size") > 0, F.expr("_quota div _pool_size")).otherwise(F.lit(0))
    rest = F.col("_quota") - F.col("_rounds") * F.col("_pool_size") - F.col("_before")
    taken = F.col("_rounds") * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    joined = joined.withColumn("_rounds", rounds).withColumn("taken", taken.cast("bigint"))
    return joined.drop("_shard", "_pool_size", "_quota", "_start", "_before", "_rounds")


def mix(rows: DataFrame, seed: str = SEED, sizes: DataFrame | None = None) -> DataFrame:
    """``rows`` (doc_id, source, size and any others) with ``source_size``, ``target`` and ``taken``.

    Documents are taken whole; at most one of a source is taken in part.
    ``sizes`` are the same rows without the others, where those are costly to read twice.
    """
    return _taken(rows, source_quotas(rows if sizes is None else sizes, seed), seed)


def slot_mix(rows: DataFrame, seed: str = SEED) -> DataFrame:
    """As ``mix``, by the rule of op2's SQL: every shard reads off its own quota, so one document of each may be taken in part."""
    given = quotas(rows, seed).select("shard", F.col("shard_size").alias("pool_size"), "quota", F.lit(0).alias("start"), "source_size", "target")
    return _taken(rows, given, seed)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every document, stored, since several steps read it."""
    return store(docs.select("doc_id", "source", words(F.col("text")).alias("size")), "mix-sizes")


def taken_texts(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: every document as often as it is taken, columns as given.

    A document taken in part brings its first words, joined by spaces; ``n_chars``
    follows its text. Documents of which nothing is taken are left out.
    """
    # The row travels as one struct, whose names meet none of the mix's own.
    mixed = mix(docs.select("doc_id", "source", words(F.col("text")).alias("size"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")), seed, sized(docs))
    text = F.col("_row.text")
    part = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD_CLASS), 0), 1, F.expr("int(taken % size)")), " ")
    texts = F.concat(F.array_repeat(text, F.expr("int(taken div size)")), F.when(F.expr("taken % size > 0"), F.array(part)).otherwise(F.array().cast("array<string>")))
    out = mixed.filter("taken > 0").select("_row", F.explode(texts).alias("_text"))
    new = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("_text").cast(docs.schema["n_chars"].dataType)
    return out.select(*(new.get(c, F.col("_row")[c]).alias(c) for c in docs.columns))
