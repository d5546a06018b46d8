"""Exact n-gram Jaccard join in metric space: components of documents at distance 1 - t or less.

Jaccard distance is a metric on sets of shingles. Equal sets are one point. Almost all other points
are at distance 1 from each other, where windows around document pivots exclude nothing, so
the first pivots are the sets of one shingle:

1. *First regions.* A document lies in the regions of the pivots it contains, nearest first; all its
   pivots are equally near (1 - 1/n), so a fixed order of shingles breaks the tie. A neighbour lacks
   less than (1 - t) n of the shingles, hence the window: the document is copied to the first
   n - ceil(t n) + l regions, and a linked pair meets in l of them at least.
   l > 1 lets documents that meet others in too few regions go at once.
2. *Narrowing.* Regions with one point are dropped; of the rest, a document keeps the least crowded
   ones, as many as a linked pair needs to meet in one (counts over all documents).
3. *Pivots.* The most central point of a region is its pivot; exact distances to it are computed
   and links join components. Regions of one pivot make one cell; where all points are in
   one component it is done.
4. *Voronoi recursion.* An open cell of more than ``CELL`` points takes pivots of its own. Each point goes
   to the cell of its nearest pivot and into every cell within twice the reach of it (the
   boundary window); cells recurse. Cells that windows do not part stay whole.
5. *Cells.* In an open cell the points outside its largest component are compared with those of other
   components that sizes and the triangle inequality over the pivot leave, in blocks of
   ``BLOCK`` points, or about ``BLOCK_SHINGLES`` shingles, a side. A task reports links that join components, not all pairs.

No window drops a pair within reach, so components are exact (shingles are 64-bit hashes). The order of
shingles uses counts of a bounded sample (``SAMPLE_DOCS``): it changes how crowded regions are, never
the result.

Lower-cased A-Z, words between ASCII white space. Fewer words than a shingle has make one;
null or wordless texts have none and stay alone, even with each other. Repeated rows and ids share
a point if their texts do; a component is named by its smallest id (null if all are null).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path, scratch_scope
from .common import HashIndex, bounded, chunks, ragged, store, utf8
from .graph import connected

#: Documents (expected) whose shingles are counted for the order, and shingles kept of them.
SAMPLE_DOCS = 2000
COMMON = 65_536
#: One more meeting is asked for every so many shingles.
PER_MEETING = 20
#: Cells of more points are cut by so many pivots.
CELL = 4096
PIVOTS = 16
#: Points of a block at most, and shingles about; a task holds two.
BLOCK = 512
BLOCK_SHINGLES = 500_000
#: Up to so many ids, or pairs of them, are broadcast (8 bytes an id); beyond it they are joined by exchange.
BROADCAST_IDS = 1_000_000


@dataclass(frozen=True)
class Rule:
    """What a shingle and a link are: words of a shingle, least similarity in hundredths."""

    words: int = 4
    similarity: int = 85

    @property
    def reach(self) -> float:
        """Greatest distance of a link, with room for rounding."""
        return 1 - self.similarity / 100 + 1e-9

    def overlap(self, n: int) -> int:
        """Shingles that a set of ``n`` shares with a linked one, at least."""
        return -(-self.similarity * n // 100)

    def window(self, n: int) -> int:
        """Regions a set of ``n`` is copied to."""
        return n - self.overlap(n) + meetings(n)

    def near(self, a: str, b: str) -> Column:
        """Whether sets of these sizes can be linked."""
        return F.expr(f"100 * least({a}, {b}) >= {self.similarity} * greatest({a}, {b})")


RULE = Rule()

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TURN = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(data: np.ndarray, ends: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """The sorted set of hashed shingles of each text."""
    with np.errstate(over="ignore"):
        seen = ~_SPACE[data]
        begins = seen.copy()
        begins[1:] &= ~seen[:-1]
        inner = ends[(ends > 0) & (ends < len(data))]
        begins[inner] = seen[inner]
        starts = np.nonzero(begins)[0]
        if len(starts):
            at = np.nonzero(seen)[0]
            first = np.searchsorted(at, starts)
            place = at - np.repeat(starts, np.diff(np.append(first, len(at))))
            terms = _BYTE[_LOWER[data[at]]] + (place >> 12).astype(np.uint64) * _TURN[63]
            terms *= _PLACE[place & 4095]
            hashed = _mixed(np.add.reduceat(terms, first))
        else:
            hashed = np.zeros(0, np.uint64)
        joined = np.zeros(max(0, len(hashed) - words + 1), np.uint64)
        for i in range(words):
            joined += _TURN[i] * hashed[i : i + len(joined)]
        joined = _mixed(joined)
        cuts = np.searchsorted(starts, ends)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a >= words:
                yield np.unique(joined[a : b - words + 1])
            elif b > a:
                short = hashed[a:b] * _TURN[: b - a]
                yield _mixed(short.sum(dtype=np.uint64, keepdims=True) + _TURN[32 + b - a])
            else:
                yield joined[:0]


def point(shingles: np.ndarray) -> int:
    """A 64-bit name of the set."""
    with np.errstate(over="ignore"):
        total = _mixed(shingles ^ _TURN[60]).sum(dtype=np.uint64, keepdims=True)
        return int(_mixed(total + np.uint64(len(shingles)))[0].astype(np.int64))


def meetings(n: int) -> int:
    return 1 + n // PER_MEETING


def _print() -> Column:
    """With the id, what tells the rows of a table apart, up to rows that are alike; made without Python."""
    return F.xxhash64("text")


def common_shingles(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several documents of a sample have, with counts; most common first, bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = list(shingle_sets(*utf8(batch.column("text")), words))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).astype(np.int64))], names=["e"])

    rows = docs.count()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000
    sample = docs.filter(draw < SAMPLE_DOCS / max(1, rows)).select("text")
    counts = sample.mapInArrow(run, "e bigint").groupBy("e").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    top = counts.orderBy(F.desc("n"), "e").limit(COMMON).collect()
    return np.array([r["e"] for r in top], np.int64).astype(np.uint64), np.array([r["n"] for r in top], np.int64)


def points(docs: DataFrame, rule: Rule) -> DataFrame:
    """(doc_id, print, n, point, pivots) of every document; ``pivots`` are the shingles of its window."""
    rows, kind = docs.select("doc_id", _print().alias("print"), "text"), docs.schema["doc_id"].dataType.simpleString()
    words = rule.words
    order, counts = common_shingles(docs, words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = HashIndex(order)
        for batch in chunks(batches):
            sizes, names, first = [], [], []
            for own in shingle_sets(*utf8(batch.column("text")), words):
                sizes.append(len(own))
                names.append(point(own) if len(own) else None)
                place = index.find(own)
                rare, known = own[place < 0], own[place >= 0]
                if len(known):
                    times = counts[place[place >= 0]]
                    rare = np.concatenate([rare, known[np.lexsort((known, times))]])
                first.append(rare[: rule.window(len(own))] if len(own) else own)
            ends = np.concatenate([[0], np.cumsum([len(f) for f in first])])
            values = np.concatenate(first).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("print"), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                names=["doc_id", "print", "n", "point", "pivots"],
            )

    return bounded(rows).mapInArrow(run, f"doc_id {kind}, print bigint, n bigint, point bigint, pivots array<bigint>")


def sets_of(docs: DataFrame, words: int) -> DataFrame:
    """(point, n, shingles) of every document with shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            found = [s for s in shingle_sets(*utf8(batch.column("text")), words) if len(s)]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in found])])
            values = np.concatenate([*found, np.zeros(0, np.uint64)]).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([point(s) for s in found], pa.int64()), pa.array([len(s) for s in found], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values))],
                names=["point", "n", "shingles"],
            )

    return bounded(docs).select("text").mapInArrow(run, "point bigint, n bigint, shingles array<bigint>")


def regions(placed: DataFrame, rule: Rule) -> DataFrame:
    """(region, point, n, central): the least crowded first regions in which every linked pair meets once.

    ``central`` adds up how crowded all of a point's regions are: high for texts others derive from.
    """
    # One exchange of (region, point): regions are counted where their copies lie, in sorted runs that spill. A crowded region is
    # the window of texts that are alike in all but common shingles; its rows are two numbers each.
    own = Window.partitionBy("region")
    copies = placed.select("point", F.explode("pivots").alias("region"))
    crowd = copies.select("region", "point", F.min("point").over(own).alias("a"), F.max("point").over(own).alias("b"), F.count(F.lit(1)).over(own).alias("crowd"))
    # Copies of one text say the same; they are merged where they are read.
    met = crowd.filter("a < b").groupBy("point").agg(F.collect_set(F.struct("crowd", "region")).alias("met"))
    met = met.join(placed.select("point", "n").distinct(), "point")
    least = f"(1 + int(ceil({rule.similarity} * n / 100) / {PER_MEETING}))"
    kept = F.expr(f"slice(array_sort(met), 1, size(met) - {least} + 1)")
    central = F.expr("aggregate(met, 0L, (a, m) -> a + m.crowd)").alias("central")
    met = met.filter(F.expr(f"size(met) >= {least}")).select(F.explode(kept).alias("m"), "point", "n", central)
    return met.select("m.region", "point", "n", "central")


def similarity_links(pairs: DataFrame, sets: DataFrame, rule: Rule, few: bool = False) -> DataFrame:
    """``pairs`` (a, b), each once, with their exact Jaccard ``distance`` and whether they are linked.

    ``few``: the pairs are known to be at most ``BROADCAST_IDS``; then they go to the sets, which stay where they are.
    """
    own = sets.select(F.col("point").alias("a"), F.col("n").alias("n_a"), F.col("shingles").alias("s_a"))
    other = sets.select(F.col("point").alias("b"), F.col("n").alias("n_b"), F.col("shingles").alias("s_b"))
    # Partners are gathered per point, so that the exchange that merges repeats also serves the first join.
    once = pairs.groupBy("a").agg(F.collect_set("b").alias("bs"))
    once = F.broadcast(once) if few else once
    both = once.join(own, "a").select("a", "n_a", "s_a", F.explode("bs").alias("b")).join(other, "b")
    both = both.withColumn("both", F.size(F.array_intersect("s_a", "s_b")).cast("bigint"))
    union = F.col("n_a") + F.col("n_b") - F.col("both")
    return both.select("a", "b", (1 - F.col("both") / union).alias("distance"), (100 * F.col("both") >= rule.similarity * union).alias("linked"))


def _named(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members with the component they are in so far."""
    return members.join(found.withColumnRenamed("node", "point"), "point", "left").withColumn("component", F.coalesce("component", "point"))


def _open(members: DataFrame) -> DataFrame:
    """Members of cells whose points are in several components, with the cell's ``points`` and their ``shingles_in``."""
    sizes = members.groupBy("cell").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count(F.lit(1)).alias("points"), F.sum("n").alias("shingles_in")
    )
    return members.join(sizes.filter("a < b").select("cell", "points", "shingles_in"), "cell")


def _cut(cells: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """Cells of more than ``CELL`` points cut by ``PIVOTS`` pivots of their own, or as they are.

    A point goes to the cell of its nearest pivot, and to every cell whose pivot may be the nearest of a neighbour: at
    most twice the reach of a link behind. Where that would hold more than half as many points again, windows do not
    part the cell and it stays whole.
    """
    bucket = F.pmod(F.xxhash64("point"), F.lit(PIVOTS))
    chosen = store(cells.groupBy("cell", bucket.alias("bucket")).agg(F.min("point").alias("pivot")).select("cell", "pivot"), "jaccard-pivots")
    paired = cells.join(chosen, "cell")
    known = store(similarity_links(paired.select(F.col("point").alias("a"), F.col("pivot").alias("b")).filter("a <> b"), sets, rule), "jaccard-distances")
    gaps = known.select(F.col("a").alias("point"), F.col("b").alias("pivot"), F.col("distance").alias("gap"))
    paired = paired.join(gaps, ["point", "pivot"], "left").withColumn("gap", F.coalesce("gap", F.lit(0.0)))
    nearest = paired.groupBy("cell", "point").agg(F.min("gap").alias("nearest"))
    reached = paired.join(nearest, ["cell", "point"]).filter(F.col("gap") <= F.col("nearest") + 2 * rule.reach)
    parted = reached.groupBy("cell").agg((F.count(F.lit(1)) <= 1.5 * F.max("points")).alias("parted"))
    reached = reached.join(parted, "cell")
    name = F.when(F.col("parted"), F.xxhash64("cell", "pivot")).otherwise(F.col("cell")).alias("cell")
    gap = F.when(F.col("parted"), F.col("gap")).otherwise(F.col("distance")).alias("distance")
    return reached.select(name, "point", "n", gap, "component", "parted").distinct()


def cell_links(points: np.ndarray, group: np.ndarray, gaps: np.ndarray, side: np.ndarray, sets: list[np.ndarray], rule: Rule = RULE) -> list[tuple[int, int]]:
    """Links that join the components (``group``) of one cell, or of two blocks of it: a spanning set, no more.

    Only points outside the largest component are compared, each with all of other components that the triangle inequality
    over the cell's pivot leaves (``gaps`` are distances to it, NaN if unknown). If both sides are given, pairs of one side are left to
    other tasks.
    """
    names, group = np.unique(group, return_inverse=True)
    merged = np.arange(len(names))  # the component each one belongs to by now

    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    flat = np.concatenate(sets)
    _, codes = np.unique(flat, return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(codes, kind="stable")
    posted, cuts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(codes))])
    begin = np.cumsum(sizes) - sizes
    cross = len(np.unique(side)) > 1
    out = []
    largest = int(np.bincount(group).argmax())
    for x in np.nonzero(group != largest)[0]:
        now = merged[group]
        rival = (now != now[x]) & (100 * np.minimum(sizes, sizes[x]) >= rule.similarity * np.maximum(sizes, sizes[x]))
        rival &= ~(np.abs(gaps - gaps[x]) > rule.reach)
        if cross:
            rival &= side != side[x]
        if not rival.any():
            continue
        own = codes[begin[x] : begin[x] + sizes[x]]
        both = np.bincount(posted[ragged(cuts[own], cuts[own + 1] - cuts[own])], minlength=len(sets))
        linked = np.nonzero(rival & (100 * both >= rule.similarity * (sizes + sizes[x] - both)))[0]
        for y in linked:
            a, b = merged[group[x]], merged[group[y]]
            if a != b:
                merged[merged == max(a, b)] = min(a, b)
                out.append((int(points[x]), int(points[y])))
    return out


def _cell_join(cells: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(a, b): links between the components of each cell, found block by block."""

    def run(_: tuple, rows: pa.Table) -> pa.Table:
        shingles = [np.asarray(x) for x in rows["shingles"].combine_chunks().to_numpy(zero_copy_only=False)]
        gaps = rows["distance"].to_numpy().astype(np.float64)
        found = cell_links(rows["point"].to_numpy(), rows["component"].to_numpy(), gaps, rows["block"].to_numpy(), shingles, rule)
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    blocks = F.greatest(F.ceil(F.col("points") / BLOCK), F.ceil(F.col("shingles_in") / BLOCK_SHINGLES)).cast("int")
    cells = cells.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("point"), F.col("blocks")).cast("int"))
    dealt = cells.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    dealt = dealt.select("cell", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "point", "component", "distance", "block")
    return dealt.join(sets.select("point", "shingles"), "point").groupBy("cell", "i", "j").applyInArrow(run, "a bigint, b bigint")


def join_regions(members: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """(node, component) of all points that links join, from regions in which every linked pair meets."""
    # The pivot of a region is its most central point; regions of one pivot make one cell.
    pivot = F.max(F.struct("central", "point", "n")).alias("p")
    first = members.groupBy("region").agg(pivot).select("region", F.col("p.point").alias("cell"), F.col("p.n").alias("pivot_n"))
    cells = store(members.join(first, "region").select("cell", "pivot_n", "point", "n").distinct(), "jaccard-cells")
    tried = cells.filter("point <> cell").filter(rule.near("n", "pivot_n")).select(F.col("point").alias("a"), F.col("cell").alias("b"))
    known = store(similarity_links(tried, sets, rule, cells.count() <= BROADCAST_IDS), "jaccard-distances")
    links = known.filter("linked").select("a", "b")
    found = store(connected(links), "jaccard-components")
    gaps = known.select(F.col("a").alias("point"), F.col("b").alias("cell"), "distance")
    left = _open(_named(cells.filter("point <> cell").select("cell", "point", "n"), found))
    left = store(left.join(gaps, ["cell", "point"], "left"), "jaccard-open")
    ready = left.filter(F.col("points") <= CELL)
    large = left.filter(F.col("points") > CELL)
    while not large.isEmpty():
        cut = store(_cut(large, sets, rule), "jaccard-cut")
        again = store(_open(cut), "jaccard-open")
        ready = ready.unionByName(again.filter(f"not parted or points <= {CELL}").drop("parted"))
        large = again.filter(f"parted and points > {CELL}").drop("parted")
    more = store(_cell_join(ready, sets, rule), "jaccard-links")
    if more.isEmpty():
        return found
    return store(connected(links.unionByName(more)), "jaccard-components")


def _grouped(placed: DataFrame, docs: DataFrame, rule: Rule) -> DataFrame:
    """``placed`` with ``component``: a point that all linked points share, null without shingles."""
    members = store(regions(placed.filter("n > 0"), rule), "jaccard-regions")
    wanted = members.select("point").distinct()
    ids = store(placed.join(wanted, "point", "left_semi").groupBy("point").agg(F.min("doc_id").alias("doc_id")).select("doc_id"), "jaccard-ids")
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col("doc_id").alias("id"), "text").join(ids, F.expr("id <=> doc_id"), "left_semi")
    sets = store(sets_of(rows, rule.words), "jaccard-sets")
    counts = sets.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("point").alias("points")).first()
    if counts["n"] != counts["points"]:  # ids that several rows have
        sets = store(sets.dropDuplicates(["point"]), "jaccard-sets")
    found = join_regions(members, sets, rule)
    rows = placed.drop("pivots").join(found.withColumnRenamed("node", "point"), "point", "left")
    return rows.withColumn("component", F.coalesce("component", "point"))


def components(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    path = scratch_path(docs.sparkSession, "jaccard-result")
    with scratch_scope(docs.sparkSession):
        placed = store(points(docs, rule), "jaccard-points")
        rows = _grouped(placed, docs, rule)
        names = rows.filter("n > 0").groupBy("component").agg(F.min("doc_id").alias("least"))
        named = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
        out = rows.join(names, "component", "left").select("doc_id", F.col("n").alias("n_shingles"), named.alias("component_id"))
        out.write.parquet(path)
    return docs.sparkSession.read.schema(out.schema).parquet(path)


def representatives(docs: DataFrame, rule: Rule = RULE) -> DataFrame:
    """One row of each component, all columns kept: the one with the smallest id.

    Documents without shingles stay. Null ids come after all others; among rows of one id in
    one component the one with the fewest shingles, then the smaller point, stays, and of rows alike one.
    Which rows go is decided on ids and hashes of texts; where they are few the texts stay where they are.
    """
    spark = docs.sparkSession
    gone, twice = scratch_path(spark, "jaccard-gone"), scratch_path(spark, "jaccard-twice")
    with scratch_scope(spark):
        placed = store(points(docs, rule), "jaccard-points")
        rows = store(_grouped(placed, docs, rule).filter("n > 0"), "jaccard-grouped")
        first = rows.groupBy("component").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n", "point", "print")).alias("r"), F.count(F.lit(1)).alias("rows")
        )
        first = first.filter("rows > 1").select("component", F.col("r.doc_id").alias("_id"), F.col("r.print").alias("_print"))
        others = rows.join(first, "component").filter("not (doc_id <=> _id and print = _print)")
        others.select("doc_id", "print").distinct().write.parquet(gone)
        alike = rows.groupBy("doc_id", "print").count().filter("count > 1")
        alike.select("doc_id", "print").write.parquet(twice)
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_id"), _print().alias("_print"))

    def listed(path: str) -> tuple[DataFrame, int]:
        found = spark.read.parquet(path)
        n = found.count()
        return (F.broadcast(found) if n <= BROADCAST_IDS else found), n

    same = F.expr("doc_id <=> _id and print = _print")
    (lost, _), (again, repeats) = listed(gone), listed(twice)
    kept = own.join(lost, same, "left_anti")
    if repeats:
        once = kept.join(again, same, "left_semi").dropDuplicates(["_id", "_print"])
        kept = kept.join(again, same, "left_anti").unionByName(once)
    return kept.select("row.*")
