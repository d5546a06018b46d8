"""Exact top-k by inner product over whole-number vectors with M-trees.

Inner product is turned into a metric: with M2 the largest squared length, a vector v becomes
(v, sqrt(M2 - |v|2)) and a query (q, 0), so that their squared distance is |q|2 + M2 - 2 qv and the nearest
is the highest product. At most ``REGIONS`` routing objects cut the space; each region is a group
of M-trees of at most about ``TREE`` vectors (rows of one region are dealt to its trees by a hash, so
a vector that fills a third of the table fills many trees).

A tree has pages of ``PAGE`` entries. An entry holds its object, its covering radius and the distance
to the object of its page. Best-first search opens the page with the smallest lower bound, for all queries of the
task that wait at it at once; stored distances to the parent rule out entries before their own distance is computed. The search
runs twice: first in the region nearest to a query, then, with that k-th score as bound, in
every other region that its radius does not rule out. Bounds carry slack for rounding,
scores are exact whole numbers.

Vectors that are null or hold null or non-finite components take no part; shorter ones count as
filled up with zeros. A query is an id; rows with another id are candidates, repeated rows each for
themselves; ties go to the smaller id. Scores are exact below 2^53; whole-number components of more than about
2^31 (squares beyond 64 bits) are refused by Spark's overflow check.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .vectors import best, matrix, query_rows, usable

#: Routing objects of the top level: also the bound of what is sent to all tasks.
REGIONS = 16
#: Vectors of one tree, on average at most.
TREE = 4096
PAGE = 64
#: Queries searched in one task.
QUERY_BLOCK = 8192
#: Rows found that a search holds before it keeps only the best of each query.
HELD = 1 << 20
#: Bounds give way by this share of the scale of squared distances.
SLACK = 1e-9


def lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, longest - (vectors * vectors).sum(axis=1)))
    return np.hstack([vectors, rest[:, None]])


def distances(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    gap = points - to
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


class Node:
    """A page: entries' objects (rows), distances to the page's object, and radii and pages below if inner."""

    __slots__ = ("rows", "parent", "radii", "below")

    def __init__(self, rows: np.ndarray, parent: np.ndarray, radii: np.ndarray | None = None, below: list | None = None) -> None:
        self.rows, self.parent, self.radii, self.below = rows, parent, radii, below


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, longest: float, page: int = PAGE) -> None:
        self.ids, self.vectors, self.page = ids, vectors, page
        self.points = lifted(vectors, longest)
        self.longest = longest
        self.root = self._build(np.argsort(ids, kind="stable"), self.points[0] * 0) if len(ids) else None
        self.computed = 0

    def _build(self, rows: np.ndarray, around: np.ndarray) -> Node:
        """Bulk load: routing objects spread over the rows; every row goes to the nearest one."""
        if len(rows) <= self.page:
            return Node(rows, distances(self.points[rows], around))
        many = min(self.page, -(-len(rows) // self.page) + 1)
        chosen = rows[np.linspace(0, len(rows) - 1, many).astype(int)]
        lengths = (self.points[chosen] ** 2).sum(axis=1)
        nearest = (lengths - 2 * self.points[rows] @ self.points[chosen].T).argmin(axis=1)
        groups = [rows[nearest == i] for i in range(many)]
        if max(map(len, groups)) == len(rows):  # all alike: any even cut will do
            groups = np.array_split(rows, many)
        kept = [(c, g) for c, g in zip(chosen, groups) if len(g)]
        objects = np.array([c for c, _ in kept])
        radii = np.array([distances(self.points[g], self.points[c]).max() for c, g in kept])
        return Node(objects, distances(self.points[objects], around), radii, [self._build(g, self.points[c]) for c, g in kept])

    def search(self, query_id: int, query: np.ndarray, k: int, floor: float = -np.inf) -> list[tuple[int, int]]:
        """The ``k`` best (score, id) of at least ``floor``, without the query's own id."""
        _, ids, scores = self.search_all(np.array([query_id]), query[None], k, np.array([floor]))
        return list(zip(scores.tolist(), ids.tolist()))

    def search_all(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the query, id and score of the ``k`` best of each query, of at least its floor.

        A page is opened for all queries waiting at it with one matrix product. Queries go to the page
        nearest to them first, which gives each a k-th score; other pages follow by lower bound, for the queries not ruled out by then.
        """
        kept = [np.zeros((0, 3), np.int64)]
        if self.root is None or not len(queries):
            return kept[0][:, 0], kept[0][:, 1], kept[0][:, 2]
        sizes = (queries * queries).sum(axis=1)
        slack = SLACK * (sizes + self.longest + 1.0)
        tops = np.full((len(queries), k), -np.inf)  # best scores so far, the k-th in front
        worst = floors.astype(float)
        held = 0

        def limits(of: np.ndarray) -> np.ndarray:
            """Distances beyond which nothing can be among the best."""
            least = worst[of]
            known = least > -np.inf
            return np.where(known, np.sqrt(np.maximum(0.0, sizes[of] + self.longest - 2 * np.where(known, least, 0.0)) + slack[of]), np.inf)

        def cut(found: list[np.ndarray]) -> list[np.ndarray]:
            """The ``k`` best of each query among the rows found, ties to the smaller id."""
            rows = np.concatenate(found)
            rows = rows[rows[:, 2] >= worst[rows[:, 0]]]
            rows = rows[np.lexsort((rows[:, 1], -rows[:, 2], rows[:, 0]))]
            starts = np.searchsorted(rows[:, 0], rows[:, 0])
            return [rows[np.arange(len(rows)) - starts < k]]

        everyone = np.arange(len(queries))
        # (later, least bound, number): pages nearest to their queries come first
        queue = [(False, 0.0, 0, self.root, everyone, np.zeros(len(queries)), np.sqrt(sizes))]
        count = 0
        while queue:
            later, _, _, node, places, bounds, around = heapq.heappop(queue)
            most = limits(places)
            waiting = bounds <= most
            if not waiting.any():
                continue
            places, around, most = places[waiting], around[waiting], most[waiting]
            room = most + slack[places]
            radii = node.radii if node.below else 0.0
            near = np.nonzero((node.parent + radii >= (around - room).min()) & (node.parent - radii <= (around + room).max()))[0]
            if not len(near):
                continue
            self.computed += len(near) * len(places)
            rows = node.rows[near]
            scores = queries[places] @ self.vectors[rows].T
            if node.below:
                # lifted vectors are all as long as the longest one, so products give distances
                exact = np.sqrt(np.maximum(0.0, sizes[places, None] + self.longest - 2 * scores))
                lower = np.maximum(0.0, exact - radii[near])
                open_ = lower <= room[:, None]
                first = np.zeros_like(open_)
                if not later:
                    first[np.arange(len(places)), lower.argmin(axis=1)] = True
                for i in range(len(near)):
                    for after, chosen in ((later, open_[:, i] & first[:, i]), (True, open_[:, i] & ~first[:, i])):
                        if chosen.any():
                            count += 1
                            gaps = lower[chosen, i]
                            heapq.heappush(queue, (after, float(gaps.min()), count, node.below[near[i]], places[chosen], gaps, exact[chosen, i]))
                continue
            scores[query_ids[places, None] == self.ids[rows]] = -np.inf
            hits = (scores >= worst[places, None]) & (scores > -np.inf)
            row, column = np.nonzero(hits)
            if not len(row):
                continue
            kept.append(np.stack([places[row], self.ids[rows[column]], scores[row, column].astype(np.int64)], axis=1))
            better = np.nonzero(hits.any(axis=1))[0]
            own = places[better]
            merged = np.concatenate([tops[own], scores[better]], axis=1)
            tops[own] = np.partition(merged, merged.shape[1] - k, axis=1)[:, merged.shape[1] - k :]
            worst[own] = np.maximum(worst[own], tops[own, 0])
            held += len(row)
            if held > HELD:
                kept = cut(kept)
                held = len(kept[0])
        found = cut(kept)[0]
        return found[:, 0], found[:, 1], found[:, 2]


def whole(rows: DataFrame, scale: int) -> DataFrame:
    return rows.withColumn("embedding", F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("bigint")))


def top_k(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256, regions: int = REGIONS, tree: int = TREE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest products of each row whose id is divisible by ``every``."""
    rows = whole(usable(vectors, nonzero=False), scale)
    squared = F.aggregate("embedding", F.lit(0).cast("bigint"), lambda a, x: a + x * x)
    stats = rows.agg(F.max(squared).alias("longest"), F.max(F.size("embedding")).alias("width")).first()
    longest, width = float(stats["longest"] or 0), stats["width"] or 0
    objects = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(regions).select("embedding").collect()
    centres = np.zeros((len(objects), width))
    for i, row in enumerate(objects):
        centres[i, : len(row[0])] = row[0]
    centres = lifted(centres, longest)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = lifted(matrix(batch.column("embedding"), width), longest)
            gaps = np.stack([distances(points, c) for c in centres], axis=1)
            region = gaps.argmin(axis=1)
            own = gaps[np.arange(len(region)), region]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(region, pa.int32()), pa.array(own, pa.float64())], names=["vec_id", "embedding", "region", "gap"])

    kind = "vec_id bigint, embedding array<bigint>"
    routed = store(rows.select(F.col("vec_id").cast("bigint"), "embedding").mapInArrow(route, f"{kind}, region int, gap double"), "mtree-vectors")
    # One row per region at most: the top page of every tree.
    top = {r["region"]: (r["n"], r["radius"]) for r in routed.groupBy("region").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect()}
    trees = {region: -(-n // tree) for region, (n, _) in top.items()}
    counts = np.array([trees.get(region, 0) for region in range(len(centres))], np.int64)
    radii = np.array([top[region][1] if region in top else 0.0 for region in range(len(centres))])
    asked = query_rows(routed, every)
    query_blocks = -(-routed.filter(F.col("vec_id") % every == 0).count() // QUERY_BLOCK) or 1

    def visits(first: bool):
        """Region, tree and bound for each place where a query is searched."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                queries = matrix(batch.column("embedding"), width)
                points = np.hstack([queries, np.zeros((len(queries), 1))])
                sizes = (queries * queries).sum(axis=1)
                gaps = np.stack([distances(points, c) for c in centres], axis=1)
                floors = np.full(len(queries), -np.inf) if first else batch.column("floor").to_numpy(zero_copy_only=False)
                reach = np.full(len(queries), np.inf)
                bounded = floors > -np.inf
                reach[bounded] = np.sqrt(np.maximum(0.0, sizes[bounded] + longest - 2 * floors[bounded]))
                home = gaps.argmin(axis=1)[:, None] == np.arange(len(centres))
                near = gaps - radii <= (reach + SLACK * (sizes + longest + 1))[:, None]
                place, region = np.nonzero(home if first else near & ~home)
                many = counts[region]
                place, region = np.repeat(place, many), np.repeat(region, many)
                number = np.arange(len(place)) - np.repeat(np.cumsum(many) - many, many)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(place)), batch.column("embedding").take(pa.array(place)), pa.array(floors[place]), pa.array(region, pa.int32()), pa.array(number, pa.int32())],
                    names=["vec_id", "embedding", "floor", "region", "tree"],
                )

        return run

    def search(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        query = vec = score = np.zeros(0, np.int64)
        if left.num_rows and right.num_rows:
            own = Tree(right["vec_id"].to_numpy(), matrix(right["embedding"], width), longest)
            asking = left["vec_id"].to_numpy()
            place, vec, score = own.search_all(asking, matrix(left["embedding"], width), k, left["floor"].to_numpy())
            query = asking[place]
        return pa.table({"query_id": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.int64())})

    sizes = F.create_map(*[F.lit(x) for pair in trees.items() for x in pair]) if trees else F.create_map(F.lit(0), F.lit(1))
    placed = routed.select("vec_id", "embedding", "region", F.pmod(F.xxhash64("vec_id", "embedding"), sizes[F.col("region")]).cast("int").alias("tree"))
    placed = placed.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))

    def searched(queries: DataFrame, first: bool) -> DataFrame:
        sent = queries.mapInArrow(visits(first), f"{kind}, floor double, region int, tree int")
        sent = sent.withColumn("qb", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
        keys = ("region", "tree", "qb")
        return sent.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")

    near = store(best(searched(asked, True), k), "mtree-near")
    floors = near.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    bounded = asked.join(floors, asked["vec_id"] == floors["query_id"], "left")
    bounded = bounded.select("vec_id", "embedding", F.when(F.col("n") == k, F.col("least").cast("double")).otherwise(F.lit(float("-inf"))).alias("floor"))
    far = searched(bounded, False)
    return best(near.drop("rank").unionByName(far), k)
