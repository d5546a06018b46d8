"""Vector codes: parts of a vector replaced by the nearest entry of a learned codebook.

Components become whole numbers floor(scale * x); a vector is cut into equal consecutive parts, each
with its own codebook. The nearest entry is found by slicing and intersecting: per dimension the
entries are sorted, and prefix masks (uint64 words) tell which entries lie below each place. The
distance to some entry is the initial radius. In every dimension the entries within the radius form one
range, whose mask is the difference of two prefix masks; the masks of all dimensions, ANDed, leave
exactly the entries in the cube around the part, and every nearest entry is among them.
Candidates are compared by exact squared distances, ties to the lower place in the codebook.

Rounds of learning run on Spark: tasks add up the parts of every entry, sums meet by (part, entry), and
only the codebooks (parts x entries x width numbers, whatever the table) pass the driver.

Rows whose vector is null or holds null or non-finite components are left out; an empty vector counts as zeros.
Vectors shorter than the longest, and widths that the parts do not divide, are filled
up with zeros. Components beyond ``LARGEST`` after scaling are held there, so that all
distances stay exact. A null id is coded like any other and comes last in the choice of first
entries; repeated ids are ordered by their vectors. With fewer rows than entries the codebooks are
shorter; an empty table gives an empty result. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store
from .vectors import matrix

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Components of at most this size keep 64-bit distances of up to 4096 of them exact.
LARGEST = 1 << 24
#: Up to this size products and sums of 512 of them are exact in doubles.
_EXACT = 1 << 21
#: Parts compared at once.
STRIPE = 4096
#: The initial radius is the least distance to so many entries on either side in so many dimensions, the widest ones.
NEIGHBOURS, DIMENSIONS = 4, 4
#: Share of candidates above which a stripe is compared by one matrix product.
DENSE = 0.05


class Slices:
    """Sorted coordinates and prefix masks of one codebook."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries.astype(np.int64)
        many, width = entries.shape
        self.words = -(-many // 64)
        self.order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, self.order, axis=0)
        bits = np.zeros((many, self.words), np.uint64)
        place = np.arange(many)
        bits[place, place // 64] = np.uint64(1) << (place % 64).astype(np.uint64)
        # prefix[d, i]: the entries at the first i sorted places of dimension d
        self.prefix = np.zeros((width, many + 1, self.words), np.uint64)
        for d in range(width):
            self.prefix[d, 1:] = np.bitwise_or.accumulate(bits[self.order[:, d]], axis=0)
        spread = self.sorted[-1] - self.sorted[0] if many else np.zeros(width)
        self.widest = np.argsort(-spread, kind="stable")[:DIMENSIONS]
        self.lengths = (self.entries * self.entries).sum(axis=1)

    def first_radius(self, parts: np.ndarray) -> np.ndarray:
        """Whole radius of a cube that holds an entry at the least distance: from neighbours in the widest dimensions."""
        least = np.full(len(parts), np.iinfo(np.int64).max)
        for d in self.widest:
            at = np.searchsorted(self.sorted[:, d], parts[:, d])
            for step in range(-NEIGHBOURS, NEIGHBOURS):
                gap = parts - self.entries[self.order[np.clip(at + step, 0, len(self.entries) - 1), d]]
                least = np.minimum(least, (gap * gap).sum(axis=1))
        return np.floor(np.sqrt(least.astype(np.float64))).astype(np.int64) + 1

    def candidates(self, parts: np.ndarray) -> np.ndarray:
        """Masks (rows x words) of the entries that can be nearest."""
        radius = self.first_radius(parts)
        kept = np.full((len(parts), self.words), ~np.uint64(0))
        for d in range(parts.shape[1]):
            below = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, side="left")
            upto = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, side="right")
            kept &= self.prefix[d, upto] ^ self.prefix[d, below]
        return kept

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the nearest entry of each part, ties to the lower one, and its squared distance."""
        place, error = np.zeros(len(parts), np.int64), np.zeros(len(parts), np.int64)
        many = len(self.entries)
        small = self.entries.shape[1] <= 512 and max(np.abs(self.entries).max(initial=0), np.abs(parts).max(initial=0)) <= _EXACT
        columns = self.entries.T.astype(np.float64)
        for begin in range(0, len(parts), STRIPE):
            some = slice(begin, begin + STRIPE)
            x = parts[some]
            bytes_ = self.candidates(x).astype("<u8", copy=False).view(np.uint8).reshape(len(x), -1)
            mask = np.unpackbits(bytes_, axis=1, bitorder="little", count=many).view(bool)
            if small and mask.mean() > DENSE:
                y = x.astype(np.float64)
                gaps = (y * y).sum(axis=1)[:, None] - 2 * (y @ columns) + self.lengths
                gaps[~mask] = np.inf
                place[some] = gaps.argmin(axis=1)
                error[some] = gaps[np.arange(len(x)), place[some]].astype(np.int64)
                continue
            row, entry = np.nonzero(mask)
            gap = np.empty(len(row), np.int64)
            for at in range(0, len(row), 1 << 16):
                part = slice(at, at + (1 << 16))
                between = x[row[part]] - self.entries[entry[part]]
                gap[part] = (between * between).sum(axis=1)
            best = np.lexsort((entry, gap, row))
            best = best[np.unique(row[best], return_index=True)[1]]
            place[some], error[some] = entry[best], gap[best]
        return place, error


def assigned(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (rows x parts) and squared distances of the nearest entries; ``books`` is parts x entries x width."""
    width = books.shape[2]
    found = [Slices(book).nearest(vectors[:, p * width : (p + 1) * width]) for p, book in enumerate(books)]
    return np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, embedding) with whole components of the rows that take part."""
    sound = vectors.filter("embedding is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")

    def floored(x):
        held = F.greatest(F.lit(-float(LARGEST)), F.least(F.lit(float(LARGEST)), x.cast("double") * scale))
        return F.floor(held).cast("bigint")

    return sound.select(F.col("vec_id").cast("bigint"), "label", F.transform("embedding", floored).alias("embedding"))


def _sums(books: np.ndarray, width: int):
    """Per task: count and componentwise sum of the parts of every entry that got any."""
    parts, entries, part_width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, part_width), np.int64)
        for batch in batches:
            vectors = matrix(batch.column("embedding"), width).astype(np.int64)
            place, _ = assigned(vectors, books)
            for p in range(parts):
                counts[p] += np.bincount(place[:, p], minlength=entries)
                np.add.at(sums[p], place[:, p], vectors[:, p * part_width : (p + 1) * part_width])
        part, entry = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "sums"],
        )

    return run


def learn(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width of a part) after ``rounds`` rounds; ``rows`` come from ``whole_vectors``."""
    part_width = width // parts
    first = rows.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    starts = np.zeros((len(first), width), np.int64)
    for i, row in enumerate(first):
        starts[i, : len(row[0])] = row[0]
    books = starts.reshape(len(first), parts, part_width).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        partial = rows.select("embedding").mapInArrow(_sums(books, width), "part int, entry int, n bigint, sums array<bigint>")
        total = partial.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(part_width)]).alias("sums")
        )
        for row in total.collect():  # at most parts x entries rows
            books[row["part"], row["entry"]] = [s // row["n"] for s in row["sums"]]
    return books


def books_text(books: np.ndarray) -> str:
    """All components by part, entry and position, comma-joined."""
    return ",".join(map(str, books.ravel().tolist()))


def coded(rows: DataFrame, books: np.ndarray, width: int) -> DataFrame:
    """(vec_id, label, code, error): two hex digits a part, and the squared distance added up over parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            place, error = assigned(matrix(batch.column("embedding"), width).astype(np.int64), books)
            code = pa.array([bytes(p).hex() for p in place.astype(np.uint8)], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), code, pa.array(error.sum(axis=1))], names=["vec_id", "label", "code", "error"]
            )

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id bigint, label {kind}, code string, error bigint")


def decoded(codes: DataFrame, books: np.ndarray, scale: int = SCALE) -> DataFrame:
    """(vec_id, embedding): the vectors that the codes stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [list(bytes.fromhex(c)) for c in batch.column("code").to_pylist()]
            vectors = [np.concatenate([books[p, e] for p, e in enumerate(place)]) / scale for place in places]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(vectors, pa.list_(pa.float64()))], names=["vec_id", "embedding"])

    return codes.select("vec_id", "code").mapInArrow(run, "vec_id bigint, embedding array<double>")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """The stored (vec_id, label, code, error) of all rows that take part, and the codebooks."""
    if entries > 256:
        raise ValueError("a code has two hex digits a part: at most 256 entries")
    rows = store(whole_vectors(vectors, scale), "whole-vectors")
    longest = rows.agg(F.max(F.size("embedding"))).first()[0] or 0
    width = max(parts, -(-longest // parts) * parts)
    books = learn(rows, width, parts, entries, rounds)
    return store(coded(rows, books, width), "vector-codes"), books


def code_report(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every row that takes part."""
    codes, books = compress(vectors)
    # summed per label first, so that a hot label meets its sum as one row
    sums = codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    met = codes.join(sums, F.col("label").eqNullSafe(F.col("of")), "left")
    digest = hashlib.sha256(books_text(books).encode()).hexdigest()
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
