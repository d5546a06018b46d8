"""Helpers the operators share: Arrow text access, chunks bounded by bytes, stored tables."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path

#: Text bytes a Python worker handles at once; longer texts make a chunk of their own.
CHUNK_BYTES = 2 << 20

#: Bytes of an Arrow batch on its way to a worker. A task holds several batches, in the JVM and in the worker;
#: at Spark's default of 64 MB those of two tasks are a fifth of a small executor.
BATCH_BYTES = 4 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", 64 << 20

#: White space of the contracts: space, tab, line feed, vertical tab, form feed, return.
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def share_package(spark: SparkSession) -> None:
    """Put this package on the Python path of workers that see the driver's files.

    On a cluster it is installed or sent with ``--py-files``; then this changes nothing.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, whose session from now on sends Arrow batches of ``BATCH_BYTES`` or one row, unless it has its own bound."""
    conf = docs.sparkSession.conf
    if conf.get(_BATCH_SETTING).removesuffix("b") == str(_BATCH_DEFAULT):
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return docs


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below ``spark.checkpoint.dir`` and read it back."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches that hold at most ``limit`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, begin = np.cumsum(sizes + 64), 0
        while begin < len(ends):
            base = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end
    pa.default_memory_pool().release_unused()  # the worker lives on, idle or with another operator


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [t or "" for t in batch.column(column).to_pylist()]


def replaced(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """The batch with columns of these names replaced, in the same order."""
    return pa.RecordBatch.from_arrays([columns.get(n, batch.column(i)) for i, n in enumerate(batch.schema.names)], names=batch.schema.names)


def held_out(doc_id: Column) -> Column:
    """The fold kept from all fitting: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def least(rows: DataFrame, group: str, draw: str, most: int, parts: int = 1024) -> DataFrame:
    """The ``most`` rows of each group with the least ``draw`` (a long).

    Ranked within hashed parts first, so that a group of any size reaches the last ranking with ``parts`` times ``most`` rows.
    """
    part = Window.partitionBy(group, F.pmod(F.xxhash64(draw), F.lit(parts))).orderBy(draw)
    for window in (part, Window.partitionBy(group).orderBy(draw)):
        rows = rows.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= most).drop("_rank")
    return rows


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the ranges ``starts[i] .. starts[i] + lengths[i]``, one after another."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(total)


_FREE = np.uint64(2**64 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class HashIndex:
    """Open addressing over distinct unsigned keys: the place of each key, or -1."""

    def __init__(self, keys: np.ndarray) -> None:
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.int64((1 << bits) - 1)
        self.keys, self.places = np.full(1 << bits, _FREE), np.full(1 << bits, -1, np.int32)
        left, place = keys.astype(np.uint64), np.arange(len(keys), dtype=np.int32)
        slots = self._slot(left)
        while len(left):
            put = np.zeros(len(slots), bool)
            put[np.unique(slots, return_index=True)[1]] = True
            put &= self.keys[slots] == _FREE
            self.keys[slots[put]], self.places[slots[put]] = left[put], place[put]
            left, place, slots = left[~put], place[~put], (slots[~put] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys * _MIX) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.places[slots], np.int32(-1))
        open_ = np.nonzero((there != keys) & (there != _FREE))[0]
        slots = (slots[open_] + 1) & self.mask
        while len(open_):
            there = self.keys[slots]
            hit = there == keys[open_]
            out[open_[hit]] = self.places[slots[hit]]
            on = ~hit & (there != _FREE)
            open_, slots = open_[on], (slots[on] + 1) & self.mask
        return out


class Pieces:
    """Distinct pieces of text with their ids, kept while a worker lives and emptied when full."""

    def __init__(self, most: int = 600_000) -> None:
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.codes: dict = {}
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int64)
        self.pool = np.zeros(8192, np.int32)
        self.used = 0

    def add(self, keys: list, ids: np.ndarray, lengths: np.ndarray) -> None:
        """Take in new keys; ``ids`` holds theirs one after another, ``lengths`` how many each has."""
        old, new, end = len(self.codes), len(self.codes) + len(keys), self.used + len(ids)
        while new > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        while end > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.codes.update(zip(keys, range(old, new)))
        self.lengths[old:new] = lengths
        self.starts[old:new] = self.used + np.cumsum(lengths) - lengths
        self.pool[self.used : end] = ids
        self.used = end

    def missing(self, keys: list) -> list:
        """Keys not yet known, each once; if too many are kept already, all are forgotten first."""
        if len(self.codes) > self.most or self.used > 8 * self.most:
            self.clear()
        return list(set(keys).difference(self.codes))

    def ids_of(self, keys: list, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all keys in order, and how many of them each text has."""
        return self.ids_at(self.places(keys), per_text)

    def places(self, keys: list) -> np.ndarray:
        return np.fromiter(map(self.codes.__getitem__, keys), np.int64, len(keys))

    def ids_at(self, codes: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What ``ids_of`` gives, for keys by their places."""
        lengths = self.lengths[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        return self.pool[ragged(self.starts[codes], lengths)], np.diff(ends[bounds])
