"""Byte-level BPE encoding and decoding with a published rank file.

Method: distinct pieces are laid into padded integer matrices by length. In every
round each row merges its leftmost pair of the lowest rank; pairs are looked up
in an open-addressing hash table; the row is compacted and finished rows leave the
matrix. Rows longer than ``LONG`` bytes would need as many rounds as bytes over
their whole width, so those keep the same order of merges with a heap.

Each match of the split pattern is encoded on its own; a piece that is a
token is that token, as in the reference library. Null texts count as empty and have no
ids; rows are independent, so ties, repeated rows and extra columns change nothing.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import heapq
import itertools
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import HashIndex, Pieces, bounded, chunks, texts

#: Rows of more bytes are merged with a heap.
LONG = 256
#: Upper ends of the length buckets; the last one is LONG.
WIDTHS = (4, 8, 12, 16, 24, 32, 64, 128, LONG)
#: Rows of a matrix of width 16; wider ones have fewer.
ROWS = 8192

#: Text bytes split at once; their pieces take some fifteen times as much.
ENCODE_BYTES = 1 << 20

_NONE = np.int32(2**31 - 1)


#: Characters for which a fixed list of letters, digits and white space decides the split.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_UNPLAIN = re.compile(rf"[^\x00-\x7f{_LETTERS}]")
#: What the classes of a pattern hold among those characters.
_PLAIN = {r"\p{L}": _LETTERS, r"\p{N}": "0-9", r"\s": r"\t-\r ", r"\S": None}


def splitters(pattern: str) -> tuple:
    """The pattern for any text, and a faster one, equal to it on texts of plain characters.

    White space is taken as Unicode has it, not as Python does. A pattern with classes
    other than letters, numbers and white space has no faster form.
    """
    full = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
    out, within = [], False
    for part in re.findall(r"\\[pP]\{\w+\}|\\.|.", pattern, re.S):
        if part.startswith("\\") and part not in _PLAIN or within and part == r"\S":
            return full, full
        if part == r"\S":
            out.append(rf"[^{_PLAIN[chr(92) + 's']}]")
        elif part in _PLAIN:
            out.append(_PLAIN[part] if within else f"[{_PLAIN[part]}]")
        else:
            within = part == "[" or within and part != "]"
            out.append(part)
    return full, re.compile("".join(out))


def rank_lines(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def read_ranks(path: str) -> dict[bytes, int]:
    return parsed_ranks(rank_lines(path))


def parsed_ranks(lines: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines())}


class PairTable:
    """(left id, right id) -> id of the merged token; its id is also its rank."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.index = HashIndex(np.array(keys, np.uint64))
        self.values = np.array([*values, _NONE], np.int32)  # the last one stands for no such pair

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged ids of the pairs; ``_NONE`` where there is none."""
        return self.values[self.index.find(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64))]


def merge_matrix(ids: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge the padded rows of ``ids`` to the end.

    Returns the rows in the order in which they were finished, their lengths,
    and their ids one after another.
    """
    rows, width = ids.shape
    order, columns = np.arange(rows), np.arange(width)
    done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ranks = np.full((rows, width), _NONE, np.int32)
    row, column = np.nonzero(columns[None, :] < lengths[:, None] - 1)
    ranks[row, column] = pairs.find(ids[row, column], ids[row, column + 1])
    while True:
        at = ranks.argmin(axis=1)
        merged = ranks[np.arange(len(order)), at]
        over = merged == _NONE
        if over.any():
            done.append((order[over], lengths[over], ids[over][columns[None, :] < lengths[over][:, None]]))
            if over.all():
                return tuple(np.concatenate(x) for x in zip(*done))  # type: ignore[return-value]
            ids, ranks, lengths, order, at, merged = (x[~over] for x in (ids, ranks, lengths, order, at, merged))
            width = max(4, int(lengths.max()))  # the longest row that is left
            ids, ranks, columns = ids[:, :width], ranks[:, :width], columns[:width]
            width = ids.shape[1]
        every = np.arange(len(order))
        ids[every, at] = merged
        ids = np.take_along_axis(ids, np.minimum(columns + (columns > at[:, None]), width - 1), 1)
        ranks = np.take_along_axis(ranks, np.minimum(columns + (columns >= at[:, None]), width - 1), 1)
        ranks[:, -1] = _NONE
        lengths = lengths - 1
        ranks[every, at] = _NONE
        right = np.nonzero(at < lengths - 1)[0]
        ranks[right, at[right]] = pairs.find(ids[right, at[right]], ids[right, at[right] + 1])
        left = np.nonzero(at > 0)[0]
        ranks[left, at[left] - 1] = pairs.find(ids[left, at[left] - 1], ids[left, at[left]])


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> np.ndarray:
    """The same merges in the same order for one long piece, by heap and links."""
    size = len(piece)
    nexts, prevs = list(range(1, size + 1)), list(range(-1, size - 1))
    alive = [True] * size

    def rank(i: int) -> int | None:
        j = nexts[i]
        return ranks.get(piece[i : nexts[j]]) if j < size else None

    current = [rank(i) for i in range(size)]
    heap = [(r, i) for i, r in enumerate(current) if r is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if not alive[i] or current[i] != r:
            continue
        j = nexts[i]
        alive[j], nexts[i] = False, nexts[j]
        if nexts[j] < size:
            prevs[nexts[j]] = i
        for k in (i, prevs[i]):
            if k >= 0:
                current[k] = rank(k)
                if current[k] is not None:
                    heapq.heappush(heap, (current[k], k))
    cuts = [i for i in range(size) if alive[i]] + [size]
    return np.array([ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])], np.int32)


class Encoder:
    """Encodes lists of texts; known pieces keep their ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pairs = ranks, PairTable(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.split, self.plain_split = splitters(pattern)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.pieces = Pieces()

    def encode_pieces(self, pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct pieces in another order, their ids one after another, and how many each has."""
        keys: list[str] = []
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        raw = [p.encode("utf-8") for p in pieces]
        whole = list(map(self.ranks.get, raw))
        buckets: dict[int, list[int]] = {}
        for i, (rank, piece) in enumerate(zip(whole, raw)):
            if rank is not None:
                keys.append(pieces[i])
            elif len(piece) <= LONG:
                buckets.setdefault(WIDTHS[bisect.bisect_left(WIDTHS, len(piece))], []).append(i)
        ids.append(np.array([r for r in whole if r is not None], np.int32))
        lengths.append(np.ones(len(keys), np.int64))
        for i, piece in enumerate(raw):
            if len(piece) > LONG and whole[i] is None:
                keys.append(pieces[i])
                ids.append(merge_long(piece, self.ranks))
                lengths.append(np.array([len(ids[-1])]))
        for width, members in buckets.items():
            rows = max(1, (ROWS * 16) // width)
            for begin in range(0, len(members), rows):
                part = members[begin : begin + rows]
                sizes = np.fromiter((len(raw[i]) for i in part), np.int64, len(part))
                matrix = np.zeros((len(part), width), np.int32)
                matrix[np.arange(width) < sizes[:, None]] = self.byte_ids[np.frombuffer(b"".join([raw[i] for i in part]), np.uint8)]
                order, own, flat = merge_matrix(matrix, sizes, self.pairs)
                keys += [pieces[part[i]] for i in order.tolist()]
                ids.append(flat)
                lengths.append(own)
        return keys, np.concatenate(ids), np.concatenate(lengths)

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each text has."""
        split = [(self.split if _UNPLAIN.search(t) else self.plain_split).findall(t) for t in batch]
        flat = list(itertools.chain.from_iterable(split))
        new = self.pieces.missing(flat)
        if new:
            if not self.pieces.codes:
                new = list(set(flat))
            self.pieces.add(*self.encode_pieces(new))
        return self.pieces.ids_of(flat, np.fromiter(map(len, split), np.int64, len(split)))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


@lru_cache(maxsize=1)
def encoder_for(lines: bytes, pattern: str) -> Encoder:
    """One encoder per worker, so that its pieces serve all tasks there."""
    return Encoder(parsed_ranks(lines), pattern)


def _rows(docs: DataFrame, rank_path: str, pattern: str, with_ids: bool) -> DataFrame:
    """The rank file is read on the driver and sent along with the tasks (about 1 MB), so executors need no copy."""
    lines = rank_lines(rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(lines, pattern)
        for batch in chunks(batches, limit=ENCODE_BYTES):
            ids, counts = encoder.encode(texts(batch))
            ends = np.concatenate([[0], np.cumsum(counts)])
            own = [ids[a:b] for a, b in zip(ends, ends[1:])]
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(",".join(map(str, i.tolist())).encode()).hexdigest() for i in own], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(encoder.decode(i)).hexdigest() for i in own], pa.string()),
            }
            if with_ids:
                columns["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_pydict(columns)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return bounded(docs).select("doc_id", "text").mapInArrow(run, schema)


def encoded(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, both digests, and the ids."""
    return _rows(docs, rank_path, pattern, True)


def digests(docs: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """One row per document: number of ids, digests of the ids and of the bytes they decode to."""
    return _rows(docs, rank_path, pattern, False)


def decoded(tokens: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """(doc_id, text) of rows with ``ids``; bytes that are no UTF-8 show as replacement characters."""
    lines = rank_lines(rank_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(lines, pattern)
        for batch in batches:
            own = [encoder.decode(np.array(i or [], np.int64)).decode("utf-8", "replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.string())], names=["doc_id", "text"])

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
