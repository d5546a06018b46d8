"""Language of a text by prediction by partial matching (PPM).

Each language gets a tree of byte contexts of up to ``ORDER`` bytes, kept as counts of
byte strings. A byte costs its code length in the longest context that has seen it;
contexts that have not charge their escape on the way down (method C: escape
weight is the number of distinct followers), and below all contexts a byte costs 8 bits. Statistics
are frozen after fitting; the language with the shortest code of the whole text wins.

Fitting counts on a bounded sample: ``SAMPLE_DOCS`` documents a language at most, a document being
an id with a text, however often the row is repeated. Code lengths are whole multiples of 2**-16 bits, so sums do not
depend on how rows are dealt. Score: share of the winner among
2**-length of all languages. Texts that are null or have no letter, and all texts where nothing
was learned, give ``und`` with score 0. Ties go to the language first in code point order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashIndex, chunks, least, store, utf8

ORDER = 4
#: Documents a language is learned from.
SAMPLE_DOCS = 200
#: Bytes scored at once; longer texts take several turns.
BLOCK = 1 << 20
UNIT = 65536.0
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    """Whether a character of a letter category is in the text; ½, ² or Ⅷ are numbers."""
    return any(found.group().isalpha() for found in _LETTER.finditer(text))


def grams(data: np.ndarray, place: np.ndarray, order: int = ORDER) -> np.ndarray:
    """The byte string that ends at each byte, zeros before the text; ``place`` is the byte's place in its text."""
    out = data.astype(np.uint64)
    for back in range(1, order + 1):
        shifted = np.zeros(len(data), np.uint64)
        shifted[back:] = data[:-back]
        shifted[place < back] = 0
        out |= shifted << np.uint64(8 * back)
    return out


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS) -> DataFrame:
    """The ``per_language`` documents (text, lang) of every language with the least hash of id and text.

    Hashes are ranked without the texts, which are then looked up and stay where they are.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang", F.xxhash64("doc_id", "text").alias("_draw"))
    chosen = store(least(rows.select("lang", "_draw").distinct(), "lang", "_draw", per_language), "language-draws")
    found = rows.join(chosen, ["lang", "_draw"], "left_semi")
    return found.groupBy("lang", "_draw").agg(F.first("text").alias("text")).select("text", "lang")


def counted(rows: DataFrame, order: int = ORDER) -> DataFrame:
    """(lang, gram, n) of all byte strings of ``order`` + 1 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            data, ends = utf8(batch.column("text"))
            sizes = np.diff(ends)
            found = grams(data, np.arange(len(data)) - np.repeat(ends[:-1], sizes), order)
            langs = np.repeat(np.arange(len(sizes)), sizes)
            names = batch.column("lang").to_pylist()
            for lang in sorted(set(names)):
                mine = np.array([n == lang for n in names])
                keys, n = np.unique(found[mine[langs]], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Frozen code lengths of every known byte string, one column a language."""

    def __init__(self, counts: list[tuple[str, int, int]], order: int = ORDER) -> None:
        self.languages = sorted({c[0] for c in counts})
        self.order, many = order, len(self.languages)
        code = {lang: i for i, lang in enumerate(self.languages)}
        langs = np.array([code[c[0]] for c in counts], np.int64)
        keys = np.array([c[1] for c in counts], np.int64).astype(np.uint64)
        n = np.array([c[2] for c in counts], np.float64)
        self.levels: list[tuple[HashIndex, np.ndarray, HashIndex, np.ndarray]] = []
        for k in range(order + 1):
            own = keys & np.uint64((1 << 8 * (k + 1)) - 1)
            known, place = np.unique(own, return_inverse=True)
            table = np.zeros((len(known), many))
            np.add.at(table, (place, langs), n)
            contexts, context = np.unique(known >> np.uint64(8), return_inverse=True)
            total, distinct = np.zeros((len(contexts), many)), np.zeros((len(contexts), many))
            np.add.at(total, context, table)
            np.add.at(distinct, context, table > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0)
                seen = -np.log2(table / (total + distinct)[context])
            cost = np.where(table > 0, seen * UNIT, 0).round().astype(np.int32)
            escape = (escape * UNIT).round().astype(np.int32)
            lower = self._cost(known, k - 1)
            cost = np.where(table > 0, cost, escape[context] + lower).astype(np.int32)
            # The last row stands for what no language has seen.
            none = np.zeros((1, many), np.int32)
            self.levels.append((HashIndex(known), np.vstack([cost, none]), HashIndex(contexts), np.vstack([escape, none])))

    def _cost(self, keys: np.ndarray, level: int) -> np.ndarray:
        """Code lengths of the last byte of each string in contexts of up to ``level`` bytes."""
        if level < 0:
            return np.full((len(keys), len(self.languages)), int(8 * UNIT), np.int32)
        known, cost, contexts, escape = self.levels[level]
        own = keys & np.uint64((1 << 8 * (level + 1)) - 1)
        place = known.find(own)
        out = cost[place]
        missing = np.nonzero(place < 0)[0]
        if len(missing):
            out[missing] = escape[contexts.find(own[missing] >> np.uint64(8))] + self._cost(keys[missing], level - 1)
        return out

    def lengths(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Code length of each text in each language."""
        out = np.zeros((len(ends) - 1, len(self.languages)), np.int64)
        for begin in range(0, len(data), BLOCK):
            end, lead = min(len(data), begin + BLOCK), min(begin, self.order)
            first = int(np.searchsorted(ends, begin, side="right")) - 1
            last = int(np.searchsorted(ends, end, side="left"))
            cuts = np.clip(ends[first : last + 1], begin, end)
            sizes = np.diff(cuts)
            place = np.arange(begin, end) - np.repeat(ends[first:last], sizes)
            padded = np.concatenate([np.full(lead, self.order, np.int64), place])
            cost = self._cost(grams(data[begin - lead : end], padded, self.order)[lead:], self.order)
            texts = np.nonzero(sizes)[0]
            out[first + texts] += np.add.reduceat(cost, cuts[texts] - begin, axis=0, dtype=np.int64)
        return out


def fit(docs: DataFrame, per_language: int = SAMPLE_DOCS, order: int = ORDER) -> Model:
    """Learn from the rows given; counts are made on the cluster, the model fits the sample."""
    return Model([tuple(r) for r in counted(sample(docs, per_language), order).collect()], order)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            column = batch.column("text")
            data, ends = utf8(column)
            said = np.array([bool(t and has_letter(t)) for t in column.to_pylist()], bool)
            names, score = np.array([UNKNOWN] * batch.num_rows, object), np.zeros(batch.num_rows)
            if model.languages:
                lengths = model.lengths(data, ends)
                best = lengths.argmin(axis=1)
                behind = (lengths - lengths.min(axis=1)[:, None]) / UNIT
                names = np.where(said, np.array(model.languages, object)[best], UNKNOWN)
                score = np.where(said, 1 / np.exp2(-np.minimum(behind, 1000)).sum(axis=1), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(names.tolist(), pa.string()), pa.array(score, pa.float64())], names=["doc_id", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")
