"""Token ids in Parquet files that can be read selectively.

Format: one row per document in ascending id order with ``doc_id``, ``file_no``,
``file_start`` (ids of the documents before it in its file), ``n_tokens``
and ``ids`` as a list column. Files are ranges of ids, so their order is the order of
the corpus. Row groups and pages have a set size; dictionaries are off for the
ids and the second page version is used, which stores integers as deltas; the writer adds page
indexes over ``doc_id``, so that a filter on it reads the pages it needs, and
a read of counts leaves the ids untouched.

Null texts count as empty (they hold the end id alone). Rows with a null id
come first. Repeated ids keep one row each, in any order among themselves; files also cut
between rows of one id, by the hash of the text.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Pieces, chunks, store, utf8

ROW_GROUP_BYTES = 8 << 20
PAGE_BYTES = 128 << 10
#: Text bytes encoded at once: the more, the fewer words are looked up again.
ENCODE_BYTES = 4 << 20
#: Words given to the tokenizer at once, whose results are large objects, and words kept by a worker.
BATCH, WORDS_KEPT = 4096, 300_000
#: Up to so many files (16 bytes each) their starts are broadcast; beyond it they are joined by exchange.
BROADCAST_FILES = 1_000_000


#: Marks that may end a word, none of them part of a special token, and what they are cut from:
#: digits, ASCII letters in lower case and letters of U+00C0 to U+00FF.
_MARKS = re.compile(r"(?<=[a-z0-9\xc0-\xd6\xd8-\xf6\xf8-\xff])([!-/:;=?@\[-`{}~]+)(?=[ \t-\r]|\Z)")
#: The same for Arrow, whose expressions look neither back nor ahead.
_MARKS_RE2 = (r"([a-z0-9\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([!-/:;=?@\[-`{}~]+)([ \t-\r]|\z)", r"\1 \2\3")
#: Words with a character of U+0300 to U+037F: all marks that compose with ASCII lie there.
_COMPOSED = re.compile(r"(?<![^ \t-\r])[^ \t-\r̀-Ϳ]*+[̀-Ϳ][^ \t-\r]*")
_WORDS = re.compile(r"[^ \t-\r]+")
_LOWER = {ord(c): c.lower() for c in string.ascii_uppercase}
#: Texts that Arrow must not change as a whole.
_ODD = r"<\||[\x{300}-\x{37f}]"
#: Stands for the end id among the words; no word has white space.
END = "\n"
#: Words of ASCII letters and letters of U+00C0 to U+00FF, and the steps that such a word passes lower-cased, whole and byte by byte.
_LETTERS = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_CUT = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
_PRE_TOKENIZERS = [
    {"type": "Split", "pattern": _CUT, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
#: The character a byte-level vocabulary has for each byte: itself, or the next of those from U+0100 on.
_BYTES = dict(zip([*_SHOWN, *(b for b in range(256) if b not in _SHOWN)], [*_SHOWN, *range(0x100, 0x144)]))


def letters_pass(definition: str) -> bool:
    """Whether the tokenizer hands a word of letters to its model whole, in lower case and as byte-level characters."""
    steps = json.loads(definition)
    return (
        steps["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZERS}
        and steps["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": _PRE_TOKENIZERS}
        and not any(steps[s] for s in ("post_processor", "truncation", "padding"))
        and not any(_LETTERS.search(t["content"]) and "<|" not in t["content"] for t in steps["added_tokens"])
    )


def split_words(text: str) -> list[str]:
    """Words at ASCII white space, so changed that fewer differ while their ids stay the same.

    What the tokenizer does itself is done first: lower case of ASCII, and a cut between a
    word and the marks that end it. It composes (NFC) before it lowers, so words with marks to
    compose stay as they are, and so do texts where lower case could make a special token.
    """
    if "<|" in text:
        return _WORDS.findall(text)
    out, at = [], 0
    for found in _COMPOSED.finditer(text):
        out += _WORDS.findall(_MARKS.sub(r" \1", text[at : found.start()].translate(_LOWER)))
        out.append(found[0])
        at = found.end()
    return out + _WORDS.findall(_MARKS.sub(r" \1", text[at:].translate(_LOWER)))


def split_texts(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of ``split_words`` of all texts, and how many each text has.

    Arrow splits whole columns; texts with a special token's beginning or a character of U+0300 to U+037F go
    through ``split_words`` one by one, and the words found come back joined by spaces.
    """
    data, ends = utf8(column)  # from their first byte on: slices that begin later come out of ascii_lower with wrong offsets
    column = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(np.ascontiguousarray(ends)), pa.py_buffer(data))
    plain = pc.replace_substring_regex(pc.ascii_lower(column), *_MARKS_RE2)
    odd = pc.match_substring_regex(column, _ODD)
    if pc.any(odd).as_py():
        split = [" ".join(split_words(t)) for t in column.filter(odd).to_pylist()]
        plain = pc.replace_with_mask(plain, odd, pa.array(split, pa.large_string()))
    lists = pc.ascii_split_whitespace(plain)
    words, text = pc.list_flatten(lists), pc.list_parent_indices(lists)
    full = pc.greater(pc.binary_length(words), 0)  # white space at an edge leaves empty strings
    return words.filter(full), np.bincount(text.filter(full).to_numpy(), minlength=len(column))


@lru_cache(maxsize=1)
def encoder_for(definition: str) -> WordEncoder:
    """One encoder per worker, so that its words serve all tasks there."""
    return WordEncoder(definition)


class WordEncoder:
    """Ids of texts by a tokenizer that starts anew at ASCII white space."""

    def __init__(self, definition: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.direct = letters_pass(definition)
        self.words = Pieces(most=WORDS_KEPT)

    def word_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Words of letters go to the tokenizer's model without the steps that leave them as they are."""
        letters = [self.direct and _LETTERS.fullmatch(w) is not None for w in words]
        others = iter(self.tokenizer.encode_batch_fast([w for w, plain in zip(words, letters) if not plain], add_special_tokens=False))
        pieces = self.tokenizer.model.tokenize

        def own(word: str) -> list[int]:
            word = word.lower()
            return [t.id for t in pieces(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES))]

        return [own(w) if plain else next(others).ids for w, plain in zip(words, letters)]

    def encode(self, column: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order, and how many each has; each distinct word is looked up once."""
        words, per_text = split_texts(column)
        coded = words.dictionary_encode()
        distinct = [*coded.dictionary.to_pylist(), END]
        new = self.words.missing(distinct)
        for at in range(0, len(new), BATCH):
            some = new[at : at + BATCH]
            own = [[end_id] if w == END else ids for w, ids in zip(some, self.word_ids(some))]
            self.words.add(some, np.fromiter(itertools.chain.from_iterable(own), np.int32), np.fromiter(map(len, own), np.int64, len(own)))
        places = self.words.places(distinct)
        ends = np.cumsum(per_text + 1)
        codes = np.full(len(words) + len(per_text), places[-1])
        inside = np.ones(len(codes), bool)
        inside[ends - 1] = False
        codes[inside] = places[coded.indices.to_numpy(zero_copy_only=False)]
        return self.words.ids_at(codes, per_text + 1)


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, path: str) -> None:
    """Encode ``docs`` and write the files below ``path``."""
    with open(tokenizer_path, encoding="utf-8") as file:
        definition = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number, start = encoder_for(definition), TaskContext.get().partitionId(), 0
        for batch in chunks(batches, limit=ENCODE_BYTES):
            ids, counts = encoder.encode(batch.column("text"), end_id)
            ends = np.concatenate([[0], np.cumsum(counts)])
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.full(rows, number, np.int32)),
                    pa.array(start + ends[:-1], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                ],
                names=["doc_id", "file_no", "file_start", "n_tokens", "ids"],
            )
            start += int(ends[-1])

    kind = docs.schema["doc_id"].dataType.simpleString()
    (
        docs.select("doc_id", "text", F.xxhash64("text").alias("_text"))
        .repartitionByRange("doc_id", "_text")  # the second key splits an id that many rows share
        .sortWithinPartitions("doc_id")
        .select("doc_id", "text")
        .mapInArrow(run, f"doc_id {kind}, file_no int, file_start bigint, n_tokens bigint, ids array<int>")
        .write.option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .parquet(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids) of the files below ``path``.

    ``start`` adds the ids of all earlier files to the place within the file;
    the sums are one row per file. Columns not selected are not read.
    """
    table = spark.read.parquet(path)
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    starts = table.groupBy("file_no").agg(F.sum("n_tokens").alias("_sum"))
    starts = starts.select("file_no", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    starts = store(starts, "token-starts")
    if starts.count() <= BROADCAST_FILES:
        starts = F.broadcast(starts)  # so that the ids stay where they are
    return table.join(starts, "file_no").select("doc_id", (F.col("_start") + F.col("file_start")).alias("start"), "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """The rows of ``read_tokens`` with ``ids_crc32`` instead of the ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            values = pc.list_flatten(ids).to_numpy(zero_copy_only=False).astype("<u4")
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
            crc = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )

    kind = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.mapInArrow(run, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint")
