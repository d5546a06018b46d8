"""Lines repeated across documents, dropped by per-document keep bitmaps.

A line's key is the line without white space at its ends, A-Z lower-cased; it travels as two 64-bit
hashes, never as text. The work, all in DataFrame functions:

1. Lines are counted per key, combined before the shuffle, so that a key with a third of all lines is
   one row per map task. Only keys counted often enough go on.
2. Their lines are range-partitioned by key, then document (largest id first) and position, and sorted
   likewise. A hot key spans many ranges. The number of the range is written with the rows.
3. Each range streams its keys: the first line of every document is its occurrence there.
   Occurrences, combined over ranges, give a key's documents and its first document.
4. All lines of a repeated key outside its first document become bits: 64 lines a word, words without a
   dropped line left out. Only these bitmaps meet the texts again.

A document is an id: rows sharing an id count once towards a key, and rows with a null id count as one
document below all others. Rows of the first document all keep their lines. Null and empty
texts have one empty line. Empty tables give empty results. Rows with equal id and text
share a bitmap. Other columns pass through ``deduplicated`` whatever their names. Two keys whose
hashes (128 bits) are equal would count as one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import scratch_path, scratch_scope
from .common import store

STRIP = " \t\n\v\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Code points a key has at least, and documents that hold it, before its lines are dropped.
KEY_CHARS = 20
DOCUMENTS = 3

_KEY = ["h1", "h2"]


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; the plain function where all characters are ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def _point() -> Column:
    """What tells rows of one id apart."""
    return F.xxhash64("text").alias("point")


def key_lines(docs: DataFrame, key_chars: int = KEY_CHARS) -> DataFrame:
    """(doc_id, point, pos, h1, h2) of each line whose key is long enough."""
    lines = docs.select("doc_id", _point(), F.posexplode(F.split(ascii_lower(_text()), "\n", -1)).alias("pos", "line"))
    keys = lines.withColumn("line", F.btrim("line", F.lit(STRIP))).filter(F.char_length("line") >= key_chars)
    return keys.select("doc_id", "point", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"))


def repeated_keys(lines: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """Keys that have enough lines to be in so many documents."""
    return lines.groupBy(*_KEY).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= documents).select(*_KEY)


def in_ranges(lines: DataFrame) -> DataFrame:
    """The lines stored in ranges of key, document and position, each with its range as ``part``."""
    order = [*_KEY, F.col("doc_id").desc_nulls_last(), "point", "pos"]
    return store(lines.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "line-ranges")


def first_documents(ranged: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """(h1, h2, first) of keys in enough documents, from the first occurrences each range streams."""
    within = Window.partitionBy("part", *_KEY).orderBy(F.col("doc_id").desc_nulls_last(), "point", "pos")
    opens = (F.row_number().over(within) == 1) | ~F.col("doc_id").eqNullSafe(F.lag("doc_id").over(within))
    starts = ranged.withColumn("opens", opens).filter("opens")
    # a document may open in two neighbouring ranges
    keys = starts.groupBy(*_KEY).agg(F.count_distinct(F.struct("doc_id")).alias("n"), F.max("doc_id").alias("first"))
    return keys.filter(F.col("n") >= documents).select(*_KEY, "first")


def drop_bitmaps(docs: DataFrame, key_chars: int = KEY_CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """(doc_id, point, n_dropped, words) of documents that lose lines.

    ``words`` holds (word, dropped) in order: bit ``b`` of word ``w`` is set when line ``64 * w + b`` goes.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "line-bitmaps")
    with scratch_scope(spark):
        lines = key_lines(docs, key_chars)
        often = store(repeated_keys(lines, documents), "line-keys")
        # stored first, as a range partitioning reads its input twice
        ranged = in_ranges(store(lines.join(often, _KEY), "line-repeats"))
        firsts = store(first_documents(ranged, documents), "line-firsts")
        gone = ranged.join(firsts, _KEY).filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("first")))
        bits = gone.groupBy("doc_id", "point", F.expr("pos div 64").cast("int").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, pos % 64)")).alias("dropped")
        )
        bitmaps = bits.groupBy("doc_id", "point").agg(
            F.sum(F.bit_count("dropped")).alias("n_dropped"),
            F.array_sort(F.collect_list(F.struct("word", "dropped"))).alias("words"),
        )
        bitmaps.write.parquet(path)
    return spark.read.schema(bitmaps.schema).parquet(path)


def _positions(words: Column) -> Column:
    """Numbers of the dropped lines, ascending."""
    bits = F.sequence(F.lit(0), F.lit(63))
    return F.flatten(
        F.transform(words, lambda w: F.transform(F.filter(bits, lambda b: F.getbit(w["dropped"], b) == 1), lambda b: w["word"] * 64 + b))
    )


def kept_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """(row, n_lines, n_dropped, kept): every row of ``docs`` as one struct, and its text without the dropped lines."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias("_id"), _point().alias("_point"))
    marks = bitmaps.select(F.col("doc_id").alias("_of"), F.col("point").alias("_at"), "n_dropped", "words")
    met = rows.join(marks, F.col("_id").eqNullSafe(F.col("_of")) & (F.col("_point") == F.col("_at")), "left")
    text = F.coalesce("row.text", F.lit(""))
    split = met.select("row", "n_dropped", F.split(text, "\n", -1).alias("lines"), _positions(F.col("words")).alias("gone"))
    lines, gone = F.col("lines"), F.col("gone")

    def run(i: Column) -> Column:
        """Lines between two dropped ones."""
        begin = F.when(i > 0, F.get(gone, i - 1) + 1).otherwise(0)
        end = F.coalesce(F.get(gone, i), F.size(lines))
        return F.slice(lines, begin + 1, end - begin)

    runs = F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), run))
    return split.select(
        "row",
        F.size(lines).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(gone.isNull(), F.coalesce("row.text", F.lit(""))).otherwise(F.array_join(runs, "\n")).alias("kept"),
    )


def deduplicated(docs: DataFrame, key_chars: int = KEY_CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """``docs`` with texts that have lost their repeated lines; null texts stay null."""
    kept = kept_lines(docs, drop_bitmaps(docs, key_chars, documents))
    text = F.when(F.col("row.text").isNotNull(), F.col("kept")).alias("text")
    return kept.select(*[text if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def digests(docs: DataFrame, key_chars: int = KEY_CHARS, documents: int = DOCUMENTS) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    kept = kept_lines(docs.select("doc_id", "text"), drop_bitmaps(docs, key_chars, documents))
    return kept.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
