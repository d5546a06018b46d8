"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing column names."""

from __future__ import annotations

PROSE = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of mint and ginger under the old stone bridge near town"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, point bigint, score double, taken string, shard int"


def varied(i: int, words: int = 80) -> str:
    return " ".join(f"w{(i * 7919 + k * k * 31 + k) % 5003}" for k in range(words))


ROWS = [
    (1, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (2, PROSE, "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "  \n\t ", "fr", ""),
    (6, "one two", None, "a"),
    (7, "ONE  two\n", "de", "b"),
    (8, "Mail jo.doe@mail.example.org, tel +49 (30) 1234-5678, card 4111 1111 1111 1111, ip 10.0.0.255 10.0.0.256", "en", "c"),
    (9, varied(1, 20_000), "en", "a"),
    (10, varied(2), "xx", "é"),
    (11, varied(2) + " more", "xx", "é"),
    (12, varied(2)[:-6], "xx", "z"),
    (13, "don't  stop \x1c \x85 now 　 ß ÄÖ½ 12345 x\r\n", "de", "z"),
    (14, "12345 !!!", "en", "z"),
    (None, PROSE, "en", "a"),
    (None, None, None, None),
    (16, "aé" * 700, "fr", "b"),
]


def table(spark, rows):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 5, 6, 0.5, "t", 1) for r in rows], COLUMNS)
