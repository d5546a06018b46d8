"""Labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(text: Column | str) -> Column:
    """Upper-case the first letter of every word split on ``_`` or blanks.

    The rest of each word keeps its case, which is why ``initcap`` is not used.
    """
    words = F.filter(
        F.split(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), r"[_\s]+"),
        lambda w: F.length(w) > 0,
    )
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(w.substr(F.lit(1), F.lit(1))), w.substr(F.lit(2), F.length(w)))),
        " ",
    )


def product_label(name: Column | str, product_id: Column | str) -> Column:
    """Name, else ``SKU <id>``, else ``Unknown product`` (blank and 0 count as missing)."""
    n = F.col(name) if isinstance(name, str) else name
    p = F.col(product_id) if isinstance(product_id, str) else product_id
    return F.coalesce(
        F.when(n != "", n),
        F.when(p != 0, F.concat(F.lit("SKU "), p.cast("string"))),
        F.lit("Unknown product"),
    )


def direction(delta: Column | str) -> Column:
    """``up`` when delta >= 0, ``down`` below, NULL stays NULL."""
    d = F.col(delta) if isinstance(delta, str) else delta
    return F.when(d >= 0, "up").when(d < 0, "down")
