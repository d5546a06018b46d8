"""Equivalent SQL of the operators that SQL can express."""

from __future__ import annotations

from .mixing import BLOCK_WORDS, MOST, SEED, SLOTS

#: Sainte-Laguë by ranked quotients, for one table of parties.
_SEATS = """
    {name}_listed AS (SELECT *, {house} AS house, CASE WHEN sum({votes}) OVER g > 0 THEN {votes} / sum({votes}) OVER g ELSE 0.0 END AS share, count(*) OVER g AS many
        FROM {parties} WINDOW g AS ({within})),
    {name}_based AS (SELECT *, CAST(floor(many * share) + 2 AS BIGINT) AS near FROM {name}_listed),
    {name}_open AS (SELECT *, greatest(0, CAST(floor(house * share) AS BIGINT) - near) AS base FROM {name}_based),
    {name}_k AS (SELECT *, house - (sum(base) OVER ({within})) AS left_over, unnest(range(base, base + 2 * near + 2)) AS k
        FROM (SELECT * FROM {name}_open)),
    {name}_won AS (SELECT *, row_number() OVER ({within} ORDER BY {votes} / (2 * k + 1) DESC, {order}, k) AS place
        FROM (SELECT * REPLACE (h.house - t.bases AS left_over) FROM {name}_k h JOIN (SELECT {key} AS tk, sum(base) AS bases FROM {name}_open GROUP BY ALL) t ON t.tk = {hkey})),
    {name} AS (SELECT {columns}, max(base) + count(*) FILTER (WHERE place <= left_over AND {votes} > 0) AS seats FROM {name}_won GROUP BY ALL)"""

MIXING = f"""
WITH sizes AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size FROM documents),
    drawn AS (SELECT *, md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS draw FROM sizes),
    slotted AS (SELECT *, CAST(CAST('0x' || draw[:8] AS BIGINT) % {SLOTS} AS VARCHAR) || coalesce('s' || source, 'n') AS shard FROM drawn),
    s1 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
    s2 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS pos, {MOST} * source_size AS cap FROM s1),
    s3 AS (SELECT *, (pos - 1) % 3 + 1 AS w FROM s2),
    s4 AS (SELECT *, (SELECT sum(source_size) FROM s1) - coalesce(sum(cap) OVER (ORDER BY cap * (6 // w), pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(w) OVER (ORDER BY cap * (6 // w), pos ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM s3),
    s5 AS (SELECT *, rest * w >= cap * w_left AS is_full FROM s4),
    s6 AS (SELECT source, pos, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE
        CAST((SELECT max(rest) FROM s5 WHERE NOT is_full) * w AS DOUBLE) / CAST((SELECT max(w_left) FROM s5 WHERE NOT is_full) AS DOUBLE) END AS target FROM s5),
    {_SEATS.format(name="given", parties="s6", within="PARTITION BY 1", house=f"(SELECT CAST(round(sum(target) / {BLOCK_WORDS}) AS BIGINT) FROM s6)", votes="target", order="pos", key="1", hkey="1", columns="source, pos, source_size, target").strip()},
    sh AS (SELECT a.shard, CAST(a.shard_size AS DOUBLE) AS shard_size, g.pos, g.source_size, g.target, g.seats AS source_seats
        FROM (SELECT shard, source, sum(size) AS shard_size FROM slotted GROUP BY ALL) a JOIN given g ON a.source IS NOT DISTINCT FROM g.source),
    {_SEATS.format(name="quota", parties="sh", within="PARTITION BY pos", house="source_seats", votes="shard_size", order="shard", key="pos", hkey="h.pos", columns="shard, shard_size, source_size, target, pos").strip()},
    q AS (SELECT shard, CAST(shard_size AS BIGINT) AS shard_size, source_size, target, least(CAST(seats * {BLOCK_WORDS} AS BIGINT), {MOST} * CAST(shard_size AS BIGINT)) AS quota FROM quota),
    d AS (SELECT s.doc_id, s.size, q.*, CASE WHEN q.shard_size > 0 THEN q.quota // q.shard_size ELSE 0 END AS rounds,
        coalesce(sum(s.size) OVER (PARTITION BY s.shard ORDER BY s.draw, s.doc_id NULLS FIRST, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
        FROM slotted s JOIN q USING (shard))
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(rounds * size + greatest(0, least(size, quota - rounds * shard_size - before)) AS BIGINT) AS taken FROM d
"""

EXACT_TOP_K = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
        FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""

NEIGHBOURS = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS length FROM v),
    scored AS (SELECT q.vec_id AS query_id, c.vec_id, greatest(-1.0, least(1.0, list_dot_product(q.e, c.e) / (q.length * c.length))) AS score
        FROM n q JOIN n c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


LINE_DEDUP = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
    l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d),
    k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
    often AS (SELECT key, max(doc_id) AS first FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), '')) >= 3),
    marked AS (SELECT k.*, coalesce(o.key IS NOT NULL AND (k.doc_id IS NULL OR k.doc_id < o.first), FALSE) AS gone FROM k LEFT JOIN often o ON k.key = o.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """The rounds one after another: assign (a), then means of the parts that chose an entry (c)."""
    steps = [
        f"""v AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
            list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS (SELECT r, part, list_slice(e, part * len(e) // {parts} + 1, (part + 1) * len(e) // {parts}) AS x FROM v, range({parts}) t(part))",
        f"c0 AS (SELECT part, r - 1 AS entry, x FROM p WHERE r <= {entries})",
    ]
    for n in range(rounds + 1):
        steps.append(
            f"""a{n} AS (SELECT p.r, p.part, arg_min(c.entry, struct_pack(d := list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := c.entry)) AS entry,
            min(list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
            FROM p JOIN c{n} c USING (part) GROUP BY p.r, p.part)"""
        )
        if n < rounds:
            steps += [
                f"u{n} AS (SELECT part, entry, unnest(x) AS x, unnest(range(len(x))) AS i FROM a{n} JOIN p USING (r, part))",
                f"s{n} AS (SELECT part, entry, i, sum(x) AS s, count(*) AS n FROM u{n} GROUP BY ALL)",
                f"m{n} AS (SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS x FROM s{n} GROUP BY ALL)",
                f"c{n + 1} AS (SELECT part, entry, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN m{n} m USING (part, entry))",
            ]
    return f"""WITH {", ".join(steps)},
    k AS (SELECT sha256(coalesce(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry), '')) AS h FROM c{rounds}),
    o AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, k.h AS codebooks_sha256 FROM v JOIN o USING (r), k
"""


HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.e, c.e) AS BIGINT) AS score
        FROM v a JOIN v c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
    s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT s.same AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": MIXING,
        "op3_exact_top_k": EXACT_TOP_K,
        "op6_neighbours": NEIGHBOURS,
        "op11_line_dedup": LINE_DEDUP,
        "op12_vector_codes": _vector_codes(),
        "op13_hard_negatives": HARD_NEGATIVES,
    }
