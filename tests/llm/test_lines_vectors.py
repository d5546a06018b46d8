"""Line dedup, vector codes and hard negatives against brute force, on odd tables too."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict

import numpy as np
import pytest
from cases import ROWS, table

from tallycart.llm import codebooks, line_dedup, negatives

LONG = "This line is long enough, all of it"


def lines_expected(rows, key_chars=20, documents=3):
    """rows: (doc_id, text) -> (doc_id, n_lines, n_dropped, kept digest), in order."""
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(line_dedup.STRIP))

    held = defaultdict(set)
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= key_chars:
                held[key(line)].add(doc)
    first = {k: max(d for d in docs if d is not None) for k, docs in held.items() if len(docs) >= documents}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) in first and (doc is None or doc < first[key(x)]))]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=str)


def page(i):
    """Many lines, some in all pages, some in two, some short."""
    own = [f"only in page {i}, line {k}, nowhere else" for k in range(i % 5)]
    pair = [f"\tshared by TWO pages, numbered {i // 2}  "] if i % 3 else []
    return "\n".join(["  " + LONG.upper() + "\r", *own, "short", *pair, f"everybody has this line ({i % 4})", "", "ÄÖÜ äöü ÄÖÜ äöü ÄÖÜ äöü"])


TABLES = {
    "cases": [(r[0], r[1]) for r in ROWS],
    "pages": [(i, page(i)) for i in range(200)],
    "hot id": [(7 if i % 3 else i, page(i)) for i in range(150)],
    "null ids": [(None if i % 3 else i, page(i)) for i in range(60)],
    "long": [(i, "\n".join([LONG, *(f"line {k} of the long text, {k * i}" for k in range(3000)), LONG])) for i in range(4)],
    "two only": [(1, LONG), (1, LONG + "\n" + LONG), (2, LONG)],
    "one": [(1, None)],
}


@pytest.mark.parametrize("name", TABLES)
def test_lines(spark, name):
    rows = TABLES[name]
    found = line_dedup.digests(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert order(map(tuple, found)) == order(lines_expected(rows))


def test_lines_empty(no_docs):
    assert line_dedup.digests(no_docs).collect() == [] and line_dedup.deduplicated(no_docs).columns == no_docs.columns


def test_lines_keep_other_columns(spark):
    kind = "doc_id bigint, point string, text string, pos int, h1 string, words string, row string, lines int, n_dropped string, `_id` int, `a.b` int"
    rows = [(i, f"p{i}", page(i), i, "h", "w", "r", 5, "d", -i, i) for i in range(12)]
    found = {r["doc_id"]: r for r in line_dedup.deduplicated(spark.createDataFrame(rows, kind)).collect()}
    expected = lines_expected([(r[0], r[2]) for r in rows])
    for row, (doc, _, _, digest) in zip(rows, expected):
        got = tuple(found[doc])
        assert got[:2] == row[:2] and got[3:] == row[3:] and hashlib.sha256(got[2].encode()).hexdigest() == digest
    again = line_dedup.deduplicated(spark.createDataFrame([(1, None, "x")], "doc_id int, text string, source string"))
    assert [tuple(r) for r in again.collect()] == [(1, None, "x")]


def test_line_bitmaps_are_sparse(spark):
    rows = [(i, "\n".join(f"{k} of {i} is a line of its own" for k in range(640)) + "\n" + LONG) for i in range(3)]
    marks = line_dedup.drop_bitmaps(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {m["doc_id"]: [tuple(w) for w in m["words"]] for m in marks} == {0: [(10, 1)], 1: [(10, 1)]}


def test_lines_native(docs):
    plan = line_dedup.key_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


VECTORS = "vec_id bigint, embedding array<float>, label int, error string, code int, score double, rank string"


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "e", 1, 0.5, "r") for r in rows], VECTORS)


def random_rows(n, width, seed, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    out = []
    for i in range(n):
        label = int(rng.integers(labels))
        out.append((i, [float(np.float32(x)) for x in (centres[label] + spread * rng.normal(size=width)) / 8], label))
    return out


ODD = [
    (3000, None, 1),
    (3050, [0.1, None, 0.2], 1),
    (3100, [0.1, math.nan], 2),
    (3150, [math.inf, 0.1], 2),
    (3200, [0.25, -0.5], 1),
    (3250, [0.0] * 8, None),
    (3300, [], 0),
    (50, [0.5] * 8, 2),
    (50, [0.5] * 8, 2),
    (51, [0.25] * 8, 3),
    (None, [0.125] * 8, 2),
]


def sound(rows):
    return [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]


def filled(rows, scale, parts=1):
    width = max((len(r[1]) for r in rows), default=0)
    width = max(parts, -(-width // parts) * parts)
    return [[math.floor(scale * np.float32(x).astype(float)) for x in r[1]] + [0] * (width - len(r[1])) for r in rows]


def codes_expected(rows, parts=4, entries=256, rounds=4):
    rows = sorted(sound(rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = filled(rows, 1024, parts)
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for v in whole]
    books = [[list(v[p]) for v in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for v in cut:
            gaps = [[sum((a - b) ** 2 for a, b in zip(v[p], e)) for e in books[p]] for p in range(parts)]
            out.append([(min(range(len(g)), key=lambda i: (g[i], i)), min(g)) for g in gaps])
        return out

    for _ in range(rounds):
        chosen = assign()
        for p in range(parts):
            groups = defaultdict(list)
            for v, c in zip(cut, chosen):
                groups[c[p][0]].append(v[p])
            for e, members in groups.items():
                books[p][e] = [sum(x) // len(members) for x in zip(*members)]
    chosen = assign()
    sums = defaultdict(int)
    for r, c in zip(rows, chosen):
        sums[r[2]] += sum(d for _, d in c)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(r[0], bytes(e for e, _ in c).hex(), sum(d for _, d in c), sums[r[2]], digest) for r, c in zip(rows, chosen)]


VECTOR_TABLES = {
    "random": random_rows(400, 8, 1),
    "close": random_rows(300, 12, 2, spread=0.01),
    "odd": random_rows(100, 8, 3) + ODD,
    "ties": [(i, [0.25 * (i % 3)] * 4, i % 2) for i in range(40)],
    "uneven width": random_rows(30, 7, 4),
    "one": [(5, [0.1, 0.2, 0.3, 0.4], None)],
}


@pytest.mark.parametrize("name", VECTOR_TABLES)
def test_codes(spark, name):
    rows = VECTOR_TABLES[name]
    assert order(map(tuple, codebooks.code_report(vectors(spark, rows)).collect())) == order(codes_expected(rows))


def test_codes_empty(spark):
    assert codebooks.code_report(vectors(spark, [])).collect() == []
    assert codebooks.code_report(vectors(spark, [ODD[0]])).collect() == []


def test_candidates_hold_every_nearest_entry():
    rng = np.random.default_rng(5)
    for width, size, spread in ((2, 256, 500), (16, 256, 128), (4, 70, 3), (3, 1, 9)):
        entries, parts = rng.integers(-spread, spread, (size, width)), rng.integers(-spread, spread, (500, width))
        gaps = ((parts[:, None] - entries) ** 2).sum(axis=2)
        place, error = codebooks.Slices(entries).nearest(parts)
        assert (place == gaps.argmin(axis=1)).all() and (error == gaps.min(axis=1)).all()
        if width == 2:  # where vectors have few dimensions, the masks leave few candidates
            left = codebooks.Slices(entries).candidates(parts)
            assert np.unpackbits(left.view(np.uint8), axis=1).mean() < 0.05


def test_codes_of_large_components():
    entries = np.array([[1 << 24, -(1 << 24)], [-(1 << 24), 1 << 24], [0, 0]])
    place, error = codebooks.Slices(entries).nearest(np.array([[(1 << 24) - 1, -(1 << 24)], [1, 2]]))
    assert place.tolist() == [0, 2] and error.tolist() == [1, 5]


def test_decoded(spark):
    rows = random_rows(200, 8, 6)
    codes, books = codebooks.compress(vectors(spark, rows), entries=16)
    back = {r["vec_id"]: np.array(r["embedding"]) for r in codebooks.decoded(codes, books).collect()}
    for r in codes.collect():
        whole = np.floor(np.array(rows[r["vec_id"]][1]) * 1024)
        assert round(((whole - back[r["vec_id"]] * 1024) ** 2).sum()) == r["error"]


def negatives_expected(rows):
    rows = [r for r in sound(rows) if r[0] is not None and r[2] is not None]
    whole = [np.array(v, dtype=object) for v in filled(rows, 256)]
    label = [(r[2] + 1) % 10 if r[0] % 7 == 0 else r[2] for r in rows]
    anchors = {}
    for i, r in enumerate(rows):
        if r[0] % 50 == 0 and (r[0] not in anchors or (label[i], list(whole[i])) < (label[anchors[r[0]]], list(whole[anchors[r[0]]]))):
            anchors[r[0]] = i
    out = []
    for a in anchors.values():
        scored = sorted((-int(whole[a] @ whole[i]), rows[i][0], i) for i in range(len(rows)) if rows[i][0] != rows[a][0])
        for score, positive, _ in [s for s in scored if label[s[2]] == label[a]][:5]:
            fits = [s for s in scored if label[s[2]] != label[a] and 50 * -score <= 100 * -s[0] <= 95 * -score]
            out += [(rows[a][0], positive, rank + 1, s[1], -score, -s[0]) for rank, s in enumerate(fits[:3])]
    return out


@pytest.mark.parametrize("blocks", [(8192, 1024), (37, 2)])
@pytest.mark.parametrize("name", VECTOR_TABLES)
def test_negatives(spark, name, blocks):
    if blocks[0] == 37 and name not in ("random", "odd"):
        pytest.skip("small blocks once")
    rows = VECTOR_TABLES[name]
    if name == "random":  # a third of all rows share one label, and one id is repeated often
        rows = [(i, v, 1 if i % 3 == 0 else lab) for i, v, lab in rows] + [(100, v, lab) for _, v, lab in rows[:60]]
    found = negatives.mined(vectors(spark, rows), block=blocks[0], anchor_block=blocks[1]).collect()
    assert order(map(tuple, found)) == order(negatives_expected(rows))


def test_negatives_empty(spark):
    assert negatives.mined(vectors(spark, [])).collect() == []


def test_bounds_hold_the_score():
    rng = np.random.default_rng(8)
    for width in (1, 7, 64):
        a, b = (rng.integers(-300, 300, (50, width)).astype(float) for _ in range(2))
        last = None
        for length in (16, 4, 1):
            low, high = negatives.bounds(negatives.Summary(a, length), negatives.Summary(b, length))
            assert (low <= a @ b.T).all() and (a @ b.T <= high).all()
            gap = (high - low).mean()
            assert last is None or gap <= last + 1e-3  # finer segments bound closer
            last = gap
