"""Operators on whole tables: mixing, sharding, searches, the Jaccard join, the pipeline."""

from __future__ import annotations

import hashlib
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from cases import PROSE, varied
from pyspark.sql import functions as F

import __spark_entry__ as repo
from checks.compare import connection, differences, spark_rows, sql_rows
from tallycart.llm import graph, jaccard, mixing, mtree, neighbours, oracle, queries, sharding


FOLDER = "/root/testdata/sf0.001"
SPACE = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def db():
    return connection(FOLDER)


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_sql(spark, db, name):
    names, rows = spark_rows(queries.queries()[name](spark, FOLDER))
    expected_names, expected = sql_rows(db, oracle.oracle_sql()[name])
    assert names == expected_names and differences(rows, expected) == []


def test_registered():
    assert {*queries.queries(), "pipeline"} <= set(repo.queries()) and set(oracle.oracle_sql()) <= set(repo.oracle_sql())


def targets(sizes: dict) -> dict:
    """By raising the level in small parts: capped sources first, the excess shared by weight."""
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[n] for n in full)
        open_ = [n for n in names if n not in full]
        out = {n: 3 * sizes[n] if n in full else rest * weight[n] / sum(weight[m] for m in open_) for n in names}
        above = {n for n in open_ if out[n] > 3 * sizes[n]}
        if not above:
            return out
        full |= above


def plain_seats(votes: list, house: int) -> list:
    got = [0] * len(votes)
    for _ in range(house):
        best = max(range(len(votes)), key=lambda i: (votes[i] / (2 * got[i] + 1), -i))
        got[best] += 1
    return got


def test_seats_are_sainte_lague(spark):
    rng = np.random.default_rng(5)
    for case in range(6):
        votes = [float(v) for v in rng.integers(0, [9, 1000, 10**6][case % 3], 17)]
        house = int(rng.integers(0, 400))
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(votes)], "i int, v double")
        found = mixing.seats(rows, [], "v", "i", F.lit(house).cast("bigint")).collect()
        assert [r["seats"] for r in sorted(found, key=lambda r: r["i"])] == (plain_seats(votes, house) if sum(votes) else [0] * 17)


def test_mixing_cases(spark, docs, no_docs):
    rows = mixing.mix(mixing.sized(docs)).collect()
    again = mixing.mix(mixing.sized(docs)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == docs.count()
    by, want = {}, {}
    for r, source in [(r, r["source"]) for r in rows]:
        by[source] = by.get(source, 0) + r["size"]
        want[source] = want.get(source, 0) + r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    expected = targets(by)
    for r in rows:
        assert r["target"] == pytest.approx(expected[r["source"]]) and r["source_size"] == by[r["source"]]
    for source, total in want.items():
        assert abs(total - expected[source]) <= max(0.05 * expected[source], 3 * mixing.BLOCK_WORDS)
    text = mixing.taken_texts(docs)
    assert text.columns == docs.columns
    found: dict = {}
    for r in text.collect():
        found[r["source"]] = found.get(r["source"], 0) + len(re.findall(SPACE, r["text"]))
    assert found == {k: v for k, v in want.items() if v}
    assert mixing.mix(mixing.sized(no_docs)).count() == 0 and mixing.taken_texts(no_docs).count() == 0


def test_mix_takes_whole_documents(spark):
    """One document a source at most is cut, however few documents a shard has."""
    rows = [(i, " ".join([f"w{i}", "\tx "] * (i % 7 + 1)), f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    texts, whole, cut = {r[0]: r[1] for r in rows}, {}, {}
    for r in mixing.taken_texts(docs).collect():
        part = r["text"] != texts[r["doc_id"]]
        assert not part or texts[r["doc_id"]].split()[: len(r["text"].split())] == r["text"].split()
        (cut if part else whole).setdefault(r["source"], []).append(r["doc_id"])
    assert len(whole) == 3 and all(len(v) <= 1 for v in cut.values())
    assert all(len(whole[s]) > 20 for s in whole)


def test_capped_source_of_short_texts_gets_its_target(spark):
    """Its slots cannot hold a block of words each, the source can."""
    rows = [(i, 10_000 if i < 100 else 3, "a" if i < 100 else "b") for i in range(400)]
    found = mixing.mix(spark.createDataFrame(rows, "doc_id bigint, size bigint, source string")).collect()
    assert {r["target"] for r in found if r["source"] == "b"} == {2700.0}
    assert sum(r["taken"] for r in found if r["source"] == "b") == 2700


def test_mixing_runs_no_python(spark):
    plan = queries.op2_mixing(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)
    plan = queries.op4_sharding(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def check_shards(rows, texts):
    assert len(rows) == len(texts)
    places: dict = {}
    for r in rows:
        places.setdefault(r["shard"], []).append(r["slot"])
        assert r["shard"] in range(8)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_sharding_cases(spark, docs, no_docs):
    rows = sharding.shard(docs).collect()
    check_shards(rows, docs.collect())
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    assert all(r["size"] == len(texts[r["doc_id"]].encode()) + 1 and r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in rows if r["doc_id"])
    assert sharding.shard(no_docs).count() == 0


def test_sharding_evens_bytes_with_a_hot_id(spark):
    """A third of all rows on one id, a third of these alike, and null ids: loads within 1 %."""
    rows = [(7 if i % 3 == 0 else None if i % 3 == 1 and i % 2 else i, "same text" if i % 9 == 0 else f"text {i} " * (i % 5)) for i in range(90_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    found = sharding.shard(docs)
    loads = [r["b"] for r in found.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(loads) == 8 and max(loads) - min(loads) <= 0.01 * sum(loads) / 8
    rows = found.collect()
    check_shards(rows, docs.collect())
    again = sharding.shard(docs.repartition(4)).collect()
    assert sorted(rows, key=str) == sorted(again, key=str)
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 1) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["size"]) for r in rows) == want


def test_mixing_keeps_clashing_columns(spark):
    names = ["size", "taken", "target", "source_size", "_row", "_text", "_start", "a.b", "pos"]
    docs = spark.createDataFrame(
        [(i, f"w{i} x y", "ab"[i % 2], *[f"{n}{i}" for n in names]) for i in range(40)], ", ".join(["doc_id bigint", "text string", "source string", *[f"`{n}` string" for n in names]])
    )
    found = mixing.taken_texts(docs)
    assert found.columns == docs.columns
    rows = found.collect()
    assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)


def test_sharding_evens_bytes_and_moves_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    records = sharding.records(docs)
    slots = sharding.slot_bytes(records)
    first = sharding.first_map(slots)
    loads = [r["b"] for r in slots.join(first, "virtual").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert len(loads) == 8 and max(loads) - min(loads) <= 0.01 * sum(loads) / 8
    grown = slots.withColumn("bytes", F.when(F.col("virtual") % 16 == 0, F.col("bytes") * 4).otherwise(F.col("bytes")))
    second = sharding.rebalanced(first, grown)
    assert {r["version"] for r in second.select("version").distinct().collect()} == {1} and second.count() == first.count()
    loads = [r["b"] for r in grown.join(second, "virtual").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    before = [r["b"] for r in grown.join(first, "virtual").groupBy("shard").agg(F.sum("bytes").alias("b")).collect()]
    assert max(loads) < max(before) and max(loads) <= 1.05 * sum(loads) / 8
    moved = first.alias("a").join(second.alias("b"), "virtual").filter("a.shard <> b.shard").count()
    assert moved < 0.2 * first.count()
    same = sharding.rebalanced(first, slots)
    assert first.alias("a").join(same.alias("b"), "virtual").filter("a.shard <> b.shard").count() == 0


VECTORS = [(0, [1.0, 2.0, 2.0]), (50, [0.5, -0.25]), (1, [1.0, 2.0, 2.0]), (1, [1.0, 2.0, 2.0]), (2, None), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 1.0]), (5, [float("nan"), 1.0, 1.0]), (6, [float("inf"), 1.0, 0.0]), (7, [-1.0, -2.0, -2.0]), (None, [1.0, 1.0, 1.0]), (100, [0.001, 0.0, 0.5]), (8, [3.0, 0.1, 0.2])]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3) for i, v in rows], "vec_id bigint, embedding array<float>, region int, rank int, label int")


def plain_top(rows, score, every=50, k=5):
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        own = min(v for i, v in rows if i == q)
        best = sorted(((score(own, v), -i) for i, v in rows if i != q), reverse=True)[:k]
        out += [(q, n + 1, -i, s) for n, (s, i) in enumerate(best)]
    return out


def sound(rows, nonzero):
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    rows = [(i, v + [0.0] * (max(len(w) for _, w in rows) - len(v))) for i, v in rows]
    return [(i, v) for i, v in rows if any(v)] if nonzero else rows


def inner(a, b):
    return sum(int(np.floor(256 * x)) * int(np.floor(256 * y)) for x, y in zip(a, b))


def cosine(a, b):
    return float(neighbours.cosines(np.array([a]), np.array([b]))[0])


def test_searches_on_odd_vectors(spark):
    frame = vectors(spark, VECTORS)
    found = sorted(map(tuple, mtree.top_k(frame, regions=2, tree=3).collect()))
    assert found == plain_top(sound(VECTORS, False), inner)
    found = sorted(map(tuple, neighbours.nearest(frame, block=3, query_block=2).collect()))
    assert found == plain_top(sound(VECTORS, True), cosine)
    none = vectors(spark, [])
    assert mtree.top_k(none).count() == 0 and neighbours.nearest(none).count() == 0


def test_searches_on_groups_of_copies(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 16))
    rows = [(i, (centres[i % 6] + 0.3 * rng.normal(size=16)).tolist()) for i in range(600)] + [(600 + i, centres[0].tolist()) for i in range(300)]
    frame = vectors(spark, rows)
    own = sound(rows, False)
    assert sorted(map(tuple, mtree.top_k(frame, regions=4, tree=50).collect())) == plain_top(own, inner)
    assert sorted(map(tuple, neighbours.nearest(frame, block=100, query_block=7).collect())) == plain_top(own, cosine)


def test_tree_prunes_and_finds_all():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 8)) * 400
    data = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 20)
    longest = float((data * data).sum(axis=1).max())
    tree = mtree.Tree(np.arange(4000), data, longest)
    for q in range(0, 4000, 400):
        found = sorted(tree.search(q, data[q], 5), reverse=True)
        scores = data @ data[q]
        expected = sorted(((int(s), -i) for i, s in enumerate(scores) if i != q), reverse=True)[:5]
        assert [(s, -i) for s, i in found] == sorted(expected, reverse=True) or sorted((s, -i) for s, i in found) == sorted(expected)
    assert tree.computed < 0.7 * 10 * 4000


def test_tree_answers_many_queries_at_once(monkeypatch):
    monkeypatch.setattr(mtree, "HELD", 50)
    rng = np.random.default_rng(4)
    data = np.floor(rng.normal(size=(900, 6)) * 300)
    data[300:600] = data[0]  # a third of the rows are copies
    data[600:620] = 0
    ids = rng.permutation(2000)[:900]
    ids[700:710] = ids[0]  # a repeated id
    longest = float((data * data).sum(axis=1).max())
    tree = mtree.Tree(ids, data, longest, page=16)
    asked = np.r_[0:900:30, 605]
    floors = np.where(np.arange(len(asked)) % 3 == 0, np.sort(data[asked] @ data.T, axis=1)[:, -3], -np.inf)
    place, found, score = tree.search_all(ids[asked], data[asked], 5, floors)
    for i, q in enumerate(asked):
        rows = sorted((-int(s), int(v)) for s, v in zip(data @ data[q], ids) if v != ids[q] and s >= floors[i])[:5]
        assert [(-int(s), int(v)) for s, v in zip(score[place == i], found[place == i])] == rows
    none = mtree.Tree(ids[:0], data[:0], longest).search_all(ids[asked], data[asked], 5, floors)
    assert [len(x) for x in none] == [0, 0, 0]


def test_tile_bounds_hold():
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(50, 64)), rng.normal(size=(400, 64))
    found = sorted(neighbours.tile(np.arange(50) + 10_000, a, np.arange(400), b, 5), key=lambda r: (r[0], -r[2], r[1]))
    scores = np.array([neighbours.cosines(np.repeat(a[i : i + 1], 400, 0), b) for i in range(50)])
    expected = [(10_000 + i, int(j), float(scores[i, j])) for i in range(50) for j in np.lexsort((np.arange(400), -scores[i]))[:5]]
    assert found == expected


def plain_components(rows, words=4, t=85):
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = []
    for _, text in rows:
        w = re.findall(SPACE, (text or "").translate(lower))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= t * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    out = []
    for (doc_id, _), own, g in zip(rows, sets, group):
        ids = [rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None]
        out.append((doc_id, len(own), min(ids, default=None) if own else doc_id))
    return sorted(out, key=str)


def found_components(frame, rule=jaccard.RULE):
    return sorted(map(tuple, jaccard.components(frame, rule).collect()), key=str)


def test_jaccard_cases(spark, docs, no_docs):
    assert found_components(docs) == plain_components([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert jaccard.components(no_docs).count() == 0
    kept = jaccard.representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    groups = {c for _, n, c in found_components(docs) if n}
    empty = [r["doc_id"] for r in docs.collect() if not (r["text"] or "").strip(" \t\n\r\x0b\x0c")]
    assert ids == sorted([*groups, *empty], key=str)


@pytest.mark.parametrize("cell, block", [(4096, 512), (8, 5)])
def test_jaccard_chains_and_shared_passages(spark, monkeypatch, cell, block):
    """Chains of edits, texts around one passage, and a large group of near copies; also with cells cut and blocks."""
    monkeypatch.setattr(jaccard, "CELL", cell)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PIVOTS", 4 if cell == 8 else 16)
    rows, n = [], 0
    for base in range(4):
        words = varied(base + 10, 90).split()
        for step in range(25):
            rows.append((n, " ".join(words)))
            words[(step * 7) % 90] = f"x{base}-{step}"
            n += 1
    for i in range(40):
        rows.append((n, f"{varied(100 + i, 25)} {PROSE} {varied(200 + i, 12)}"))
        n += 1
    for i in range(60):
        words = varied(77, 70).split()
        words[i % 70] = f"y{i}"
        words[(i * 3 + 1) % 70] = f"z{i}"
        rows.append((n, " ".join(words)))
        n += 1
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert found_components(frame) == plain_components(rows)
    assert found_components(frame, jaccard.Rule(5, 80)) == plain_components(rows, 5, 80)


def test_cell_links_span_all_links():
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**62, 60, dtype=np.uint64)
    sets = []
    for i in range(90):
        own = base.copy() if i < 60 else rng.integers(0, 2**62, 60, dtype=np.uint64)
        own[rng.integers(0, 60, i % 9)] = rng.integers(0, 2**62, i % 9, dtype=np.uint64)
        sets.append(np.unique(own))
    gaps = np.array([1 - len(np.intersect1d(s, sets[5])) / len(np.union1d(s, sets[5])) for s in sets])
    linked = {(i, j) for i in range(90) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}

    def groups(pairs):
        names = list(range(90))
        for a, b in pairs:
            x, y = names[a], names[b]
            names = [y if n == x else n for n in names]
        return {tuple(i for i in range(90) if names[i] == n) for n in names}

    for known in (gaps, np.full(90, np.nan)):
        found = jaccard.cell_links(np.arange(90), np.arange(90), known, np.zeros(90, int), sets)
        assert groups(found) == groups(linked) and len(found) == 90 - len(groups(linked))
        assert all((max(p), min(p)) in linked for p in found)
    side = np.arange(90) % 2
    found = jaccard.cell_links(np.arange(90), np.arange(90), gaps, side, sets)
    assert groups(found) == groups({p for p in linked if side[p[0]] != side[p[1]]})


def test_jaccard_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op8_jaccard(spark, FOLDER).collect()), key=str) == plain_components([tuple(r) for r in docs])


def test_window_never_loses_a_pair():
    for n in range(1, 400):
        for m in range(n, n * 100 // 85 + 2):
            both = -(-85 * (n + m) // 185)
            if both <= n and 100 * both >= 85 * (n + m - both):
                rule = jaccard.RULE
                assert both >= rule.overlap(m) >= rule.overlap(n)
                least = min(jaccard.meetings(n), jaccard.meetings(m))
                assert least >= jaccard.meetings(rule.overlap(n)) and least >= jaccard.meetings(rule.overlap(m))


def test_connected(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (60, 50), (50, 60)]
    found = {r["node"]: r["component"] for r in graph.connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 50: 50, 60: 50}
    assert graph.connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_pipeline(spark, tmp_path):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert len(corpus_pipeline.STAGES) == 5 and rows
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == names
        path = str(tmp_path / stage.__name__)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    texts: dict = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(hashlib.sha256(r["text"].encode()).hexdigest())
    found: dict = {}
    for r in rows:
        assert len(r["ids"]) == r["n_tokens"] and hashlib.sha256(",".join(map(str, r["ids"])).encode()).hexdigest() == r["ids_sha256"]
        found.setdefault(r["doc_id"], []).append(r["decoded_sha256"])
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in texts.items()}
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty_out = stage(spark, empty, FOLDER)
        assert empty_out.count() == 0
